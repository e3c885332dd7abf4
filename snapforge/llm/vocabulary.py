"""Public BPE vocabularies (.json with a word pattern and byte alphabet) and the text rules they come with.

The driver reads the file from a given path and broadcasts it: about 2 MB, whatever the data. Nothing is trained.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex

CHUNK = 1 << 16  # characters looked at in one go
SLICE_BYTES = 4 << 20  # text bytes of one output batch, unless one text is longer
WORD_END = "</w>"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if it has one, else the next free one from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens by number, and merges as ``(left, right) -> rank``; ``product[rank]`` is the merged token."""

    def __init__(self, content: str) -> None:
        data = json.loads(content)
        model, self.tokens = data["model"], {}
        numbers = model["vocab"]
        self.size = 1 + max([*numbers.values(), *(t["id"] for t in data["added_tokens"])])
        self.tokens = {n: t for t, n in numbers.items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.rank, self.product, self.parts = {}, [], {}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        for k, (a, b) in enumerate(pairs):
            a, b, made = numbers[a], numbers[b], numbers[a + b]
            self.rank.setdefault(a * self.size + b, k)
            self.parts.setdefault(made, (a, b))
            self.product.append(made)
        alphabet, suffix = byte_alphabet(), model["end_of_word_suffix"] or ""
        self.inner = [numbers[c] for c in alphabet]
        self.last = [numbers[c + suffix] for c in alphabet]
        self.word = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.patterns = Patterns(self.word)
        self._exact: Patterns | None = None
        self.special_text = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")

    def exact_patterns(self) -> Patterns:
        if self._exact is None:
            self._exact = Patterns(self.word, _later_letters())
        return self._exact

    def symbols(self, word: str) -> list[int]:
        """Numbers of the bytes of a whole word, the last one being a word end."""
        data = word.encode()
        return [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]


@lru_cache(maxsize=2)
def parsed(content: str) -> Vocabulary:
    """One vocabulary per Python worker, not per batch."""
    return Vocabulary(content)


def read_content(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def normalized(text: str) -> str:
    """NFC, then lower case character by character: a capital sigma has no final form."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _cut(text: str, begin: int, end: int) -> int:
    """The last place up to ``begin + CHUNK`` where no composition and no contraction goes on, else the next one."""

    def splits(p: int) -> bool:
        c, before = text[p], text[p - 1]
        if not (c.isascii() or "\u4e00" <= c <= "\u9fff"):
            return False  # it might combine with what stands before it
        return not (c.isalpha() and (before == "'" or text[p - 2] == "'" and before.isalpha()))

    if end - begin <= CHUNK:
        return end
    space = max(text.rfind(c, begin + 2, begin + CHUNK) for c in " \n")
    if space > 0:
        return space
    back = (p for p in range(begin + CHUNK - 1, begin + 1, -1) if splits(p))
    on = (p for p in range(begin + CHUNK, end) if splits(p))
    return next(back, None) or next(on, end)


def _chunks(text: str, begin: int, end: int) -> Iterator[tuple[str, bool]]:
    """Normalized chunks, and whether it is the last one."""
    while begin < end:
        upto = _cut(text, begin, end)
        yield normalized(text[begin:upto]), upto == end
        begin = upto


class Patterns:
    """The word pattern of a vocabulary, and what can continue a word at the end of a chunk."""

    def __init__(self, word: str, but: str = "") -> None:
        def exact(pattern: str) -> regex.Pattern:
            for name in (r"\p{L}", r"\p{N}"):
                pattern = pattern.replace(name, f"[{name}--[{but}]]") if but else pattern
            return regex.compile(pattern, regex.V1)

        self.word, self.runs = exact(word), (exact(r"\p{L}*"), exact(r"[^\s\p{L}\p{N}]*"))

    def run(self, word: str) -> int | None:
        """Number of the run that can go on after ``word``; nothing continues a digit or a contraction."""
        return next((k for k, run in enumerate(self.runs) if run.fullmatch(word)), None)


@lru_cache(maxsize=1)
def _later_letters() -> str:
    """Letters and digits of the regular expressions' Unicode version that are not assigned in Python's."""
    known = regex.compile(r"[\p{L}\p{N}]")
    later = [ord(c) for c in known.findall("".join(map(chr, range(0x110000)))) if unicodedata.category(c) == "Cn"]
    starts = [c for k, c in enumerate(later) if k == 0 or later[k - 1] != c - 1]
    ends = [c for k, c in enumerate(later) if k == len(later) - 1 or later[k + 1] != c + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


@lru_cache(maxsize=1)
def _later() -> frozenset[str]:
    """Those letters and digits one by one."""
    spans = regex.findall("(.)-(.)", _later_letters(), regex.DOTALL)
    return frozenset(chr(c) for a, b in spans for c in range(ord(a), ord(b) + 1))


def pieces(text: str, vocabulary: Vocabulary) -> Iterator[tuple[str, object]]:
    """A text in order: ``words`` (a list of whole words), ``part`` (some of a word that goes on over chunks), ``end``
    (of that word) and ``special`` (the number of a special token)."""
    begin = 0
    for match in vocabulary.special_text.finditer(text):
        yield from _words(text, begin, match.start(), vocabulary)
        yield "special", vocabulary.special[match[0]]
        begin = match.end()
    yield from _words(text, begin, len(text), vocabulary)


def _words(text: str, begin: int, end: int, vocabulary: Vocabulary) -> Iterator[tuple[str, object]]:
    run = None
    for chunk, is_last in _chunks(text, begin, end):
        patterns = vocabulary.patterns if chunk.isascii() or _later().isdisjoint(chunk) else vocabulary.exact_patterns()
        at = 0
        if run is not None:
            at = patterns.runs[run].match(chunk).end()
            yield "part", chunk[:at]
            if at == len(chunk) and not is_last:
                continue
            yield "end", None
        found, run = patterns.word.findall(chunk, at), None
        if found and not is_last and chunk.endswith(found[-1]):
            run = patterns.run(found[-1])
        open_word = found.pop() if run is not None else None
        yield "words", found
        if open_word is not None:
            yield "part", open_word


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about SLICE_BYTES of text, or one row."""
    texts = batch.column(column)
    sizes = [0 if v is None else v for v in pa.compute.binary_length(texts).to_pylist()]
    begin = held = 0
    for k, size in enumerate(sizes):
        if k > begin and held + size > SLICE_BYTES:
            yield batch.slice(begin, k - begin)
            begin, held = k, 0
        held += size
    if len(sizes) > begin:
        yield batch.slice(begin)


class Bounded(dict):
    """A cache that starts anew when full; ``find`` makes what is missing."""

    def __init__(self, find, most: int = 300_000) -> None:
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.find(key)
        return value

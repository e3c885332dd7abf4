"""BPE as a streaming transducer with bounded lookahead, and decoding as a byte-to-text state machine.

Whether two neighbouring symbols end up in one token depends on what follows only as far as a chain of merges can carry
a difference to the left. ``lookahead`` computes that distance from the merge list; a token that ends further back than
it is stable and leaves the buffer. So a word of any length is encoded with a buffer of twice that distance.

Rules: a null or empty text has no identifiers and decodes to the empty text; special strings inside a text give
their own identifiers. Repeated rows give equal results.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from snapforge.llm.common import table
from snapforge.llm.vocabulary import (WORD_END, Bounded, Vocabulary, byte_alphabet, parsed, pieces, read_content,
                                      slices)


def lookahead(vocabulary: Vocabulary) -> int:
    """Symbols that have to follow the end of a token before it is stable.

    Let two texts agree up to a place. A merge (u, v) can remove a boundary in one of them only if v reaches that place;
    then u ends at the boundary in one text and not in the other. The next boundary to the left, where u begins, can
    differ only by a later merge (u', v') whose v' begins with u: u is v' or on its left spine. So the distance is the
    heaviest chain of merges of rising rank, the length of the first v and of each u counted.
    """
    parts, length, carried, most = vocabulary.parts, {}, {}, 1

    def size(token: int) -> int:
        if token not in length:
            length[token] = sum(map(size, parts[token])) if token in parts else 1
        return length[token]

    for rank, made in sorted((vocabulary.rank[a * vocabulary.size + b], (a, b)) for a, b in parts.values()):
        u, v = made
        reach, spine = size(v), v
        while True:
            reach = max(reach, carried.get(spine, 0))
            if spine not in parts:
                break
            spine = parts[spine][0]
        carried[u] = max(carried.get(u, 0), reach + size(u))
        most = max(most, reach)
    return most + 1


def merged(symbols: list[int], vocabulary: Vocabulary) -> tuple[list[int], list[int]]:
    """Tokens of a buffer and where each ends, in symbols."""
    n, rank, product, size = len(symbols), vocabulary.rank, vocabulary.product, vocabulary.size
    at, following, previous = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := rank.get(at[i] * size + at[i + 1])) is not None]
    heapify(heap)
    while heap:
        r, i = heappop(heap)
        j = following[i]
        if at[i] < 0 or j >= n or rank.get(at[i] * size + at[j]) != r:
            continue
        at[i], at[j] = product[r], -1
        k = following[i] = following[j]
        if k < n:
            previous[k] = i
        for x, y in ((i, k), (previous[i], i)):
            if x >= 0 and y < n and (r := rank.get(at[x] * size + at[y])) is not None:
                heappush(heap, (r, x))
    places = [i for i in range(n) if at[i] >= 0]
    return [at[i] for i in places], [following[i] for i in places]


def merged_short(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """The tokens of a short word: without a heap, the pair of lowest rank is found by looking at all of them."""
    rank, product, size = vocabulary.rank.get, vocabulary.product, vocabulary.size
    none = len(product)
    at = list(symbols)
    ranks = [rank(a * size + b, none) for a, b in pairwise(at)]
    while ranks and (r := min(ranks)) < none:
        i = ranks.index(r)
        at[i:i + 2] = [product[r]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = rank(at[i] * size + at[i + 1], none)
        if i:
            ranks[i - 1] = rank(at[i - 1] * size + at[i], none)
    return at


class WordEncoder:
    """One word as a stream of bytes: ``feed`` returns what is stable, ``finish`` the rest."""

    def __init__(self, vocabulary: Vocabulary, ahead: int) -> None:
        self.vocabulary, self.ahead, self.most = vocabulary, ahead, max(2 * ahead, 64)
        self.held: list[int] = []
        self.last: int | None = None  # its symbol depends on whether the word ends here

    def feed(self, data: bytes) -> list[int]:
        out, inner = [], self.vocabulary.inner
        for byte in data:
            if self.last is not None:
                self.held.append(inner[self.last])
            self.last = byte
            if len(self.held) >= self.most:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        tokens, ends = merged(self.held, self.vocabulary)
        upto = len(self.held) - self.ahead
        count = next((k for k, end in enumerate(ends) if end > upto), len(ends))
        self.held = self.held[ends[count - 1]:] if count else self.held
        if not count:
            self.most *= 2  # cannot be: no token is as long as the lookahead
        return tokens[:count]

    def finish(self) -> list[int]:
        if self.last is None:
            return []
        tokens, _ = merged([*self.held, self.vocabulary.last[self.last]], self.vocabulary)
        self.held, self.last, self.most = [], None, max(2 * self.ahead, 64)
        return tokens


class Encoder:
    """Texts to identifiers, packed as 32-bit integers."""

    REMEMBERED = 64

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.ahead = lookahead(vocabulary)
        self.stream = WordEncoder(vocabulary, self.ahead)
        self.known = Bounded(self._short)

    def _short(self, word: str) -> bytes:
        return array("i", merged_short(self.vocabulary.symbols(word), self.vocabulary)).tobytes()

    def _word(self, word: str) -> bytes:
        return np.array(self.stream.feed(word.encode()) + self.stream.finish(), np.int32).tobytes()

    def parts(self, text: str) -> Iterator[bytes]:
        """Identifiers in order, as they become stable."""
        for kind, found in pieces(text, self.vocabulary):
            if kind == "words" and max(map(len, found), default=0) <= self.REMEMBERED:
                yield b"".join(map(self.known.__getitem__, found))
            elif kind == "words":
                for word in found:
                    yield self.known[word] if len(word) <= self.REMEMBERED else self._word(word)
            elif kind == "part":
                yield _packed(self.stream.feed(found.encode()))
            elif kind == "end":
                yield _packed(self.stream.finish())
            else:
                yield _packed([found])

    def encode(self, text: str) -> bytes:
        return b"".join(self.parts(text))


def _packed(tokens: list[int]) -> bytes:
    return np.array(tokens, np.int32).tobytes()


class Decoder:
    """Identifiers to text, any number at a time.

    ``joined=True`` is what a vocabulary without a decoder of its own gives: the tokens as they are written, with a space
    between. ``joined=False`` turns them back into the bytes they stand for and a word end into a space; bytes of one
    character may come in several tokens, bytes that are no text become U+FFFD.
    """

    def __init__(self, vocabulary: Vocabulary, joined: bool = True) -> None:
        self.vocabulary, self.joined = vocabulary, joined
        self.byte = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        self.known = Bounded(self._bytes)
        self.begin()

    def begin(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = True

    def _bytes(self, token: int) -> bytes:
        text = self.vocabulary.tokens[token]
        if self.joined or token in self.vocabulary.special.values():
            return text.encode()
        ends = text.endswith(WORD_END)
        inner = text[:-len(WORD_END)] if ends else text
        return b"".join(self.byte[c] for c in inner) + b" " * ends

    def feed(self, tokens: Iterable[int]) -> str:
        between = b" " if self.joined else b""
        data = between.join(map(self.known.__getitem__, tokens))
        if self.joined and not self.first and data:
            data = between + data
        self.first = self.first and not data
        return self.state.decode(data)

    def finish(self) -> str:
        rest = self.state.decode(b"", final=True)
        self.begin()
        return rest


DECODED_AT_ONCE = 1 << 16


def decoded(data: bytes, decoder: Decoder) -> str:
    tokens = np.frombuffer(data, np.int32)
    parts = [decoder.feed(tokens[k:k + DECODED_AT_ONCE].tolist()) for k in range(0, len(tokens), DECODED_AT_ONCE)]
    return "".join(parts) + decoder.finish()


_encoders: dict[int, Encoder] = {}


def _encoder(content: str) -> Encoder:
    vocabulary = parsed(content)
    if id(vocabulary) not in _encoders:
        _encoders[id(vocabulary)] = Encoder(vocabulary)
    return _encoders[id(vocabulary)]


def _token_lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encode(rows: DataFrame, path: str, text_col: str = "text", out: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``rows`` with the identifiers of ``text_col`` as an array; the vocabulary at ``path`` is read by the driver.

    With ``decoded_col`` the identifiers are decoded as well, in the same pass and worker.
    """
    content = rows.sparkSession.sparkContext.broadcast(read_content(path))
    kept = rows.drop(out, decoded_col or out)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(content.value), Decoder(parsed(content.value))
        for batch in batches:
            for piece in slices(batch, text_col):
                packed = [encoder.encode(t.as_py() or "") for t in piece.column(text_col)]
                columns, names = [*piece.columns, _token_lists(packed)], [*piece.schema.names, out]
                if decoded_col:
                    columns.append(pa.array([decoded(p, decoder) for p in packed], pa.string()))
                    names.append(decoded_col)
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = _plus(kept, out, ArrayType(IntegerType()))
    return kept.mapInArrow(encoded, schema.add(decoded_col, StringType()) if decoded_col else schema)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded", joined: bool = True) -> DataFrame:
    """``rows`` with the text of ``ids_col``; a null array gives the empty text."""
    content = rows.sparkSession.sparkContext.broadcast(read_content(path))
    kept = rows.drop(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(parsed(content.value), joined)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                piece = batch.slice(begin, 256)
                texts = [decoded(_as_bytes(v), decoder) for v in piece.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())],
                                                 [*piece.schema.names, out])

    return kept.mapInArrow(read, _plus(kept, out, StringType()))


def _plus(rows: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*rows.schema.fields, StructField(name, kind)])


def _as_bytes(value: pa.ListScalar) -> bytes:
    return value.values.to_numpy().astype(np.int32).tobytes() if value.is_valid else b""


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded_col="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op6_bpe_codec": op6_bpe_codec}
SQL: dict[str, str] = {}

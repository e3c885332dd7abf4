"""Alignment against the libraries on whole texts, one at a time."""

from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from snapforge import llm
from snapforge.llm import alignment

SF = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def tokens(text: str | None):
        if not text:
            return None
        ids_a = first.encode(" " + text, add_special_tokens=False).ids
        bytes_a = [bytes(back[c] for c in first.id_to_token(k)) for k in ids_a]
        ids_b = second.encode(text)
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(k) else p.replace("▁", " ").encode()
                   for k, p in ((k, second.id_to_piece(k)) for k in ids_b)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return None
        return ids_a, np.cumsum([len(x) for x in bytes_a]), ids_b, np.cumsum([len(x) for x in bytes_b])

    return tokens


def plain(docs: list[tuple], tokens) -> list[tuple]:
    groups = []
    for _, text in docs:
        found, own = tokens(text), []
        if found:
            ids_a, ends_a, ids_b, ends_b = found
            for cut in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
                begin = own[-1][2] if own else 0
                own.append(([k for k, e in zip(ids_a, ends_a, strict=True) if begin < e <= cut],
                            [k for k, e in zip(ids_b, ends_b, strict=True) if begin < e <= cut], cut))
        groups.append(own)
    held = Counter(pair for own in groups for pair in {(x, y) for a, b, _ in own for x in a for y in b})
    highest: dict[int, int] = {}
    for (x, _), n in held.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for (key, _), own in zip(docs, groups, strict=True):
        links = [(x, y) for a, b, _ in own for x in a for y in b]
        digest = sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in own).encode()).hexdigest()
        out.append((key, sum(len(a) for a, _, _ in own), sum(len(b) for _, b, _ in own), len(own), len(links),
                    sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links), digest if own else ""))
    return out


def test_query_agrees_with_libraries(spark, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = llm.QUERIES["op13_alignment"](spark, SF)
    assert out.columns == ["doc_id", *COLUMNS[1:]]
    found = sorted(tuple(r) for r in out.collect())
    assert found == sorted(plain(docs, libraries))


ODD = ["", None, "a", " ", "  two  spaces ", "a▁b", "<s> <unk> <|endoftext|> </s>", "tab\tand\nline\r\n\n", "日本語のテキスト、です。",
       "naïve café ﬁ Ａ é   　x", "x" * 700, "word, word; word. " * 60, "nul \0 here", "😀👍🏽 flags 🇩🇪", "a" + " " * 300 + "b"]


@pytest.mark.parametrize("chunk", [100, 1 << 16])
def test_chunks_of_any_size_give_the_same(spark, libraries, chunk, monkeypatch):
    """Odd texts, repeated rows and ids, null ids; long texts over many chunks, composed in several rounds."""
    rng = random.Random(1)
    words = ["the", "thonheha", "erst,", "don't", "x1y2", "(see)", "été", "日本", "...", "a  b", "\n", "▁", "U.S.A."]
    texts = [*ODD, *(" ".join(rng.choices(words[:-2], k=rng.choice([3, 40, 150]))) for _ in range(12)),
             " ".join(rng.choices(words, k=150))]
    docs = [(k if k % 5 else None, t) for k, t in enumerate(texts)] + [(3, "a"), (3, "a")]
    rows = spark.createDataFrame([(k, t, 0) for k, t in docs], "doc_id long, text string, slice int")
    found = [tuple(r) for r in alignment.aligned(rows, *PATHS, chunk=chunk).select(*COLUMNS).collect()]
    assert sorted(found, key=repr) == sorted(plain(docs, libraries), key=repr)


def test_without_rows_and_with_other_ids(spark):
    rows = spark.createDataFrame([("k", "some text")], "doc_id string, text string")
    assert alignment.aligned(rows, *PATHS).first()["id"] == "k"
    assert alignment.aligned(rows.limit(0), *PATHS).count() == 0


def _same(x: alignment.Fragment, y: alignment.Fragment) -> bool:
    return all(np.array_equal(p, q) for p, q in zip(x, y, strict=True))


@pytest.mark.parametrize("seed", range(20))
def test_composition_is_associative(seed):
    """Any cut of the token streams, each apart, and any order of composition give the whole."""
    rng = np.random.default_rng(seed)
    size = int(rng.integers(5, 60))
    streams = [np.append(np.flatnonzero(rng.random(size - 1) < rng.uniform(0.05, 0.7)) + 1, size) for _ in range(2)]
    ids = [rng.integers(0, 9, len(s)) for s in streams]
    whole = alignment.Fragment.of(ids[0], streams[0], ids[1], streams[1])
    parts = []
    for target in range(0, size, 7):
        own = []
        for s, i in zip(streams, ids, strict=True):
            place = [np.searchsorted(s, t, "right") if t < size else len(s) for t in (target, target + 7)]
            begin = place[0] if target else 0
            own += [i[begin:place[1]], s[begin:place[1]]]
        parts.append(alignment.Fragment.of(*own))
    # A's chunks end a token later than B's now and then
    shifted = [alignment.Fragment.of(*(np.zeros(0, np.int64),) * 4), *parts]
    for order in range(6):
        left = [*shifted]
        pick = np.random.default_rng(order)
        while len(left) > 1:
            k = int(pick.integers(0, len(left) - 1))
            left[k:k + 2] = [alignment.compose(left[k], left[k + 1])]
        assert _same(left[0], whole)


def test_byte_tokens_are_the_librarys_for_every_character():
    """Each assigned or unassigned code point beside letters, digits, signs and blanks."""
    library = Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    ours = alignment.ByteTokenizer(open(PATHS[0], encoding="utf-8").read())
    points = [c for c in range(1, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    texts = [f" a{chr(c)}b 1{chr(c)}2 .{chr(c)}! {chr(c)} {chr(c)}{chr(c)}" for c in points]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ours.encode([t.encode() for t in texts]) == expected

"""Repeated passages against a plain search for windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from snapforge import llm
from snapforge.llm import suffix_dedup

SF = "/root/testdata/sf0.001"


def plain(docs: list[tuple[int | None, str | None]], depth: int) -> list[tuple]:
    """``id, kept, spans`` of each row, in the order of the rows."""
    lowest: dict[bytes, int] = {}
    for k, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - depth + 1 if k is not None else 0):
            window = data[p:p + depth]
            lowest[window] = min(k, lowest.get(window, k))
    out = []
    for k, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - depth + 1 if k is not None else 0):
            if lowest[data[p:p + depth]] < k:
                gone[p:p + depth] = b"\1" * depth
        edges = [p for p in range(len(data) + 1) if (p < len(data) and gone[p]) != (p > 0 and gone[p - 1])]
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((k, kept, list(zip(edges[::2], edges[1::2], strict=True))))
    return out


def ours(spark, docs, depth, **settings) -> list[tuple]:
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    return [(r["id"], bytes(r["kept"]), [tuple(s) for s in r["spans"]])
            for r in suffix_dedup.without_repeats(rows, depth, **settings).collect()]


def test_query_agrees_with_plain_search(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    expected = {(k, len((t or "").encode()), sum(e - b for b, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
                for (_, t), (k, kept, spans) in zip(docs, plain(docs, 50), strict=True)}
    out = llm.QUERIES["op11_suffix_dedup"](spark, SF)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {tuple(r) for r in out.collect()} == expected and any(row[2] for row in expected)


@pytest.mark.parametrize(("depth", "crowd"), [(16, 3), (21, 0), (21, 20_000), (50, 3)])
def test_random_texts_at_any_size_of_bucket(spark, depth, crowd, monkeypatch):
    """Few letters, shared lines with other neighbours, runs of one letter, several slices and pieces."""
    rng = random.Random(depth)
    lines = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 90))) for _ in range(12)] + ["x" * 130, "ä" * 40]
    docs = [(k, "".join(rng.choice(lines) if rng.random() < 0.6 else "".join(rng.choice("abc ") for _ in range(30))
                        for _ in range(rng.randint(0, 8)))) for k in range(60)]
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 4000)
    found = ours(spark, docs, depth, crowd=crowd)
    assert sorted(found) == sorted(plain(docs, depth))
    assert any(spans for _, _, spans in found)


def test_odd_rows(spark):
    """Nulls, empty texts, repeated rows and ids, ids in no order, a clashing column, one long text."""
    passage = "This passage stands in several documents, word for word, and is longer than fifty bytes."
    docs = [(7, f"before {passage} after"), (7, f"other {passage}"), (3, passage), (3, passage), (None, passage), (5, None),
            (6, ""), (9, passage[:49]), (8, "x " * 100_000 + passage), (2**40, passage), (-1, "short")]
    rows = spark.createDataFrame([(k, t, "s") for k, t in docs], "doc_id long, text string, slice string")
    found = sorted(((r["id"], bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in
                    suffix_dedup.without_repeats(rows).collect()), key=repr)
    assert found == sorted(plain(docs, 50), key=repr)
    assert suffix_dedup.without_repeats(rows.limit(0)).count() == 0


def test_only_repeated_rows_and_nulls(spark):
    passage = "a passage that is repeated with one id only is kept in every row " * 2
    assert sorted(ours(spark, [(1, passage)] * 5, 50)) == [(1, passage.encode(), [])] * 5
    assert ours(spark, [(None, passage)] * 2, 50) == [(None, passage.encode(), [])] * 2


@pytest.mark.parametrize("depth", [16, 17, 33, 50])
def test_numbers_stand_for_bytes(depth):
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=3000)) + b"a" * 200, np.uint8)
    numbers = suffix_dedup.refined(data, depth)
    windows = [data[p:p + depth].tobytes() for p in range(len(data) - depth + 1)]
    assert len(numbers) == len(windows)
    rank = {w: k for k, w in enumerate(sorted(set(windows)))}
    assert numbers.tolist() == [rank[w] for w in windows]


def test_every_window_has_one_anchor(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 70)
    texts = [bytes(random.Random(2).choices(b"abc", k=500)), b"", b"short", b"z" * 120]
    anchors = suffix_dedup.Anchors(texts, 20)
    covered = sorted((d, b + w) for d, b, n in zip(anchors.doc, anchors.begin, anchors.count, strict=True) for w in range(n))
    assert covered == [(d, p) for d, t in enumerate(texts) for p in range(len(t) - 19)]
    assert all(0 <= lead and lead + anchors.length <= 20 for lead in anchors.lead)


def test_windows_must_have_sixteen_bytes():
    with pytest.raises(ValueError, match="16"):
        suffix_dedup.gram_length(15)

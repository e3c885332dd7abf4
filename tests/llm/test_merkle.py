"""The Merkle manifest against trees built in one piece."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapforge.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(row: tuple, more: int = 0) -> str:
    values = [v + more if k == 3 and v is not None else v for k, v in enumerate(row)]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves: list[str]) -> list[list[str]]:
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def path(tree: list[list[str]], k: int) -> list[tuple[str, bool]]:
    out = []
    for level in tree[:-1]:
        out.append((level[k ^ 1], k % 2 == 1) if k ^ 1 < len(level) else ("", False))
        k //= 2
    return out


def plain(rows: list[tuple]) -> list[tuple]:
    key = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: sorted((r for r in rows if r[2] == lang), key=key) for lang in langs}
    built = {lang: levels([leaf_of(r) for r in own]) for lang, own in trees.items()}
    top = levels([built[lang][-1][0] for lang in langs])
    out = []
    for number, lang in enumerate(langs):
        for k, row in enumerate(trees[lang]):
            steps = path(built[lang], k) + path(top, number)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf_of(row, 1 if tampered else 0)
            for sibling, left in steps:
                folded = h(sibling + folded if left else folded + sibling)
            out.append((row[0], leaf_of(row), built[lang][-1][0], top[-1][0], h("".join(s for s, _ in steps)), folded,
                        folded == top[-1][0]))
    return out


def ours(frame, part_rows: int) -> list[tuple]:
    return [tuple(r) for r in merkle.manifest(merkle.document_leaves(frame), "lang", ["doc_id"], part_rows).select(
        *merkle.RESULT).collect()]


@pytest.mark.parametrize(("part_rows", "rounds"), [(7, 2), (40, 12), (1 << 16, 12)])
def test_parts_of_any_size_give_one_manifest(spark, part_rows, rounds, monkeypatch):
    """Languages inside a part, over many parts and of one row; levels made in several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", rounds)
    rng = random.Random(5)
    rows = [(k, "s", rng.choice(["en", "en", "en", "de"]), k % 50, f"text {k} ä") for k in rng.sample(range(5000), 150)]
    rows += [(9001, "s", "fr", 3, "one"), (9002, "s", None, 3, "no language"), (9003, None, "zz", None, None)]
    found = ours(spark.createDataFrame(rows, DOCS), part_rows)
    assert sorted(found) == sorted(plain(rows))
    assert {r[6] for r in found} == {True, False}


def test_odd_rows(spark):
    """Nulls in every column, repeated rows and ids, a clashing column, a language of one leaf."""
    rows = [(1, "s", "en", 1, "a"), (1, "s", "en", 1, "a"), (1, "s", "en", 2, "b"), (None, "s", "en", 1, "a"),
            (None, None, None, None, None), (7, "s", "de", None, ""), (2**40, "s", "é", 1, "x" * 300_000)] * 2
    frame = spark.createDataFrame(rows, DOCS).withColumn("part", F.lit("p")).withColumn("tree", F.lit(1))
    assert sorted(ours(frame, 3), key=repr) == sorted(plain(rows), key=repr)
    assert ours(frame.limit(0), 3) == []
    single = [(5, "s", None, 1, "t")]
    assert ours(spark.createDataFrame(single, DOCS), 3) == plain(single)


def test_hot_row_is_dealt_to_several_parts(spark):
    rows = [(4, "s", "en", 1, "t")] * 60 + [(k, "s", "en", 1, "t") for k in range(20)]
    stored, trees = merkle.placed(merkle.document_leaves(spark.createDataFrame(rows, DOCS)), "lang", ["doc_id", "leaf"], 10)
    assert stored.groupBy("part").count().agg(F.max("count")).first()[0] < 30
    assert [tuple(r) for r in trees.collect()] == [(0, 80)]
    assert sorted(r["place"] for r in stored.collect()) == list(range(80))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 64])
def test_multiproof_is_enough_and_minimal(n):
    """With the missing nodes all proofs can be read; without any one of them some cannot."""
    tree = levels([h(str(k)) for k in range(n)])
    rng = random.Random(n)
    for _ in range(10):
        places = sorted(rng.sample(range(n), rng.randint(1, n)))
        asked = merkle.missing(np.array(places), n)
        assert len(asked) == len(set(asked))

        def proofs(coordinates, places=places):
            known = {(0, p): tree[0][p] for p in places} | {(lv, p): tree[lv][p] for lv, p in coordinates}
            nodes = merkle.inner_nodes(known, n)
            return [merkle.proof(nodes, p, n) for p in places]

        assert proofs(asked) == [path(tree, p) for p in places]
        for left_out in asked:
            with pytest.raises(KeyError):
                proofs([c for c in asked if c != left_out])

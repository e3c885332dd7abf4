"""Recall of the index for vectors of one length, of many lengths and in clusters, on full blocks."""

from __future__ import annotations

import numpy as np
import pytest

from snapforge.llm import permutation_index

SIZE, DIMENSIONS = 2 * permutation_index.BLOCK + 900, 32


def made(kind: str) -> np.ndarray:
    rng = np.random.default_rng(7)
    x = rng.normal(size=(SIZE, DIMENSIONS))
    if kind == "clustered":
        return 2 * rng.normal(size=(40, DIMENSIONS))[rng.integers(0, 40, SIZE)] + x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * np.exp(rng.normal(size=(SIZE, 1)) * {"one length": 0, "log-normal 0.5": 0.5, "log-normal 1": 1}[kind])


@pytest.mark.parametrize("kind", ["one length", "log-normal 0.5", "log-normal 1", "clustered"])
def test_recall_on_full_blocks(spark, kind):
    x = made(kind)
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = {}
    for r in permutation_index.nearest(rows, "id % 200 = 0").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(found) == list(range(0, SIZE, 200))
    hits = 0
    for k, own in found.items():
        scores = x @ x[k]
        scores[k] = -np.inf
        hits += len(own & set(np.argsort(-scores, kind="stable")[:permutation_index.NEIGHBOURS].tolist()))
    assert hits / len(found) / permutation_index.NEIGHBOURS >= 0.9


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_of_given_vectors(spark, sf):
    given = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").select("vec_id", "embedding")
    ids, x = zip(*((r["vec_id"], np.array(r["embedding"], float)) for r in given.collect() if r["embedding"]), strict=True)
    ids, x = np.array(ids), np.array(x)
    found = {}
    for r in permutation_index.nearest(given, "id % 20 = 0").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for k, own in found.items():
        scores = x @ x[ids == k][0]
        best = ids[np.argsort(-scores, kind="stable")]
        hits += len(own & set(best[best != k][:permutation_index.NEIGHBOURS].tolist()))
    assert hits / len(found) / permutation_index.NEIGHBOURS >= 0.9

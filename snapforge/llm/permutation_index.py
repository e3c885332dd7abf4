"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order. Vectors are dealt into blocks; in each block every pivot has an
inverted file of the vectors it is near to, with its place in their order. A query goes through the files of its own
nearest pivots in every block and adds up, per vector, how far the places differ (the footrule distance; a pivot that
only one of the two has counts as the full length). The sums tell angles; as inner products also grow with the length of a
vector, the likeness (how far a sum is below the block's mean) is weighted by it. The share of a block with the largest
likeness is compared exactly, the same share whatever the size.

Rules: a vector that is null, zero, or has null or non-finite components takes no part, nor do rows without an id or with
another number of components than most rows have (of equally many, the larger). Rows equal in id and vector count once;
rows with the query's id are not its neighbours. A query id with several vectors is answered for the best score of each
neighbour. Fewer candidates than wanted are all returned. Equal scores go by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapforge.llm.common import table, written

NEIGHBOURS = 20
PIVOTS, LENGTH = 128, 64
SHARE = 3  # one in SHARE of a block is compared exactly, the wanted neighbours at least
SAMPLE = 4096  # rows that pivots are drawn from
BLOCK, QUERIES_AT_ONCE = 8192, 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (doubles) of the rows that take part, equal ones once."""
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull()).where(sound).dropDuplicates()
    return rows.withColumn("dim", F.size("v"))


def choose_pivots(rows: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Different directions among the ``sample`` rows that come first by the hash of their vector."""
    first = rows.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).collect()
    seen = dict.fromkeys(tuple(r["v"]) for r in first)
    return _unit(np.array(list(seen)[:count], float)) if seen else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def orders(x: np.ndarray, pivots: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each vector the numbers of its nearest pivots, nearest first."""
    return np.argsort(-(_unit(x) @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int32)


class Block:
    """The inverted files of one block, its vectors sorted by id: ``files[pivot]`` has the pivot's place in the order of
    each vector, or the full length where it is not among them. About half of the entries are places, so files are dense."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, length: int = LENGTH) -> None:
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        scaled = self.vectors / np.abs(self.vectors).max()  # squares of very large or small components stay finite
        self.lengths = np.linalg.norm(scaled, axis=1)
        found = orders(self.vectors, pivots, length)
        self.length = found.shape[1]
        self.files = np.full((len(pivots), len(ids)), self.length, np.int16)
        for place in range(self.length):
            self.files[found[:, place], np.arange(len(ids))] = place

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance from a query's order to each vector, less what is the same for all of them. A vector's pivot that the
        query lacks costs what is left of the length; going through the query's files takes that back for the others."""
        out = np.zeros(len(self.ids), np.int32)
        for place, pivot in enumerate(order):
            theirs = self.files[pivot]
            out += np.abs(theirs - np.int16(place)) + theirs
        return out

    def search(self, query: np.ndarray, order: np.ndarray, own: int, most: int, share: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best candidates of the block."""
        distance = self.footrule(order)
        likeness = self.lengths * np.maximum(distance.mean() - distance, 0)
        wanted = max(-(-len(self.ids) // share), most) + 1  # the query itself may be one
        at = _first(-likeness, wanted)
        at = at[self.ids[at] != own]
        scores = self.vectors[at] @ query
        best = _first(-scores, most)
        best = best[np.lexsort((self.ids[at][best], -scores[best]))]
        return self.ids[at][best], scores[best]


def _first(values: np.ndarray, wanted: int) -> np.ndarray:
    """Places of the ``wanted`` smallest values, in order of place; of equal ones at the border the first."""
    if wanted >= len(values):
        return np.arange(len(values))
    last = np.partition(values, wanted - 1)[wanted - 1]
    below, border = np.flatnonzero(values < last), np.flatnonzero(values == last)
    return np.sort(np.concatenate([below, border[:wanted - len(below)]]))


SAME = "query_id long, vec_id long, score double"


def _search(rows: DataFrame, pivots: np.ndarray, most: int, share: int, length: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                piece = batch.slice(begin, 2048)
                vectors = piece.column("v").flatten().to_numpy().reshape(piece.num_rows, -1)
                keys = zip(*(piece.column(c).to_pylist() for c in ("block", "part", "is_query", "id")), strict=True)
                yield from zip(keys, vectors, strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in groupby(parts(batches), key=lambda r: r[0][:2]):
            block, waiting = None, []
            for is_query, side in groupby(members, key=lambda r: r[0][2]):
                keys, vectors = zip(*side, strict=True)
                ids, vectors = np.array([k[3] for k in keys]), np.array(vectors)
                if not is_query:
                    block = Block(ids, vectors, shared.value, length)
                elif block is not None:
                    found = orders(vectors, shared.value, length)
                    waiting = [(i, *block.search(v, o, i, most, share)) for i, v, o in zip(ids, vectors, found, strict=True)]
            if waiting:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([w[0] for w in waiting], [len(w[1]) for w in waiting]), pa.int64()),
                     pa.array(np.concatenate([w[1] for w in waiting]), pa.int64()),
                     pa.array(np.concatenate([w[2] for w in waiting]), pa.float64())], ["query_id", "vec_id", "score"])

    return rows.repartition("block", "part").sortWithinPartitions("block", "part", "is_query").select(
        "block", "part", "is_query", "id", "v").mapInArrow(run, SAME)


def nearest(vectors: DataFrame, query_ids: str, most: int = NEIGHBOURS, id_col: str = "vec_id",
            vector_col: str = "embedding", pivots: int = PIVOTS, length: int = LENGTH, share: int = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row fitting ``query_ids`` (a condition on ``id``) its nearest others.

    Each row is in one block; queries go to every block, in parts of bounded size, and bring back ``most`` rows each.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vector_col), "vectors")
    usual = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, n = rows.where(F.col("dim") == usual["dim"]), usual["n"]
    asked = rows.where(query_ids)
    blocks, parts = -(-n // BLOCK), max(1, -(-asked.count() // QUERIES_AT_ONCE))
    place = F.xxhash64("id", "v")
    held = rows.select(F.pmod(place, F.lit(blocks)).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("is_query"), "id", "v")
    asking = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                          F.pmod(place, F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("is_query"), "id", "v")
    found = _search(held.unionByName(asking), choose_pivots(rows, pivots), most, share, length)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(
        "query_id", "rank", "vec_id", "score")


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


QUERIES = {"op4_permutation_index": op4_permutation_index}
SQL: dict[str, str] = {}

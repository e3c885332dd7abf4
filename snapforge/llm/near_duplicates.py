"""Near duplicates: circulant MinHash for candidates, exact Jaccard on whole shingle sets for links.

One permutation shuffles the shingles, a second one, shifted by 0, 1, 2 ..., gives all coordinates of a signature. The
coordinates are cut into bands; documents that share a band are candidates. With 32 bands of 4 a pair at the threshold
of 0.8 is no candidate with a chance of 4e-8, and one below the threshold is a candidate that the exact check turns
down. Documents with equal sets are one class from the start, so copies cost one row each.

Candidates are clustered first, by ids only. A cluster's sets then meet in blocks of bounded size. A block finds all
its links, but follows only those that join what is not yet joined; whatever is outside a cluster's largest part is then
compared with its other blocks as well. So a link between two parts cannot be missed, and no pairs are listed.

Rules: a document is its id; rows with one id are one document and are linked by it. A null id takes no part: its
component is null and it is kept. A text without words, empty or null has an empty set, no links, and is kept. A text
with fewer words than a shingle is one shingle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.llm.common import table, written
from snapforge.llm.components import components
from snapforge.llm.vocabulary import Bounded, slices

WIDTH, PERCENT = 5, 80
BANDS, ROWS = 32, 4
BLOCK_SHINGLES = 4_000_000
TEXT_CHUNK, LONG_WORD = 1 << 20, 1 << 6
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _digest(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


_known = Bounded(_digest)


def _numbers(words: list[bytes]) -> np.ndarray:
    """A digest of each word. Only short words are remembered."""
    if max(map(len, words), default=0) <= LONG_WORD:
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    return np.fromiter((_known[w] if len(w) <= LONG_WORD else _digest(w) for w in words), np.uint64, len(words))


def word_hashes(text: str) -> np.ndarray:
    """Digests of all words, A-Z taken as a-z; memory beyond the text is bounded by a chunk and 8 bytes a word."""
    data = text.encode("utf-8", "surrogatepass").lower()
    parts, begin = [], 0
    while begin < len(data):
        end = min(begin + TEXT_CHUNK, len(data))
        if end < len(data) and not BLANK.match(data, end):  # the word goes on
            match = BLANK.search(data, end)
            end = match.start() if match else len(data)
        parts.append(_numbers(data[begin:end].split()))
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit numbers."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
    return np.unique(out)


def _permuted(x: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= np.uint32(seed)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]


def signature(found: np.ndarray) -> np.ndarray:
    """All coordinates from two permutations: the second one is shifted by the coordinate's number."""
    first = _permuted((found ^ (found >> np.uint64(32))).astype(np.uint32), 0x2545F491)
    least = np.full(len(_SHIFTS), 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(first), 1024):
        np.minimum(least, _permuted(first[None, begin:begin + 1024] + _SHIFTS, 0x7FEB352D).min(1), out=least)
    return least


def bands(found: np.ndarray) -> np.ndarray:
    parts = signature(found).reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return out.view(np.int64)


def _fingerprint(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def sketches(documents: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``id, n_shingles, class, node, bands`` per row; equal sets have one class, ``node`` is half of it as a number.
    All but the first two are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = [shingles(t.as_py(), width) for t in piece.column("text")]
                marks = [_fingerprint(s) if len(s) else None for s in sets]
                nodes = [m and int.from_bytes(m[:8], "little", signed=True) for m in marks]
                lists = pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(map(len, sets), pa.int64()), pa.array(marks, pa.binary()),
                     pa.array(nodes, pa.int64()), lists], ["id", "n_shingles", "class", "node", "bands"])

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_shingles long, class binary, node long, bands array<long>")


def _joined(sets: list[np.ndarray], labels: np.ndarray, centres: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that join parts, as pairs of places. Without ``centres``: as many as join all that is linked, found from
    the members of all parts but the largest. With ``centres``: links of these to any others."""
    sizes, links = np.array([len(s) for s in sets]), []
    m = len(sets)
    shared, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    postings = np.repeat(np.arange(m), sizes)[np.argsort(inverse, kind="stable")]
    starts = np.cumsum(count) - count

    def follow(c: int) -> None:
        own = inverse[ends[c] - sizes[c]:ends[c]]
        lengths = count[own]
        places = np.repeat(starts[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(postings[places], minlength=m)
        near = np.flatnonzero(100 * common >= percent * (sizes + sizes[c] - common))
        for other in near:
            if labels[other] != labels[c]:
                links.append((c, int(other)))
                labels[labels == labels[other]] = labels[c]

    if centres is not None:
        for c in np.flatnonzero(centres):
            follow(int(c))
        return links
    waiting = np.ones(m, bool)
    nxt = int(np.argmax(np.add.reduceat(count[inverse], ends - sizes) / sizes))  # shares most with the others
    while True:
        waiting[nxt] = False
        follow(nxt)
        values, of_label = np.unique(labels, return_counts=True)
        rest = np.flatnonzero(waiting & (labels != values[of_label.argmax()]))
        if not len(rest):
            return links
        nxt = int(rest[0])


def _links_of_groups(grouped: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b`` (classes) from rows ``cluster, block, part, class, label, centre, text`` sorted by the first three."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield from zip(*(piece.column(c).to_pylist() for c in (
                    "cluster", "block", "part", "class", "label", "centre", "text")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in groupby(rows(batches), key=lambda r: r[:3]):
            found = {}
            for *_, mark, label, centre, text in members:
                own = shingles(text, width)
                if mark not in found and _fingerprint(own) == mark:  # an id may have several texts
                    found[mark] = (own, label, centre)
            if len(found) < 2:
                continue
            marks = list(found)
            sets, names, roles = (list(x) for x in zip(*found.values(), strict=True))
            known = {name: k for k, name in enumerate(dict.fromkeys(names))}
            labels = np.array([known[n] for n in names]) if roles[0] is not None else np.arange(len(marks))
            centres = np.array(roles, bool) if roles[0] is not None else None
            links = _joined(sets, labels, centres, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([marks[a] for a, _ in links], pa.binary()), pa.array([marks[b] for _, b in links], pa.binary())],
                ["a", "b"])

    near = grouped.repartition("cluster", "block", "part").sortWithinPartitions("cluster", "block", "part")
    return near.select("cluster", "block", "part", "class", "label", "centre", "text").mapInArrow(run, "a binary, b binary")


def _pieces_of(total: str) -> Column:
    return F.ceil(F.col(total) / BLOCK_SHINGLES).cast("int")


def class_links(documents: DataFrame, classes: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``a, b``: links between classes that join all that similarity joins. ``classes``: class, node, id, n_shingles,
    bands, one row per class."""
    banded = classes.select("node", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    star = banded.join(heads, "band").where("node <> head").select("node", "head")
    clusters = components(star, "node", "head").select(F.col("node").alias("n"), F.col("root").alias("cluster"))
    members = classes.select("class", "node", "id", "n_shingles").join(clusters, F.col("node") == F.col("n"))
    totals = members.groupBy("cluster").agg(F.sum("n_shingles").alias("total"))
    members = written(members.join(totals, "cluster").select(
        "cluster", "class", "id", "n_shingles", _pieces_of("total").alias("blocks"),
        F.pmod(F.xxhash64("class"), _pieces_of("total")).cast("int").alias("block")), "members")
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # a cluster's first class goes to each of its blocks, which joins most of a large group already
    anchors = members.where("blocks > 1").groupBy("cluster").agg(F.min("class").alias("first"))
    spread = members.where("blocks > 1").join(anchors, "cluster").where("class = first").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(members.columns)
    nothing = {"part": F.lit(0), "label": F.lit(None).cast("binary"), "centre": F.lit(None).cast("boolean")}
    inside = members.unionByName(spread).distinct().withColumns(nothing)
    first = written(_links_of_groups(inside.join(texts, "id"), width, percent), "links")
    parts = components(first.join(members.where("blocks > 1").select(F.col("class").alias("a")), "a", "left_semi"), "a", "b")
    labelled = members.where("blocks > 1").join(parts, F.col("class") == F.col("node"), "left").withColumn(
        "label", F.coalesce("root", "class")).drop("node", "root")
    largest = labelled.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster").agg(
        F.max(F.struct("n", "label"))["label"].alias("largest"))
    apart = labelled.join(largest, "cluster").where("label <> largest")
    amount = apart.groupBy("cluster").agg(F.sum("n_shingles").alias("apart"))
    chunks = amount.select("cluster", _pieces_of("apart").alias("parts"))
    centres = apart.join(chunks, "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part"), "class", "id", "label",
        F.lit(True).alias("centre"))
    others = labelled.join(chunks, "cluster").select(
        "cluster", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "class", "id", "label",
        F.lit(False).alias("centre"))
    both = centres.unionByName(others).groupBy("cluster", "block", "part", "class", "id", "label").agg(
        F.max("centre").alias("centre"))
    second = written(_links_of_groups(both.join(texts, "id"), width, percent), "links")
    return first.unionByName(second)


def near_duplicates(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` for each row; a component's id is its smallest, which is the one kept."""
    rows = written(sketches(documents, width, id_col, text_col), "sketches")
    named = rows.where("class is not null and id is not null")
    classes = written(named.groupBy("class").agg(
        F.min("id").alias("id"), F.max("id").alias("last"), F.min("node").alias("node"),
        F.min("n_shingles").alias("n_shingles"), F.min("bands").alias("bands")), "classes")
    links = class_links(documents, classes, width, percent, id_col, text_col)
    several = named.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z")
    by_id = named.join(several.drop("z"), "id").select("a", F.col("class").alias("b"))
    parts = components(links.unionByName(by_id), "a", "b")
    linked = classes.drop("node").join(parts, F.col("class") == F.col("node"))
    lowest = linked.groupBy("root").agg(F.min("id").alias("component"))
    far = linked.join(lowest, "root").select("class", "component")
    copied = classes.where("id <> last").join(far, "class", "left_anti").select("class", F.col("id").alias("component"))
    component = written(far.unionByName(copied), "components")
    component_id = F.coalesce("component", "id")
    return rows.select("id", "n_shingles", "class").join(component, "class", "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), component_id).alias("component_id"),
        F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4).withColumnRenamed("id", "doc_id")


def shingles_sql(width: int) -> str:
    """CTE ``sets``: doc_id and distinct shingles."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
worded AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + {width} - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width} + 1, 1) + 1)) AS s FROM worded WHERE len(w) > 0))"""


SQL = {"op9_near_duplicates": f"""
WITH RECURSIVE {shingles_sql(4)},
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON roots.a = d.doc_id
"""}
QUERIES = {"op9_near_duplicates": op9_near_duplicates}

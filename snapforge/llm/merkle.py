"""A Merkle manifest of a dataset, with proofs for all leaves made by octopus multiproofs.

A leaf is the hash of a row. The leaves of one language make a binary tree, ordered by doc_id; the roots of these trees,
ordered by language, make the tree on top. Leaves are dealt by range to parts of bounded size, so a part is a run of
neighbours, of one language or several:

1. A part folds its own leaves. Whatever another part or a higher level can ask for are the nodes whose parent is not
   inside the part: at most two a level. Only these are stored.
2. Nodes above are made from them, ``LEVELS`` levels a round: nodes below one ancestor meet in one group.
3. A part computes the union of the coordinates that all its proofs miss, level by level; a sibling that is inside the
   part, or made from what is known already, is not in it. The union is joined with the stored nodes once, inner nodes are
   derived once for all leaves of the part, and each leaf's proof is read from them.

Rules: a null column counts as ``-``, any other as its UTF-8 length, ``:`` and its value. Rows with one doc_id are ordered by
their leaf; equal rows are leaves of their own. Null doc_ids come first, and a null language is a language. The last node
of a level with an odd number of nodes has no sibling and is hashed alone. A dataset without rows has no root and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapforge.llm.common import table, written

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PART_ROWS = 1 << 16
LEVELS = 12
TOP = -1  # the number of the tree above the languages
NODE = "tree long, level int, place long, digest string"
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def leaf_hash(columns: list[Column]) -> Column:
    """The hash of a row's values, each with its length."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def hashed(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return (int(n) - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes of a level."""
    return -(-n // (1 << level))


def missing(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Coordinates ``(level, place)`` that are needed, beside the leaves at ``places``, for the proofs of all of these."""
    out, known = [], np.unique(places)
    for level in range(height(n)):
        siblings = known ^ 1
        absent = siblings[(siblings < width(n, level)) & ~np.isin(siblings, known)]
        out += [(level, int(p)) for p in absent]
        known = np.unique(known >> 1)
    return out


def inner_nodes(known: dict[tuple[int, int], str], n: int) -> dict[tuple[int, int], str]:
    """``known`` and every node that follows from it: those whose children are all known."""
    out = dict(known)
    by_level: dict[int, set[int]] = {}
    for level, place in known:
        by_level.setdefault(level, set()).add(place)
    for level in range(height(n)):
        here = by_level.get(level, set())
        size = width(n, level)
        for parent in {p >> 1 for p in here}:
            children = [p for p in (2 * parent, 2 * parent + 1) if p < size]
            if (level + 1, parent) not in out and here.issuperset(children):
                out[level + 1, parent] = hashed([out[level, p] for p in children])
                by_level.setdefault(level + 1, set()).add(parent)
    return out


def proof(nodes: dict[tuple[int, int], str], place: int, n: int) -> list[tuple[str, bool]]:
    """Sibling and whether it stands left, or nothing where a node has none, from the leaf up."""
    out = []
    for level in range(height(n)):
        sibling = place ^ 1
        out.append((nodes[level, sibling], bool(place & 1)) if sibling < width(n, level) else ("", False))
        place >>= 1
    return out


def fold(digest: str, siblings: list[tuple[str, bool]]) -> str:
    """The root that a leaf and its siblings give."""
    for sibling, left in siblings:
        digest = hashed([sibling, digest] if left else [digest, sibling])
    return digest


def _nodes_table(rows: list[tuple[int, int, int, str]]) -> pa.Table:
    tree, level, place, digest = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"tree": pa.array(tree, pa.int64()), "level": pa.array(level, pa.int32()),
                     "place": pa.array(place, pa.int64()), "digest": pa.array(digest, pa.string())})


def placed(rows: DataFrame, group: str, order: list[str], part_rows: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``part``, ``tree`` (the group's number, in its order) and ``place`` inside it, and the trees:
    ``tree, n``. Parts are ranges, so only counts per part are numbered by windows."""
    # the range sample reads all rows, and a number for ties deals equal rows to several parts
    tied = written(rows.withColumn("tie", F.monotonically_increasing_id()), "rows")
    parts = tied.count() // part_rows + 1
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    ranged = tied.repartitionByRange(parts, *keys, "tie").withColumn("part", F.spark_partition_id())
    stored = written(ranged.drop("tie"), "leaves")
    counts = written(stored.groupBy("part", group).agg(F.count("*").alias("k")), "counts")
    of_group = Window.partitionBy(group)
    offsets = counts.withColumn("n", F.sum("k").over(of_group)).withColumn(
        "before", F.sum("k").over(of_group.orderBy("part")) - F.col("k")).withColumn("home", F.min("part").over(of_group))
    # a group is numbered in the part where it begins, after the groups that begin in earlier parts
    begun = offsets.where("part = home")
    homes = begun.groupBy("home").agg(F.count("*").alias("groups"))
    homes = homes.withColumn("earlier", F.sum("groups").over(Window.orderBy("home")) - F.col("groups"))
    inside = F.row_number().over(Window.partitionBy("home").orderBy(F.col(group).asc_nulls_first())) - 1
    trees = written(begun.withColumn("inside", inside).join(homes, "home").select(
        F.col(group).alias("name"), (F.col("earlier") + F.col("inside")).alias("tree"), "n"), "trees")
    known = offsets.join(trees.select("name", "tree"), F.col(group).eqNullSafe(F.col("name"))).select(
        F.col("part").alias("of_part"), F.col("name").alias("of_group"), "tree", "before")
    joined = stored.join(written(known, "offsets"), (F.col("part") == F.col("of_part"))
                         & F.col(group).eqNullSafe(F.col("of_group")))
    place = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*(F.col(c).asc_nulls_first() for c in order))) - 1
    return (written(joined.withColumn("place", (F.col("before") + place)).drop("of_part", "of_group", "before"), "placed"),
            trees.select("tree", "n"))


def _open_nodes(leaves: DataFrame, sizes: DataFrame) -> DataFrame:
    """``tree, level, place, digest`` of the nodes of each part whose parent needs leaves of another part, roots too."""

    def run(rows: pa.Table) -> pa.Table:
        out = []
        for (tree, n), own in rows.to_pandas().groupby(["tree", "n"]):
            nodes = inner_nodes({(0, p): d for p, d in zip(own["place"].tolist(), own["leaf"], strict=True)}, n)
            out += [(tree, level, place, d) for (level, place), d in nodes.items() if (level + 1, place >> 1) not in nodes]
        return _nodes_table(out)

    return leaves.join(sizes, "tree").select("part", "tree", "n", "place", "leaf").groupBy("part").applyInArrow(run, NODE)


def _upper_nodes(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """``nodes`` and all that follow from them, up to the roots; ``LEVELS`` levels a round."""
    highest = sizes.agg(F.max("n")).first()[0]
    base, all_nodes = 0, nodes

    def run(rows: pa.Table) -> pa.Table:
        tree, n = rows.column("tree")[0].as_py(), rows.column("n")[0].as_py()
        known = {(level, place): d for level, place, d in zip(
            *(rows.column(c).to_pylist() for c in ("level", "place", "digest")), strict=True)}
        top = rows.column("top")[0].as_py()
        return _nodes_table([(tree, level, place, d) for (level, place), d in inner_nodes(known, n).items()
                             if (level, place) not in known and level <= top])

    while base < height(highest or 1):
        top = base + LEVELS
        below = all_nodes.where((F.col("level") >= base) & (F.col("level") < top)).join(sizes, "tree")
        ancestor = F.expr(f"shiftright(place, {top} - level)")
        made = below.withColumns({"top": F.lit(top), "ancestor": ancestor}).groupBy("tree", "ancestor").applyInArrow(run, NODE)
        all_nodes = written(all_nodes.unionByName(made), "nodes")
        base = top
    return all_nodes


def _roots(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    top = F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))
    return nodes.join(sizes, "tree").where((F.col("place") == 0) & (F.col("level") == top)).select(
        "tree", F.col("digest").alias("subroot"))


def _wanted(leaves: DataFrame, sizes: DataFrame, languages: int) -> DataFrame:
    """``part, tree, level, place``: what each part needs to prove all its leaves, each coordinate once."""

    def run(rows: pa.Table) -> pa.Table:
        part, frame, out = rows.column("part")[0].as_py(), rows.to_pandas(), []
        for (tree, n), own in frame.groupby(["tree", "n"]):
            out += [(tree, level, place) for level, place in missing(own["place"].to_numpy(), n)]
        out += [(TOP, level, place) for level, place in missing(frame["tree"].unique(), languages)]
        tree, level, place = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"part": pa.array([part] * len(out), pa.int32()), "tree": pa.array(tree, pa.int64()),
                         "level": pa.array(level, pa.int32()), "place": pa.array(place, pa.int64())})

    return leaves.join(sizes, "tree").select("part", "tree", "n", "place").groupBy("part").applyInArrow(
        run, "part int, tree long, level int, place long")


def _proved(leaves: DataFrame, sizes: DataFrame, fetched: DataFrame, languages: int, root: str) -> DataFrame:
    """Every leaf with its proof, from its part's leaves and the nodes fetched for the part."""
    carried = [f for f in leaves.schema.fields if f.name not in ("part", "tree", "place")]
    names = [f.name for f in carried]

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        frame, extra = rows.select(["tree", "n", "place", "leaf", "tampered"]).to_pandas(), {}
        for tree, level, place, digest in zip(*(found.column(c).to_pylist() for c in ("tree", "level", "place", "digest")),
                                              strict=True):
            extra.setdefault(tree, {})[level, place] = digest
        proofs, subroots, folded = [""] * len(frame), [""] * len(frame), [""] * len(frame)
        trees, tops = {}, {}
        for (tree, n), own in frame.groupby(["tree", "n"]):
            known = {(0, p): d for p, d in zip(own["place"].tolist(), own["leaf"], strict=True)} | extra.get(tree, {})
            trees[tree] = inner_nodes(known, n)
            tops[0, tree] = trees[tree][height(n), 0]
        upper = inner_nodes(tops | extra.get(TOP, {}), languages)
        above = {tree: proof(upper, tree, languages) for tree in trees}
        for k, (tree, n, place, leaf, tampered) in enumerate(frame.itertuples(index=False, name=None)):
            siblings = proof(trees[tree], place, n) + above[tree]
            proofs[k] = hashed([s for s, _ in siblings])
            subroots[k] = tops[0, tree]
            folded[k] = fold(leaf if tampered is None else tampered, siblings)
        out = rows.select(names)
        for name, values in (("subroot", subroots), ("proof_sha256", proofs), ("folded_root", folded)):
            out = out.append_column(name, pa.array(values, pa.string()))
        return out.append_column("root", pa.array([root] * len(frame), pa.string())).append_column(
            "verified", pa.array([f == root for f in folded], pa.bool_()))

    with_sizes = leaves.join(sizes, "tree")
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried),
                      "subroot string, proof_sha256 string, folded_root string, root string, verified boolean"])
    return with_sizes.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(run, kind)


def manifest(leaves: DataFrame, group: str, order: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """``leaves`` (``group``, ``order`` columns, ``leaf`` and ``tampered``, the leaf to be checked instead or null) with
    ``subroot, root, proof_sha256, folded_root, verified``."""
    stored, trees = placed(leaves, group, [*order, "leaf"], part_rows)
    languages = trees.count()
    if not languages:
        kind = "subroot string, proof_sha256 string, folded_root string, root string, verified boolean"
        return leaves.select("*", *(F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in kind.split(", "))))
    nodes = _upper_nodes(written(_open_nodes(stored, trees), "open"), trees)
    top = stored.sparkSession.range(1).select(F.lit(TOP).cast("long").alias("tree"), F.lit(languages).alias("n"))
    subroots = _roots(nodes, trees).select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"),
        F.col("subroot").alias("digest"))
    above = _upper_nodes(written(subroots, "subroots"), top)
    root = _roots(above, top).first()["subroot"]
    wanted = written(_wanted(stored, trees, languages), "wanted")
    fetched = written(wanted.join(nodes.unionByName(above), ["tree", "level", "place"]), "fetched")
    return _proved(stored, trees, fetched, languages, root)


def document_leaves(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, tampered`` of every row: where 7 divides the checksum of the id, ``n_chars`` is one more."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    plain = [F.col(c) for c in COLUMNS]
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    return documents.select("doc_id", "lang", leaf_hash(plain).alias("leaf"),
                            F.when(chosen, leaf_hash(changed)).alias("tampered"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(document_leaves(table(spark, sf_dir, "documents")), "lang", ["doc_id"]).select(*RESULT)


def _leaf_sql(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(concat(" + ", ".join(
        f"coalesce(concat(strlen(CAST({v} AS VARCHAR)), ':', CAST({v} AS VARCHAR)), '-')" for v in values) + "))"


def _levels_sql(out: str, leaves: str) -> str:
    return f"""
{out} AS (
  SELECT * FROM ({leaves})
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2
  FROM {out} WHERE n > 1 GROUP BY tree, level, place // 2, n)"""


def _steps_sql(nodes: str, place: str, tree: str, offset: int) -> str:
    """The sibling at each level, after a letter for its side."""
    return f"""
  SELECT d.rid, {offset} + o.level AS level,
         CASE WHEN s.h IS NULL THEN 'N' WHEN o.place % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') AS step
  FROM leaves d JOIN {nodes} o ON o.tree = {tree} AND o.place = d.{place} >> o.level AND o.n > 1
  LEFT JOIN {nodes} s ON s.tree = o.tree AND s.level = o.level AND s.place = xor(o.place, 1)"""


SQL = {"op12_merkle_manifest": f"""
WITH RECURSIVE bits AS (
  SELECT i, CAST(i AS BIGINT) AS v, 0 AS n FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM bits WHERE n < 8),
crc AS (SELECT list(v ORDER BY i) AS steps FROM bits WHERE n = 8),
hashed AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                list_transform(regexp_extract_all(hex(CAST(doc_id AS VARCHAR)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
              lambda a, x: xor(a >> 8, crc.steps[(xor(a, x) & 255) + 1])), 4294967295) % 7 = 0
              THEN {_leaf_sql("(n_chars + 1)")} END AS tampered
  FROM documents, crc),
leaves AS (
  SELECT *, row_number() OVER () AS rid, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
{_levels_sql("nodes", "SELECT tree, 0 AS level, place, leaf AS h, n FROM leaves")},
subroots AS (SELECT tree, h AS subroot FROM nodes WHERE n = 1),
{_levels_sql("tops", "SELECT CAST(0 AS BIGINT) AS tree, 0 AS level, tree AS place, subroot AS h, count(*) OVER () AS n FROM subroots")},
steps AS ({_steps_sql("nodes", "place", "d.tree", 0)}
  UNION ALL {_steps_sql("tops", "tree", "0", 1000)}),
proofs AS (SELECT rid, list(step ORDER BY level) AS steps FROM steps GROUP BY rid),
folds AS (
  SELECT l.*, subroot, (SELECT h FROM tops WHERE n = 1) AS root,
         sha256(array_to_string(list_transform(coalesce(steps, []), lambda s: s[2:]), '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])),
           lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM leaves l JOIN subroots USING (tree) LEFT JOIN proofs USING (rid))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folds
"""}
QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}

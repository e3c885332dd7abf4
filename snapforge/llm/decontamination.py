"""Benchmark decontamination with a positional inverted index; column expressions and joins only.

The index holds, for the rarest terms of the test windows, every posting of the training texts: term, document,
position and the words around it. A posting minus the term's offset in the item is where the item would begin; the
lists are followed from the rarest term of each window, the other terms are compared at their offsets. Runs of equal
words that are as long as a window are exact phrase matches.

Rules: a null or empty text has no words and no hits; an item with fewer words than a window is one window; items
without words are ignored, as are items without an id. Rows equal in ``doc_id`` and text are judged alike and each
returned; items with one id are one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.llm.common import ascii_lower, fresh, table, written

WINDOW = 13
SHARE = 20  # a document is contaminated if at least one word in so many is hit
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; an empty array for null."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), BETWEEN), lambda w: w != "")


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows equal in id and text share a key, other rows do not."""
    return documents.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
        words(F.col(text_col)).alias("words"))


def test_items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id"), words(F.col("text")).alias("item_words")).where(
        "item_id is not null and size(item_words) > 0").distinct()


def term_counts(tokens: DataFrame, items: DataFrame) -> DataFrame:
    """``term, n``: how often each term of the items occurs in the training texts; 0 if it does not."""
    terms = written(items.select(F.explode("item_words").alias("term")).distinct(), "terms")
    found = tokens.select(F.explode("words").alias("term")).join(terms, "term").groupBy("term").agg(
        F.count("*").alias("n"))
    return terms.join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_terms(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, item_words, at, term``: for each window of an item the place of its rarest term, each place once.

    A window with a term that never occurs cannot match and has no row.
    """
    whole = F.xxhash64("item_words")
    places = items.withColumn("item_key", whole).select(
        "item_id", "item_key", F.size("item_words").alias("length"), F.posexplode("item_words").alias("at", "term"))
    first = F.explode(F.sequence(F.greatest(F.col("at") - window + 1, F.lit(0)),
                                 F.least("at", F.greatest(F.col("length") - window, F.lit(0)))))
    rarest = (
        places.join(counts, "term").withColumn("first", first)
        .groupBy("item_id", "item_key", "first").agg(F.min(F.struct("n", "term", "at")).alias("rarest"))
        .where("rarest.n > 0").select("item_id", "item_key", "rarest.at", "rarest.term").distinct())
    return rarest.join(items.withColumn("item_key", whole), ["item_id", "item_key"]).select(
        "item_id", "item_words", "at", "term")


def build_index(tokens: DataFrame, terms: DataFrame, reach: int = WINDOW - 1) -> DataFrame:
    """Postings ``term, id, text_key, pos, left, right`` of the given terms; left is read backwards from the posting."""
    pos = F.col("pos")
    begin = F.greatest(pos - reach, F.lit(0))
    return (
        tokens.select("*", F.posexplode("words").alias("pos", "term")).join(terms, "term").select(
            "term", "id", "text_key", "pos", F.reverse(F.slice("words", begin + 1, pos - begin)).alias("left"),
            F.slice("words", pos + 2, F.lit(reach)).alias("right")))


def _equal_run(a: Column, b: Column, most: int) -> Column:
    """How many leading words two arrays share."""
    def step(n: Column, k: Column) -> Column:
        return F.when((n == k) & F.coalesce(F.get(a, k) == F.get(b, k), F.lit(False)), n + 1).otherwise(n)

    return F.aggregate(F.sequence(F.lit(0), F.lit(most - 1)), F.lit(0), step)


def phrase_matches(index: DataFrame, anchors: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, text_key, item_id, begin, end``: runs of words (end exclusive) that a document shares with an item and that
    are at least a window, or a whole shorter item, long."""
    reach, at = window - 1, F.col("at")
    begin = F.greatest(at - reach, F.lit(0))
    prepared = anchors.select(
        "item_id", "term", F.least(F.size("item_words"), F.lit(window)).alias("needed"),
        F.reverse(F.slice("item_words", begin + 1, at - begin)).alias("item_left"),
        F.slice("item_words", at + 2, F.lit(reach)).alias("item_right"))
    if window == 1:
        return index.join(prepared, "term").select(
            "id", "text_key", "item_id", F.col("pos").alias("begin"), (F.col("pos") + 1).alias("end"))
    before, after = (_equal_run(F.col(a), F.col(b), reach) for a, b in (("left", "item_left"), ("right", "item_right")))
    return (
        index.join(prepared, "term").where(before + after + 1 >= F.col("needed"))
        .select("id", "text_key", "item_id", (F.col("pos") - before).alias("begin"),
                (F.col("pos") + after + 1).alias("end")))


def proximity_matches(index: DataFrame, anchors: DataFrame, terms: int = 3) -> DataFrame:
    """``id, text_key, item_id, pos``: postings of a window's rarest term that have the ``terms`` item words next to it
    among the words around them, in any order."""
    at = F.col("at")
    near = F.slice("item_words", F.greatest(at - terms // 2, F.lit(0)) + 1, F.lit(terms + 1))
    around = F.concat(F.col("left"), F.array("term"), F.col("right"))
    return index.join(anchors.select("item_id", "term", near.alias("near")), "term").where(
        F.size(F.array_except("near", around)) == 0).select("id", "text_key", "item_id", "pos")


def _covered(spans: Column) -> Column:
    """Places in the union of ``array(struct(begin, end))``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(F.array_sort(spans), start, lambda s, x: F.struct(
        (s["n"] + F.greatest(x["end"] - F.greatest(x["begin"], s["upto"]), F.lit(0))).alias("n"),
        F.greatest(s["upto"], x["end"]).alias("upto")))["n"]


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id, text_key, n_hit, item_ids`` of the documents with a hit; item_ids sorted as text."""
    tokens, items = _keyed(documents, id_col, text_col), written(test_items(benchmark), "items")
    anchors = written(rarest_terms(items, written(term_counts(tokens, items), "counts"), window), "anchors")
    terms = written(anchors.select("term").distinct(), "terms")
    index = written(build_index(tokens, terms, max(window - 1, 1)), "index")
    runs = phrase_matches(index, anchors, window)
    ends = runs.groupBy("id", "text_key", "begin").agg(F.max("end").alias("end"))
    covered = ends.groupBy("id", "text_key").agg(_covered(F.collect_list(F.struct("begin", "end"))).alias("n_hit"))
    named = runs.groupBy("id", "text_key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    return covered.withColumnRenamed("id", "cid").withColumnRenamed("text_key", "ckey").join(
        named, F.col("cid").eqNullSafe(F.col("id")) & (F.col("ckey") == F.col("text_key"))).drop("cid", "ckey")


def contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``documents`` with ``n_words, n_hit, item_ids, contaminated``, which replace columns of these names; no row is
    dropped."""
    own = documents.drop("n_words", "n_hit", "item_ids", "contaminated")
    found_id, found_key, own_key = (fresh(name, own.columns) for name in ("found_id", "found_key", "own_key"))
    found = written(hits(documents, benchmark, window, id_col, text_col), "hits").select(
        F.col("id").alias(found_id), F.col("text_key").alias(found_key), "n_hit", "item_ids")
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = own.withColumns({own_key: text_key, "n_words": F.size(words(F.col(text_col))).cast("long")}).join(
        found, F.col(id_col).eqNullSafe(F.col(found_id)) & (F.col(own_key) == F.col(found_key)), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        *own.columns, "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(documents, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str) -> str:
    return f"regexp_extract_all({_LOWER.format(text)}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def words_sql(source: str = "documents") -> str:
    """CTEs up to ``judged``: every row of ``source`` with its counts."""
    return f"""
rows AS (SELECT *, row_number() OVER () AS rid, coalesce({_words_sql("text")}, []) AS w FROM {source}),
items AS (SELECT item_id, {_words_sql("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
lens AS (SELECT DISTINCT least(len(w), {WINDOW}) AS n FROM items WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[s:s + least(len(w), {WINDOW}) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
grams AS (
  SELECT rid, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM rows, lens WHERE len(w) >= n)),
found AS (SELECT rid, s, n, item_id FROM grams JOIN wins USING (n, g)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM found) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY rid),
judged AS (
  SELECT rows.*, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
         CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
         coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM rows LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid))"""


SQL = {"op1_decontamination": f"""
WITH {words_sql()}
SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM judged
"""}
QUERIES = {"op1_decontamination": op1_decontamination}

"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in column expressions only.

Rules: the key of a row and the number of shards decide its shard; with one more shard a row stays or moves to the new
one. A null key counts as the empty text. Rows that are equal in key, size and checksum are counted, not sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.llm.common import fresh, table, written

MULTIPLIER = 2862933555777941757  # of the published generator: key * MULTIPLIER + 1 modulo 2**64
M_HIGH, M_LOW, WORD = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF, 0xFFFFFFFF
USUAL_STEPS = 32
BUCKET_DIGITS = 3


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a key given as ``struct(hi, lo)``, unsigned halves of a 64-bit key.

    About ln(shards) steps are usual and ``shards`` the most; the long loop runs for keys that are not done by then.
    """
    if shards < 1:
        raise ValueError("at least one shard")

    def steps(state: Column, most: int) -> Column:
        def step(s: Column, _: Column) -> Column:
            after = F.transform(
                _step(s), lambda n: F.struct(
                    n["b"].alias("b"),
                    ((n["b"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(n["hi"], 1) + 1))).cast("long").alias("j"),
                    n["hi"].alias("hi"), n["lo"].alias("lo")))[0]
            return F.when(s["j"] < shards, after).otherwise(s)

        return F.aggregate(F.sequence(F.lit(1), F.lit(most)), state, step)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), key["hi"].alias("hi"),
                     key["lo"].alias("lo"))
    if shards <= USUAL_STEPS:
        return steps(start, shards)["b"].cast("int")
    return F.transform(F.array(steps(start, USUAL_STEPS)), lambda s: F.when(
        s["j"] < shards, steps(s, shards)["b"]).otherwise(s["b"]))[0].cast("int")


def _step(s: Column) -> Column:
    """``array(struct(b, hi, lo))``: the generator moved on once."""
    low, high = F.lit(M_LOW).cast("long"), F.lit(M_HIGH).cast("long")

    def half(n: int) -> Column:
        return F.lit(n).cast("long")

    first = F.array(F.struct(
        s["j"].alias("b"), s["hi"].alias("hi"), s["lo"].alias("lo"),
        (F.shiftright(s["lo"], 16) * low).alias("mid"), (s["lo"].bitwiseAND(half(0xFFFF)) * low).alias("low")))
    second = F.transform(first, lambda n: F.struct(
        n["b"].alias("b"), n["hi"].alias("hi"), n["lo"].alias("lo"), n["mid"].alias("mid"),
        (n["low"] + F.shiftleft(n["mid"].bitwiseAND(half(0xFFFF)), 16) + 1).alias("t")))
    return F.transform(second, lambda n: F.struct(
        n["b"].alias("b"),
        (F.shiftright(n["t"], 32) + F.shiftright(n["mid"], 16) + (n["lo"] * high).bitwiseAND(half(WORD))
         + (n["hi"].bitwiseAND(half(0xFFFF)) * low).bitwiseAND(half(WORD))
         + F.shiftleft((F.shiftright(n["hi"], 16) * low).bitwiseAND(half(0xFFFF)), 16)).bitwiseAND(half(WORD)).alias("hi"),
        n["t"].bitwiseAND(half(WORD)).alias("lo")))


def stable_key(column: Column) -> Column:
    """``struct(hi, lo)`` from the column's text, alike on every machine."""
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")))

    def part(begin: int) -> Column:
        return F.conv(F.substring(digest, begin, 8), 16, 10).cast("long")

    return F.struct(part(1).alias("hi"), part(9).alias("lo"))


def assign(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` and ``grown_shard``, the shard with one more; they replace columns of these names. Nothing
    is shuffled."""
    halves = fresh("halves", rows.columns)
    return rows.withColumn(halves, stable_key(F.col(key))).withColumns({
        "shard": jump_hash(F.col(halves), shards), "grown_shard": jump_hash(F.col(halves), shards + 1)}).drop(halves)


def with_slots(rows: DataFrame) -> DataFrame:
    """``rows`` (all columns can be compared) with ``slot``, counting from 0 in each shard without a gap.

    The order is by a digest of the row, cut into 16 ** BUCKET_DIGITS buckets, then by the row. Equal rows are counted
    first, so no bucket is hot; the offsets of the buckets are one row each.
    """
    order = [c for c in rows.columns if c != "shard"]
    text = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order))
    counted = written(
        rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
        .withColumn("_bucket", F.substring(F.md5(text), 1, BUCKET_DIGITS)), "slots")
    sizes = counted.groupBy("shard", "_bucket").agg(F.sum("_n").alias("_size"))
    before = F.expr("coalesce(sum(_size) over (partition by shard order by _bucket rows between unbounded preceding"
                    " and 1 preceding), 0)")
    inside = F.expr("coalesce(sum(_n) over (partition by shard, _bucket order by " + ", ".join(f"`{c}`" for c in order)
                    + " rows between unbounded preceding and 1 preceding), 0)")
    numbered = counted.withColumn("_inside", inside)
    offsets = sizes.select("shard", "_bucket", before.alias("_before"))
    return (
        numbered.join(offsets, ["shard", "_bucket"])
        .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
        .select(*rows.columns, (F.col("_before") + F.col("_inside") + F.col("_k")).alias("slot")))


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return with_slots(assign(narrow, "doc_id", shards)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def _jump_sql(shards: int, out: str) -> str:
    """Steps written out; the key is a HUGEINT of 64 bits."""
    steps = [f"s0_{out} AS (SELECT *, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j, key AS k FROM base_{out})"]
    for n in range(shards):
        steps.append(f"""
s{n + 1}_{out} AS (
  SELECT * EXCLUDE (b, j, k, k2), CASE WHEN j < {shards} THEN j ELSE b END AS b,
         CASE WHEN j < {shards} THEN CAST(floor((j + 1) * (2147483648.0::DOUBLE / (k2 // 8589934592 + 1)::DOUBLE)) AS BIGINT)
              ELSE j END AS j, k2 AS k
  FROM (SELECT *, (k * {MULTIPLIER} + 1) % 18446744073709551616::HUGEINT AS k2 FROM s{n}_{out}))""")
    steps.append(f"{out} AS (SELECT * EXCLUDE (b, j, k), CAST(b AS INTEGER) AS {out} FROM s{shards}_{out})")
    return ",".join(steps)


SQL = {"op2_sharding": f"""
WITH RECURSIVE bits AS (
  SELECT i, CAST(i AS BIGINT) AS v, 0 AS n FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM bits WHERE n < 8),
crc AS (SELECT list(v ORDER BY i) AS steps FROM bits WHERE n = 8),
sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: CAST('0x' || h AS BIGINT))),
             lambda a, x: xor(a >> 8, crc.steps[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc),
base_shard AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS HUGEINT) * 4294967296
            + CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 9, 8) AS HUGEINT) AS key
  FROM sized),
{_jump_sql(8, "shard")},
base_grown_shard AS (SELECT * FROM shard),
{_jump_sql(9, "grown_shard")}
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY
         substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32, grown_shard)), 1, {BUCKET_DIGITS}),
         doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM grown_shard
"""}
QUERIES = {"op2_sharding": op2_sharding}

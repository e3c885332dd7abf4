"""The training-data pipeline over ``documents``.

Each stage works on all rows its predecessor kept and gives rows with the columns of ``documents``; the last one gives
identifiers instead. Every stage's result is a table in the shared folder, so a lost executor costs its own tasks only.

Rules: whatever else ``documents`` holds goes with its row and is not changed, whatever its name; only ``text`` and
``n_chars`` follow a redaction. A null or empty text has no letter and goes in the first stage; texts with a letter stay,
also where no row tells a language (no ``lang``, all such rows held out or without a doc_id). Near duplicates are rows:
of repeated rows, of rows without a doc_id and of several texts with one doc_id each is judged by its text. An empty
table gives an empty result, and an empty ``benchmark`` takes nothing out.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.llm import bpe_codec, decontamination, language_id, near_duplicates, secret_scan
from snapforge.llm.common import fresh, table, written
from snapforge.session import bound_batches

VOCABULARY = "word_bpe_49k.json"


def _carried(docs: DataFrame) -> DataFrame:
    """``doc_id, text, row``: ``row`` has all columns but the text, so no operator meets a column with a name of its own."""
    return docs.select("doc_id", "text", F.struct("doc_id", *(c for c in docs.columns if c not in ("doc_id", "text"))).alias("row"))


def _restored(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from rows that were carried."""
    plain = {c: F.col("text") if c == "text" else F.col("row").getField(c) for c in docs.columns}
    return rows.select(*(changed.get(c, column).alias(c) for c, column in plain.items()))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language go: null, or without a letter. The model learns from the rows that are not held out; where
    they teach no language, it would call every text ``und``, so the letters alone decide."""
    model = language_id.learn(docs.where(~language_id.is_held_out()))
    if not model.languages:
        return _restored(language_id.lettered(_carried(docs)), docs)
    judged = language_id.predict(_carried(docs), model)
    return _restored(judged.where(F.col("lang_pred") != language_id.UNDETERMINED), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that five-word shingles link at 0.8 or more one row stays: the smallest doc_id's, one
    without a doc_id if there is no other, of several the one with the smallest digest. Rows are judged by their text,
    whatever their doc_id."""
    number = fresh("row", docs.columns)
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates.near_duplicates(rows, id_col=number).select("id", "component_id")
    linked = written(found.join(rows.select(F.col(number).alias("id"), "doc_id", F.md5("text").alias("mark")), "id"),
                     "linked")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark", "id")
    groups = linked.groupBy("component_id").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = linked.join(groups, "component_id").where(F.col("id") != F.col("first.id")).select(F.col("id").alias(number))
    return rows.join(written(gone, "gone"), number, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontamination.contaminated(_carried(docs), table(spark, sf_dir, "benchmark"))
    return _restored(judged.where("not contaminated"), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a mark, ``n_chars`` follows; the documents stay."""
    found = secret_scan.scan(_carried(docs), secret_scan.learn(docs), masked_col="masked")
    n_chars = F.when(F.size("spans") > 0, F.char_length("masked").cast("long")).otherwise(F.col("row.n_chars"))
    return _restored(found, docs, text=F.col("masked"), n_chars=n_chars)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, identifiers, their number, and a digest of what they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    rows = bpe_codec.encode(docs.select("doc_id", "text"), path, decoded_col="decoded")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def _bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with Arrow batches of bounded size, which an executor's Python workers hold several of."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [("language ID", keep_languages), ("MinHash near-dedup", drop_near_duplicates),
          ("benchmark decontamination", drop_contaminated), ("secret scans", redact_secrets),
          ("BPE encoding and decoding", encode_tokens)]
STAGES = [(name, _bounded(stage)) for name, stage in STAGES]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs

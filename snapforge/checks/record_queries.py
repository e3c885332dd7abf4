"""Decode, JSON, audit and equality tables, record operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapforge.checks import inputs as i
from snapforge.functions import json_text, names, text
from snapforge.operators import decode, records
from snapforge.session import new_run_dir
from snapforge.sinks import files, tables
from snapforge.sources import tables as sources

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def _new_database(spark) -> str:
    name = f"check_{uuid.uuid4().hex}"
    tables.create_database(spark, name, new_run_dir(spark, "db"))
    return name


def _decoded(spark, sf, cipher: str, codec: str, objects: DataFrame | None = None, lineage: bool = True) -> DataFrame:
    objects = i.objects(spark, sf, cipher, codec) if objects is None else objects
    keyed = decode.with_plain_keys(objects, i.key_table(spark, sf, cipher))
    if lineage:
        return decode.decode_objects(keyed, cipher, codec, ["collection", "path"])
    return decode.decode_objects(keyed, cipher, codec, ["collection"], error_only=["path"])


LINES_SQL = "WITH " + i.KEYS_SQL + """
    , parts AS (SELECT collection, 'exp/full/' || name AS path, string_split(text, chr(10)) AS p FROM docs)
    SELECT collection, path, unnest(range(len(p))) AS line_no, unnest(p) AS val FROM parts"""


@query("decode_ctr_gzip", LINES_SQL)
def decode_ctr_gzip(spark, sf):
    return _decoded(spark, sf, "ctr", "gzip").select("collection", "path", "line_no", "val")


@query("decode_eax_zlib", LINES_SQL)
def decode_eax_zlib(spark, sf):
    return _decoded(spark, sf, "eax", "zlib").select("collection", "path", "line_no", "val")


@query("decode_failures", "WITH " + i.KEYS_SQL + """
    SELECT 'exp/full/' || name AS path, coalesce(toxic, 0) = 1 AS failed,
           CASE WHEN toxic = 1 THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines
    FROM docs LEFT JOIN labels USING (doc_id)""")
def decode_failures(spark, sf):
    """Content of toxic documents is cut in half; the others must come through whole."""
    labels = i.table(spark, sf, "labels").select("doc_id", "toxic")
    flagged = i.objects(spark, sf, "ctr", "gzip").join(labels, "doc_id", "left")
    half = (F.length("content") / 2).cast("int")
    content = F.when(F.col("toxic") == 1, F.substring("content", F.lit(1), half)).otherwise(F.col("content"))
    decoded = _decoded(spark, sf, "ctr", "gzip", flagged.withColumn("content", content))
    return decoded.groupBy("path").agg(
        F.max(F.col("error").isNotNull()).alias("failed"), F.count("line_no").alias("n_lines")
    )


@query("data_keys", "SELECT DISTINCT 'sealed-' || source AS ciphertext, 'master-1' AS key_id FROM documents")
def data_keys(spark, sf):
    docs = i.table(spark, sf, "documents")
    sealed = docs.select(F.concat(F.lit("sealed-"), F.col("source")).alias("ciphertext"), F.lit("master-1").alias("key_id"))
    return decode.data_keys(sealed)


@query("split_lines", LINES_SQL)
def split_lines(spark, sf):
    """The built-in twin of the line reader, for text that is already plain."""
    docs = i.table(spark, sf, "documents").select(
        F.concat(F.lit("db."), "source", F.lit("."), "lang").alias("collection"), "doc_id", "text"
    )
    path = F.concat(
        F.lit(i.PREFIX), F.col("collection"), F.lit("."), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".gz.enc")
    )
    return docs.select(
        "collection", path.alias("path"), F.posexplode(text.lines(F.concat("text", F.lit("\n")))).alias("n", "val")
    ).select("collection", "path", F.col("n").cast("long").alias("line_no"), "val")


def publish(spark, sf) -> tuple[str, str]:
    """Decode, write and publish all documents; returns the database and the root of the files."""
    root, database = new_run_dir(spark, "published"), _new_database(spark)
    docs = i.table(spark, sf, "documents").select(
        F.concat(F.lit("db."), "source", F.lit("."), "lang").alias("collection")
    )
    named = docs.select("collection", names.table_name(F.col("collection")).alias("table_name"))
    found = named.distinct().collect()  # one row per collection
    files.write_decoded(_decoded(spark, sf, "ctr", "gzip", lineage=False), root, ["collection"], few_files=True)
    locations = {
        f"{database}.{row['table_name']}": files.lines_location(root, collection=row["collection"]) for row in found
    }
    errors = tables.publish_raw_tables(spark, locations)
    if errors:
        raise RuntimeError(str(errors))
    return database, root


@query("publish_raw", "WITH " + i.KEYS_SQL + """
    SELECT collection, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
           CAST(sum(list_sum(list_transform(string_split(text, chr(10)), lambda x: length(x)))) AS BIGINT) AS n_chars
    FROM docs GROUP BY collection""")
def publish_raw(spark, sf):
    _, root = publish(spark, sf)
    lines = sources.read_lines(spark, f"{root}/kind={files.LINES}")
    return lines.groupBy("collection").agg(F.count("*").alias("n_lines"), F.sum(F.length("val")).alias("n_chars"))


@query("published_tables", """
    SELECT source || '_' || lang AS table_name, count(*) AS n_lines, min(line) AS first_line, max(line) AS last_line,
           CAST(sum(('0x' || md5(line)[1:8])::BIGINT) AS BIGINT) AS checksum
    FROM (SELECT source, lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source, lang""")
def published_tables(spark, sf):
    """Number, ends and a sum of hashes of all lines below the locations the tables name, in one scan."""
    database, root = publish(spark, sf)
    found = {row.tableName for row in spark.sql(f"SHOW TABLES IN {database}").collect()}
    location = f"{root}/kind={files.LINES}"
    lines = spark.read.schema("value string, collection string").option("basePath", location).text(location)
    each = lines.select(names.table_name(F.col("collection")).alias("table_name"), "value")
    return each.where(F.col("table_name").isin(found)).groupBy("table_name").agg(
        F.count("*").alias("n_lines"), F.min("value").alias("first_line"), F.max("value").alias("last_line"),
        F.sum(F.conv(F.substring(F.md5(F.col("value").cast("binary")), 1, 8), 16, 10).cast("long")).alias("checksum"),
    )


@query("publish_parquet", "SELECT * FROM events")
def publish_parquet(spark, sf):
    database, location = _new_database(spark), new_run_dir(spark, "parquet")
    events = i.table(spark, sf, "events")
    tables.publish_parquet(events, f"{database}.events", location, ["event_type"])
    return spark.table(f"{database}.events")


@query("json_typed", "WITH " + i.AUDIT_SQL + "SELECT number, event_id, event_type, userid, props FROM audit")
def json_typed(spark, sf):
    lines = i.audit_lines(spark, sf).withColumnRenamed("event_id", "number")
    return json_text.with_json_columns(lines, "val", i.AUDIT_FIELDS).drop("val", "date_str")


@query("json_nested_flatten", "WITH " + i.EQUALITY_SQL + "SELECT * REPLACE (CAST(load_date AS VARCHAR) AS load_date) FROM equality")
def json_nested_flatten(spark, sf):
    flat = records.flatten_equality(i.equality_lines(spark, sf), F.lit("2021-07-02"))
    return flat.withColumn("load_date", F.col("load_date").cast("string"))


def _audit_twice(spark, sf) -> str:
    """Load every date twice, then the newest one again; returns the database."""
    database = _new_database(spark)
    lines = i.audit_lines(spark, sf).select("val", "date_str")
    newest = lines.agg(F.max("date_str")).first()[0]
    for part in (lines, lines, lines.where(F.col("date_str") == newest)):
        tables.load_audit_raw(part, f"{database}.auditlog_raw")
        tables.load_audit_typed(part, f"{database}.auditlog_managed", i.AUDIT_FIELDS)
    return database


@query("audit_overwrite_twice", "WITH " + i.AUDIT_SQL + """
    SELECT date_str, count(*) AS n_raw, count(*) AS n_typed, count(event_id) AS n_sound,
           count(DISTINCT userid) AS n_users FROM audit GROUP BY date_str""")
def audit_overwrite_twice(spark, sf):
    database = _audit_twice(spark, sf)
    raw = spark.table(f"{database}.auditlog_raw").groupBy("date_str").agg(F.count("*").alias("n_raw"))
    typed = spark.table(f"{database}.auditlog_managed").groupBy("date_str").agg(
        F.count("*").alias("n_typed"), F.count("event_id").alias("n_sound"), F.countDistinct("userid").alias("n_users")
    )
    return raw.join(typed, "date_str")


@query("audit_projection", "WITH " + i.AUDIT_SQL + "SELECT event_type, userid, date_str FROM audit")
def audit_projection(spark, sf):
    database = _audit_twice(spark, sf)
    source = spark.table(f"{database}.auditlog_managed")
    location = new_run_dir(spark, "secured")
    for _ in range(2):
        tables.copy_audit_projection(source, f"{database}.auditlog_sec_v", ["event_type", "userid"], location)
    return spark.table(f"{database}.auditlog_sec_v")


EQUALITY_COLUMNS = "type, claimantid, ethnicgroup, ethnicitysubgroup, sexualorientation, religion, maritalstatus"


@query("equality_append_twice", "WITH " + i.EQUALITY_SQL + f"""
    SELECT {EQUALITY_COLUMNS}, CAST(load_date AS VARCHAR) AS load_date FROM equality
    UNION ALL SELECT {EQUALITY_COLUMNS}, CAST(load_date AS VARCHAR) FROM equality""")
def equality_append_twice(spark, sf):
    target = f"{_new_database(spark)}.equality_managed"
    for _ in range(2):
        tables.append_equality(records.flatten_equality(i.equality_lines(spark, sf), F.lit("2021-07-02")), target)
    return spark.table(target).withColumn("load_date", F.col("load_date").cast("string"))


@query("equality_idempotent", "WITH " + i.EQUALITY_SQL + f"""
    SELECT {EQUALITY_COLUMNS}, CAST(load_date AS VARCHAR) AS load_date, '2021-07-01' AS export_date FROM equality""")
def equality_idempotent(spark, sf):
    target = f"{_new_database(spark)}.equality_keyed"
    flat = records.flatten_equality(i.equality_lines(spark, sf), F.lit("2021-07-02"))
    for _ in range(2):
        tables.replace_equality(flat, target, "2021-07-01")
    return spark.table(target).withColumn("load_date", F.col("load_date").cast("string"))


@query("latest_version", """
    SELECT user_id, event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
           arg_max(value, (ts, event_id)) AS value, arg_max(props, (ts, event_id)) AS props
    FROM events GROUP BY user_id, event_type""")
def latest_version(spark, sf):
    events = i.table(spark, sf, "events")
    return records.latest_version(events, ["user_id", "event_type"], ["ts", "event_id"])


@query("message_envelope", """
    SELECT source AS db, lang AS collection, CAST(doc_id AS VARCHAR) AS id, 'MONGO_INSERT' AS message_type,
           epoch_ms(TIMESTAMP '2019-07-01 11:05:09.250' + to_days(CAST(doc_id % 28 AS INT))) AS modified_millis,
           'k-1' AS encryption_key_id, 'sealed-' || source AS ciphertext, 'master-1' AS key_id,
           'v-2' AS version FROM documents""")
def message_envelope(spark, sf):
    decoded = records.decode_envelope(i.envelopes(spark, sf))
    return decoded.select(
        "db", "collection", "id", "message_type", F.unix_millis("modified_at").alias("modified_millis"),
        "encryption_key_id", "ciphertext", "key_id", "version",
    )


@query("envelope_payload", "SELECT CAST(doc_id AS VARCHAR) AS id, text AS payload FROM documents")
def envelope_payload(spark, sf):
    decoded = records.decode_envelope(i.envelopes(spark, sf)).select("id", "ciphertext", "iv", "db_object")
    keyed = decode.with_plain_keys(decoded, i.key_table(spark, sf, "ctr"))
    return records.open_payload(keyed).select("id", "payload")

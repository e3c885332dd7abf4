"""Inputs of the registered queries, derived from the given tables, each with its SQL twin.

Every frame covers its whole tables.
"""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from snapforge.functions import crypto

PREFIX = "exp/full/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- object listing ----------------------------------------------------------------------------------------

def _export_name(collection: Column, number: Column) -> Column:
    return F.concat(collection, F.lit("."), F.lpad(number.cast("string"), 12, "0"), F.lit(".gz.enc"))


def _doc_collection() -> Column:
    return F.concat(F.lit("db."), F.col("source"), F.lit("."), F.col("lang"))


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, name, length``: exports, re-exports of labelled documents in a second folder, names that do not
    follow the pattern, audit and equality exports, another prefix and the folder marker."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    docs = table(spark, sf_dir, "documents").select(
        _export_name(_doc_collection(), F.col("doc_id")).alias("name"),
        F.octet_length("text").cast("long").alias("length"),
        "doc_id",
    )
    folders = F.when(F.col("labelled"), F.array(F.lit(PREFIX), F.lit(PREFIX + "retry/"))).otherwise(F.array(F.lit(PREFIX)))
    docs = docs.join(labels, "doc_id", "left").select("name", "length", F.explode(folders).alias("folder"))
    chats = table(spark, sf_dir, "conversations")
    events = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey")

    def put(df: DataFrame, folder: str, name: Column | str, length: Column | str) -> DataFrame:
        name = F.col(name) if isinstance(name, str) else name
        return df.select(F.concat(F.lit(folder), name).alias("path"), name.alias("name"), F.col(length).alias("length"))

    parts = [
        docs.select(F.concat("folder", "name").alias("path"), "name", "length"),
        put(
            table(spark, sf_dir, "pages").withColumn("length", F.octet_length("html").cast("long")),
            PREFIX, F.concat(F.lit("page-"), F.col("page_id").cast("string")), "length",
        ),
        put(
            events.agg(F.sum(F.octet_length("props")).alias("length")),
            PREFIX, F.concat(F.lit("db.data.businessAudit."), F.col("day"), F.lit(".gz.enc")), "length",
        ),
        put(
            customers.agg(F.sum(F.octet_length("c_name")).alias("length")),
            PREFIX, _export_name(F.lit("db.data.equality"), F.col("c_nationkey")), "length",
        ),
        put(
            chats.withColumn("length", F.octet_length("text").cast("long")),
            "exp/incremental/",
            F.concat(
                F.lit("db.chat."), F.col("role"), F.lit("."), F.lpad(F.col("conv_id").cast("string"), 12, "0"),
                F.lit("-"), F.lpad(F.col("turn").cast("string"), 6, "0"), F.lit(".gz.enc"),
            ),
            "length",
        ),
    ]
    marker = table(spark, sf_dir, "region").agg(F.lit(0).cast("long").alias("length"))
    out = marker.select(F.lit(PREFIX).alias("path"), F.lit("").alias("name"), "length")
    for part in parts:
        out = out.unionByName(part)
    return out


KEYS_SQL = """
docs AS (
    SELECT doc_id, 'db.' || source || '.' || lang AS collection, text,
           'db.' || source || '.' || lang || '.' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '.gz.enc' AS name,
           CAST(strlen(text) AS BIGINT) AS length
    FROM documents),
keys AS (
    SELECT 'exp/full/' AS path, '' AS name, CAST(0 AS BIGINT) AS length
    UNION ALL SELECT 'exp/full/' || name, name, length FROM docs
    UNION ALL SELECT 'exp/full/retry/' || name, name, length FROM docs
              WHERE doc_id IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'exp/full/page-' || page_id, 'page-' || page_id, CAST(strlen(html) AS BIGINT) FROM pages
    UNION ALL SELECT 'exp/full/db.data.businessAudit.' || strftime(ts, '%Y-%m-%d') || '.gz.enc',
                     'db.data.businessAudit.' || strftime(ts, '%Y-%m-%d') || '.gz.enc',
                     CAST(sum(strlen(props)) AS BIGINT) FROM events GROUP BY ALL
    UNION ALL SELECT 'exp/full/db.data.equality.' || lpad(CAST(c_nationkey AS VARCHAR), 12, '0') || '.gz.enc',
                     'db.data.equality.' || lpad(CAST(c_nationkey AS VARCHAR), 12, '0') || '.gz.enc',
                     CAST(sum(strlen(c_name)) AS BIGINT) FROM customer GROUP BY ALL
    UNION ALL SELECT 'exp/incremental/db.chat.' || role || '.' || lpad(CAST(conv_id AS VARCHAR), 12, '0') || '-'
                     || lpad(CAST(turn AS VARCHAR), 6, '0') || '.gz.enc',
                     'db.chat.' || role || '.' || lpad(CAST(conv_id AS VARCHAR), 12, '0') || '-'
                     || lpad(CAST(turn AS VARCHAR), 6, '0') || '.gz.enc',
                     CAST(strlen(text) AS BIGINT) FROM conversations),
named AS (
    SELECT path, name, length,
           nullif(regexp_extract(name, '^(?:db.)?([\\w-]+)\\.([A-Za-z]+-?[A-Za-z]+)', 0), '') AS collection
    FROM keys WHERE starts_with(path, 'exp/full/') AND path <> 'exp/full/')
"""


# --- collection configuration -----------------------------------------------------------------------------

def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collection, tags``: collections with a toxic document, the audit and equality ones, and an empty one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labels = table(spark, sf_dir, "labels").where("toxic = 1")
    grouped = docs.join(labels, "doc_id").groupBy("source", "lang").agg(
        F.when(F.min("quality") == 0, "true").otherwise("false").alias("pii"),
        F.when(F.count("*") > 1, "crown").otherwise("team").alias("owner"),
    )

    def tags(pii: Column, db: Column, name: Column, owner: Column) -> Column:
        return F.create_map(
            F.lit("pii"), pii, F.lit("db"), db, F.lit("table"), name, F.lit("collection_tag"), owner
        ).alias("tags")

    named = grouped.select(
        _doc_collection().alias("collection"), tags(F.col("pii"), F.col("source"), F.col("lang"), F.col("owner"))
    )
    fixed = [("data", "businessAudit"), ("data", "equality"), ("fake", "empty")]
    one = table(spark, sf_dir, "region").agg(F.lit(1).alias("one"))
    rows = F.array(*[F.struct(F.lit(db).alias("db"), F.lit(name).alias("name")) for db, name in fixed])
    always = one.select(F.inline(rows)).select(
        F.concat(F.lit("db."), "db", F.lit("."), "name").alias("collection"),
        tags(F.lit("true"), F.col("db"), F.col("name"), F.lit("crown")),
    )
    return named.unionByName(always)


CONFIG_SQL = """
config AS (
    SELECT 'db.' || source || '.' || lang AS collection, source AS db, lang AS tbl,
           CASE WHEN min(quality) = 0 THEN 'true' ELSE 'false' END AS pii,
           CASE WHEN count(*) > 1 THEN 'crown' ELSE 'team' END AS owner
    FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY source, lang
    UNION ALL SELECT 'db.data.businessAudit', 'data', 'businessAudit', 'true', 'crown'
    UNION ALL SELECT 'db.data.equality', 'data', 'equality', 'true', 'crown'
    UNION ALL SELECT 'db.fake.empty', 'fake', 'empty', 'true', 'crown')
"""


# --- encrypted objects ------------------------------------------------------------------------------------

@F.arrow_udf(BinaryType())
def _gzip(data: pa.Array) -> pa.Array:
    return pa.array([gzip.compress(d.as_buffer(), 1, mtime=0) for d in data], pa.binary())


@F.arrow_udf(BinaryType())
def _zlib(data: pa.Array) -> pa.Array:
    return pa.array([zlib.compress(d.as_buffer(), 1) for d in data], pa.binary())


def secret(seed: Column, key_bytes: int) -> Column:
    return F.substring(F.unhex(F.sha2(seed, 256)), 1, key_bytes)


KEY_BYTES = {"ctr": 16, "eax": 32}


def sealed(texts: DataFrame, cipher: str, codec: str) -> DataFrame:
    """``texts(name, owner, text, ...)`` with ``content``: the text and one newline, packed and encrypted.

    Every owner has a data key of its own, the vector follows from the name. Both ciphers are their own inverse, so
    the key stream that decrypts also encrypts.
    """
    keyed = texts.withColumns(
        {"_key": secret(F.col("owner"), KEY_BYTES[cipher]), "_nonce": secret(F.col("name"), 16)}
    )
    packed = (_gzip if codec == "gzip" else _zlib)(F.encode(F.concat("text", F.lit("\n")), "UTF-8"))
    started = crypto.with_start(keyed, cipher, "_nonce", "_key", "_start")
    content = crypto.ctr_transform(packed, F.col("_key"), F.col("_start"))
    return started.withColumn("content", content).drop("_key", "_nonce", "_start")


def objects(spark: SparkSession, sf_dir: str, cipher: str, codec: str) -> DataFrame:
    """``collection, path, content, iv, ciphertext, key_id, doc_id``: one export object per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    named = docs.select(
        _export_name(_doc_collection(), F.col("doc_id")).alias("name"), F.col("source").alias("owner"), "text",
        _doc_collection().alias("collection"), "doc_id",
    )
    return sealed(named, cipher, codec).select(
        "collection",
        F.concat(F.lit(PREFIX), "name").alias("path"),
        "content",
        F.base64(secret(F.col("name"), 16)).alias("iv"),
        F.concat(F.lit("sealed-"), "owner").alias("ciphertext"),
        F.lit("master-1").alias("key_id"),
        "doc_id",
    )


def key_table(spark: SparkSession, sf_dir: str, cipher: str) -> DataFrame:
    """``ciphertext, plain_key``, as a key service would give it."""
    sources = table(spark, sf_dir, "documents").select("source").distinct()
    return sources.select(
        F.concat(F.lit("sealed-"), F.col("source")).alias("ciphertext"),
        F.base64(secret(F.col("source"), KEY_BYTES[cipher])).alias("plain_key"),
    )


# --- audit and equality lines -----------------------------------------------------------------------------

AUDIT_FIELDS = {"event_id": "event_id", "event_type": "event_type", "userid": "userId", "props": "props"}


def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, val, date_str``: events as JSON; those of type error are cut short, those of type click have
    keys in capitals."""
    events = table(spark, sf_dir, "events")
    line = F.format_string(
        '{"event_id":%d,"event_type":"%s","userId":"%d","props":%s}', "event_id", "event_type", "user_id", "props"
    )
    shouted = F.replace(
        F.replace(line, F.lit('"userId"'), F.lit('"USERID"')), F.lit('"event_type"'), F.lit('"EVENT_TYPE"')
    )
    val = (
        F.when(F.col("event_type") == "error", F.substring(line, F.lit(1), F.length(line) - 9))
        .when(F.col("event_type") == "click", shouted)
        .otherwise(line)
    )
    return events.select("event_id", val.alias("val"), F.date_format("ts", "yyyy-MM-dd").alias("date_str"))


AUDIT_SQL = """
audit AS (
    SELECT event_id AS number, strftime(ts, '%Y-%m-%d') AS date_str, event_type = 'error' AS broken,
           CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS event_id,
           CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
           CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS userid,
           CASE WHEN event_type <> 'error' THEN replace(props, ' ', '') END AS props
    FROM events)
"""


def equality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``val``: customers nested below ``message``; a NULL field stands for customers in debt."""
    customers = table(spark, sf_dir, "customer")
    message = F.struct(
        F.lit("CUSTOMER").alias("type"),
        F.col("c_custkey").cast("string").alias("claimantId"),
        F.col("c_mktsegment").alias("ethnicGroup"),
        F.col("c_nationkey").alias("ethnicitySubgroup"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("religion"),
    )
    return customers.select(F.to_json(F.struct(message.alias("message"))).alias("val"))


EQUALITY_SQL = """
equality AS (
    SELECT 'CUSTOMER' AS type, CAST(c_custkey AS VARCHAR) AS claimantid, c_mktsegment AS ethnicgroup,
           CAST(c_nationkey AS VARCHAR) AS ethnicitysubgroup, CAST(NULL AS VARCHAR) AS sexualorientation,
           CASE WHEN c_acctbal >= 0 THEN c_name END AS religion, CAST(NULL AS VARCHAR) AS maritalstatus,
           DATE '2021-07-02' AS load_date
    FROM customer)
"""


# --- run state --------------------------------------------------------------------------------------------

STATUS_BY_EVENT = {
    "signup": "Processing", "view": "Publishing", "purchase": "Completed",
    "error": "Failed_Processing", "click": "Failed_Publishing",
}


def status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``correlation_id, collection, status, ts, event_id``: a user's events as status changes of one collection."""
    status = F.lit(None).cast("string")
    for event, name in STATUS_BY_EVENT.items():
        status = F.when(F.col("event_type") == event, name).otherwise(status)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), (F.col("user_id") % 10).cast("string")).alias("correlation_id"),
        F.concat(
            F.lit("db.src"), (F.col("user_id") % 20).cast("string"), F.lit("."),
            F.when(F.col("user_id") % 3 == 0, "en").otherwise("de"),
        ).alias("collection"),
        status.alias("status"),
        "ts",
        "event_id",
    )


STATUS_SQL = """
history AS (
    SELECT 'run-' || (user_id % 10) AS correlation_id,
           'db.src' || (user_id % 20) || '.' || CASE WHEN user_id % 3 = 0 THEN 'en' ELSE 'de' END AS collection,
           CASE event_type WHEN 'signup' THEN 'Processing' WHEN 'view' THEN 'Publishing'
                WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed_Processing'
                WHEN 'click' THEN 'Failed_Publishing' END AS status, ts, event_id
    FROM events),
latest AS (
    SELECT correlation_id, collection, arg_max(status, (ts, event_id)) AS status FROM history GROUP BY ALL)
"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ledger from orders; an order still open leaves step and prefix out."""
    open_ = F.col("o_orderstatus") == "O"
    status = F.when(open_, "IN_PROGRESS").when(F.col("o_orderstatus") == "F", "FAILED").otherwise("COMPLETED")
    product = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "snapshot-incremental").otherwise(
        "snapshot-full"
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("correlation_id"),
        product.alias("data_product"),
        status.alias("status"),
        F.when(~open_, F.concat(F.lit("step-"), F.substring("o_orderpriority", 1, 1))).alias("current_step"),
        F.when(~open_, F.concat(F.lit("out/"), F.col("o_orderkey").cast("string"))).alias("output_prefix"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("seq"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``correlation_id, snapshot_type, data_product``: one requested run per customer."""
    from snapforge.operators import parameters

    kind = parameters.snapshot_type(F.when(F.col("c_mktsegment") == "BUILDING", "Incremental").otherwise("other"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("correlation_id"),
        kind.alias("snapshot_type"),
        parameters.data_product(kind).alias("data_product"),
    )


LEDGER_SQL = """
ledger AS (
    SELECT 'c' || o_custkey AS correlation_id,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'snapshot-incremental'
                ELSE 'snapshot-full' END AS data_product,
           CASE o_orderstatus WHEN 'O' THEN 'IN_PROGRESS' WHEN 'F' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
           CASE WHEN o_orderstatus <> 'O' THEN 'step-' || substr(o_orderpriority, 1, 1) END AS current_step,
           CASE WHEN o_orderstatus <> 'O' THEN 'out/' || o_orderkey END AS output_prefix,
           o_orderdate AS stamp, o_orderkey AS seq
    FROM orders),
current AS (
    SELECT correlation_id, data_product, arg_max(status, (stamp, seq)) AS status,
           arg_max(current_step, (stamp, seq)) FILTER (WHERE current_step IS NOT NULL) AS current_step,
           arg_max(output_prefix, (stamp, seq)) FILTER (WHERE output_prefix IS NOT NULL) AS output_prefix
    FROM ledger GROUP BY ALL),
requests AS (
    SELECT 'c' || c_custkey AS correlation_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'incremental' ELSE 'full' END AS snapshot_type,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'snapshot-incremental' ELSE 'snapshot-full' END AS data_product
    FROM customer)
"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``correlation_id, step, state, ts, event_id, hour``: a user's events as observed step states."""
    from snapforge.operators import changes

    return observed(table(spark, sf_dir, "events")).withColumn("step", changes.step_name(F.col("step")))


def observed(events: DataFrame) -> DataFrame:
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    state = (
        F.when(k == 7, "FAILED").when(k == 8, "CANCELLED").when(k >= 90, "COMPLETED")
        .when(k >= 50, "RUNNING").otherwise("PENDING")
    )
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("correlation_id"),
        F.concat(F.lit("/opt/steps/"), F.col("event_type"), F.lit(".py")).alias("step"),
        state.alias("state"),
        "ts",
        "event_id",
        F.date_trunc("hour", "ts").alias("hour"),
    )


OBSERVED_SQL = """
observed AS (
    SELECT 'run-' || user_id AS correlation_id, event_type AS step, event_id, ts,
           CASE WHEN k = 7 THEN 'FAILED' WHEN k = 8 THEN 'CANCELLED' WHEN k >= 90 THEN 'COMPLETED'
                WHEN k >= 50 THEN 'RUNNING' ELSE 'PENDING' END AS state
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)),
flagged AS (
    SELECT *, row_number() OVER (PARTITION BY correlation_id ORDER BY ts, event_id) AS rn,
           state IN ('FAILED', 'CANCELLED') OR (step = 'purchase' AND state = 'COMPLETED') AS final
    FROM observed),
ended AS (
    SELECT *, min(CASE WHEN final THEN rn END) OVER (PARTITION BY correlation_id) AS last_rn FROM flagged),
compared AS (
    SELECT *, lag(step) OVER w AS before_step, lag(state) OVER w AS before_state
    FROM ended WHERE last_rn IS NULL OR rn <= last_rn
    WINDOW w AS (PARTITION BY correlation_id ORDER BY rn))
"""


# --- log lines and cluster events -------------------------------------------------------------------------

def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: events as service log lines, some of another shape."""
    k = F.get_json_object("props", "$.k")
    message = (
        F.when(
            F.col("event_type") == "purchase",
            F.concat(F.lit("time taken for db.user"), F.col("user_id").cast("string"), F.lit(" : "), k),
        )
        .when(F.col("event_type") == "view", F.concat(F.lit("Time for all collections: "), k, F.lit(" ' ]")))
        .otherwise(F.lit('said "done"'))
    )
    line = F.concat(
        F.lit('{ "timestamp": "'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit('", "log_level": "'),
        F.when(F.col("event_type") == "click", "WARNING").otherwise("INFO"), F.lit('", "message": "'), message,
        F.lit('" }'),
    )
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit("Traceback (most recent call last):")).otherwise(line).alias("value")
    )


LOG_SQL = """
messages AS (
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS logged_at,
           CASE WHEN event_type = 'click' THEN 'WARNING' ELSE 'INFO' END AS log_level,
           CASE event_type
                WHEN 'purchase' THEN 'time taken for db.user' || user_id || ' : ' || json_extract_string(props, '$.k')
                WHEN 'view' THEN 'Time for all collections: ' || json_extract_string(props, '$.k') || ' '' ]'
                ELSE 'said "done"' END AS message
    FROM events WHERE event_type <> 'error')
"""

CLUSTERS = {"full": "snapshot-full", "incremental": "snapshot-incremental"}


def cluster_events(events: DataFrame) -> DataFrame:
    """``event_id, ts, value``: events as cluster state changes; large values belong to another cluster, and small
    ones of type signup ended for a reason no rule knows."""
    from snapforge.operators import alerts

    state = (
        F.when(F.col("event_type") == "error", "TERMINATED_WITH_ERRORS")
        .when(F.col("event_type") == "view", "RUNNING")
        .otherwise("TERMINATED")
    )
    reason = (
        F.when(F.col("event_type") == "click", alerts.REASONS["terminated"])
        .when(F.col("event_type") == "purchase", alerts.REASONS["success"])
        .when(F.col("value") >= 5, alerts.REASONS["success_with_errors"])
        .otherwise("unknown")
    )
    name = F.when(F.col("value") < 10, "snapshot-full").when(F.col("value") < 40, "snapshot-incremental").otherwise("other")
    detail = F.struct(state.alias("state"), name.alias("name"), reason.alias("stateChangeReason"))
    event = F.struct(
        F.lit("aws.emr").alias("source"), F.lit("EMR Cluster State Change").alias("detail-type"), detail.alias("detail")
    )
    return events.select("event_id", "ts", F.to_json(event).alias("value"))


ALERT_SQL = """
classified AS (
    SELECT event_id, ts, CASE WHEN value < 10 THEN 'full' ELSE 'incremental' END AS kind,
           CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' WHEN 'click' THEN 'terminated'
                WHEN 'purchase' THEN 'success' ELSE 'success_with_errors' END AS rule
    FROM events
    WHERE value < 40 AND (event_type <> 'signup' OR value >= 5)),
windows AS (
    SELECT strftime(time_bucket(INTERVAL 60 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start, kind, rule,
           count(*) AS n,
           CASE WHEN rule IN ('terminated', 'success_with_errors') THEN 'High' ELSE 'Critical' END AS severity,
           CASE rule WHEN 'failed' THEN 'Error' WHEN 'success_with_errors' THEN 'Warning'
                ELSE 'Information' END AS notice_type
    FROM classified GROUP BY ALL)
"""


# --- message envelopes ------------------------------------------------------------------------------------

def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``val``: one message per document, its text encrypted and base64 encoded inside."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    iv, key = secret(F.col("doc_id").cast("string"), 16), secret(F.col("source"), 16)
    modified = F.concat(
        F.lit("2019-07-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T11:05:09.250+0000")
    )
    encryption = F.struct(
        F.lit("k-1").alias("encryptionKeyId"),
        F.concat(F.lit("sealed-"), F.col("source")).alias("encryptedEncryptionKey"),
        F.base64(iv).alias("initialisationVector"),
        F.lit("master-1").alias("keyEncryptionKeyId"),
    )
    sealed_text = crypto.ctr_transform(F.encode("text", "UTF-8"), key, crypto.ctr_start(iv))
    message = F.struct(
        F.col("source").alias("db"),
        F.col("lang").alias("collection"),
        F.struct(F.col("doc_id").cast("string").alias("declarationId")).alias("_id"),
        F.lit("MONGO_INSERT").alias("@type"),
        modified.alias("_lastModifiedDateTime"),
        encryption.alias("encryption"),
        F.base64(sealed_text).alias("dbObject"),
    )
    envelope = F.struct(
        F.lit("E1").alias("@type"), message.alias("message"), F.lit("v-2").alias("version"),
        F.lit("2019-07-04T11:05:09.250+0000").alias("timestamp"),
    )
    return docs.select(F.to_json(envelope).alias("val"))

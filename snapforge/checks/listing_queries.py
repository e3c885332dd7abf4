"""Listing, grouping, configuration and policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapforge.checks import inputs as i
from snapforge.functions import dates, names, text
from snapforge.operators import listing, parameters, policy
from snapforge.sources import objects

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _listed(spark, sf) -> DataFrame:
    return objects.under_prefix(i.keys(spark, sf), i.PREFIX)


def _chosen(spark, sf) -> DataFrame:
    return listing.matched(listing.last_per_name(_listed(spark, sf)))


# Re-exported names count once, from the folder that comes last.
CHOSEN_SQL = """
chosen AS (
    SELECT name, max(path) AS path, arg_max(length, path) AS length, any_value(collection) AS collection
    FROM named WHERE collection IS NOT NULL GROUP BY name)
"""
CHOSEN = _with(i.KEYS_SQL, CHOSEN_SQL, i.CONFIG_SQL)


@query("list_keys", _with(i.KEYS_SQL) + "SELECT path, length FROM keys "
       "WHERE starts_with(path, 'exp/full/') AND path <> 'exp/full/'")
def list_keys(spark, sf):
    return _listed(spark, sf).select("path", "length")


@query("first_level_folders", _with(i.KEYS_SQL) + """
    SELECT DISTINCT 'exp/' || split_part(path, '/', 2) || '/' AS folder FROM keys
    WHERE starts_with(path, 'exp/') AND contains(substr(path, 5), '/')""")
def first_level_folders(spark, sf):
    return objects.first_level_folders(i.keys(spark, sf), "exp/")


@query("collection_names", _with(i.KEYS_SQL) + """
    , folders AS (
        SELECT DISTINCT collection, replace(replace(replace(collection, 'db.', ''), '.', '/'), '-', '_') AS p
        FROM named WHERE collection IS NOT NULL)
    SELECT collection, p AS collection_path, replace(p, '_', '-') AS folder, replace(p, '/', '_') AS table_name,
           CASE p WHEN 'data/businessAudit' THEN 'audit' WHEN 'data/equality' THEN 'equality' ELSE 'raw' END AS handler,
           CASE WHEN p IN ('data/businessAudit', 'data/equality')
                THEN 'out/' || replace(p, '_', '-') || '/2021-07-02/'
                ELSE 'out/full/s1/' || replace(p, '_', '-') || '/' END AS location
    FROM folders""")
def collection_names(spark, sf):
    found = _chosen(spark, sf).select("collection").distinct()
    c = F.col("collection")
    return found.select(
        c,
        names.collection_path(c).alias("collection_path"),
        names.folder_name(c).alias("folder"),
        names.table_name(c).alias("table_name"),
        names.handler(c).alias("handler"),
        names.output_location(c, F.lit("out/full/s1"), F.lit("out"), F.lit("2021-07-02")).alias("location"),
    )


@query("rejected_keys", _with(i.KEYS_SQL) + "SELECT path FROM named WHERE collection IS NULL")
def rejected_keys(spark, sf):
    return listing.rejects(_listed(spark, sf)).select("path")


@query("basename_last_wins", _with(i.KEYS_SQL) + """
    SELECT name, max(path) AS path, arg_max(length, path) AS length FROM named GROUP BY name""")
def basename_last_wins(spark, sf):
    return listing.last_per_name(_listed(spark, sf)).select("name", "path", "length")


@query("group_keys", CHOSEN + "SELECT collection, path FROM chosen")
def group_keys(spark, sf):
    return _chosen(spark, sf).select("collection", "path")


@query("group_summary", CHOSEN + """
    SELECT collection, count(*) AS n_keys, min(path) AS first_key, max(path) AS last_key
    FROM chosen GROUP BY collection""")
def group_summary(spark, sf):
    return listing.group_summary(_chosen(spark, sf))


@query("allowed", CHOSEN + "SELECT collection, path FROM chosen WHERE collection IN (SELECT collection FROM config)")
def allowed(spark, sf):
    return listing.allowed(_chosen(spark, sf), i.config(spark, sf)).select("collection", "path")


@query("unlisted", CHOSEN
       + "SELECT collection, path FROM chosen WHERE collection NOT IN (SELECT collection FROM config)")
def unlisted(spark, sf):
    return listing.unlisted(_chosen(spark, sf), i.config(spark, sf)).select("collection", "path")


@query("missing", CHOSEN + "SELECT collection FROM config WHERE collection NOT IN (SELECT collection FROM chosen)")
def missing(spark, sf):
    return listing.missing(i.config(spark, sf), _chosen(spark, sf)).select("collection")


@query("reconcile", CHOSEN + """
    , counted AS (SELECT collection, count(*) AS n FROM chosen GROUP BY collection)
    SELECT coalesce(counted.collection, config.collection) AS collection, coalesce(n, 0) AS n_keys,
           CASE WHEN n IS NULL THEN 'missing' WHEN config.collection IS NULL THEN 'unlisted' ELSE 'allowed' END
           AS outcome
    FROM counted FULL JOIN config ON counted.collection = config.collection""")
def reconcile(spark, sf):
    return listing.reconcile(_chosen(spark, sf), i.config(spark, sf))


@query("placeholders", CHOSEN + """
    SELECT collection, 'out/incremental/s1/fake/empty/empty.txt' AS path, 'Empty' AS status
    FROM config WHERE collection NOT IN (SELECT collection FROM chosen)""")
def placeholders(spark, sf):
    return listing.placeholders(i.config(spark, sf), _chosen(spark, sf), "out/incremental/s1")


@query("collection_tags", CHOSEN + """
    , tagged AS (SELECT chosen.path, config.* FROM chosen LEFT JOIN config USING (collection))
    SELECT path, 'pii' AS key, pii AS value FROM tagged WHERE db IS NOT NULL
    UNION ALL SELECT path, 'db', db FROM tagged WHERE db IS NOT NULL
    UNION ALL SELECT path, 'table', tbl FROM tagged WHERE db IS NOT NULL
    UNION ALL SELECT path, 'collection_tag', owner FROM tagged WHERE db IS NOT NULL
    UNION ALL SELECT path, 'snapshot_type', 'full' FROM tagged WHERE db IS NOT NULL
    UNION ALL SELECT path, 'collection_tag', 'NOT_SET' FROM tagged WHERE db IS NULL""")
def collection_tags(spark, sf):
    return listing.tags_of(_chosen(spark, sf), i.config(spark, sf), "full")


@query("sizes", CHOSEN + """
    SELECT coalesce(collection, 'all_collections') AS collection, CAST(sum(length) AS BIGINT) AS total_bytes,
           count(*) AS n_keys
    FROM chosen GROUP BY ROLLUP (collection)""")
def sizes(spark, sf):
    return listing.sizes(_chosen(spark, sf)).select(
        "collection", "total_bytes", F.col("n_keys").cast("long").alias("n_keys")
    )


@query("table_collisions", """
    SELECT DISTINCT 'db.' || source || c || lang || '.doc' AS collection, source || '_' || lang || '_doc' AS table_name
    FROM (SELECT source, lang FROM documents JOIN labels USING (doc_id)) AS labelled, (VALUES ('-'), ('_')) AS v(c)""")
def table_collisions(spark, sf):
    docs = i.table(spark, sf, "documents").select("doc_id", "source", "lang")

    def named(df: DataFrame, joint: str) -> DataFrame:
        return df.select(
            F.concat(F.lit("db."), F.col("source"), F.lit(joint), F.col("lang"), F.lit(".doc")).alias("collection")
        )

    labelled = docs.join(i.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return listing.table_collisions(named(docs, "-").unionByName(named(labelled, "_")))


POLICIES = [
    policy.ReadPolicy("crown", ("exp/",), {"collection_tag": "crown"}),
    policy.ReadPolicy("crown_non_pii", ("exp/",), {"collection_tag": "crown", "Pii": "false"}),
    policy.ReadPolicy("retry_all", ("exp/full/retry/", "exp/metrics/")),
    policy.ReadPolicy("retry_non_pii", ("exp/full/retry/", "exp/metrics/"), {"PII": "false"}),
]


@query("readable_paths", CHOSEN + """
    , tagged AS (SELECT chosen.path, pii, owner FROM chosen LEFT JOIN config USING (collection))
    SELECT path, 'crown' AS policy FROM tagged WHERE owner = 'crown'
    UNION ALL SELECT path, 'crown_non_pii' FROM tagged WHERE owner = 'crown' AND pii = 'false'
    UNION ALL SELECT path, 'retry_all' FROM tagged WHERE starts_with(path, 'exp/full/retry/')
    UNION ALL SELECT path, 'retry_non_pii' FROM tagged WHERE starts_with(path, 'exp/full/retry/') AND pii = 'false'""")
def readable_paths(spark, sf):
    tagged = _chosen(spark, sf).join(i.config(spark, sf), "collection", "left")
    return policy.readable(tagged, POLICIES)


@query("expired_objects", """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'pub/full/' ELSE 'pub/incremental/' END || o_orderkey AS path
    FROM orders WHERE o_orderstatus <> 'O' AND o_orderdate < TIMESTAMP '1997-06-01 00:00:00' - INTERVAL 7 DAY""")
def expired_objects(spark, sf):
    folder = (
        F.when(F.col("o_orderstatus") == "F", "pub/full/").when(F.col("o_orderstatus") == "O", "pub/hive/")
        .otherwise("pub/incremental/")
    )
    written = i.table(spark, sf, "orders").select(
        F.concat(folder, F.col("o_orderkey").cast("string")).alias("path"), F.col("o_orderdate").alias("modificationTime")
    )
    now = F.lit("1997-06-01 00:00:00").cast("timestamp_ntz")
    return policy.expired(written, now, purge=["pub/full", "pub/incremental"], keep=["pub/hive", "pub/data"]).select("path")


@query("snapshot_types", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'incremental' ELSE 'full' END AS snapshot_type,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'pub_incremental' ELSE 'pub' END AS database_name,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'snapshot-incremental' ELSE 'snapshot-full' END AS data_product
    FROM orders""")
def snapshot_types(spark, sf):
    given = F.when(F.col("o_orderpriority") == "1-URGENT", "InCremental").otherwise(F.col("o_orderpriority"))
    typed = i.table(spark, sf, "orders").select("o_orderkey", parameters.snapshot_type(given).alias("snapshot_type"))
    kind = F.col("snapshot_type")
    return typed.select(
        "o_orderkey", kind, parameters.database_name(F.lit("pub"), kind).alias("database_name"),
        parameters.data_product(kind).alias("data_product"),
    )


@query("parameter_violations", """
    WITH given AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS correlation_id,
               CASE WHEN o_totalprice > 1000 THEN 'in/' END AS s3_prefix,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'FULL' WHEN '2-HIGH' THEN 'incremental'
                    WHEN '3-MEDIUM' THEN 'full' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'other' END AS snapshot_type
        FROM orders)
    SELECT o_orderkey, 'missing correlation_id' AS violation FROM given WHERE correlation_id IS NULL
    UNION ALL SELECT o_orderkey, 'missing s3_prefix' FROM given WHERE s3_prefix IS NULL
    UNION ALL SELECT o_orderkey, 'missing snapshot_type' FROM given WHERE snapshot_type IS NULL
    UNION ALL SELECT o_orderkey, 'snapshot_type must be full or incremental' FROM given WHERE snapshot_type = 'other'
    """)
def parameter_violations(spark, sf):
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "FULL").when(F.col("o_orderpriority") == "2-HIGH", "incremental")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "full").when(F.col("o_orderpriority") == "5-LOW", "other")
    )
    given = i.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("correlation_id"),
        F.when(F.col("o_totalprice") > 1000, F.lit("in/")).alias("s3_prefix"),
        kind.alias("snapshot_type"),
    )
    return parameters.violations(given, ["correlation_id", "s3_prefix", "snapshot_type"]).select("o_orderkey", "violation")


@query("day_prefixes", """
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day, 'exp/audit/' || strftime(d, '%Y-%m-%d') || '/' AS prefix
    FROM (SELECT o_orderkey, unnest(generate_series(
              CAST(o_orderdate AS TIMESTAMP), CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 5 - 1 AS INT)),
              INTERVAL 1 DAY)) AS d FROM orders)""")
def day_prefixes(spark, sf):
    start = F.to_date("o_orderdate")
    ranges = i.table(spark, sf, "orders").select(
        "o_orderkey", start.alias("start_date"),
        F.date_add(start, (F.col("o_orderkey") % 5 - 1).cast("int")).alias("end_date"),
    )
    return dates.day_prefixes(ranges, "exp/audit/").select("o_orderkey", "day", "prefix")


@query("run_stamps", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS export_date, strftime(ts, '%Y_%m_%d') AS date_underscore,
           strftime(ts, '%Y-%m-%d_%H-%M-%S') AS run_stamp, epoch_us(ts) // 1000 + 604800000 AS expires_at
    FROM events""")
def run_stamps(spark, sf):
    ts = F.col("ts")
    return i.table(spark, sf, "events").select(
        "event_id", dates.export_date(ts).alias("export_date"),
        dates.underscored(dates.export_date(ts)).alias("date_underscore"),
        dates.run_stamp(ts).alias("run_stamp"), dates.expires_at(ts).alias("expires_at"),
    )


@query("sql_statements", """
    SELECT page_id, statement FROM (SELECT page_id, unnest(string_split(html, ';')) AS statement FROM pages)
    WHERE regexp_matches(statement, '[^\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]')
    """)
def sql_statements(spark, sf):
    pages = i.table(spark, sf, "pages")
    return pages.select("page_id", F.explode(text.statements(F.col("html"))).alias("statement"))


@query("granted_paths", CHOSEN + """
    , tagged AS (SELECT path, pii, owner FROM named LEFT JOIN config USING (collection) WHERE collection IS NOT NULL)
    SELECT DISTINCT path, 'one-' || c.collection AS policy FROM tagged JOIN config AS c
        ON starts_with(path, 'exp/full/' || c.collection || '.') OR starts_with(path, 'exp/full/retry/' || c.collection || '.')
    WHERE NOT (starts_with(path, 'exp/full/retry/') AND coalesce(tagged.pii, '') = 'true')
    UNION ALL SELECT DISTINCT path, 'db-' || d.db FROM tagged JOIN (SELECT DISTINCT db FROM config) AS d
        ON regexp_matches(path, '^exp/.*/db\\.' || d.db || '\\.') WHERE owner = 'crown'""")
def granted_paths(spark, sf):
    """A policy per collection, closed to personal data below retry/, and one per database for what the crown owns."""
    config = i.config(spark, sf)
    nothing = F.expr("cast(map() AS map<string,array<string>>)")

    def rule(frame, policy_name, effect, pattern, tags=nothing):
        return frame.select(policy_name.alias("policy"), F.lit(effect).alias("effect"), pattern.alias("pattern"), tags.alias("tags"))

    def tags(name, value):
        return F.create_map(F.lit(name), F.array(F.lit(value)))

    one = F.concat(F.lit("one-"), "collection")
    database = config.select(F.col("tags")["db"].alias("db")).distinct()
    rules = rule(config, one, "allow", F.concat(F.lit("exp/full/"), "collection", F.lit(".*")))
    for more in (
        rule(config, one, "allow", F.concat(F.lit("exp/full/retry/"), "collection", F.lit(".*"))),
        rule(config, one, "deny", F.lit("exp/full/retry/*"), tags("PII", "true")),
        rule(database, F.concat(F.lit("db-"), "db"), "allow", F.concat(F.lit("exp/*/db."), "db", F.lit(".*")),
             tags("collection_tag", "crown")),
    ):
        rules = rules.unionByName(more)
    tagged = listing.matched(_listed(spark, sf)).join(config, "collection", "left").select("path", "tags")
    return policy.granted(tagged, rules)


@query("listing_changes", _with(i.KEYS_SQL) + """
    , before AS (SELECT name, max(length) AS length FROM keys WHERE starts_with(path, 'exp/full/') AND length % 10 <> 0
                 GROUP BY name),
    after AS (SELECT name, max(length + CASE WHEN starts_with(path, 'exp/full/retry/') THEN 1 ELSE 0 END) AS length
              FROM keys WHERE starts_with(path, 'exp/full/') AND length % 10 <> 1 GROUP BY name)
    SELECT coalesce(before.name, after.name) AS path, before.length AS old_length, after.length AS length,
           CASE WHEN before.name IS NULL THEN 'added' WHEN after.name IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM before FULL JOIN after ON before.name = after.name WHERE before.length IS DISTINCT FROM after.length""")
def listing_changes(spark, sf):
    """Two states of one folder: lengths that end in 0 are new, those in 1 are gone, what was exported again has grown."""
    listed = i.keys(spark, sf).where(F.startswith("path", F.lit(i.PREFIX)))
    again = F.startswith("path", F.lit(i.PREFIX + "retry/")).cast("long")
    before = listed.where("length % 10 <> 0").select(F.col("name").alias("path"), "length")
    after = listed.where("length % 10 <> 1").select(F.col("name").alias("path"), (F.col("length") + again).alias("length"))
    return listing.listing_changes(before, after)

"""URL verdicts by rules, carried over redirect and canonical-link aliases; column expressions and joins only.

Rules: the longest rule that fits decides. A URL that no rule fits takes the decision of its aliases: allowed if one of
them is explicitly allowed, else blocked if one is blocked, else allowed. Aliases are the URLs joined, over any number
of steps, by a canonical link or a refresh redirect in a page's html; URLs that differ in scheme or fragment only are
one. A null URL, or one without ``://``, has an empty host and path, fits no rule and has no alias. Repeated rows are
judged alike, and a null html has no links. All canonical links and refreshes of a page count; their targets are resolved
against its ``base``, if it has one, or its URL, after ``&amp;`` is decoded; tags in comments and scripts are none. Targets of other schemes (``mailto:``) are
ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.llm.common import fresh, table, written
from snapforge.llm.components import components


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"))

PARTS = "://([^/?#]*)([^?#]*)"
CANONICAL = (r"""(?i)<link\s[^>]*rel\s*=\s*(?:["'](?:[^"'>]*\s)?canonical(?:\s[^"'>]*)?["'][^>]*"""
             r"""|canonical(?:\s[^>]*)?/?>)""")
# What a browser does not take for tags: comments, and what scripts hold; one that is not closed goes on to the end.
NO_TAGS = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
REFRESH = r"""(?i)<meta\s[^>]*http-equiv\s*=\s*["']?refresh["'\s>][^>]*"""
HREF = r"""(?i)\shref\s*=\s*["']?([^"'\s>]+)"""
BASE = r"(?i)<base\s[^>]*\shref\s*=[^>]*|<base\shref\s*=[^>]*"
SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
TARGET = r"""(?i)url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), string.ascii_uppercase,
                       string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def alias_key(url: Column) -> Column:
    """What URLs of one place share: host, path and query; null without a host."""
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest)))


def rule_for(host: Column, path: Column, rules: Sequence[Rule], value: str = "name") -> Column:
    """Name or action of the longest fitting rule, else null. A short list by contract: one condition each."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def unescaped(target: Column) -> Column:
    """``target`` without the character references of marks that URLs are made of; the ampersand's come last."""
    for mark in "/:?=#&":
        code = f"#0*{ord(mark)}|#x0*{ord(mark):x}" + "|amp" * (mark == "&")
        target = F.regexp_replace(target, f"(?i)&(?:{code});", mark)
    return target


def without_dots(path: Column) -> Column:
    """A path that begins with ``/``, its segments ``.`` and ``..`` taken as steps."""
    parts = F.split(F.substr(F.regexp_replace(path, r"(/\.\.?)$", "$1/"), F.lit(2)), "/")
    return F.concat(F.lit("/"), F.array_join(F.aggregate(
        parts, F.array().cast("array<string>"), lambda done, part: F.when(
            part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(
            part == ".", done).otherwise(F.concat(done, F.array(part)))), "/"))


def resolved(base: Column, target: Column) -> Column:
    """The URL that ``target`` names in a page at ``base``; null for what is no place, as ``mailto:``. A target with a
    scheme is taken as it stands."""
    site, own = F.regexp_extract(base, "^[^/?#]*://[^/?#]*", 0), path_of(base)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    path = F.regexp_extract(target, "^[^?#]*", 0)
    folder = F.regexp_extract(own, "(?s)^.*/", 0)
    beside = F.concat(F.when(folder == "", "/").otherwise(folder), path)
    return F.when(target.rlike(f"^{SCHEME}://"), target).when(target.rlike(f"^{SCHEME}:"), None).when(
        target.startswith("//"), F.concat(F.lit("http:"), target)).when(target.startswith("#"), base).when(
        target.startswith("?"), F.concat(site, F.when(own == "", "/").otherwise(own), target)).otherwise(
        F.concat(site, without_dots(F.when(path.startswith("/"), path).otherwise(beside)), rest))


def links(pages: DataFrame) -> DataFrame:
    """``source, target`` keys of the canonical links and redirects that pages hold."""

    def targets(tag: str, inside: str) -> Column:
        return F.transform(F.regexp_extract_all("html", F.lit(tag), F.lit(0)),
                           lambda found: F.regexp_extract(found, inside, 1))

    base = F.regexp_extract(F.regexp_extract("html", BASE, 0), HREF, 1)
    linked = pages.where(F.col("html").rlike("(?i)canonical|refresh"))
    both = linked.select("url", F.regexp_replace("html", NO_TAGS, "").alias("html")).select("url", base.alias("base"), F.explode(F.concat(targets(CANONICAL, HREF), targets(REFRESH, TARGET))).alias("to"))
    both = both.where("to <> ''").select("url", unescaped(F.col("base")).alias("base"), unescaped(F.col("to")).alias("to"))
    both = both.withColumn("base", F.when(F.col("base") == "", F.col("url")).otherwise(
        F.coalesce(resolved(F.col("url"), F.col("base")), "url")))
    both = both.withColumn("to", resolved(F.col("base"), F.col("to")))
    return both.where("to is not null").select(
        alias_key(F.col("url")).alias("source"), alias_key(F.col("to")).alias("target")).dropna()


def class_verdicts(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``key, carried``: the verdict of a URL's class, for URLs that have an alias."""
    members = components(edges, "source", "target")
    at = F.concat(F.lit("://"), F.col("node"))
    action = rule_for(host_of(at), path_of(at), rules, "action")
    votes = members.withColumn("action", action).groupBy("root").agg(
        F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked"))
    carried = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow")
    return members.join(votes, "root").select(F.col("node").alias("key"), carried.alias("carried"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``, which replace columns of these names. ``redirects`` (source, target
    URLs) adds edges to those in html."""
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(
            alias_key(F.col("source")).alias("source"), alias_key(F.col("target")).alias("target")).dropna())
    carried = written(class_verdicts(edges, rules), "aliases")
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    key, own, other = (fresh(name, kept) for name in ("key", "own", "carried"))
    judged = pages.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                          alias_key(F.col("url")).alias(key))
    host, path = F.col("host"), F.col("path")
    judged = judged.withColumns({"rule": rule_for(host, path, rules), own: rule_for(host, path, rules, "action")})
    return judged.join(carried.withColumnsRenamed({"key": key, "carried": other}), key, "left").withColumn(
        "verdict", F.coalesce(own, other, F.lit("allow"))).drop(key, own, other)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def _rule_sql(value: str, host: str, path: str) -> str:
    cases = " ".join(
        f"WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}')"
        f" THEN '{getattr(r, value)}'" for r in sorted(RULES, key=lambda r: (-len(r.name), r.name)))
    return f"CASE {cases} END"


_A, _Z = string.ascii_uppercase, string.ascii_lowercase


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _key_sql(url: str) -> str:
    host = f"translate(regexp_extract({url}, '{PARTS}', 1), '{_A}', '{_Z}')"
    rest = f"regexp_extract({url}, '://[^/?#]*([^#]*)', 1)"
    return f"CASE WHEN {host} <> '' THEN {host} || CASE WHEN {rest} = '' THEN '/' ELSE {rest} END END"


SQL = {"op10_url_filter": f"""
WITH RECURSIVE judged AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '{PARTS}', 1), '{_A}', '{_Z}'), '') AS host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path, {_key_sql("url")} AS key
  FROM pages),
found AS (
  SELECT url, unnest([regexp_extract(regexp_extract(html, {_sql_text(CANONICAL)}), {_sql_text(HREF)}, 1),
                      regexp_extract(regexp_extract(html, {_sql_text(REFRESH)}), {_sql_text(TARGET)}, 1)]) AS f
  FROM (SELECT url, regexp_replace(html, {_sql_text(NO_TAGS)}, '', 'g') AS html FROM pages)),
targets AS (
  SELECT url, CASE WHEN starts_with(f, '//') THEN 'http:' || f
                   WHEN starts_with(f, '/') THEN regexp_extract(url, '^[^/?#]*://[^/?#]*') || f
                   WHEN contains(f, '://') THEN f END AS t FROM found),
edges AS (SELECT DISTINCT {_key_sql("url")} AS a, {_key_sql("t")} AS b FROM targets),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (
  SELECT a, b, translate(regexp_extract('://' || b, '{PARTS}', 1), '{_A}', '{_Z}') AS host,
         regexp_extract('://' || b, '{PARTS}', 2) AS path FROM reach),
votes AS (
  SELECT a, max(action = 'allow') AS allowed, max(action = 'block') AS blocked
  FROM (SELECT a, {_rule_sql("action", "host", "path")} AS action FROM nodes) GROUP BY a)
SELECT page_id, host, path, {_rule_sql("name", "host", "path")} AS rule,
       coalesce({_rule_sql("action", "host", "path")},
                CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN votes ON votes.a = judged.key
"""}
QUERIES = {"op10_url_filter": op10_url_filter}

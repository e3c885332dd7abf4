"""Who may read what, by tag and by prefix; and what is old enough to be removed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReadPolicy:
    """Grants the objects under any of the prefixes that carry all the tags."""

    name: str
    prefixes: tuple[str, ...]
    tags: Mapping[str, str] = field(default_factory=dict)


def tag(tags: Column, name: str) -> Column:
    """Tag value, the tag name compared without regard to case."""
    hits = F.filter(F.map_entries(tags), lambda entry: F.lower(entry.key) == name.lower())
    return F.try_element_at(hits, F.lit(1)).getField("value")


def grants(policy: ReadPolicy, path: Column, tags: Column) -> Column:
    inside = F.lit(False)
    for prefix in policy.prefixes:
        inside = inside | F.startswith(path, F.lit(prefix))
    for name, value in policy.tags.items():
        inside = inside & F.coalesce(tag(tags, name) == value, F.lit(False))
    return inside


def readable(objects: DataFrame, policies: Sequence[ReadPolicy]) -> DataFrame:
    """``path, policy``: one row per object and policy that grants it, without a join."""
    granted = F.array_compact(
        F.array(*[F.when(grants(p, F.col("path"), F.col("tags")), F.lit(p.name)) for p in policies])
    )
    return objects.select("path", F.explode(granted).alias("policy"))


# Rules as rows: who, ``allow`` or ``deny``, a pattern of paths, and the values each tag may have.
RULES = "policy string, effect string, pattern string, tags map<string,array<string>>"


def _folders(path: Column) -> Column:
    """The empty text and every folder the path lies in, each with its last slash."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/"))),
    )


def _like(pattern: Column) -> Column:
    """The pattern for LIKE: ``*`` stands for any characters, slashes too, ``?`` for one."""
    plain = F.regexp_replace(pattern, r"([%_\\])", r"\\$1")
    return F.translate(plain, "*?", "%_")


def granted(objects: DataFrame, rules: DataFrame) -> DataFrame:
    """``path, policy`` once for every policy that allows the object and does not deny it.

    ``objects(path, tags)``, ``rules`` as in :data:`RULES`. A rule is filed under the folder its pattern names before its
    first wildcard, and an object looks under each folder it lies in, so rules are met by equal folders, however many
    there are, and the plan is the same for any number. Tag names are compared without regard to case; all tags of a
    rule have to hold one of their values. Rows of one path are one object. A rule without a pattern, or with another
    effect than the two, takes no part; an object without tags has none.
    """
    head = F.regexp_extract("pattern", "^[^*?]*", 0)
    filed = rules.where(F.col("effect").isin("allow", "deny")).select(
        "policy", "effect", "pattern", F.col("tags").alias("_wanted"),
        F.regexp_extract(head, "(?s)^(?:.*/)?", 0).alias("_folder"), head.alias("_head"),
        (F.col("pattern") == F.concat(head, F.lit("*"))).alias("_plain"), _like(F.col("pattern")).alias("_like"),
    )
    looked = objects.select("path", "tags", F.explode(_folders(F.col("path"))).alias("_folder"))
    met = filed.join(looked, "_folder")
    fits = F.when(F.col("_plain"), F.startswith("path", "_head")).otherwise(F.expr("path LIKE _like"))
    held = F.coalesce(F.map_entries("tags"), F.expr("map_entries(map('', ''))"))
    wanted = F.coalesce(
        F.forall(
            F.map_entries("_wanted"),
            lambda want: F.exists(
                held,
                lambda tag: (F.lower(tag.key) == F.lower(want.key)) & F.coalesce(F.array_contains(want.value, tag.value), F.lit(False)),
            ),
        ),
        F.lit(True),
    )
    decided = met.where(fits & wanted).groupBy("path", "policy").agg(F.max("effect").alias("_strongest"))
    return decided.where("_strongest = 'allow'").select("path", "policy")


def expired(
    objects: DataFrame, now: Column, purge: Sequence[str], keep: Sequence[str] = (), days: int = 7
) -> DataFrame:
    """Objects under a purged prefix, and under no kept one, that are more than ``days`` old."""
    purged, kept = F.lit(False), F.lit(False)
    for prefix in purge:
        purged = purged | F.startswith("path", F.lit(prefix))
    for prefix in keep:
        kept = kept | F.startswith("path", F.lit(prefix))
    old = F.col("modificationTime") < now - F.expr(f"interval {int(days)} days")
    return objects.where(purged & ~kept & old)


def expired_rows(ledger: DataFrame, now_millis: Column) -> DataFrame:
    return ledger.where(F.col("expires_at") < now_millis)

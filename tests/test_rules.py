"""Rules as rows and as JSON: policies, event patterns, differences of listings."""

from __future__ import annotations

import json
import random
import re
from fnmatch import translate

import pytest
from pyspark.sql import functions as F

from snapforge.operators import listing, patterns, policy


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def objects(spark, data):
    return spark.createDataFrame(data, "path string, tags map<string,string>")


def plain_grants(data, rules):
    out = {}
    for path, tags in data:
        held = {(k.lower(), v) for k, v in (tags or {}).items()}
        for name, effect, pattern, wanted in rules:
            if path is None or pattern is None or effect not in ("allow", "deny"):
                continue
            inside = re.fullmatch(translate(pattern.replace("[", "[[]")), path)
            if inside and all(any((k.lower(), v) in held for v in values) for k, values in (wanted or {}).items()):
                out.setdefault((path, name), set()).add(effect)
    return sorted(k for k, effects in out.items() if "deny" not in effects)


def test_granted_agrees_with_a_plain_loop(spark):
    rng = random.Random(3)

    def text(*letters):
        return "".join(rng.choice(letters) for _ in range(rng.randrange(7)))

    data = [(text("a", "b", "/", "%", "_", "\\"), rng.choice([None, {}, {"Pii": "false"}, {"pii": "true", "x": "1"}]))
            for _ in range(300)] + [(None, {}), ("", None), ("a/b", {"PII": "false"}), ("a/b", {"PII": "false"})]
    rules = [(f"p{n % 40}", rng.choice(["allow", "allow", "deny"]), text("a", "b", "/", "*", "?", "_", "%", "\\"),
              rng.choice([None, {}, {"pii": ["false", "none"]}, {"PII": ["true"], "X": ["1", "2"]}])) for n in range(200)]
    rules += [("none", "allow", None, None), ("other", "maybe", "*", None), ("all", "allow", "*", None)]
    found = rows(policy.granted(objects(spark, data), spark.createDataFrame(rules, policy.RULES)))
    assert found == sorted(plain_grants(data, rules), key=str) and len(found) > 300


def test_ten_thousand_policies_in_one_small_plan(spark):
    ids = spark.range(10_000)
    name = F.concat(F.lit("p"), "id")
    rules = ids.select(name.alias("policy"), F.lit("allow").alias("effect"),
                       F.concat(F.lit("in/"), "id", F.lit("/*")).alias("pattern"),
                       F.expr("cast(null AS map<string,array<string>>)").alias("tags"))
    held = ids.select(F.concat(F.lit("in/"), "id", F.lit("/x/file")).alias("path"),
                      F.expr("cast(null AS map<string,string>)").alias("tags"))
    found = policy.granted(held, rules)
    assert found.count() == 10_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 10_000 and "Cross" not in plan
    assert found.where("split(path, '/')[1] <> substr(policy, 2)").isEmpty()


def test_no_rules_no_objects(spark):
    none, some = spark.createDataFrame([], policy.RULES), objects(spark, [("a", None)])
    assert rows(policy.granted(some, none)) == []
    assert rows(policy.granted(objects(spark, []), spark.createDataFrame([("p", "allow", "*", None)], policy.RULES))) == []


EVENTS = {
    1: {"source": "s", "detail": {"state": "RUNNING", "n": 5, "name": "job-a"}},
    2: {"source": "s", "detail": {"state": "running", "n": 0.5, "name": None}},
    3: {"source": "t", "detail": {"n": "x", "name": "other", "done": True}},
    4: {"source": "s"},
}


@pytest.mark.parametrize("pattern, expected", [
    ({"source": ["s"]}, [1, 2, 4]),
    ({"source": ["s", "t"], "detail": {"name": [{"prefix": "job"}, {"suffix": "er"}]}}, [1, 3]),
    ({"detail": {"state": [{"equals-ignore-case": "Running"}]}}, [1, 2]),
    ({"detail": {"state": ["RUNNING"], "n": [5]}}, [1]),
    ({"detail": {"n": [{"numeric": [">", 0, "<", 5]}]}}, [2]),
    ({"detail": {"n": [{"numeric": ["=", 5]}, "x"]}}, [1, 3]),
    ({"detail": {"name": [{"exists": False}]}}, [2, 4]),
    ({"detail": {"name": [None]}}, [2, 4]),
    ({"detail": {"name": [{"exists": True}]}}, [1, 3]),
    ({"detail": {"name": [{"anything-but": ["other", "x"]}]}}, [1]),
    ({"detail": {"name": [{"anything-but": {"prefix": "job"}}]}}, [3]),
    ({"detail": {"done": [True]}}, [3]),
])
def test_patterns(spark, pattern, expected):
    texts = [(k, json.dumps(v)) for k, v in EVENTS.items()] + [(5, "no json"), (6, None), (7, ""), (8, "{broken")]
    events = spark.createDataFrame(texts, "id int, value string")
    found = patterns.fired_rules(events, {"rule": json.dumps(pattern), "never": '{"source": ["none"]}'})
    assert [r["id"] for r in found.orderBy("id").collect()] == expected
    assert found.columns == ["id", "value", "rule"]


def test_an_event_may_fire_several_rules(spark):
    events = spark.createDataFrame([('{"a": "x"}',)], "value string")
    assert [r["rule"] for r in patterns.fired_rules(events, {"r": '{"a": ["x"]}', "q": '{"a": [{"prefix": "x"}]}'}).collect()] == ["r", "q"]


@pytest.mark.parametrize("pattern", [{}, {"a": []}, {"a": "x"}, {"a": [{"like": "x"}]}, {"a": [{"prefix": "x", "suffix": "y"}]}])
def test_patterns_that_say_nothing_are_refused(spark, pattern):
    with pytest.raises(ValueError):
        patterns.condition(pattern, F.struct(F.lit("x").alias("a")))


def test_listing_changes(spark):
    kind = "path string, length long"
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 3), ("n", None), ("m", None)], kind)
    after = spark.createDataFrame([("a", 1), ("b", 5), ("b", 4), ("d", 7), ("n", None), ("m", 0)], kind)
    assert rows(listing.listing_changes(before, after)) == [
        ("b", "changed", 2, 5), ("c", "removed", 3, None), ("d", "added", None, 7), ("m", "changed", None, 0)]
    assert rows(listing.listing_changes(before, before)) == []

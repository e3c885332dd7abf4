"""Event patterns as data: JSON patterns become one column expression each, events are parsed once.

A pattern is an object. A field holds a nested pattern or a list of what its value may be: a text, number or null, or one of
``{"prefix": t}``, ``{"suffix": t}``, ``{"equals-ignore-case": t}``, ``{"anything-but": t | [t, ...] | {"prefix": t}}``,
``{"exists": true | false}``, ``{"numeric": [">", 0, "<=", 5]}``. All fields have to match, of a list any entry.

Texts of an event are compared as they are, numbers and booleans by their JSON text or, under ``numeric``, as doubles. A field that
is null or absent matches null and ``{"exists": false}`` only. An event that is no JSON matches no rule.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

COMPARE = {
    "=": lambda a, b: a == b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def _text(value: object) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def _one(field: Column, entry: object) -> Column:
    """Whether the field, a text, is what one entry of a list asks for; never null."""
    if entry is None:
        return field.isNull()
    if not isinstance(entry, Mapping):
        return field.eqNullSafe(F.lit(_text(entry)))
    if len(entry) != 1:
        raise ValueError(f"one condition at a time: {entry}")
    kind, want = next(iter(entry.items()))
    if kind == "exists":
        return field.isNotNull() if want else field.isNull()
    if kind == "prefix":
        found = F.startswith(field, F.lit(want))
    elif kind == "suffix":
        found = F.endswith(field, F.lit(want))
    elif kind == "equals-ignore-case":
        found = F.lower(field) == want.lower()
    elif kind == "anything-but":
        others = want if isinstance(want, list) else [want]
        found = field.isNotNull() & ~reduce(Column.__or__, [_one(field, other) for other in others])
    elif kind == "numeric":
        number = field.try_cast("double")
        found = reduce(Column.__and__, [COMPARE[op](number, F.lit(float(at))) for op, at in zip(want[::2], want[1::2], strict=True)])
    else:
        raise ValueError(f"unknown condition {kind}")
    return F.coalesce(found, F.lit(False))


def condition(pattern: Mapping, event: Column) -> Column:
    """The pattern as a condition on a struct of texts, see :func:`event_schema`."""
    fields = []
    for name, inner in pattern.items():
        value = event.getField(name)
        if isinstance(inner, Mapping):
            fields.append(condition(inner, value))
        elif isinstance(inner, list) and inner:
            fields.append(reduce(Column.__or__, [_one(value, entry) for entry in inner]))
        else:
            raise ValueError(f"{name}: a pattern or a list of values is needed")
    if not fields:
        raise ValueError("an empty pattern")
    return reduce(Column.__and__, fields)


def event_schema(patterns: list[Mapping]) -> StructType:
    """The fields any of the patterns looks at, as texts; nothing else of an event is parsed."""
    names = dict.fromkeys(name for pattern in patterns for name in pattern)
    out = []
    for name in names:
        asked = [pattern[name] for pattern in patterns if name in pattern]
        nested = [inner for inner in asked if isinstance(inner, Mapping)]
        if nested and len(nested) < len(asked):
            raise ValueError(f"{name}: values in one pattern, fields in another")
        out.append(StructField(name, event_schema(nested) if nested else StringType()))
    return StructType(out)


def fired_rules(events: DataFrame, rules: Mapping[str, str], value: str = "value") -> DataFrame:
    """Add ``rule``: one row per event and rule that its JSON text fits. ``rules``: name -> pattern as JSON text."""
    parsed = {name: json.loads(pattern) for name, pattern in rules.items()}
    event = F.col("_event")
    fired = F.array(*[F.when(condition(pattern, event), F.lit(name)) for name, pattern in parsed.items()])
    read = events.withColumn("_event", F.from_json(value, event_schema(list(parsed.values()))))
    # Rows that are no JSON come out with null in every field; their text tells them from events without these fields.
    is_event = F.startswith(F.ltrim(value), F.lit("{")) & F.get_json_object(value, "$").isNotNull()
    return read.where(is_event).withColumn("rule", F.explode(F.array_compact(fired))).drop("_event")

"""Operators of a training-data pipeline. Nothing outside this package imports it."""

from snapforge.llm import registry

QUERIES = registry.QUERIES
SQL = registry.SQL

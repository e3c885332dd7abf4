"""Snapshot publishing on Spark: encrypted JSON exports in, queryable tables out."""

__version__ = "0.1.0"

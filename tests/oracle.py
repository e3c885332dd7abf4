"""Compare registered queries with DuckDB: ``python -m tests.oracle [sf] [query ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

import __spark_entry__ as registered
from snapforge.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if columns and rows agree, regardless of order."""
    out = registered.queries()[name](spark, sf_dir)
    columns = sorted(out.columns)
    ours = sorted((tuple(row) for row in out.select(*columns).collect()), key=repr)
    sql = registered.oracle_sql().get(name)
    if sql is None:
        return None
    result = con.sql(sql)
    if sorted(result.columns) != columns:
        return f"columns {columns} against {sorted(result.columns)}"
    order = [result.columns.index(c) for c in columns]
    theirs = sorted((tuple(row[k] for k in order) for row in result.fetchall()), key=repr)
    if ours == theirs:
        return None
    mine, other = set(map(repr, ours)), set(map(repr, theirs))
    return f"{len(ours)} against {len(theirs)} rows; {sorted(mine - other)[:2]} / {sorted(other - mine)[:2]}"


def main() -> None:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = build_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or registered.queries():
        begin = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as failure:  # report and go on with the other queries
            problem = f"{type(failure).__name__}: {str(failure)[:400]}"
        bad += problem is not None
        print(f"{time.time() - begin:6.2f} {name}: {'ok' if problem is None else problem}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()

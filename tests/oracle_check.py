"""Compare queries with their DuckDB text, and time them: python tests/oracle_check.py [sf_dir] [names...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(type_name: str) -> str:
    same = {"bigint": "int64", "int": "int32", "integer": "int32", "varchar": "string", "text": "string"}
    return same.get(type_name.lower(), type_name.lower())


def _value(x: object) -> object:
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return x


def compare(frame, connection, sql: str) -> str | None:
    """None when names, types and rows agree, else what differs."""
    names = sorted(frame.columns)
    types = {f.name: _kind(f.dataType.simpleString()) for f in frame.schema}
    ours = Counter(tuple(_value(v) for v in row) for row in frame.select(*names).collect())
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    their_types = {d[0]: _kind(str(d[1])) for d in result.description}
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    if types != their_types:
        return f"types {[(n, types[n], their_types[n]) for n in names if types[n] != their_types[n]]}"
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple(_value(row[i]) for i in order) for row in result.fetchall())
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        return (f"{sum(ours.values())} vs {sum(theirs.values())} rows; {sum(only.values())} differ; "
                f"{str(list(only)[:2])[:700]} / {str(list(missing)[:2])[:700]}")
    return None if ours else "empty result"


def main() -> int:
    import __spark_entry__ as entry
    from docloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or sorted(entry.queries())
    spark = local_session("oracle-check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            frame = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            outcome = f"rows only: {frame.count()}" if sql is None else compare(frame, connection, sql) or "ok"
        except Exception as error:
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failures += outcome != "ok" and not outcome.startswith("rows only")
        print(f"{name:26s} {time.time() - start:6.2f}s  {outcome}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())

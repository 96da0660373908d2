"""Runs registered queries and their SQL on the same tables and compares them.

    python tests/check.py [folder] [name ...]

CHECK_CONF holds further session settings, as key=value pairs separated by commas: with
spark.sql.autoBroadcastJoinThreshold=-1 the joins run as they would on large tables.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree in columns, types and rows; otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    for field in df.schema.fields:
        wanted = DUCK_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if wanted != types[field.name]:
            return f"type of {field.name}: {wanted} vs {types[field.name]}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if expected == actual:
        return None if expected else "no rows on either side"
    only_left = [r for r in actual if r not in set(expected)][:2]
    only_right = [r for r in expected if r not in set(actual)][:2]
    return f"{len(actual)} vs {len(expected)} rows; e.g. {str(only_left)[:300]} | {str(only_right)[:300]}"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from fieldsieve.session import local_session

    pairs = [p.split("=", 1) for p in os.environ.get("CHECK_CONF", "").split(",") if p]
    spark = local_session("check", 8, **dict(pairs))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, args) else 0)

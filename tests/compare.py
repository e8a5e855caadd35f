"""Run registered queries against DuckDB and compare types and values.

    python tests/compare.py [--sf DIR] [--spread] [name ...]

``--spread`` broadcasts nothing and treats every key with a few rows as hot,
so that all lookups take the path of large tables.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(value):
    """Value as comparable text."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return f"D{value.normalize():f}"
    if isinstance(value, float):
        return f"F{value!r}"
    if isinstance(value, dt.datetime):
        return f"T{value.isoformat()}"
    if isinstance(value, dt.date):
        return f"d{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


DUCK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, con, sql):
    """Columns whose types do not correspond."""
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    return {c: (t, theirs.get(c)) for c, t in mine.items() if theirs.get(c) != t}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, entry, sf):
    """None when equal, else a short reason."""
    df = entry.run(spark, sf)
    columns, mine = rows_of(df.columns, df.collect())
    if entry.sql is None:
        return None if mine else "no rows and no oracle"
    result = con.execute(entry.sql)
    their_columns, theirs = rows_of([c[0] for c in result.description], result.fetchall())
    if columns != their_columns:
        return f"columns {columns} vs {their_columns}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    if not mine:
        return "both empty"
    types = type_differences(df, con, entry.sql)
    if types:
        return f"types {types}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}" if bad else None


def main(argv):
    from basketry.catalog import REGISTRY
    from basketry.session import build_session

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        del argv[at:at + 2]
    settings = {}
    if "--spread" in argv:
        from basketry.operators import joins

        argv.remove("--spread")
        joins.HOT_KEY_ROWS = 3
        settings = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    spark = build_session("compare", "8", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", **settings)
    con = duck(sf)
    failed = 0
    for name, entry in REGISTRY.items():
        if argv and name not in argv:
            continue
        start = time.time()
        try:
            reason = compare(spark, con, name, entry, sf)
        except Exception as error:  # report and go on
            reason = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += reason is not None
        print(f"{'ok  ' if reason is None else 'FAIL'} {name:36s} {time.time() - start:6.2f}s {'' if entry.sql else '(no oracle)'} {reason or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

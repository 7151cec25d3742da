"""Run registered queries next to their SQL and report differences.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
_DIGITS = int(os.environ.get("COMPARE_DIGITS", "9"))
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.{_DIGITS}g}"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, fn, sql: str | None) -> tuple[list[str], int]:
    """(what differs, rows)."""
    df = fn(spark, sf_dir)
    mine = df.collect()
    if sql is None:
        return [], len(mine)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    found = []
    types = {d[0]: str(d[1]) for d in cursor.description}
    for field in df.schema:
        want = _TYPES.get(field.dataType.simpleString())
        if types.get(field.name) != want:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} / "
                         f"{types.get(field.name)}")
    if sorted(df.columns) != sorted(names):
        return found + [f"columns {sorted(df.columns)} / {sorted(names)}"], len(mine)
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a != b:
        found.append(f"rows {len(mine)} / {len(theirs)}, only Spark "
                     f"{list((a - b).items())[:3]}, only SQL {list((b - a).items())[:3]} "
                     f"({sorted(names)})")
    return found, len(mine)


def main() -> None:
    from stoptide.catalog import oracle_sql, queries
    from stoptide.session import build

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build("local[8]", 8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), []
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            found, n = differences(spark, con, sf_dir, fn, sqls.get(name))
        except Exception as exc:  # noqa: BLE001 - a report of everything that fails
            found, n = [f"{type(exc).__name__}: {str(exc)[:600]}"], -1
        mark = "ok  " if not found else "DIFF"
        kind = "" if name in sqls else " (no sql)"
        print(f"{mark} {name:<28} {n:>8} rows {time.time() - started:6.2f}s{kind}", flush=True)
        for text in found:
            print("      ", text[:1200], flush=True)
        if found:
            bad.append(name)
    print(f"{len(bad)} differ: {bad}")


if __name__ == "__main__":
    main()

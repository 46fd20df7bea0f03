"""Runs a registered query and its SQL and compares the results as multisets of rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _kind(values) -> set[str]:
    return {type(v).__name__ for v in values if v is not None}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and a SQL text; empty if they agree."""
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    other = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    mine = [df.columns.index(c) for c in sorted(df.columns)]
    theirs = [names.index(c) for c in sorted(names)]
    a = Counter(tuple(_norm(r[i]) for i in mine) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in theirs) for r in other)
    if len(rows) != len(other):
        problems.append(f"{len(rows)} rows against {len(other)}")
    if a != b:
        problems.append(f"only here {list((a - b).items())[:3]}; only in SQL {list((b - a).items())[:3]}")
    for c, i, j in zip(sorted(names), mine, theirs):
        ka, kb = _kind(r[i] for r in rows), _kind(r[j] for r in other)
        if ka and kb and ka != kb:
            problems.append(f"types of {c}: {ka} against {kb}")
        if (ka | kb) - {"int", "float", "str", "bool"}:
            problems.append(f"type of {c} does not hash the same everywhere: {ka | kb}")
    if not rows:
        problems.append("no rows")
    return problems


def main(folder: str, wanted: list[str]) -> int:
    from stallbook.catalog import ORACLES, QUERIES
    from stallbook.session import clear_scratch, local_session

    extra = {}
    if wanted and wanted[0].startswith("parts="):
        extra["spark.sql.shuffle.partitions"] = wanted.pop(0)[6:]
    spark = local_session(extra=extra)
    con = duck(folder)
    failed = 0
    names = [n for n in QUERIES if not wanted or any(n.startswith(w) for w in wanted)]
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            problems = compare(df, con, ORACLES[name])
            size = df.count() if problems else ""
        except Exception as error:  # reported, then counted as a failure
            problems, size = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {size}", flush=True)
        for p in problems:
            print("     ", p[:1800], flush=True)
    clear_scratch(spark)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

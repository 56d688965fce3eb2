"""Run every query next to its oracle: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    if name not in ORACLE:
        return [] if got else ["no rows"]
    rel = con.sql(ORACLE[name])
    want = rows(rel.columns, rel.fetchall())
    problems = []
    if sorted(df.columns) != sorted(rel.columns):
        problems.append(f"columns {sorted(df.columns)} / {sorted(rel.columns)}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} / {len(want)}")
    extra = [g for g in got if g not in set(want)][:3] if got != want else []
    missing = [w for w in want if w not in set(got)][:3] if got != want else []
    problems += [f"spark {x}" for x in extra] + [f"duckdb {x}" for x in missing]
    if got != want and not problems:
        problems.append("same rows, different counts")
    return problems


def main(args: list[str]) -> int:
    from shelfmark.session import local_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con, failed = local_session(8), duck(sf_dir), 0
    for name in args[1:] or QUERIES:
        start = time.time()
        try:
            problems = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in ORACLE else "ok (rows only)")
        print(f"{mark:15} {name:34} {time.time() - start:6.2f}s", *problems, sep="\n      " if problems else "")
    print(f"{failed} failed of {len(args[1:] or QUERIES)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

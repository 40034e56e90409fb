"""Run the registered queries next to their oracle SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "*", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("rankhouse-checks")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("FATAL")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return 0.0 if value == 0 and isinstance(value, float) else value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# For small data: both sides are collected.
def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list]:
    """Row count of the Spark result and what does not match: [] or up to three examples of each side."""
    rows = result.collect()
    expected = db.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(result.columns):
        return len(rows), [("columns", sorted(result.columns), sorted(names))]
    ours, theirs = multiset(result.columns, rows), multiset(names, expected.fetchall())
    missing, surplus = theirs - ours, ours - theirs
    if not missing and not surplus:
        return len(rows), []
    key = lambda row: str(row)
    return len(rows), [
        ("counts", sum(ours.values()), sum(theirs.values()), "unmatched", sum(surplus.values()), sum(missing.values())),
        ("ours", sorted(surplus, key=key)[:3]),
        ("oracle", sorted(missing, key=key)[:3]),
    ]


def main(sf_dir: str, names: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark, db, bad = session("8"), connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            result = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                rows, diff = differences(result, db, ORACLE[name])
            else:
                rows, diff = result.count(), []
            verdict = "no oracle" if name not in ORACLE else "ok" if not diff else "DIFFERS"
        except Exception as failure:
            rows, diff, verdict = -1, [str(failure)[:600]], "FAILED"
        bad += bool(diff)
        print(f"{verdict:9} {name:38} {rows:8d} rows {time.monotonic() - started:6.2f}s", *diff, sep="\n    " if diff else " ", flush=True)
    print("all match" if not bad else f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]), 1))

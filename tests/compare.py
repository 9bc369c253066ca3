"""Run named queries next to their SQL twins: python tests/compare.py [sf_dir] [query ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cut = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cut, key=repr)


def differences(frame, connection, sql: str) -> list[str]:
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = _sorted(expected_columns, result.fetchall())
    found = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    if expected[0] != found[0]:
        return [f"columns {found[0]} != {expected[0]}"]
    if len(expected[1]) != len(found[1]):
        return [f"{len(found[1])} rows != {len(expected[1])} rows"]
    bad = [f"{f} != {e}" for f, e in zip(found[1], expected[1]) if f != e]
    types = [
        f"type of {c}: {type(f).__name__} != {type(e).__name__}"
        for rows in zip(found[1], expected[1])
        for c, f, e in zip(found[0], *rows)
        if f is not None and e is not None and type(f) is not type(e)
    ]
    return bad + types[:1]


def main() -> int:
    import __spark_entry__ as entry
    from demandkit.runtime import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(sf), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            frame = run(spark, sf)
            if name in sql:
                wrong = differences(frame, connection, sql[name])
            else:
                wrong = [] if frame.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            wrong = [f"{type(error).__name__}: {str(error)[:700]}"]
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name:32s} {time.time() - begin:6.2f}s {wrong[:2] if wrong else ''}", flush=True)
        if wrong:
            print("     ", len(wrong), "differences")
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

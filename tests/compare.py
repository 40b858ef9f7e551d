"""Runs queries beside their SQL twins and reports differences."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def cell(value):
    """A comparable form of one value, strict about type and digits."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return [cell(item) for item in value]
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(repr([cell(row[i]) for i in order]) for row in rows)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return names, result.fetchall()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


# Column types that mean the same on both sides.
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def type_difference(frame, connection, sql):
    ours = {name: SAME_TYPE.get(kind, kind) for name, kind in frame.dtypes}
    theirs = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {n: (ours[n], theirs.get(n)) for n in ours if ours[n] != theirs.get(n)}
    return f"types {wrong}" if wrong else None


def difference(frame, connection, sql):
    """None when both sides agree, else a short description."""
    if found := type_difference(frame, connection, sql):
        return found
    collected = frame.collect()
    spark_names = frame.columns
    duck_names, duck = duck_rows(connection, sql)
    if sorted(spark_names) != sorted(duck_names):
        return f"columns {sorted(spark_names)} != {sorted(duck_names)}"
    left, right = rows_of(spark_names, collected), rows_of(duck_names, duck)
    if left == right:
        return None
    only_left, only_right = list((left - right).items()), list((right - left).items())
    return (
        f"{len(collected)} rows vs {len(duck)}; only spark ({len(only_left)}): "
        f"{str(only_left[:2])[:700]} only sql ({len(only_right)}): {str(only_right[:2])[:700]}"
    )


def main() -> int:
    import __spark_entry__ as registry

    from tidemark.sources.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, build in registry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        sql = registry.oracle_sql().get(name)
        try:
            frame = build(spark, folder)
            if sql is None:
                verdict = f"rows only: {len(frame.collect())}"
            else:
                verdict = difference(frame, connection, sql)
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:900]}"
        failed = verdict is not None and not verdict.startswith("rows only")
        bad += failed
        mark = "FAIL" if failed else "ok"
        print(f"\n{mark} {name} {time.time() - started:.1f}s {verdict or ''}", flush=True)
    print(f"\n{bad} failing", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())

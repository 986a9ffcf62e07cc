"""Run registered queries and their SQL side by side.

``python tests/compare.py [sf] [name…]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/sf{sf}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return repr(float(value) + 0.0)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_result(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def sql_result(connection, sql: str):
    cursor = connection.execute(sql)
    return normal([d[0] for d in cursor.description], cursor.fetchall())


def difference(actual, expected) -> str | None:
    """None when equal, else a short account of the first differences."""
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if actual[1] == expected[1]:
        return None
    extra = sorted(set(actual[1]) - set(expected[1]))[:2]
    lacking = sorted(set(expected[1]) - set(actual[1]))[:2]
    return f"{len(actual[1])} rows against {len(expected[1])}; only here {extra}; only in SQL {lacking}"


def main() -> None:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as contract
    from tests.conftest import local_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    spark = local_session()
    connection, oracle, failed = database(sf), contract.oracle_sql(), []
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            actual = spark_result(run(spark, f"{DATA}/sf{sf}"))
            taken = time.time() - start
            fault = difference(actual, sql_result(connection, oracle[name])) if name in oracle else "no SQL"
        except Exception as error:  # noqa: BLE001 - a report over all queries
            actual, taken, fault = ([], []), time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {len(actual[1]):7d} rows {taken:6.2f}s  {fault or 'equal'}", flush=True)
        if fault and fault != "no SQL":
            failed.append(name)
    print(f"{len(failed)} different: {failed}; without queries: {sorted(oracle.keys() - contract.queries().keys())}")


if __name__ == "__main__":
    main()

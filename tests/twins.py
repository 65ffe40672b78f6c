"""Run queries next to their SQL twins: ``python tests/twins.py [scale] [name ...]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog.queries import CATALOG  # noqa: E402

DATA = "/root/testdata"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _ordered(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(row[i] for i in places) for row in rows]
    return sorted(table, key=lambda row: tuple((v is None, str(v)) for v in row))


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE"}


def differences(spark, connection, folder, name):
    """List of differences between a query and its twin; empty when they agree."""
    query = CATALOG[name]
    frame = query.run(spark, folder)
    got = [tuple(row) for row in frame.collect()]
    if not query.sql:
        return ["no SQL twin"]
    result = connection.execute(query.sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = result.fetchall()
    found = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    for column, kind in frame.dtypes:
        if KINDS.get(kind, kind) != types[column]:
            found.append(f"type of {column}: {kind} != {types[column]}")
    if len(got) != len(expected):
        found.append(f"{len(got)} rows != {len(expected)}")
    left, right = _ordered(frame.columns, got), _ordered(names, expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}")
    if not got:
        found.append("no rows")
    return found


def main():
    from txlens.session import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    names = sys.argv[2:] or list(CATALOG)
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"{DATA}/{scale}"
    connection = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, connection, folder, name)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name}", *found,
              flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

"""Run registered queries next to their check SQL in DuckDB and compare the results.

    python -m tests.oracle [--sf sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    """A comparable form of one value."""
    if value is None:
        return "<null>"
    if isinstance(value, float):
        if math.isnan(value):
            return "<null>"
        return f"{value + 0.0:.6f}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(normal(v) for v in value) + "]"
    return str(value)


def rows_of_spark(df):
    columns = sorted(df.columns)
    rows = [tuple(normal(r[c]) for c in columns) for r in df.collect()]
    return columns, sorted(rows)


def rows_of_duckdb(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(normal(r[i]) for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows)


SAME_TYPE = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def compare(spark, connection, folder, run, sql) -> list[str]:
    """Problems found, empty when both sides agree."""
    df = run(spark, folder)
    columns, got = rows_of_spark(df)
    names, want = rows_of_duckdb(connection, sql)
    problems = []
    if columns != names:
        return [f"columns {columns} != {names}"]
    types = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    spark_types = dict(df.dtypes)
    for name in columns:
        if "[]" not in types[name] and SAME_TYPE.get(types[name]) != spark_types[name]:
            problems.append(f"type of {name}: spark {spark_types[name]}, sql {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        only_spark = sorted(set(got) - set(want))[:3]
        only_sql = sorted(set(want) - set(got))[:3]
        problems.append(f"values differ {columns}\n    spark only {only_spark}\n    sql only   {only_sql}")
    return problems


def main() -> int:
    from riskmart.catalog import ORACLE, QUERIES
    from tests.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    folder = str(TESTDATA / options.sf)
    spark = local_session("oracle")
    connection = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if options.names and name not in options.names:
            continue
        began = time.time()
        try:
            if name in ORACLE:
                problems = compare(spark, connection, folder, run, ORACLE[name])
                kind = "oracle"
            else:
                n = run(spark, folder).count()
                problems, kind = [], f"rows={n}"
        except Exception as error:  # noqa: BLE001  (report and go on)
            problems, kind = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name:32} {kind:12} {time.time() - began:6.2f}s", flush=True)
        for problem in problems:
            print("   ", problem, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())

"""Run queries of the catalogue and their SQL side by side.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str, tables: list[str] = TABLES) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def rows_of(result: pa.Table) -> tuple[list[str], list[tuple]]:
    names = sorted(result.column_names)
    columns = [result.column(name).to_pylist() for name in names]
    return names, sorted(zip(*columns), key=repr)


def kinds(result: pa.Table) -> dict[str, str]:
    plain = {"large_string": "string", "string_view": "string"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in result.schema}


def expected_of(connection: duckdb.DuckDBPyConnection, sql: str) -> pa.Table:
    return connection.sql(sql).to_arrow_table()


def differences(actual: pa.Table, expected: pa.Table) -> str:
    """Empty when both hold the same rows under the same names and types."""
    if kinds(actual) != kinds(expected):
        left, right = kinds(actual), kinds(expected)
        return f"schema {sorted(set(left.items()) ^ set(right.items()))}"
    a, b = rows_of(actual)[1], rows_of(expected)[1]
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> None:
    import __spark_entry__ as contract
    from strikelens.runtime import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(folder, [*TABLES, "documents", "labels", "conversations"]), contract.oracle_sql()
    chosen = sys.argv[2:] or list(contract.queries())
    for name in chosen:
        start = time.time()
        try:
            actual = contract.queries()[name](spark, folder).toArrow()
            took = time.time() - start
            verdict = differences(actual, expected_of(connection, sql[name])) if name in sql else "no SQL"
            print(f"{name:28s} {actual.num_rows:7d} rows {took:6.2f} s  {verdict or 'equal'}", flush=True)
        except Exception as error:  # keep going: this is a report
            print(f"{name:28s} FAILED {str(error)[:600]}", flush=True)


if __name__ == "__main__":
    main()

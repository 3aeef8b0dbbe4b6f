"""Side-by-side check of registered queries against their oracle SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(spark_df, connection, sql: str) -> tuple[list[str], int]:
    """Problems found (empty when equal) and the number of rows."""
    oracle = connection.execute(sql)
    oracle_columns = [item[0] for item in oracle.description]
    oracle_types = {item[0]: str(item[1]) for item in oracle.description}
    oracle_rows = oracle.fetchall()
    rows = [tuple(row) for row in spark_df.collect()]
    if sorted(spark_df.columns) != sorted(oracle_columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(oracle_columns)}"], len(rows)
    problems = []
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    oracle_types = {name: kind for name, kind, *_ in described}
    for name, kind in spark_df.dtypes:
        if SAME_TYPE.get(kind, kind) != oracle_types[name]:
            problems.append(f"type of {name}: {kind} vs {oracle_types[name]}")
    left, right = _rows(spark_df.columns, rows), _rows(oracle_columns, oracle_rows)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows vs {len(right)}")
    if left != right:
        missing = [row for row in left if row not in right][:2]
        absent = [row for row in right if row not in left][:2]
        problems.append(f"values: only spark {missing} only oracle {absent}")
    return problems, len(rows)


def main(sf_dir: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems, count = differences(query(spark, sf_dir), connection, oracles[name])
            else:
                problems, count = [], query(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001
            problems, count = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        bad += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in oracles else "rows")
        print(f"{mark:4} {name:12} rows={count:6} {time.time() - start:6.2f}s", *problems, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

"""Compare every query with its SQL oracle: `python -m matchlake.harness.check SF_DIR [name ...]`."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if value != value else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


# DuckDB type names to Spark ones that hold the same values.
_SAME_TYPE = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
}


def compare(spark: SparkSession, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = query(spark, sf_dir)
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
        cursor = connection.execute(sql)
        described = {d[0]: str(d[1]) for d in cursor.description}
        expected = _sorted_rows(list(described), cursor.fetchall())
    actual = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    if expected[0] != actual[0]:
        return f"columns: expected {expected[0]}, got {actual[0]}"
    types = [
        f"{name}: expected {described[name]}, got {kind}"
        for name, kind in result.dtypes
        if _SAME_TYPE.get(described[name], described[name]) != kind.replace("_ntz", "")
    ]
    if types:
        return "types: " + "; ".join(types)
    if len(expected[1]) != len(actual[1]):
        return f"rows: expected {len(expected[1])}, got {len(actual[1])}"
    wrong = [(e, a) for e, a in zip(expected[1], actual[1], strict=True) if e != a]
    if wrong:
        return f"{len(wrong)} of {len(expected[1])} rows differ, first {wrong[0]}"
    if not expected[1]:
        return "no rows"
    return None


def main(argv: list[str]) -> int:
    from matchlake.harness.oracles import oracle_sql
    from matchlake.harness.queries import queries
    from matchlake.session import build_session

    sf_dir, *names = argv
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                              "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failures = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, sf_dir, query, oracles[name])
                kind = "oracle"
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
                kind = "rows"
        except Exception as error:  # report every query, then fail
            problem, kind = f"{type(error).__name__}: {str(error)[:1500]}", "error"
        failures += problem is not None
        print(f"{name:32s} {kind:6s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

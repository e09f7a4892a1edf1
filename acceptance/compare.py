"""Run registered queries next to their oracle SQL and compare the results.

``python -m acceptance.compare [folder] [name ...]``
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from acceptance.oracles import oracle_sql
from acceptance.queries import queries

DEFAULT_FOLDER = "/root/testdata/sf0.01"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cells(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows as comparable texts, columns by name, rows in any order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(value) -> str:
        if value is None:
            return "~"
        return repr(float(value)) if isinstance(value, float | Decimal) else str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
}


def compare(spark: SparkSession, connection, folder: str, name: str, sql: str) -> list[str]:
    """Differences between the query and its oracle; empty when they agree."""
    result = queries()[name](spark, folder)
    ours = result.collect()
    cursor = connection.execute(sql)
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    theirs = cursor.fetchall()
    if sorted(result.columns) != sorted(kinds):
        return [f"columns {sorted(result.columns)} != {sorted(kinds)}"]
    problems = [
        f"type of {column}: {kind} != {kinds[column]}"
        for column, kind in result.dtypes
        if KINDS.get(kind, kind) != kinds[column]
    ]
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    left, right = _cells(result.columns, ours), _cells(list(kinds), theirs)
    if left != right:
        problems.append(f"values differ, first: {[(a, b) for a, b in zip(left, right) if a != b][:2]}")
    return problems


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else DEFAULT_FOLDER
    wanted = arguments[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sqls = oracle_sql()
    bad = 0
    for name in queries():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems = compare(spark, connection, folder, name, sqls[name]) if name in sqls else ["no oracle"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - start:.1f}s", *problems, flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

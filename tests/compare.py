"""Run registered queries next to their SQL on the same files and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sort_key(row):
    return [(v is None, str(type(v)), str(v)) for v in row]


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and all values agree."""
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    cursor = con.execute(sql)
    sql_kinds = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(sql_kinds) != names:
        return [f"columns {names} against {sorted(sql_kinds)}"]
    found = [
        f"type of {c}: {kinds[c]} against {sql_kinds[c]}" for c in names if KINDS.get(kinds[c]) != sql_kinds[c]
    ]
    order = [list(sql_kinds).index(c) for c in names]
    expected = [tuple(_plain(row[i]) for i in order) for row in cursor.fetchall()]
    actual = [tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in names]).collect()]
    if len(actual) != len(expected):
        return found + [f"{len(actual)} rows against {len(expected)}"]
    actual.sort(key=_sort_key)
    expected.sort(key=_sort_key)
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} of {len(actual)} rows differ, first: {str(wrong[0])[:600]}")
    if not actual:
        found.append("no rows")
    return found


def main(folder: str, only: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from quipu.plans import load

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, q in load().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = q(spark, folder)
            problems = differences(df, con, q.sql) if q.sql else [] if df.count() else ["no rows"]
        except Exception as error:  # report every query
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n     ", flush=True)
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

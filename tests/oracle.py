"""Compare registered queries with their SQL on DuckDB.

``python -m tests.oracle [folder] [name prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    """A hashable value that keeps the type distinctions a reader of the result would notice."""
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("time", str(value))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


# Spark type names that DuckDB spells differently.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
}


def type_differences(df, con, sql: str) -> str:
    """Columns whose type in the result differs from the SQL's, as text."""
    rel = con.sql(sql)
    want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = {c: TYPES.get(t, t) for c, t in df.dtypes}
    return ", ".join(f"{c}: {got[c]} != {want.get(c)}" for c in got if got[c] != want.get(c))


def compare(df, con, sql: str) -> str:
    """Empty text when equal, else what differs."""
    result = con.execute(sql)
    want_cols = [c[0] for c in result.description]
    want = rows_of(want_cols, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w or [type(a) for a in g] != [type(b) for b in w]]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}"
    return "" if got else "EMPTY"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if chosen and not any(name == c or name.startswith(c + "_") for c in chosen):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            note = compare(df, con, oracles[name]) if name in oracles else f"(no SQL) {df.count()} rows"
            if note == "" and name in oracles and (types := type_differences(df, con, oracles[name])):
                note = f"(types) {types}"
        except Exception as error:  # report and go on with the next query
            note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = note == "" or note.startswith("(")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

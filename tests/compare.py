"""Run registered queries against their SQL twins: ``python tests/compare.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(sorted((k, plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def kind(name: str) -> str:
    name = name.lower()
    if name in ("double", "float"):
        return "double"
    return {"bigint": "long", "integer": "int", "varchar": "string", "boolean": "boolean"}.get(
        name, name
    )


def spark_kind(name: str) -> str:
    return {"bigint": "long"}.get(name, name)


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(sql)
    description = cursor.description
    return [c[0] for c in description], [str(c[1]) for c in description], cursor.fetchall()


def compare(spark, name, fn, sql, sf_dir):
    """Return (ok, message, seconds)."""
    started = time.time()
    frame = fn(spark, sf_dir)
    got = frame.collect()
    seconds = time.time() - started
    if sql is None:
        return len(got) > 0, f"rows only: {len(got)}", seconds
    names, types, expected = oracle(sf_dir, sql)
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}", seconds
    mine = {f.name: spark_kind(f.dataType.simpleString()) for f in frame.schema}
    theirs = {n: kind(t) for n, t in zip(names, types)}
    typed = {n: (mine[n], theirs[n]) for n in names if mine[n] != theirs[n]}
    a, b = rows_of(frame.columns, got), rows_of(names, expected)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}", seconds
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    note = f"{len(a)} rows" + (f" TYPES {typed}" if typed else "")
    if bad:
        return False, f"{note}; {len(bad)} differ, {sorted(names)}\n   {bad[0][0]}\n   {bad[0][1]}", seconds
    return len(a) > 0 and not typed, note, seconds


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("parcella-compare")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as contract

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    queries, sqls = contract.queries(), contract.oracle_sql()
    spark, failed = session(), []
    for name in argv or list(queries):
        try:
            ok, message, seconds = compare(spark, name, queries[name], sqls.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, message, seconds = False, f"{type(error).__name__}: {str(error)[:700]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {seconds:6.2f}s {message}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])

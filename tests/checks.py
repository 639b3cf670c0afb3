"""Compare a registered query with its check SQL on DuckDB."""

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float):
        return repr(value)
    return value


def ordered(rows, columns, names):
    at = [columns.index(n) for n in names]
    return sorted([tuple(plain(r[i]) for i in at) for r in rows], key=repr)


def compare(spark, sf_dir, con, fn, sql):
    """(problem or None, rows)."""
    got = fn(spark, sf_dir)
    rel = con.sql(sql)
    names = sorted(got.columns)
    if names != sorted(rel.columns):
        return f"columns {names} != {sorted(rel.columns)}", 0
    spark_types = {f.name: f.dataType.simpleString() for f in got.schema}
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    alike = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    for n in names:
        if alike.get(spark_types[n]) != duck_types[n]:
            return f"type of {n}: {spark_types[n]} != {duck_types[n]}", 0
    a = ordered(got.collect(), got.columns, names)
    b = ordered(rel.fetchall(), rel.columns, names)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}", len(a)
    for x, y in zip(a, b):
        if x != y:
            return f"{names}: {x} != {y}", len(a)
    return None, len(a)

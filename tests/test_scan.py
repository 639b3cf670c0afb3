import random

import pytest
from pyspark.sql import functions as F

from retail_lake.operators import scan


def make_rows(seed, n=400, skew=True):
    rnd = random.Random(seed)
    rows, nxt = [], {}
    for _ in range(n):
        table = "hot" if skew and rnd.random() < 0.4 else f"t{rnd.randrange(4)}"
        i = nxt.get(table, 0)
        nxt[table] = i + 1
        first = i == 0
        rows.append((
            table, i,
            f"f{rnd.randrange(3)}" if first or rnd.random() < 0.15 else None,
            f"c{rnd.randrange(50)}" if rnd.random() < 0.4 else None,
            rnd.randrange(100) if rnd.random() < 0.5 else None,
        ))
    rnd.shuffle(rows)
    return rows


COLUMNS = "table_name string, row_index bigint, file_name string, code string, qty bigint"


def by_table(rows):
    tables = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1])):
        tables.setdefault(row[0], []).append(row)
    return tables


@pytest.mark.parametrize("bits", [(3,), (2, 3), (20,)])
def test_forward_fill_matches_brute_force(spark, bits):
    rows = make_rows(1)
    want = []
    for table in by_table(rows).values():
        held = [None, None, None]
        for row in table:
            held = [v if v is not None else h for v, h in zip(row[2:], held)]
            want.append((row[0], row[1], *held))
    got = scan.forward_fill(spark.createDataFrame(rows, COLUMNS), ["table_name"], "row_index",
                            ["file_name", "code", "qty"], bits=bits)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


@pytest.mark.parametrize("bits", [(3,), (2, 3)])
def test_forward_fill_within_file(spark, bits):
    rows = make_rows(2)
    want = []
    for table in by_table(rows).values():
        held = [None, None, None]
        for row in table:
            if row[2] is not None and row[2] != held[0]:
                held = [None, None, None]
            held = [v if v is not None else h for v, h in zip(row[2:], held)]
            want.append((row[0], row[1], *held))
    got = scan.forward_fill(spark.createDataFrame(rows, COLUMNS), ["table_name"], "row_index",
                            ["file_name", "code", "qty"], within="file_name", bits=bits)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


def brute_runs(rows):
    ids, runs = [], []
    for table in by_table(rows).values():
        name, run = None, 0
        for row in table:
            if row[2] is not None and row[2] != name:
                name, run = row[2], run + 1
                runs.append([row[0], run, name, row[1], row[1], 0])
            ids.append((row[0], row[1], run))
            if run:
                runs[-1][4] = row[1]
                runs[-1][5] += 1
    return ids, [tuple(r) for r in runs]


@pytest.mark.parametrize("bits", [(3,), (2, 3), (20,)])
def test_runs_match_brute_force(spark, bits):
    rows = make_rows(3)
    df = spark.createDataFrame(rows, COLUMNS)
    ids, runs = brute_runs(rows)
    got = scan.run_ids(df, ["table_name"], "row_index", "file_name", bits=bits)
    got = got.select("table_name", "row_index", "run_id").collect()
    assert sorted(map(tuple, got)) == ids
    counts = scan.run_counts(df, ["table_name"], "row_index", "file_name", bits=bits)
    counts = counts.select("table_name", "run_id", "file_name", "first_row", "last_row", "n_rows")
    assert sorted(map(tuple, counts.collect())) == sorted(runs)


def test_rows_before_the_first_name_have_run_zero(spark):
    rows = [("t", 0, None, None, None), ("t", 1, None, None, None), ("t", 2, "a", None, None)]
    df = spark.createDataFrame(rows, COLUMNS)
    got = scan.run_ids(df, ["table_name"], "row_index", "file_name", bits=(1,))
    assert [r.run_id for r in got.orderBy("row_index").collect()] == [0, 0, 1]
    counts = scan.run_counts(df, ["table_name"], "row_index", "file_name", bits=(1,)).collect()
    assert [(r.file_name, r.first_row, r.n_rows) for r in counts] == [("a", 2, 1)]


def test_number_rows_continues_from_the_stored_mark(spark):
    df = spark.createDataFrame([("a", 50), ("a", 7), ("b", 9), ("a", 1000)], "k string, at bigint")
    start = spark.createDataFrame([("a", 41)], "k string, last_row bigint")
    got = scan.number_rows(df, ["k"], "at", start, bits=(3, 2)).orderBy("k", "at").collect()
    assert [(r.k, r.at, r.row_index) for r in got] == [
        ("a", 7, 42), ("a", 50, 43), ("a", 1000, 44), ("b", 9, 0)]


def test_no_window_is_partitioned_by_table_alone(spark):
    df = spark.createDataFrame(make_rows(4), COLUMNS)
    plan = scan.forward_fill(df, ["table_name"], "row_index", ["code"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert any("_bucket" in line for line in windows)
    assert plan.where(F.col("code").isNull()).count() >= 0

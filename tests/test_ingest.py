"""The push cases of the landing format: dense keys, sparse keys, two chunks, resume."""

import pytest
from pyspark.sql import functions as F

from retail_lake.operators import filters, ingest, merge, scan

WIDE = "table_name string, row_index bigint, found_folder string, file_name string, more_data string"


def load(spark, rows, carry=None, content=("more_data",)):
    df = spark.createDataFrame(rows, WIDE)
    return ingest.ingest(df, ["table_name"], list(content), carry=carry)


def shape(rows):
    return [(r.row_index, r.found_folder, r.file_name, r.content) for r in rows.orderBy("row_index").collect()]


def test_every_row_its_own_file(spark):
    rows = [("t", i, f"folder{i}", f"file{i}", f"data{i}") for i in range(10)]
    packed, bad = load(spark, rows)
    assert shape(packed) == [(i, f"folder{i}", f"file{i}", {"more_data": f"data{i}"}) for i in range(10)]
    assert bad.count() == 0
    marks = ingest.completion_markers(spark.createDataFrame(rows, WIDE), ["table_name"], bits=(1,))
    got = sorted((r.first_row, r.file_complete, r.file_name, r.total_expected_records) for r in marks.collect())
    assert got == [(i, "true", f"file{i}", 1) for i in range(10)]


@pytest.mark.parametrize("bits", [(1,), (20,)])
def test_sparse_keys_leave_no_nulls(spark, bits):
    rows = [("t", 0, "folder", "file", "data")] + [("t", i, None, None, None) for i in range(1, 10)]
    packed, _ = ingest.ingest(spark.createDataFrame(rows, WIDE), ["table_name"], ["more_data"], bits=bits)
    assert shape(packed) == [(i, "folder", "file", {"more_data": "data"}) for i in range(10)]


def test_marker_counts_do_not_depend_on_buckets(spark):
    rows = [("t", i, "d", "f1" if i < 5 else "f2", None) for i in range(7)]
    df = spark.createDataFrame(rows, WIDE)
    for bits in ((1,), (2,), (1, 1), (20,)):
        marks = ingest.completion_markers(df, ["table_name"], bits=bits).collect()
        assert sorted((r.file_name, r.total_expected_records) for r in marks) == [("f1", 5), ("f2", 2)]


def test_a_file_in_two_runs_has_two_markers(spark):
    rows = [("t", i, "d", f, None) for i, f in enumerate(["a", "a", "b", "a"])]
    marks = ingest.completion_markers(spark.createDataFrame(rows, WIDE), ["table_name"]).collect()
    assert sorted((r.run_id, r.file_name, r.total_expected_records) for r in marks) == [
        (1, "a", 2), (2, "b", 1), (3, "a", 1)]


def test_first_row_without_keys_sets_the_table_aside(spark):
    rows = [("bad", 0, None, "f", "x"), ("bad", 1, "d", "f", "x"), ("good", 0, "d", "f", "x")]
    packed, bad = load(spark, rows)
    assert [r.table_name for r in packed.collect()] == ["good"]
    assert sorted(r.row_index for r in bad.collect()) == [0, 1]


def test_markers_follow_their_rows(spark):
    rows = spark.createDataFrame([("t", i, "d", "f1" if i < 2 else "f2", None) for i in range(3)], WIDE)
    packed, _ = ingest.ingest(rows, ["table_name"], ["more_data"])
    both = ingest.with_markers(packed, ingest.completion_markers(rows, ["table_name"])).orderBy("seq").collect()
    assert [(r.file_name, r.file_complete) for r in both] == [
        ("f1", None), ("f1", None), ("f1", "true"), ("f2", None), ("f2", "true")]
    kept = filters.drop_control(ingest.with_markers(packed, ingest.completion_markers(rows, ["table_name"])))
    assert kept.count() == 3


def test_resume_equals_one_load(spark):
    rows = [("t", 0, "d", "f", "x"), ("t", 1, None, None, None), ("t", 2, None, None, "y"), ("t", 3, None, None, None),
            ("t", 4, None, "g", None)]
    whole, _ = load(spark, rows)
    first, _ = load(spark, rows[:2])
    marks = ingest.progress_of(spark.createDataFrame(rows[:2], WIDE))
    fresh = ingest.rows_after(spark.createDataFrame(rows, WIDE), marks)
    carry = first.where("row_index = 1").select(
        "table_name", "row_index", "found_folder", "file_name", F.col("content.more_data").alias("more_data"))
    second, bad = ingest.ingest(fresh, ["table_name"], ["more_data"], carry=carry)
    assert shape(first) + shape(second) == shape(whole) and bad.count() == 0
    after = ingest.merge_progress(marks, ingest.progress_of(fresh)).first()
    assert (after.table_name, after.last_row) == ("t", 4)


def test_continued_runs_take_over_the_open_one(spark):
    new = spark.createDataFrame([("t", 3, "a"), ("t", 4, "b"), ("u", 0, "c")],
                                "table_name string, row_index bigint, file_name string")
    held = spark.createDataFrame([("t", "a", 1, 2, 2), ("v", "z", 0, 9, 10)],
                                 "table_name string, file_name string, first_row bigint, last_row bigint, n_rows bigint")
    got = {(r.table_name, r.file_name): (r.first_row, r.n_rows, r.has_new_rows)
           for r in ingest.continued_runs(new, held, ["table_name"]).collect()}
    assert got == {("t", "a"): (1, 3, True), ("t", "b"): (4, 1, True), ("u", "c"): (0, 1, True),
                   ("v", "z"): (0, 10, False)}


def test_insert_ignore_and_upsert(spark):
    schema = "k bigint, v string, content string, seq bigint"
    stored = spark.createDataFrame([(1, "old", "c", 0)], schema)
    items = spark.createDataFrame([(1, "new", "c", 1), (2, "b", "c", 3), (2, "a", "c", 2), (None, "m1", None, 4),
                                   (None, "m2", None, 5)], schema)
    added = merge.insert_ignore(stored, items, ["k"], "seq", exempt=F.col("content").isNull())
    assert sorted((r.k or 0, r.v) for r in added.collect()) == [(0, "m1"), (0, "m2"), (2, "a")]
    again = merge.insert_ignore(stored.unionByName(added), items, ["k"], "seq", exempt=F.col("content").isNull())
    assert [r.v for r in again.where("k IS NOT NULL").collect()] == []
    after = merge.upsert(stored, items.where("k IS NOT NULL"), ["k"], "seq")
    assert sorted((r.k, r.v) for r in after.collect()) == [(1, "new"), (2, "b")]


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x bigint")
    b = spark.createDataFrame([(2,), (3,)], "x bigint")
    assert [r.x for r in merge.subtract(a, b).collect()] == [1]
    assert sorted(r.x for r in merge.union_seen(a, b).collect()) == [1, 2, 3]


def test_ledger_keeps_old_ids_and_adds_new_ones_once(spark):
    old = spark.createDataFrame([("f", "1"), ("f", "2")], "source_file string, digest string")
    new = spark.createDataFrame([("f", "2"), ("f", "3"), ("f", "3"), ("g", "1")], "source_file string, digest string")
    assert sorted(map(tuple, merge.append_ledger(old, new).collect())) == [("f", "1"), ("f", "2"), ("f", "3"), ("g", "1")]


def test_one_hot_table_is_spread_over_tasks(spark):
    """Half of the rows belong to one table; no window sees more than a bucket of it."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 7)).alias("table_name"),
        F.col("id").alias("row_index"), F.when(F.col("id") % 50 < 2, F.col("id").cast("string")).alias("v"))
    filled = scan.forward_fill(rows, ["table_name"], "row_index", ["v"], bits=(7,))
    spread = filled.where("table_name = 'hot'").withColumn("task", F.spark_partition_id())
    assert spread.where(F.col("v").isNull()).count() == 0
    biggest = (rows.where("table_name = 'hot'").groupBy(F.shiftright("row_index", 7)).count()
               .agg(F.max("count")).first()[0])
    assert biggest <= 2 ** 7

"""Inputs at the edge: missing keys and columns, broken files, line breaks in cells, repeated loads."""

import json

import pytest
from pyspark.sql import functions as F

from retail_lake.operators import access, filters, merge
from retail_lake.plans.lake import Lake
from retail_lake.sinks import snapshot
from retail_lake.sources import files, topic

SCHEMA = "key string, seq bigint, value string"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rows_without_order_are_kept(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 2, "z"), ("b", 1, "w")], SCHEMA)
    assert tuples(merge.first_per_key(df, ["key"], "seq")) == [("a", None, "x"), ("b", 1, "w")]
    assert tuples(merge.last_per_key(df, ["key"], F.col("seq"))) == [("a", None, "x"), ("b", 2, "z")]
    assert tuples(access.latest(df, ["key"], "seq")) == [("a", None, "x"), ("b", 2, "z")]


def test_absent_column_is_missing_everywhere(spark):
    df = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    assert filters.eq_filter(df, {"absent": None}).count() == 1
    assert filters.eq_filter(df, {"absent": "v"}).count() == 0
    assert filters.eq_filter(df, {"key": None}).count() == 0


@pytest.mark.parametrize("offset,size", [(0, 2), (1, 3), (3, 10), (9, 1)])
def test_deep_and_shallow_pages_agree_on_a_missing_key(spark, offset, size):
    df = spark.createDataFrame([(None,), (0,), (1,), (2,), (3,)], "row_index bigint")
    shallow = [r.row_index for r in access.page(df, offset, size).collect()]
    assert shallow == [None, 0, 1, 2, 3][offset:offset + size]
    assert [r.row_index for r in access.page(df, offset, size, bits=(1,), top_n=0).collect()] == shallow


def test_documents_repeat_within_a_topic_only(spark):
    sent = [("t", '{"a":1}'), ("u", '{"a":1}'), ("t", '{"a":"1"}'), ("t", '{ "a":1 }'), ("t", "raw"), ("t", "raw"),
            ("t", "[1]"), ("t", "[ 1]"), ("t", '{"flush":"true"}'), ("t", '{"b":{"x":1,"y":2}}'), ("t", '{"b":{"y":2,"x":1}}')]
    got = topic.clean_topic(spark.createDataFrame(sent, "topic string, value string"))
    assert tuples(got.select("topic", F.coalesce("canonical", "value"))) == sorted([
        ("t", '{"a":"1"}'), ("t", '{"a":1}'), ("t", '{"b":{"x":1,"y":2}}'), ("t", "[1]"), ("t", "raw"), ("t", "raw"),
        ("u", '{"a":1}')], key=repr)


def test_snapshot_keeps_names_like_numbers_and_empty_versions(spark, tmp_path):
    rows = spark.createDataFrame([("PRICE_FILE", "007", 1, "x"), ("PRICE_FILE", "7", 2, "y")],
                                 "file_type string, chain string, row_index bigint, content string")
    status = spark.createDataFrame([], "source_file string")
    snapshot.write_snapshot(rows, status, str(tmp_path), 0)
    snapshot.write_snapshot(rows.where("false"), status, str(tmp_path), 1)
    got = snapshot.read_snapshot(spark, str(tmp_path), 0, chains=["007"])
    assert tuples(got.select(*rows.columns)) == [("PRICE_FILE", "007", 1, "x")]
    assert snapshot.read_snapshot(spark, str(tmp_path), 1).count() == 0
    assert snapshot.read_snapshot(spark, str(tmp_path), 0, "status").columns == ["source_file"]


def landing(folder):
    for name in ("outputs", "scraper", "parser"):
        (folder / name).mkdir()
    head = "found_folder,file_name,itemcode,name\n"
    (folder / "outputs" / "price_file_alpha.csv").write_text(
        head + 'd,Price1-1-202401010000.xml,1,"two\nlines, ""quoted"""\n,,2,plain\n,,3,"a ""b"" c"\n')
    (folder / "outputs" / "price_file_beta.csv").write_text(head + ",,1,lost\n,,2,lost\n")
    event = {"index": "i", "status": "started", "task_id": "t1", "chain": "ALPHA", "v": 1}
    (folder / "scraper" / "alpha.json").write_text(json.dumps({"events": [
        event, event | {"v": "1"}, dict(reversed(event.items()))], "global_status": []}))
    (folder / "scraper" / "beta.json").write_text('{"events": [{"index": ')
    (folder / "scraper" / "gamma.json").write_text('{"events": ["one", "two", {"v": 1.0}, {"v": 1}, {"v": 2, "v": 1}], "note": {"events": []}}')
    (folder / "scraper" / "delta.json").write_text("[1,2]")
    return [str(folder / n) for n in ("outputs", "scraper", "parser")]


def test_two_loads_of_awkward_files(spark, tmp_path):
    folders = landing(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"), {"ALPHA": "Alpha", "BETA": "Beta"})
    for hour in (1, 2):
        lake.upload(*folders, as_of=f"2024-01-01 0{hour}:00:00")
        got = sorted((r.row_index, r.content["name"]) for r in lake.rows().collect())
        assert got == [(0, 'two\nlines, "quoted"'), (1, "plain"), (2, 'a "b" c')]
        assert sorted((r.chain, r.row_index) for r in lake.quarantined().collect()) == [("BETA", 0), ("BETA", 1)]
        assert sorted(r.source_file for r in lake.status("ScraperStatus").collect()) == ["alpha.json"] * 2 + ["gamma.json"] * 4
        assert tuples(lake.broken_logs().select("source_file", "kind")) == [("beta.json", "scraper"), ("delta.json", "scraper")]
    assert tuples(lake.reconcile(folders[0]).select("table_name", "source_rows", "stored_rows", "matches")) == [
        ("price_file_alpha", 3, 3, True), ("price_file_beta", 2, 0, False)]


def test_whole_files_are_still_read_in_blocks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text('x,y\n"5\n6",7\n8,9\n')
    got = files.read_csv_rows(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["x", "y"], folder=str(tmp_path / "scratch"))
    assert tuples(got.select("source_file", "row_index", "x", "y")) == [
        ("a.csv", 0, "1", "2"), ("a.csv", 1, "3", "4"), ("b.csv", 0, "5\n6", "7"), ("b.csv", 1, "8", "9")]

import csv
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from retail_lake.operators import access, filters, status, versions
from retail_lake.sinks import store, topic as topic_sink
from retail_lake.sources import files, status_logs, tables, topic


def write(path, text):
    os.makedirs(os.path.dirname(str(path)), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_row_positions_hold_when_a_file_is_read_in_blocks(spark, tmp_path):
    """Small blocks: one file is read by many tasks, and each row still knows its line."""
    for name, n in (("price_file_a.csv", 900), ("price_file_b.csv", 7)):
        write(tmp_path / name, "pos,found_folder,file_name\n" + "".join(
            f"{i},d,{'x' * (i % 40)}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        (columns, paths), = files.landing_groups(spark, str(tmp_path))
        rows = files.read_csv_rows(spark, paths, columns)
        blocks = spark.read.csv(paths).select(F.col("_metadata.file_block_start")).distinct().count()
        got = rows.select("table_name", "row_index", "pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks > 5
    assert len(got) == 907 and all(r.row_index == int(r.pos) for r in got)
    assert {r.table_name for r in got} == {"price_file_a", "price_file_b"}


def test_numbering_csv_rows_shuffles_no_rows(spark, tmp_path):
    write(tmp_path / "price_file_a.csv", "a,b\n1,2\n")
    rows = files.read_csv_rows(spark, [str(tmp_path / "price_file_a.csv")], ["a", "b"])
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


def test_landing_groups_by_header(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,2\n")
    write(tmp_path / "b.csv", "x,y\n")
    write(tmp_path / "c.csv", "x,z\n1,2\n")
    write(tmp_path / "notes.txt", "no")
    groups = files.landing_groups(spark, str(tmp_path))
    assert sorted((c, len(p)) for c, p in groups) == [(["x", "y"], 2), (["x", "z"], 1)]
    assert files.csv_header(spark, str(tmp_path / "c.csv")) == ["x", "z"]
    columns, paths = next(g for g in groups if g[0] == ["x", "y"])
    assert [(r.source_file, r.row_index, r.x) for r in files.read_csv_rows(spark, paths, columns).collect()] == [
        ("a.csv", 0, "1")]


def test_quoted_line_breaks(spark, tmp_path):
    write(tmp_path / "a.csv", 'x,y\n"one\ntwo",2\n3,4\n')
    rows = files.read_csv_rows(spark, [str(tmp_path / "a.csv")], ["x", "y"])
    assert [(r.row_index, r.x) for r in rows.orderBy("row_index").collect()] == [(0, "one\ntwo"), (1, "3")]


def test_a_file_with_quoted_breaks_is_read_in_blocks(spark, tmp_path):
    """Breaks, doubled quotes, blank lines and blocks that begin inside quotes, against a CSV library."""
    rng = random.Random(2)
    rows = [[str(i), "".join(rng.choice(["a", '"', "\n", ",", "\n\n", "é", " "]) for _ in range(rng.randint(0, 9))) or "x"] for i in range(400)]
    with open(tmp_path / "price_file_a.csv", "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerows([["x", "y"], *rows])
        out.write("\n\n")
    write(tmp_path / "price_file_b.csv", "x,y\n1,2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        paths = [str(tmp_path / f"price_file_{n}.csv") for n in "ab"]
        got = files.read_csv_rows(spark, paths, ["x", "y"]).orderBy("table_name", "row_index").collect()
        counts = {r.table_name: r.source_rows for r in files.count_csv_rows(spark, paths, ["x", "y"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.table_name, r.row_index, r.x) for r in got] == [("price_file_a", i, str(i)) for i in range(400)] + [("price_file_b", 0, "1")]
    assert [r.y.strip(" ") for r in got[:400]] == [y.strip(" ") for _, y in rows]
    assert counts == {"price_file_a": 400, "price_file_b": 1}


def test_quotes_and_missing_cells(spark, tmp_path):
    write(tmp_path / "a.csv", 'x,y\n"say ""hi"", then",NULL\n"",NaN\n\nnull and void,n/a\n')
    rows = files.read_csv_rows(spark, [str(tmp_path / "a.csv")], ["x", "y"]).orderBy("row_index").collect()
    assert [(r.row_index, r.x, r.y) for r in rows] == [
        (0, 'say "hi", then', None), (1, None, None), (2, "null and void", None)]


def test_empty_tables_have_their_schema(spark, tmp_path):
    store.create_empty(spark, str(tmp_path / "t"), "a bigint, b string, batch_id bigint")
    df = tables.read_table(spark, str(tmp_path / "t"), "a bigint, b string, batch_id bigint")
    assert df.count() == 0 and df.columns == ["a", "b", "batch_id"]


def test_status_logs(spark, tmp_path):
    doc = {"events": [{"task_id": "t", "n": 2 ** 63}, {"task_id": "u"}], "global_status": [{"task_id": "t", "status": "started"}]}
    write(tmp_path / "alpha.json", json.dumps(doc, indent=2))
    write(tmp_path / "alpha.txt", "no")
    rows = status_logs.read_logs(spark, str(tmp_path))[0].orderBy("seq").collect()
    assert [(r.source_file, r.part) for r in rows] == [
        ("alpha.json", "events"), ("alpha.json", "events"), ("alpha.json", "global_status")]
    assert json.loads(rows[0].payload) == {"task_id": "t", "n": 2 ** 63}


def test_xml_dump(spark, tmp_path):
    write(tmp_path / "Alpha" / "Price1.xml",
          "<Root><Items><Item><Code>1</Code><Price>2.5</Price></Item><Item><Code>2</Code></Item></Items></Root>")
    rows = files.read_xml_rows(spark, str(tmp_path / "Alpha"), "Item", "Code string, Price string").orderBy("Code").collect()
    assert [tuple(r) for r in rows] == [("Alpha", "Price1.xml", "1", "2.5"), ("Alpha", "Price1.xml", "2", None)]


def test_dataset_files(spark, tmp_path):
    write(tmp_path / "price_file_alpha.csv", "a\n1\n")
    write(tmp_path / "alpha.json", '{"x": 1}')
    write(tmp_path / "readme.md", "hello\n")
    folder = str(tmp_path)
    assert {r.file_name for r in files.list_files(spark, folder).collect()} == {"price_file_alpha.csv", "alpha.json", "readme.md"}
    assert [r.file_name for r in files.list_files(spark, folder, "Alpha", "csv").collect()] == ["price_file_alpha.csv"]
    assert files.read_file(spark, folder, "alpha.json").first().x == 1
    assert files.read_file(spark, folder, "price_file_alpha.csv").first().a == "1"
    assert files.read_file(spark, folder, "readme.md").first().value == "hello"
    assert files.last_modified(spark, folder).first().last_update is not None


def test_a_missing_table_is_empty(spark, tmp_path):
    df = tables.read_table(spark, str(tmp_path / "none"), "a bigint, b string", {"b": "x"})
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_equality_filter(spark):
    df = spark.createDataFrame([(1, "csv"), (2, "json"), (3, "csv"), (4, None)], "id bigint, file_type string")
    assert filters.eq_filter(df, {"file_type": "csv"}).count() == 2
    assert [r.id for r in filters.eq_filter(df, {"file_type": None}).collect()] == [4]
    assert filters.eq_filter(df, {}).count() == 4


def test_regex_filter_takes_operands_literally(spark):
    df = spark.createDataFrame([("PRICE_FILE@A.B@1",), ("PRICE_FILE@AXB@1",), ("STORE_FILE@A.B@1",)], "index string")
    assert filters.match_index(df, "A.B").count() == 2
    assert [r[0] for r in filters.match_index(df, "A.B", "PRICE_FILE").collect()] == ["PRICE_FILE@A.B@1"]


def test_domain_checks():
    with pytest.raises(ValueError, match="name a file"):
        filters.check_domain(["A"], "A", needs_file=True)
    assert filters.check_domain(["A"], "A", file="NULLPriceFull7290000000001-1.xml") == "PRICE_FULL_FILE"


def test_store_and_date_filters(spark):
    df = spark.createDataFrame([(1, ["x-001", "x-002"], "2024-01-01"), (2, None, None)], "id bigint, files array<string>, d string")
    df = df.withColumn("ts", F.to_timestamp_ntz("d"))
    assert filters.with_store(df, "002").first().files == ["x-002"]
    assert filters.with_store(df, None).first().files == ["x-001", "x-002"]
    bound = F.lit("2024-01-02").cast("timestamp_ntz")
    assert [r.id for r in filters.since(df, "ts", bound).collect()] == [2]
    assert access.explode_files(df).count() == 2


@pytest.mark.parametrize("offset,size", [(0, 3), (5, 4), (95, 10), (200, 5), (0, 0)])
def test_deep_page_equals_shallow_page(spark, offset, size):
    df = spark.range(100).select((F.col("id") * 7 + 3).alias("row_index"))
    deep = access.page(df, offset, size, bits=(4,), top_n=-1)
    shallow = access.page(df, offset, size)
    assert [r[0] for r in deep.collect()] == [r[0] for r in shallow.collect()]
    with pytest.raises(ValueError):
        access.page(df, -1, 5)


def test_page_metadata(spark):
    df = spark.range(25)
    assert tuple(access.page_meta(df, 0, 10).first()) == (25, True, 0, 10, "10", None)
    assert tuple(access.page_meta(df, 10, 10).first()) == (25, True, 10, 10, "20", "0")
    assert tuple(access.page_meta(df, 20, 10).first()) == (25, False, 20, 10, None, "10")
    assert tuple(access.page_meta(df, 5, 10).first()) == (25, True, 5, 10, "15", "0")
    assert access.page_meta(df.where("false")).first().total_count == 0


def test_task_lists_are_bounded(spark):
    events = spark.range(25).select(F.lit("t").alias("task_id"), "id", F.lit("x").alias("v"))
    glob = spark.range(100, 101).select(F.lit("t").alias("task_id"), "id", F.lit("g").alias("v"))
    got = {(r.part, r.chunk): [i.id for i in r["items"]]
           for r in status.by_task(events, glob, "id", ["id", "v"], size=10, bits=(3, 2)).collect()}
    assert got == {("events", 0): list(range(10)), ("events", 1): list(range(10, 20)), ("events", 2): list(range(20, 25)),
                   ("global_status", 0): [100]}


def test_lifecycle(spark):
    rows = [("ok", "started", 1), ("ok", "done", 2), ("twice", "started", 1), ("twice", "started", 2), ("twice", "done", 3),
            ("late", "done", 1), ("late", "started", 2), ("open", "started", 1)]
    df = spark.createDataFrame(rows, "task_id string, status string, ts bigint")
    got = {r.task_id: r.is_valid for r in status.lifecycle(df, "started", ["done"]).collect()}
    assert got == {"ok": True, "twice": False, "late": False, "open": False}
    assert not status.lifecycle(df.where("task_id = 'ok'"), "started", ["done"], 4).first().is_valid


def test_new_events_share_the_ledger_of_their_file(spark):
    events = spark.createDataFrame(
        [("f", "1", 0, "events"), ("f", "1", 9, "global"), ("f", "2", 1, "events"), ("g", "2", 0, "events")],
        "source_file string, digest string, seq bigint, part string")
    ledger = spark.createDataFrame([("f", "2")], "source_file string, digest string")
    got = sorted((r.source_file, r.digest, r.part) for r in status.new_events(events, ledger, "seq").collect())
    assert got == [("f", "1", "events"), ("g", "2", "events")]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "chain string, id bigint")
    assert tuple(status.cardinality_check(df, "chains", ["chain"], 2).first()) == ("chains", 2, 2, True)
    assert {r.chain: r.passed for r in status.documents_per_group(df, ["chain"], 2).collect()} == {"a": True, "b": False}
    other = spark.createDataFrame([("b",), ("c",)], "chain string")
    assert {tuple(r) for r in status.set_diff(df.select("chain"), other).collect()} == {("a", "left"), ("c", "right")}


def test_freshness_is_strict(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", None)], "t string, at string").select(
        "t", F.to_timestamp_ntz("at").alias("ts"))
    as_of = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    assert {r.t: r.is_updated for r in access.freshness(df, ["t"], "ts", as_of, 3600).collect()} == {"a": False, "b": False}
    assert {r.t: r.is_updated for r in access.freshness(df, ["t"], "ts", as_of, 3601).collect()} == {"a": True, "b": False}


def test_topic_messages(spark, tmp_path):
    rows = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", 3)], "file_name string, n bigint")
    sent = topic_sink.messages(rows, "t").unionByName(topic_sink.flush_messages(rows, "t"))
    registry = spark.createDataFrame([("t",)], "table_name string")
    sent = sent.unionByName(topic_sink.warmup_messages(registry))
    more = spark.createDataFrame([("t", "f1", '{"n": 1, "file_name": "f1"}'), ("t", "f1", "junk"), ("t", "f1", "junk")],
                                 sent.schema)
    topic_sink.append(sent.unionByName(more), str(tmp_path / "topic"))
    got = topic.clean_topic(topic.read_messages(spark, str(tmp_path / "topic"))).collect()
    assert sorted(r.canonical or r.value for r in got) == [
        "junk", "junk", '{"file_name":"f1","n":1}', '{"file_name":"f1","n":2}', '{"file_name":"f2","n":3}']


def test_batches_replace_their_own_output(spark, tmp_path):
    root = str(tmp_path / "rows")
    schema = "file_type string, chain string, row_index bigint, batch_id bigint"
    store.write_rows(spark.createDataFrame([("P", "a", i, 0) for i in range(3)], schema), root, 0)
    store.write_rows(spark.createDataFrame([("P", "a", i, 1) for i in range(3, 9)], schema), root, 1)
    store.write_rows(spark.createDataFrame([("P", "a", i, 1) for i in range(3, 5)], schema), root, 1)
    assert sorted(r.row_index for r in tables.read_table(spark, root, schema).collect()) == [0, 1, 2, 3, 4]


def test_versions(spark):
    none = spark.createDataFrame([], "version bigint, created_at timestamp_ntz")
    first = versions.add_version(none, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    second = versions.add_version(first, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    assert versions.current_version(none).first().version == -1
    assert versions.current_version(second).first().version == 1
    asked = spark.createDataFrame([("2023-12-31",), ("2024-01-01",), ("2024-01-01 12:00:00",), ("2024-03-01",)], "d string")
    got = versions.version_at(second, asked.select(F.to_timestamp_ntz("d").alias("at"))).orderBy("at").collect()
    assert [r.version for r in got] == [None, 0, 0, 1]


def test_manifest_and_routes(spark):
    logs = spark.createDataFrame([("a.json", "Parser"), ("b.json", "Scraper"), ("c.txt", "Parser")], "file_name string, stage string")
    got = {r.path: r.description for r in versions.manifest(logs).collect()}
    assert set(got) == {"index.json", "parser-status.json", "a.json", "b.json"}
    assert got["b.json"] == "Scraper status file for 'b.json' execution."
    listing = spark.createDataFrame([("price_alpha.csv",), ("Alpha.json",), ("beta.csv",), ("parser-status.json",)], "file_name string")
    routed = {r.file_name: r.target for r in versions.route_files(listing, ["ALPHA"]).collect()}
    assert routed == {"price_alpha.csv": "data", "Alpha.json": "status", "parser-status.json": "data"}

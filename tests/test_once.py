"""What a load, a log and a topic compute once: their plans, and the canonical form against the fold over tokens."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from retail_lake.functions import values
from retail_lake.operators import status
from retail_lake.plans import lake_queries
from retail_lake.plans.lake import Lake
from retail_lake.sources import files, status_logs
from retail_lake.sources.topic import clean_topic


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_canonical_form_parses_a_document_once(spark):
    # The fold has a parser of its own for each token; the form by the variant parser has one.
    df = spark.createDataFrame([("{}",)], "v string")
    sorted_form = _optimized(df.select(values._sorted_document(F.col("v"))))
    assert sorted_form.count("parseJson") == 1


def test_topic_computes_the_canonical_form_once(spark):
    df = spark.createDataFrame([("t", '{"b":1,"a":2}')], "topic string, value string")
    once = _optimized(df.select(values.canonical_json("value"))).lower()
    cleaned = _optimized(clean_topic(df).where("canonical IS NOT NULL")).lower()
    assert 0 < cleaned.count("parse") <= once.count("parse")


def test_sorted_and_folded_forms_agree(spark):
    docs = ['{"b":1,"a":[1.0,-0,1e5,"x\\"y",null,true]}', '{"a":-1.50E+10,"n":"n1","s":"s"}', "1", '"a"', "[]", '["]"]', "null",
            '{"a":{"z":"$1 \\\\ $","y":{"q":[],"p":{}}}}', '{"\u05d0":12345678901234567890123456789012345678901234567890}', '""']
    no = ["", " ", "-", '"', "01", "-01", "1 2", "1,2", "[1],[2", '{"a":1', '{"a":1}}', '{"a":"1"2}', '{"a":NaN}', "5.", ".5", "+5", 'x"y']
    df = spark.createDataFrame([(d,) for d in docs + no], "v string")
    rows = df.select("v", values._sorted_document(F.col("v")).alias("a"), values._folded_document(F.col("v")).alias("b")).collect()
    assert all(r.a is not None and r.a == r.b for r in rows if r.v in docs)
    assert all(r.a is None for r in rows if r.v in no)


def test_plain_documents_are_sorted_without_a_parser(spark, monkeypatch):
    # Every text that the short way takes has the parser's form; the others go the long way.
    plain = ['{"b":1,"a":"x y","a_1":null,"A":[1.0,-0,1e5,"é",true]}', '{"r":{"z":[],"b":"}","a":-1.5E+10},"e":{},"c":""}', "{}",
             '{"n":12345678901234567890123456789012345678901234567890,"a":"n1,b:{["}', '{"k":"' + "x" * 60_000 + '","a":1}',
             "{" + ",".join(f'"k{i}":[{i}]' for i in range(5_000)) + "}"]
    other = ['{"a":1,"a":2}', '{"b":{"a":1,"a":2}}', '{"a": 1}', '{"a":"\\n"}', '{"a":"\t"}', '{"a b":1}', '{"a":[{"c":1,"b":2}]}', '{"a":{"b":{}}}', "[1]",
             '{"a":01}', '{"a":1.}', '{"a":1,}', '{"a":1}{}', '{"a":1', '{"a":1}\n', "1", ""]
    df = spark.createDataFrame([(d,) for d in plain + other], "v string")
    rows = df.select("v", values._plain_document(F.col("v")).alias("a"), values._sorted_document(F.col("v")).alias("b")).collect()
    assert all(r.a is not None and r.a == r.b for r in rows if r.v in plain)
    assert all(r.a is None for r in rows if r.v in other)
    monkeypatch.setattr(values, "_sorted_document", lambda text: F.raise_error(F.lit("parsed")).cast("string"))
    docs = df.where(F.col("v").isin(plain)).select(values.canonical_json("v").alias("c")).collect()
    assert sorted(r.c for r in docs) == sorted(r.b for r in rows if r.v in plain)


def test_what_stands_between_two_brackets_is_matched_once(spark):
    texts = ['{"a":1,"b":"}{","c":["x","y]"],"d":', 'in } side","e":"{"}]', "", '"', '""[', 'a"b{"c}"d"{', '"' + "{" * 50_000 + '"}']
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select("v", status_logs._brackets("v").alias("out"), status_logs._brackets("v", inside=True).alias("inner"),
                     F.regexp_count("v", F.lit(status_logs._NO_BRACKETS)).alias("n")).collect()

    def brackets(text, inside):
        return "".join(c for i, part in enumerate(text.split('"')) if (i % 2 == 1) == inside for c in part if c in "{}[]")

    for r in rows:
        assert (r.out, r.inner) == (brackets(r.v, False), brackets(r.v, True))
        assert r.n <= len(r.out) + 1


def test_a_log_is_cut_into_buckets_for_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(status_logs, "PIECE_BITS", (3, 2))
    (tmp_path / "in").mkdir()
    events = ",".join(f'{{"n":{i},"r":{{"f":["}}{i}"]}}}}' for i in range(200))
    (tmp_path / "in" / "a.json").write_text(f'{{"events":[{events}],"global_status":[{{"n":"g"}}]}}')
    rows, broken = status_logs.read_logs(spark, str(tmp_path / "in"), str(tmp_path / "scratch"))
    got = [(r.part, r.payload) for r in rows.orderBy("seq").collect()]
    assert got == [("events", f'{{"n":{i},"r":{{"f":["}}{i}"]}}}}') for i in range(200)] + [("global_status", '{"n":"g"}')]
    assert broken.count() == 0


def test_records_with_line_breaks_are_cut_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "price_file_alpha.csv"
    path.write_text('a,b\n1,"x\ny"\n2,z\n')
    rows = files.read_csv_rows(spark, [str(path)], ["a", "b"], folder=str(tmp_path / "scratch"))
    assert "lines" not in "".join(rows.inputFiles())
    assert sorted((r.row_index, r.a, r.b) for r in rows.collect()) == [(0, "1", "x\ny"), (1, "2", "z")]


def test_events_of_a_load_are_parsed_once_for_both_tables(spark, tmp_path, monkeypatch):
    for name in ("out", "logs"):
        (tmp_path / name).mkdir()
    (tmp_path / "logs" / "a.json").write_text('{"events":[{"task_id":"1"},{"task_id":"1"}],"global_status":[{"task_id":"2"}]}')
    plans = []
    monkeypatch.setattr("retail_lake.sinks.store.write_batch", lambda df, path, *args: plans.append((path, _optimized(df))) or _written(df, path, *args))
    lake = Lake(spark, str(tmp_path / "lake"), {"alpha": "alpha"})
    lake.upload(str(tmp_path / "out"), str(tmp_path / "logs"), str(tmp_path / "logs"), as_of="2024-01-01 00:00:00")
    told = [plan for path, plan in plans if "status/" in path and "Relation" in plan]
    assert told and not any("sha2" in plan for plan in told)
    assert [lake.status(t).count() for t in ("ParserStatus", "GlobalParserStatus")] == [1, 1]


def _written(df, path, batch_id, partitions=()):
    writer = df.drop("batch_id").write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{path}/batch_id={batch_id}")


def _logs(folder, **logs):
    folder.mkdir(parents=True, exist_ok=True)
    for name, events in logs.items():
        (folder / f"{name}.json").write_text(json.dumps({"events": events, "global_status": []}))
    return str(folder)


def test_logs_of_both_kinds_are_read_in_one_pass(spark, tmp_path, monkeypatch):
    # Logs of one name in two folders are two logs, and one that both kinds list counts for both.
    (tmp_path / "out").mkdir()
    scraped, parsed = _logs(tmp_path / "s", a=[{"task_id": "1"}]), _logs(tmp_path / "p", a=[{"task_id": "1"}, {"task_id": "2"}], b=[])
    (tmp_path / "p" / "bad.json").write_text("[1]")
    calls, read = [], status_logs.read_logs
    monkeypatch.setattr(status_logs, "read_logs", lambda s, found, *a, **k: calls.append(len(found)) or read(s, found, *a, **k))
    lake = Lake(spark, str(tmp_path / "lake"), {"alpha": "alpha"})

    def stored():
        return {kind: sorted(r.task_id for r in lake.status(f"{kind}Status").collect()) for kind in ("Scraper", "Parser")}

    lake.upload(str(tmp_path / "out"), scraped, parsed, as_of="2024-01-01 00:00:00")
    assert calls == [4] and stored() == {"Scraper": ["1"], "Parser": ["1", "2"]}
    assert [(r.source_file, r.kind) for r in lake.broken_logs().collect()] == [("bad.json", "parser")]
    assert (lake.ledger("scraper").count(), lake.ledger("parser").count()) == (1, 2)
    lake.upload(str(tmp_path / "out"), parsed, parsed, as_of="2024-01-02 00:00:00")
    assert calls == [4, 3] and stored() == {"Scraper": ["1", "2"], "Parser": ["1", "2"]}


def test_pieces_of_a_log_are_sorted_twice_at_most(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(status_logs, "PIECE_BITS", (1, 1))
    items = {"x": [{"q": "}]{"}, "}"], "events": [{"n": i, "r": [{"f": "\\\"]}"}]} for i in range(9)], "y": {"events": [{}, {}]},
             "global_status": [1, "t", {"n": "g"}, []]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(items))
    (tmp_path / "in" / "b.json").write_text('{"events":[' + ",".join(f'{{"n":{i}}}' for i in range(9)) + '],"global_status":[{"n":"g"}]} {}')
    tables, kept = [], status_logs._kept
    monkeypatch.setattr(status_logs, "_kept", lambda df, path: tables.append(path.rsplit("/", 1)[1]) or kept(df, path))
    rows, broken = status_logs.read_logs(spark, str(tmp_path / "in"), str(tmp_path / "scratch"))
    got = [(r.source_file, r.part, json.loads(r.payload) if r.payload != "t" else "t") for r in rows.orderBy("source_file", "seq").collect()]
    assert got == [("a.json", part, e) for part in ("events", "global_status") for e in items[part]]
    assert [r.source_file for r in broken.collect()] == ["b.json"]
    # ``marked`` and ``leveled`` alone have a row per piece; those between have one per bucket.
    assert tables == ["marked", "turns", "begun", "leveled", "cuts", "cut", "segments", "parsed", "totals", "opened", "checked"]


def test_rows_and_logs_are_loaded_at_once(spark, tmp_path, monkeypatch):
    # Each step waits until the other has begun; one that fails leaves the load uncommitted.
    for name in ("out", "logs"):
        (tmp_path / name).mkdir()
    both = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(Lake, "_load_rows", lambda self, *a: both.wait())
    monkeypatch.setattr(Lake, "_load_status", lambda self, *a: both.wait())
    lake = Lake(spark, str(tmp_path / "lake"), {"alpha": "alpha"})
    assert lake.upload(str(tmp_path / "out"), str(tmp_path / "logs"), str(tmp_path / "logs"), as_of="2024-01-01 00:00:00") == 0

    def fails(self, *a):
        raise RuntimeError("rows")

    monkeypatch.setattr(Lake, "_load_rows", fails)
    monkeypatch.setattr(Lake, "_load_status", lambda self, *a: None)
    with pytest.raises(RuntimeError, match="rows"):
        lake.upload(str(tmp_path / "out"), str(tmp_path / "logs"), str(tmp_path / "logs"), as_of="2024-01-02 00:00:00")
    assert lake.last_batch() == 0


def test_documents_are_looked_up_in_the_ledger_without_a_join(spark):
    # Of copies the lowest number is kept, one without a number last; a missing file or digest is a value of its own.
    events = spark.createDataFrame(
        [("k", "a", "1", 5, "late"), ("k", "a", "1", 2, "early"), ("k", "a", "1", None, "none"), ("k", "a", "2", 1, "held"),
         ("m", "a", "2", 1, "other kind"), ("k", None, "2", 1, "no file"), ("k", None, None, 1, "held too"), ("k", "a", "3", None, "alone")],
        "kind string, source_file string, digest string, seq bigint, payload string")
    ledger = spark.createDataFrame([("k", "a", "2"), ("k", "a", "2"), ("k", None, None), ("m", "b", "1")],
                                   "kind string, source_file string, digest string")
    found = status.new_events(events, ledger, "seq", ["kind"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.payload for r in found.collect()) == ["alone", "early", "no file", "other kind"]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    # Rows that are not the first of their key stay where they are.
    assert "WindowGroupLimit" in plan
    assert sorted(r.digest for r in status.new_events(events, ledger.drop("kind")).select("digest").collect()) == ["1", "2", "3"]


def test_rows_of_a_load_are_cut_into_runs_once(spark, tmp_path, monkeypatch):
    (tmp_path / "out").mkdir()
    (tmp_path / "logs").mkdir()
    (tmp_path / "out" / "price_full_file_alpha.csv").write_text("found_folder,file_name,a\nd,f,1\n,,2\nd,g,3\n")
    plans = {}
    monkeypatch.setattr("retail_lake.sinks.store.write_batch", lambda df, path, *args: plans.update(
        {path.rsplit("/", 1)[1]: _optimized(df)}) or _written(df, path, *args))
    lake = Lake(spark, str(tmp_path / "lake"), {"alpha": "alpha"})
    lake.upload(str(tmp_path / "out"), str(tmp_path / "logs"), str(tmp_path / "logs"), as_of="2024-01-01 00:00:00")
    assert "Window" not in plans["markers"] and "Window" not in plans["progress"]
    assert sorted((r.file_name, r.total_expected_records, r.first_row) for r in lake.markers().collect()) == [("f", 2, 0), ("g", 1, 2)]
    state = lake.progress().first()
    assert (state.last_row, state.file_name, state.first_row, state.n_rows, state.content) == (2, "g", 2, 1, {"a": "3"})


def test_queries_with_a_lake_of_their_own_do_not_wait_for_the_other(spark, tmp_path, monkeypatch):
    # Each lake waits until the other has begun.
    for query in (lake_queries.lake_reload, lake_queries.lake_restore):
        both = threading.Barrier(2, timeout=60)
        uploads = []
        monkeypatch.setattr(lake_queries, "landed_of", lambda *a: [("out", "logs")], raising=False)
        monkeypatch.setattr(lake_queries, "lake_of", lambda *a: both.wait())
        monkeypatch.setattr(Lake, "upload", lambda self, *a, **k: uploads.append(a) or (len(uploads) == 1 and both.wait()))
        for step in ("publish", "clear_ledger", "load_version"):
            monkeypatch.setattr(Lake, step, lambda self, *a: None)
        query(spark, str(tmp_path))
        assert len(uploads) == (1 if query is lake_queries.lake_reload else 3)

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from retail_lake.operators import catalog, quality
from retail_lake.plans.audit import audit
from retail_lake.schemas import PARSER_STATUS, SCRAPER_STATUS

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def greedy(left, right):
    """Each left stamp in order takes the nearest unused right stamp at or after it."""
    used, pairs = set(), []
    for stamp in sorted(set(left)):
        free = [r for r in set(right) - used if r >= stamp]
        pairs.append((stamp, min(free) if free else None))
        used |= {min(free)} if free else set()
    return pairs


@pytest.mark.parametrize("bits", [(22, 3), (24,), (26, 16)])
def test_asof_greedy_matches_brute_force(spark, bits):
    rnd = random.Random(5)
    left, right, want = [], [], []
    for chain in ("hot", "a", "b", "none"):
        size = 120 if chain == "hot" else 15
        ls = [at(rnd.randrange(size * 2)) for _ in range(size)]
        rs = [] if chain == "none" else [at(rnd.randrange(size * 2)) for _ in range(size)]
        left += [(chain, t) for t in ls]
        right += [(chain, t) for t in rs]
        want += [(chain, *pair) for pair in greedy(ls, rs)]
    got = quality.asof_greedy(
        spark.createDataFrame(left, "chain string, scraped timestamp_ntz"),
        spark.createDataFrame(right, "chain string, parsed timestamp_ntz"),
        ["chain"], "scraped", "parsed", bits)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])


def test_pair_status_needs_both_and_takes_the_first(spark):
    schema = "chain string, run bigint, seq bigint, v string"
    c = spark.createDataFrame([("a", 1, 2, "late"), ("a", 1, 1, "c1"), ("a", 2, 1, "c2")], schema)
    d = spark.createDataFrame([("a", 1, 1, "d1"), ("a", 3, 1, "d3")], schema)
    got = quality.pair_status(c, d, ["chain", "run"], "seq").collect()
    assert [(r.run, r.collected_v, r.downloaded_v) for r in got] == [(1, "c1", "d1")]


def fates(spark):
    seen = [("a", 1, f) for f in ("ok.xml.gz", "bad.gz", "left.xml", "fail.gz", "odd.gz", "odd.gz", "none.gz")]
    down = [("a", 1, "ok.gz", True, True, None), ("a", 1, "bad.gz", True, False, "zip"),
            ("a", 1, "left", True, True, None), ("a", 1, "fail.gz", True, True, None),
            ("a", 1, "odd.gz", True, True, None)]
    to_parse = [("a", 1, f) for f in ("ok.xml", "fail.xml", "odd.aspx")]
    parses = [("a", 1, "ok", True, True, None), ("a", 1, "fail", None, None, None)]
    key = "chain string, run bigint, file_name string"
    return quality.file_fates(
        spark.createDataFrame(seen, key),
        spark.createDataFrame(down, key + ", downloaded boolean, extracted boolean, error string"),
        spark.createDataFrame(to_parse, key),
        spark.createDataFrame(parses, key + ", succeeded boolean, loaded boolean, error string"))


def test_file_fates_and_funnel(spark):
    got = {r.file_name: (r.stage, r.n_seen, r.error) for r in fates(spark).collect()}
    assert got == {
        "ok": ("succesful_processed", 1, None), "bad": ("fail_downloaded", 1, "zip"),
        "left": ("not_collected_by_parser", 1, None), "fail": ("fail_parsed", 1, "empty file"),
        "odd": ("unclassified", 2, None), "none": ("unclassified", 1, None)}
    row = quality.funnel(fates(spark)).first()
    assert (row.saw, row.fail_downloaded, row.not_collected_by_parser, row.fail_parsed, row.succesful_processed,
            row.unclassified) == (7, 1, 1, 1, 1, 3)
    loss = quality.loss_rate(fates(spark)).first()
    assert (loss.n_lost, loss.n_seen, loss.within_limit) == (2, 6, False)


def test_the_funnel_needs_no_sort(spark):
    plan = quality.loss_rate(fates(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Join" not in plan and "HashAggregate" in plan


def test_reconcile_reports_both_sides(spark):
    source = spark.createDataFrame([("t", 0), ("t", 1), ("only", 0)], "table_name string, row_index bigint")
    stored = spark.createDataFrame([("t", 0), ("t", 1), ("extra", 5)], "table_name string, row_index bigint")
    got = {r.table_name: (r.source_rows, r.stored_rows, r.matches)
           for r in quality.reconcile(source, stored).collect()}
    assert got == {"t": (2, 2, True), "only": (1, 0, False), "extra": (0, 1, False)}


def scrape(chain, when, status, **data):
    return {"index": f"{chain}@{status}@{when}", "file_name": chain, "timestamp": when, "status": status,
            "status_data": data}


def parse(chain, when, kind, files, logs):
    return {"requested_store_enum": chain, "when_date": when, "requested_file_type": kind,
            "response": {"files_to_process": files, "execution_log": logs}}


def test_audit_of_two_runs(spark):
    def result(name, ok=True, error=None):
        return {"file_name": name, "downloaded": ok, "extract_succefully": ok, "error": error}

    one, two, three = "2024-01-01 10:00:00", "2024-01-01 12:00:00", "2024-01-01 14:00:00"
    scraper = [
        scrape("alpha", one, "collected", file_name_collected_from_site=["f1.xml.gz", "f2.gz"]),
        scrape("alpha", one, "downloaded", results=[result("f1.gz"), result("f2.gz", False, "timeout")]),
        scrape("alpha", two, "collected", file_name_collected_from_site=["f2.gz", "f3.gz"]),
        scrape("alpha", two, "downloaded", results=[result("f2"), result("f3")]),
        scrape("alpha", three, "collected", file_name_collected_from_site=["f4.gz"]),
    ]
    parser = [
        parse("ALPHA", " 2024-01-01 10:30:00", "PRICE_FILE", ["f1.xml"],
              [{"file_name": "f1", "succusfull": True, "loaded": True}]),
        parse("ALPHA", "2024-01-01 13:00:00", "PRICE_FILE", ["f2.xml"],
              [{"file_name": "f2", "succusfull": True, "loaded": True}]),
        parse("ALPHA", "2024-01-01 13:00:00", "PROMO_FILE", ["f3.xml"],
              [{"file_name": "f3", "succusfull": False, "loaded": True}]),
    ]
    chains = catalog.chain_dim(spark, {"ALPHA": "Alpha", "BETA": "Beta"})
    found = audit(spark.createDataFrame(scraper, SCRAPER_STATUS), spark.createDataFrame(parser, PARSER_STATUS), chains)
    rows = {(r.chain, str(r.run)): r for r in found.funnel.collect()}
    assert set(rows) == {("ALPHA", one), ("ALPHA", two), ("ALPHA", three), ("BETA", "None")}
    first, second = rows["ALPHA", one], rows["ALPHA", two]
    assert (first.saw, first.fail_downloaded, first.succesful_processed, first.new_files) == (2, 1, 1, 2)
    assert (second.saw, second.fail_parsed, second.succesful_processed, second.new_files) == (2, 1, 1, 1)
    assert rows["ALPHA", three].saw is None and rows["BETA", "None"].saw is None
    assert {(r.stage, r.error, r.n_files) for r in found.errors.collect()} == {
        ("fail_downloaded", "timeout", 1), ("fail_parsed", "unknown", 1)}
    loss = found.loss.first()
    # f2 was lost in the first run and processed in the second.
    assert (loss.chain, loss.n_lost, loss.n_seen) == ("ALPHA", 1, 3)


def test_registry_and_expected_files(spark):
    chains = catalog.chain_dim(spark, {"A": "a", "B": "b"})
    registry = catalog.table_registry(chains, ["PRICE_FILE", "STORE_FILE"])
    assert sorted(r.table_name for r in registry.collect()) == [
        "price_file_a", "price_file_b", "store_file_a", "store_file_b"]
    names = {r.file_name for r in catalog.expected_files(registry).collect()}
    assert names == {"index.json", "a.json", "b.json", *(f"{t}_file_{c}.csv" for t in ("price", "store") for c in "ab"),
                     *(f"{c}_{t}_file.json" for t in ("price", "store") for c in "ab")}
    assert "CartesianProduct" not in registry._jdf.queryExecution().executedPlan().toString()


def test_run_timestamps_are_numbered(spark):
    rows = spark.createDataFrame([("a", at(5)), ("a", at(1)), ("a", at(5)), ("b", None)], "c string, ts timestamp_ntz")
    got = quality.run_timestamps(rows, ["c"], "ts").orderBy("run_no").collect()
    assert [(r.c, r.ts, r.run_no) for r in got] == [("a", at(1), 1), ("a", at(5), 2)]


def test_loss_is_empty_without_files(spark):
    empty = fates(spark).where(F.lit(False))
    assert quality.loss_rate(empty).count() == 0

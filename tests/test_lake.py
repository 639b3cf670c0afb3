import json
import os

import pytest
from pyspark.sql import functions as F

from retail_lake.plans.lake import Lake
from retail_lake.sources import files, status_logs

CHAINS = {"AlphaMart": "Alpha", "Beta": "Beta"}
F1, F2, F3 = (f"PriceFull7290000000001-00{i}-202401010000.xml" for i in (1, 2, 3))


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def csv(path, rows, header="found_folder,file_name,code,price"):
    write(path, "\n".join([header, *rows]) + "\n")


def log(path, events, global_status=()):
    write(path, json.dumps({"events": list(events), "global_status": list(global_status)}))


def parser_event(task, status, **more):
    return {"task_id": task, "status": status, "timestamp": "2024-01-01T01:00:00", **more}


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    return {n: str(base / n) for n in ("outputs", "scraping", "converting")}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory, folders):
    """Two loads: the second one finds one file longer, one table new and one event repeated."""
    out, scraping, converting = folders["outputs"], folders["scraping"], folders["converting"]
    csv(f"{out}/price_full_file_alphamart.csv",
        [f"d,{F1},c0,1.0", ",,c1,", ",,,3.0", f"d,{F2},c3,", ",,c4,5.0"])
    csv(f"{out}/store_file_beta.csv", [",,x0,1", f"d,{F3},x1,2"])
    csv(f"{out}/unknown_table.csv", ["d,f,x,1"])
    write(f"{out}/notes.txt", "skip me")
    log(f"{scraping}/alpha.json", [parser_event("s1", "started"), parser_event("s1", "completed")],
        [parser_event("s1", "started")])
    log(f"{converting}/alphamart_price_full_file.json",
        [parser_event("p1", "started", chain="AlphaMart", file_type="PRICE_FULL_FILE",
                      response={"files_to_process": [F1, F2]}),
         parser_event("p1", "started", chain="AlphaMart", file_type="PRICE_FULL_FILE",
                      response={"files_to_process": [F1, F2]})])
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")), CHAINS)
    lake.first = lake.upload(out, scraping, converting, "2024-01-01 02:00:00")
    lake.first_marks = {(r.file_name, r.first_row): r.total_expected_records for r in lake.markers().collect()}

    csv(f"{out}/price_full_file_alphamart.csv",
        [f"d,{F1},c0,1.0", ",,c1,", ",,,3.0", f"d,{F2},c3,", ",,c4,5.0", ",,,6.0", f"d,{F3},c6,", ",,,"])
    csv(f"{out}/promo_file_beta.csv", [f"e,{F3},1,2", ",,,,"], "found_folder,file_name,promo,gift")
    log(f"{converting}/alphamart_price_full_file.json",
        [parser_event("p1", "started", chain="AlphaMart", file_type="PRICE_FULL_FILE",
                      response={"files_to_process": [F1, F2]}),
         parser_event("p1", "completed", chain="AlphaMart", file_type="PRICE_FULL_FILE",
                      response={"files_to_process": [F3]}),
         {"task_id": "v1", "status": "started", "index": "STORE_FILE@Beta@2024-01-01 00:00:00",
          "response": {"files_to_process": ["Stores1.xml"]}}])
    lake.second = lake.upload(out, scraping, converting, "2024-01-01 03:00:00")
    return lake


def stored(lake, chain="AlphaMart"):
    rows = lake.rows({"chain": chain}).orderBy("file_type", "row_index").collect()
    return [(r.row_index, r.file_name, r.content) for r in rows]


def test_rows_are_filled_across_loads(lake):
    assert (lake.first, lake.second) == (0, 1)
    assert stored(lake) == [
        (0, F1, {"code": "c0", "price": "1.0"}), (1, F1, {"code": "c1", "price": "1.0"}),
        (2, F1, {"code": "c1", "price": "3.0"}), (3, F2, {"code": "c3", "price": "3.0"}),
        (4, F2, {"code": "c4", "price": "5.0"}), (5, F2, {"code": "c4", "price": "6.0"}),
        (6, F3, {"code": "c6", "price": "6.0"}), (7, F3, {"code": "c6", "price": "6.0"})]


def test_markers_count_whole_files(lake):
    assert lake.first_marks == {(F1, 0): 3, (F2, 3): 2}
    marks = {(r.chain, r.file_name, r.first_row): r.total_expected_records for r in lake.markers().collect()}
    assert marks == {("AlphaMart", F1, 0): 3, ("AlphaMart", F2, 3): 3, ("AlphaMart", F3, 6): 2,
                     ("Beta", F3, 0): 2}


def test_table_without_keys_is_set_aside(lake):
    assert {(r.table_name, r.row_index) for r in lake.quarantined().collect()} == {
        ("store_file_beta", 0), ("store_file_beta", 1)}
    assert lake.rows({"file_type": "STORE_FILE"}).count() == 0


def test_progress_has_one_row_per_table(lake):
    got = {r.table_name: (r.last_row, r.file_name, r.first_row, r.n_rows) for r in lake.progress().collect()}
    assert got == {"price_full_file_alphamart": (7, F3, 6, 2), "promo_file_beta": (1, F3, 0, 2)}


def test_status_events_are_pushed_once(lake):
    assert lake.status("ScraperStatus").count() == 2
    # The global row equals an event of its file, whose id is in the ledger.
    assert lake.status("GlobalScraperStatus").count() == 0
    assert sorted(r.status for r in lake.status("ParserStatus").collect()) == ["completed", "started", "started"]
    assert lake.ledger("parser").count() == 3 and lake.ledger("scraper").count() == 2


def test_loading_again_adds_nothing(spark, lake, folders):
    before = (lake.rows().count(), lake.status("ParserStatus").count(), lake.markers().count())
    lake.upload(folders["outputs"], folders["scraping"], folders["converting"], "2024-01-01 03:30:00")
    assert (lake.rows().count(), lake.status("ParserStatus").count(), lake.markers().count()) == before


def test_unchanged_files_are_not_opened(spark, lake, folders, monkeypatch):
    """A load with nothing new surveys, parses and stores no row, and quarantine and marks stay."""
    before = (lake.rows().count(), lake.quarantined().count(), sorted(map(str, lake.progress().drop("content").collect())))
    opened = []
    for module, name in ((files, "_survey"), (files, "read_csv_rows"), (status_logs, "read_logs")):
        whole = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _w=whole, **k: opened.append(a[1]) or _w(*a, **k))
    batch = lake.upload(folders["outputs"], folders["scraping"], folders["converting"], "2024-01-01 03:40:00")
    assert not opened
    assert lake.rows({"batch_id": batch}).count() == 0
    assert (lake.rows().count(), lake.quarantined().count(), sorted(map(str, lake.progress().drop("content").collect()))) == before


def test_only_changed_files_are_opened(spark, tmp_path, monkeypatch):
    out, logs = str(tmp_path / "out"), str(tmp_path / "logs")
    csv(f"{out}/price_file_alphamart.csv", [f"d,{F1},a,1"])
    csv(f"{out}/price_file_beta.csv", [f"d,{F2},b,1"])
    log(f"{logs}/a b+c%20.json", [{"task_id": "1", "status": "s"}])
    write(f"{logs}/x y.json", "[1,2]")
    lake = Lake(spark, str(tmp_path / "lake"), {"AlphaMart": "A"})
    lake.upload(out, logs, logs, "2024-01-01 01:00:00")
    assert [(r.source_file, r.kind) for r in lake.broken_logs().orderBy("kind").collect()] == [
        ("x y.json", "parser"), ("x y.json", "scraper")]
    csv(f"{out}/price_file_alphamart.csv", [f"d,{F1},a,1", ",,c,"])
    opened = []
    read = files.read_csv_rows
    monkeypatch.setattr(files, "read_csv_rows", lambda s, paths, *a, **k: opened.extend(paths) or read(s, paths, *a, **k))
    # A chain enabled later gets all rows of its file, although the file is as it was.
    both = Lake(spark, lake.root, CHAINS)
    both.upload(out, logs, logs, "2024-01-01 02:00:00")
    assert sorted(p.rsplit("/", 1)[1] for p in opened) == ["price_file_alphamart.csv", "price_file_beta.csv"]
    assert {(r.chain, r.row_index, r.content["code"]) for r in both.rows().collect()} == {
        ("AlphaMart", 0, "a"), ("AlphaMart", 1, "c"), ("Beta", 0, "b")}
    # A broken log is told again by every load, until it can be read.
    assert both.broken_logs().count() == 2 and both.status("ParserStatus").count() == 1
    log(f"{logs}/x y.json", [{"task_id": "2", "status": "s"}])
    opened.clear()
    both.upload(out, logs, logs, "2024-01-01 03:00:00")
    assert not opened and both.broken_logs().count() == 0 and both.status("ParserStatus").count() == 2


def test_a_version_is_loaded_into_the_store(spark, tmp_path):
    """After publish, reset and restore the same landing holds nothing new, and longer files go on."""
    out, logs = str(tmp_path / "out"), str(tmp_path / "logs")
    csv(f"{out}/price_file_alphamart.csv", [f"d,{F1},a,1", ",,b,", f"d,{F2},,3"])
    csv(f"{out}/price_file_beta.csv", [",,q,1"])
    log(f"{logs}/a.json", [{"task_id": "1", "status": "s"}, {"task_id": "1", "status": "t"}], [{"task_id": "1", "status": "u"}])
    lake = Lake(spark, str(tmp_path / "lake"), CHAINS)

    def state():
        return {name: sorted(map(str, df.drop("batch_id").collect())) for name, df in (
            ("rows", lake.rows()), ("markers", lake.markers()), ("progress", lake.progress()),
            ("scraper", lake.ledger("scraper")), ("parser", lake.ledger("parser")),
            *((t, lake.status(t)) for t in ("ParserStatus", "GlobalParserStatus", "ScraperStatus", "GlobalScraperStatus")))}

    lake.upload(out, logs, logs, "2024-01-01 01:00:00")
    before = state()
    lake.publish("2024-01-01 02:00:00")
    lake.clear_ledger()
    assert lake.rows().count() == 0
    assert lake.load_version("2024-01-02 00:00:00") == 0
    assert state() == before
    again = lake.upload(out, logs, logs, "2024-01-02 01:00:00")
    assert again == 1 and state() == before and lake.rows({"batch_id": 1}).count() == 0
    assert lake.quarantined().count() == 1
    csv(f"{out}/price_file_alphamart.csv", [f"d,{F1},a,1", ",,b,", f"d,{F2},,3", ",,c,"])
    lake.upload(out, logs, logs, "2024-01-02 02:00:00")
    last = lake.rows().where("row_index = 3").first()
    assert (last.file_name, last.content, last.batch_id) == (F2, {"code": "c", "price": "3"}, 2)
    assert {(r.file_name, r.total_expected_records) for r in lake.markers().collect()} == {(F1, 2), (F2, 2)}


def test_a_load_without_commit_is_not_seen(spark, lake):
    ghost = lake.rows().limit(1).withColumn("row_index", F.lit(99).cast("bigint"))
    before = lake.rows().count()
    path = f"{lake.root}/rows/batch_id={lake.last_batch() + 1}"
    ghost.drop("batch_id").write.partitionBy("file_type", "chain").parquet(path)
    assert lake.rows().count() == before


def test_listing(lake):
    def found(**kw):
        return sorted(r.file_name for r in lake.list_files_with_filters("AlphaMart", **kw).collect())

    assert sorted(r.file_name for r in lake.list_files("AlphaMart").collect()) == [F1, F2, F3]
    assert found(file_type="PRICE_FULL_FILE", store_number="002") == [F2]
    assert found(file_type="PROMO_FILE") == []
    assert found(after_extracted_date="2024-01-01T01:00:00Z") == [F1, F2, F3]
    assert found(after_extracted_date="2024-01-01T01:00:01Z") == []
    assert found(only_latest=True) == [F3]
    # A document without a time passes every date.
    old = lake.list_files_with_filters("Beta", after_extracted_date="2030-01-01")
    assert [r.file_name for r in old.collect()] == ["Stores1.xml"]
    with pytest.raises(ValueError, match="no chain"):
        lake.list_files("Gamma")
    with pytest.raises(ValueError, match="no file type"):
        lake.list_files("Beta", "JUNK")
    with pytest.raises(ValueError, match="name a chain"):
        lake.list_files("")


def test_listing_pushes_chain_and_type(lake):
    plan = lake.list_files("AlphaMart", "PRICE_FULL_FILE")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(chain,AlphaMart)" in plan and "EqualTo(file_type,PRICE_FULL" in plan


def test_paging(lake):
    rows, meta = lake.file_content_with_cursor("AlphaMart", F1, 2)
    assert [r.row_index for r in rows.collect()] == [0, 1]
    assert rows.columns == ["row_index", "found_folder", "file_name", "row_content"]
    assert tuple(meta.first()) == (3, True, 0, 2, "2", None)
    rows, meta = lake.file_content_with_cursor("AlphaMart", F1, 2, "2")
    assert [r.row_index for r in rows.collect()] == [2]
    assert tuple(meta.first()) == (3, False, 2, 2, None, "0")
    assert [r.row_index for r in lake.file_content_after("AlphaMart", F1, 0).collect()] == [1, 2]
    assert [r.row_index for r in lake.file_content("AlphaMart", F2).collect()] == [3, 4, 5]
    for cursor in ("x", "-1"):
        with pytest.raises(ValueError, match="cursor"):
            lake.file_content_with_cursor("AlphaMart", F1, 2, cursor)
    with pytest.raises(ValueError, match="no file type"):
        lake.file_content("AlphaMart", "notes.txt")


def test_file_read_prunes_partitions_and_pushes_the_name(lake):
    plan = lake.file_content("AlphaMart", F1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and f"EqualTo(file_name,{F1})" in plan
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "chain" in filters and "file_type" in filters


def test_health(lake):
    assert tuple(lake.short_term_health("2024-01-01 03:59:59").first()) == (True, "2024-01-01 03:00:00")
    assert tuple(lake.short_term_health("2024-01-01 04:00:00").first()) == (False, "2024-01-01 03:00:00")


def test_destinations_and_content(lake):
    names = {r.table_name for r in lake.list_destinations().collect()}
    assert len(names) == 2 * 5 + 4 and "price_full_file_alphamart" in names
    assert lake.content("price_full_file_alphamart", {"file_name": F1}).count() == 3
    assert lake.content("ParserStatus", {"status": "completed"}).count() == 1
    assert lake.content("no_such_table").count() == 0
    assert lake.list_available_chains().count() == 2 and lake.list_available_file_types().count() == 5


def test_reconcile(lake, folders):
    got = {r.table_name: r.matches for r in lake.reconcile(folders["outputs"]).collect()}
    assert got == {"price_full_file_alphamart": True, "promo_file_beta": True, "store_file_beta": False,
                   "unknown_table": False}


def test_task_checks(lake):
    checks = {r.task_id: (r.n_events, r.is_valid) for r in lake.task_checks("ParserStatus").collect()}
    assert checks == {"p1": (2, True), "v1": (1, False)}


def test_publish_and_restore(spark, lake):
    assert tuple(lake.long_term_health("2024-01-02 00:00:00").first()) == (False, None)
    assert lake.current_version() == -1
    version = lake.publish("2024-01-01 23:59:00")
    assert version == 0 and lake.current_version() == 0
    assert lake.versions().first().message.startswith("Update-Time: 2024-01-01 23:59:00, Scrapers:AlphaMart,Beta")
    assert lake.restore().count() == lake.rows().count()
    only = Lake(spark, lake.root, {"beta": "Beta"})
    assert {r.chain for r in only.restore(0).collect()} == {"Beta"}
    names = {r.file_name for r in lake.snapshot_files().collect()}
    assert names == {"index.json", "price_full_file_alphamart.csv", "promo_file_beta.csv", "alpha.json",
                     "alphamart_price_full_file.json"}
    assert [r.file_name for r in lake.list_snapshot_files("Beta", "csv").collect()] == ["promo_file_beta.csv"]
    assert lake.manifest().count() == 4
    missing = {r.file_name for r in lake.missing_files().collect()}
    assert "store_file_beta.csv" in missing and "index.json" not in missing
    assert lake.publish("2024-01-02 23:59:00") == 1
    assert tuple(lake.long_term_health("2024-01-03 23:58:59").first()) == (True, "2024-01-02 23:59:00")


def test_full_refresh_starts_over(lake, folders):
    batch = lake.upload(folders["outputs"], folders["scraping"], folders["converting"],
                        "2024-01-03 00:00:00", full_refresh=True)
    assert batch == 0
    assert [r[0] for r in stored(lake)] == list(range(8))
    assert lake.status("ParserStatus").count() == 3

"""What a load keeps on disk while it runs, and how it stores it."""

import os

from pyspark.sql import functions as F

from retail_lake.plans.lake import Lake
from retail_lake.sources import files, status_logs


def test_the_text_of_logs_is_kept_in_one_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"events":[' + ",".join(f'{{"n":{i}}}' for i in range(9)) + '],"global_status":[{"n":"g"}]}')
    events, broken = status_logs.read_logs(spark, str(tmp_path / "in"), str(tmp_path / "scratch"))
    assert {"pieces", "marked", "leveled", "segments", "parsed"} & set(os.listdir(tmp_path / "scratch")) == {"parsed"}
    assert [r.payload for r in events.orderBy("seq").collect()] == [f'{{"n":{i}}}' for i in range(9)] + ['{"n":"g"}']
    assert not broken.collect()


def test_lines_of_broken_files_go_once_they_are_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n3,4\n')
    rows = files.read_csv_rows(spark, [str(tmp_path / "a.csv")], ["x", "y"], folder=str(tmp_path / "scratch"))
    assert os.listdir(tmp_path / "scratch" / "broken") == ["records"]
    assert sorted((r.x, r.y) for r in rows.collect()) == [("1", "two\nlines"), ("3", "4")]


def test_stored_digests_take_half(spark, tmp_path):
    for name in ("out", "logs"):
        (tmp_path / name).mkdir()
    (tmp_path / "logs" / "a.json").write_text('{"events":[' + ",".join(f'{{"n":{i}}}' for i in range(2000)) + "]}")
    lake = Lake(spark, str(tmp_path / "lake"), {"alpha": "alpha"})
    lake.upload(str(tmp_path / "out"), str(tmp_path / "logs"), str(tmp_path / "logs"), as_of="2024-01-01 00:00:00")
    lake.publish("2024-01-01 23:59:00")
    assert lake.ledger("parser").agg(F.count_distinct("digest")).first()[0] == 2000
    for folder in ("ledger", "status", "snapshots"):
        held = [os.path.join(d, n) for d, _, names in os.walk(tmp_path / "lake" / folder) for n in names if n.endswith(".parquet")]
        assert held and sum(map(os.path.getsize, held)) < 2 * 2000 * 64 * (1.5 if folder == "snapshots" else 1)
    assert not os.path.exists(tmp_path / "lake" / "_scratch")

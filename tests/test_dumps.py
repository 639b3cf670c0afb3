"""XML dumps into the lake (SRC5)."""

import os

import pytest

from retail_lake.plans.lake import Lake
from retail_lake.sources import xml_dumps

CHAINS = {"AlphaMart": "Alpha", "Beta": "BetaDumps"}
LAYOUT = {"PRICE_FULL_FILE": ("Item", ["_kind", "code", "price"])}
NAME = "PriceFull7290000000001-001-2024010{}0000.xml"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def dump(rows):
    return f"<?xml version=\"1.0\"?>\n<Root><Items Count=\"{len(rows)}\">\n" + "\n".join(rows) + "\n</Items></Root>\n"


def item(code, price=None):
    cell = "" if price is None else f"<price>{price}</price>"
    return f"<Item kind=\"k>{code}\">\n <code>{code}</code>{cell}</Item>"


def test_rows_of_dumps_in_small_blocks(spark, tmp_path):
    """Blocks far smaller than a file change nothing; empty rows, entities and nested elements have their cells."""
    rows = [item(i, f"{i}.5") for i in range(400)]
    rows[3] = "<Item/><Item kind='only' /> <Item ><code>a &amp; b</code><price><net>1</net></price></Item>"
    write(str(tmp_path / "a.xml"), dump(rows))
    write(str(tmp_path / "none.xml"), dump([]))
    write(str(tmp_path / "empty.xml"), "")
    paths = [str(tmp_path / n) for n in ("a.xml", "none.xml", "empty.xml")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = xml_dumps.read_dump_rows(spark, paths, "Item", LAYOUT["PRICE_FULL_FILE"][1], str(tmp_path / "scratch"))
        got = got.orderBy("_path", "pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(os.listdir(tmp_path / "scratch" / "rows")) > 20
    assert [r.pos for r in got] == list(range(402))
    assert all(r._broken is None for r in got)
    cells = [(r._kind, r.code, r.price) for r in got]
    assert cells[:3] == [(f"k>{i}", str(i), f"{i}.5") for i in range(3)]
    assert cells[3:5] == [(None, None, None), ("only", None, None)]
    assert cells[5][1] == "a & b" and "1" in cells[5][2]
    assert cells[6:] == [(f"k>{i}", str(i), f"{i}.5") for i in range(4, 400)]


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    base = tmp_path_factory.mktemp("dumps")
    for name in ("outputs", "logs", "dumps"):
        os.makedirs(base / name)
    return base


def load(lake, landing, hour):
    folders = [str(landing / n) for n in ("outputs", "logs", "logs")]
    return lake.upload(*folders, f"2024-01-01 0{hour}:00:00", dumps=str(landing / "dumps"), layouts=LAYOUT)


def stored(lake):
    return [(r.chain, r.row_index, r.file_name, r.content["code"], r.content["price"], r.batch_id)
            for r in lake.rows().orderBy("chain", "row_index").collect()]


def test_dumps_into_the_store(spark, landing, tmp_path):
    """Later dumps go on after the mark, each dump once, broken rows aside, and a restore knows what is stored."""
    lake = Lake(spark, str(tmp_path / "lake"), CHAINS)
    write(f"{landing}/dumps/Alpha/{NAME.format(2)}", dump([item("b0", 1), item("b1")]))
    write(f"{landing}/dumps/Alpha/{NAME.format(1)}", dump([item("a0", 3)]))
    write(f"{landing}/dumps/Elsewhere/{NAME.format(1)}", dump([item("x", 3)]))
    write(f"{landing}/dumps/Alpha/Promo7290000000001-001-202401010000.xml", dump([item("p", 3)]))
    write(f"{landing}/dumps/Alpha/notes.xml", dump([item("n", 3)]))
    assert load(lake, landing, 1) == 0
    first = [("AlphaMart", 0, NAME.format(1), "a0", "3", 0), ("AlphaMart", 1, NAME.format(2), "b0", "1", 0),
             ("AlphaMart", 2, NAME.format(2), "b1", None, 0)]
    assert stored(lake) == first

    write(f"{landing}/dumps/Alpha/{NAME.format(3)}", dump([item("c0", 5)]))
    cut = dump([item("d0", 6), item("d1", 7)]).split("<price>7")[0]
    write(f"{landing}/dumps/BetaDumps/{NAME.format(1)}", cut)
    for hour in (2, 3):
        load(lake, landing, hour)
        assert stored(lake) == [*first, ("AlphaMart", 3, NAME.format(3), "c0", "5", 1), ("Beta", 0, NAME.format(1), "d0", "6", 1)]
    marks = {(r.chain, r.file_name): (r.first_row, r.total_expected_records) for r in lake.markers().collect()}
    assert marks == {("AlphaMart", NAME.format(1)): (0, 1), ("AlphaMart", NAME.format(2)): (1, 2),
                     ("AlphaMart", NAME.format(3)): (3, 1), ("Beta", NAME.format(1)): (0, 1)}
    bad = lake.quarantined().collect()
    assert [(r.table_name, r.row_index, list(r.content)) for r in bad] == [("price_full_file_beta", 1, [xml_dumps.BROKEN_TEXT])]
    assert "d1" in bad[0].content[xml_dumps.BROKEN_TEXT]

    held = [row[:-1] for row in stored(lake)]
    lake.publish("2024-01-01 05:00:00")
    lake.clear_ledger()
    lake.load_version("2024-01-01 06:00:00")
    load(lake, landing, 7)
    assert [row[:-1] for row in stored(lake)] == held


def test_a_table_takes_csv_or_dumps(spark, landing, tmp_path):
    write(f"{tmp_path}/outputs/price_full_file_alphamart.csv", "found_folder,file_name,code\nd,f,1\n")
    lake = Lake(spark, str(tmp_path / "lake"), CHAINS)
    with pytest.raises(ValueError, match="PRICE_FULL_FILE"):
        lake.upload(str(tmp_path / "outputs"), str(landing / "logs"), str(landing / "logs"), "2024-01-01 01:00:00",
                    dumps=str(landing / "dumps"), layouts=LAYOUT)
    assert lake.last_batch() == -1

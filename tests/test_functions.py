import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_lake.functions import names, values


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_strip_ext_removes_suffixes_anywhere(spark):
    row = one(spark, a=names.strip_ext(F.lit("Price1.xml.gz")), b=names.strip_ext(F.lit("a.gz.b.aspx")))
    assert (row.a, row.b) == ("Price1", "a.b")


@pytest.mark.parametrize("name,want", [
    ("PriceFull7290027600007-001-202410010000.xml", "PRICE_FULL_FILE"),
    ("PromoFull7290027600007-001-202410010000.xml", "PROMO_FULL_FILE"),
    ("Price7290027600007-001-202410010000.xml", "PRICE_FILE"),
    ("Promo7290027600007-001-202410010000.xml", "PROMO_FILE"),
    ("Stores7290027600007-202410010000.xml", "STORE_FILE"),
    ("NULLPrice7290027600007-001-202410010000.xml", "PRICE_FILE"),
    ("notes.txt", None),
])
def test_file_type(spark, name, want):
    assert one(spark, t=names.file_type(F.lit(name))).t == want
    assert names.file_type_of(name) == want


@pytest.mark.parametrize("name,want", [
    ("PriceFull7290027600007-001-202410010000.xml", ("7290027600007", "001", "2024-10-01", "00:00")),
    ("Stores7290027600007-20241001-0530.xml", ("7290027600007", None, "2024-10-01", "05:30")),
    ("Promo7290027600007-12-20241001-053059.gz", ("7290027600007", "12", "2024-10-01", "05:30:59")),
    ("Price7290027600007-012-20241001", ("7290027600007", "012", "2024-10-01", None)),
    ("notes.txt", (None, None, None, None)),
])
def test_name_parts(spark, name, want):
    assert tuple(one(spark, p=names.name_parts(F.lit(name))).p) == want


def test_table_names(spark):
    row = one(spark, a=names.table_name(F.lit("PRICE_FULL_FILE"), F.lit("ChainA")),
              b=names.table_of_path(F.lit("/out/price_file_chaina.v2.csv")),
              c=names.base_name(F.lit("a/b/c.xml")),
              d=names.split_table_name(F.lit("price_full_file_chain_a")))
    assert (row.a, row.b, row.c) == ("price_full_file_chaina", "price_file_chaina", "c.xml")
    assert tuple(row.d) == ("PRICE_FULL_FILE", "chain_a")


def test_index_codec(spark):
    row = one(spark, i=names.encode_index(F.lit("PRICE_FILE"), F.lit("A"), F.lit("2024-01-01")))
    assert row.i == "PRICE_FILE@A@2024-01-01"
    back = one(spark, p=names.decode_index(F.lit(row.i), ["file_type", "chain", "when", "extra"])).p
    assert tuple(back) == ("PRICE_FILE", "A", "2024-01-01", None)


def test_file_patterns(spark):
    assert names.file_glob() == "*"
    assert names.file_glob("ChainA", "csv") == "*chaina.csv"
    row = one(spark, a=names.matches_file(F.lit("price_file_chaina.csv"), "ChainA", "csv"),
              b=names.matches_file(F.lit("price_file_chainaXcsv"), "ChainA", "csv"),
              c=names.matches_file(F.lit("price_file_chaina.csv.bak"), "ChainA", "csv"),
              d=names.matches_file(F.lit("x.json"), None, "json"))
    assert tuple(row) == (True, False, False, True)


def test_snapshot_message(spark):
    row = one(spark, a=names.snapshot_message(F.lit("2024-01-01 00:00:00")),
              b=names.snapshot_message(F.lit("t"), ["A", "B"], ["PRICE_FILE"]))
    assert row.a == "Update-Time: 2024-01-01 00:00:00, Scrapers:ALL, Files:ALL"
    assert row.b == "Update-Time: t, Scrapers:A,B, Files:PRICE_FILE"


def test_digest_ignores_column_order_and_sees_the_source(spark):
    a = values.digest(F.lit("f.json"), {"x": F.lit("1"), "y": F.lit(None).cast("string")})
    b = values.digest(F.lit("f.json"), {"y": F.lit(None).cast("string"), "x": F.lit("1")})
    c = values.digest(F.lit("g.json"), {"x": F.lit("1"), "y": F.lit(None).cast("string")})
    row = one(spark, a=a, b=b, c=c)
    assert row.a == row.b != row.c and len(row.a) == 64


@pytest.mark.parametrize("text,want", [
    ("12", (12, None)), (str(2**63 - 1), (2**63 - 1, None)), (str(2**63), (None, str(2**63))),
    (str(-2**63), (-2**63, None)), ("true", (None, "true")), ("1.5", (None, "1.5")),
])
def test_int_guard(spark, text, want):
    assert tuple(one(spark, g=values.int_guard(F.lit(text))).g) == want


def test_guard_document_keeps_big_integers(spark):
    text = ('{"b": true, "a": {"n": [9223372036854775808, -9223372036854775808, 1, "x,12345678901234567890,\\" y"]}, '
            '"c": 12345678901234567890, "d": 1.5, "e": null}')
    assert one(spark, d=values.guard_document(F.lit(text))).d == (
        '{"a":{"n":["9223372036854775808",-9223372036854775808,1,"x,12345678901234567890,\\" y"]},"b":true,'
        '"c":"12345678901234567890","d":1.5,"e":null}')
    assert one(spark, d=values.guard_document(F.lit("no json"))).d is None


@pytest.mark.parametrize("left,right,same", [
    ('{"a":{"x":1,"y":2}}', '{ "a": {"y":2, "x":1} }', True), ('{"a":1}', '{"a":"1"}', False), ("[1]", "[ 1 ]", True),
    ('{"a":[1,2]}', '{"a":[2,1]}', False), ('{"a":true}', '{"a":"true"}', False), ('{"a":null}', "{}", False),
    ('{"a":1.0}', '{"a":1}', False), ("1" * 45, "1" * 44 + "2", False), ('"x"', ' "x" ', True), ('"1"', "1", False), ('"n1"', "1", False),
    ('{"a":1,"a":2}', '{"a":2}', True), ('[{"b":{"y":1,"x":2,"y":3},"a":"}"}]', '[{"a":"}","b":{"x":2,"y":3}}]', True),
    ('{"a":1,"b":[{},[],""],"a":1e5}', '{"b":[{}, [],"" ],"a":1e5}', True), ('{"a":1,"a":2}', '{"a":1}', False),
    ('"\\u0041"', '"A"', True), ("null", "null ", True), ('{"a":"' + "x" * 50_000 + '"}', '{"a" :"' + "x" * 50_000 + '"}', True),
])
def test_canonical_json_is_typed_at_every_level(spark, left, right, same):
    row = one(spark, a=values.canonical_json(F.lit(left)), b=values.canonical_json(F.lit(right)))
    assert row.a is not None and (row.a == row.b) == same


@pytest.mark.parametrize("text", ["", "no json", "1 2", "1,2", '{"a":1} x', '{"a":1', "01", "{'a':1}", '{"a":1,}', '"open', "-", None])
def test_what_is_no_document_has_no_form_but_an_identity(spark, text):
    col = F.lit(text).cast("string")
    row = one(spark, c=values.canonical_json(col), i=values.identity(col))
    assert row.c is None and row.i == ("n" if text is None else "t" + text)


@given(st.recursive(st.none() | st.booleans() | st.integers(-10**30, 10**30) | st.text(alphabet='a"\\{}[]:,n s1é', max_size=6),
                    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(alphabet='ab"', max_size=2), inner, max_size=3),
                    max_leaves=12))
@settings(max_examples=15, deadline=None)
def test_canonical_json_is_the_document_with_sorted_keys(spark, doc):
    """Both ways, the parser's and the fold's, against a JSON library."""
    text = json.dumps(doc, indent=1, ensure_ascii=False)
    row = one(spark, a=values.canonical_json(F.lit(text)), b=values._folded_document(F.lit(text)))
    want = json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(row.a) == doc and row.a == row.b and len(row.a) == len(want)


def test_coercions(spark):
    row = one(spark, a=values.coerce_store(F.lit(7)), b=values.coerce_limit(F.lit("")),
              c=values.coerce_limit(F.lit("5")), d=values.coerce_links(F.lit("")),
              e=values.coerce_links(F.lit('["u1","u2"]')))
    assert (row.a, row.b, row.c, row.d, row.e) == ("7", -1, 5, [], ["u1", "u2"])


@pytest.mark.parametrize("text,want", [
    ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05+02:00", dt.datetime(2024, 1, 2, 1, 4, 5)),
    ("2024-01-02T03:04:05-03:30", dt.datetime(2024, 1, 2, 6, 34, 5)),
    (" 2024-01-02 03:04:05 ", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02", dt.datetime(2024, 1, 2)),
    ("soon", None),
])
def test_parse_ts(spark, text, want):
    assert one(spark, t=values.parse_ts(F.lit(text))).t == want


def test_civil_time(spark):
    row = one(spark, w=values.parse_civil(F.lit("2024-01-02 03:04:05")),
              s=values.parse_civil(F.lit("2024-07-02 03:04:05")))
    assert row.w == dt.datetime(2024, 1, 2, 1, 4, 5)
    assert row.s == dt.datetime(2024, 7, 2, 0, 4, 5)


def test_clock_and_format(spark):
    at = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    row = one(spark, a=values.format_ts(values.backfill(at, 5)), b=values.micros(at))
    assert row.a == "2024-01-01 22:04:05"
    assert row.b == int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp() * 1e6)


def test_documents(spark):
    row = one(spark, a=values.decode_doc(F.lit('{"x": 1}'), "x bigint"),
              b=values.decode_doc(F.lit("not json"), "x bigint"),
              c=values.encode_doc([F.lit("v").alias("k"), F.lit(None).cast("string").alias("n")]))
    assert row.a.doc.x == 1 and row.a.raw is None
    assert row.b.doc is None and row.b.raw == "not json"
    assert row.c == '{"k":"v","n":null}'


def test_error_label_and_success(spark):
    null_text, null_flag = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    row = one(spark, a=values.error_label(F.lit("timeout"), F.lit(False)),
              b=values.error_label(null_text, null_flag), c=values.error_label(null_text, F.lit(True)),
              d=values.is_ok(F.lit(True), F.lit(True)), e=values.is_ok(F.lit(True), null_flag))
    assert tuple(row) == ("timeout", "empty file", "unknown", True, False)

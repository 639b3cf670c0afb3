"""Registered queries of the read path."""

from pyspark.sql import functions as F

from retail_lake.functions import names, values
from retail_lake.operators import access, filters, ingest
from retail_lake.plans.fixtures import view, with_views
from retail_lake.plans.ingest_queries import _FFILL, CONTENT
from retail_lake.plans.registry import query
from retail_lake.schemas import DEFAULT_SECONDS

CHAIN = "chain3"
FILE = "PriceFull7290000000003-002-202401010000.xml"
KIND = "PRICE_FULL_FILE"
AS_OF = "2024-01-31 00:00:00"

_CONTENT = "CAST(json_object('item_code', item_code, 'item_price', item_price) AS STRING) AS row_content"
_ONE_FILE = (f"FROM fx_stored WHERE chain = '{CHAIN}' AND file_type = '{KIND}' AND file_name = '{FILE}' "
             "AND file_complete IS NULL")
_PAGE_COLS = f"row_index, found_folder, file_name, {_CONTENT}"


def stored(spark, sf_dir):
    """Stored rows in response shape, markers included."""
    rows = view(spark, sf_dir, "fx_stored")
    return rows.withColumn("content", F.create_map(
        F.lit("item_code"), "item_code", F.lit("item_price"), "item_price")).drop("item_code", "item_price")


def one_file(spark, sf_dir):
    kind = filters.check_domain([CHAIN], CHAIN, file=FILE, needs_file=True)
    return access.file_rows(stored(spark, sf_dir), CHAIN, kind, FILE)


def shown(rows):
    return access.to_row_content(rows).withColumn("row_content", F.to_json("row_content"))


@query("file_page", with_views(["fx_rows"], (
    f", {_FFILL} SELECT row_index, found_folder, file_name, CAST(json_object("
    + ", ".join(f"'{c}', {c}" for c in CONTENT)
    + f") AS STRING) AS row_content FROM ffill WHERE chain = '{CHAIN}' AND file_name = '{FILE}' "
    "ORDER BY row_index LIMIT 100")))
def file_page(spark, sf_dir):
    """Landing rows filled, packed, filtered and paged for one file."""
    packed, _ = ingest.ingest(view(spark, sf_dir, "fx_rows"), ["chain", "file_type"], CONTENT)
    return shown(access.page(access.file_rows(packed, CHAIN, KIND, FILE)))


@query("file_rows", with_views(["fx_stored"], f"SELECT {_PAGE_COLS} {_ONE_FILE}"))
def file_rows(spark, sf_dir):
    """L3: the whole content of one file."""
    return shown(one_file(spark, sf_dir))


@query("file_second_page", with_views(["fx_stored"], (
    f"SELECT {_PAGE_COLS} {_ONE_FILE} ORDER BY row_index LIMIT 10 OFFSET 5")))
def file_second_page(spark, sf_dir):
    """L1/L2: the page a cursor points to."""
    return shown(access.page(one_file(spark, sf_dir), access.parse_cursor("5"), 10))


@query("file_page_meta", with_views(["fx_stored"], (
    "SELECT n AS total_count, 15 < n AS has_more, CAST(5 AS BIGINT) AS \"offset\", "
    "CAST(10 AS BIGINT) AS chunk_size, CASE WHEN 15 < n THEN '15' END AS next_cursor, '0' AS prev_cursor "
    f"FROM (SELECT count(*) AS n {_ONE_FILE}) c")))
def file_page_meta(spark, sf_dir):
    """L1: total, has_more and cursors of a page."""
    return access.page_meta(one_file(spark, sf_dir), 5, 10)


@query("file_keyset_page", with_views(["fx_stored"], (
    f"SELECT {_PAGE_COLS} {_ONE_FILE} AND row_index > 20 ORDER BY row_index LIMIT 100")))
def file_keyset_page(spark, sf_dir):
    """L2: the page after a row index; the predicate reaches the scan."""
    return shown(access.page_after(one_file(spark, sf_dir), 20))


@query("table_deep_page", with_views(["fx_stored"], (
    f"SELECT {_PAGE_COLS} FROM fx_stored WHERE chain = '{CHAIN}' AND file_complete IS NULL "
    "ORDER BY row_index LIMIT 25 OFFSET 30")))
def table_deep_page(spark, sf_dir):
    """L1 for a page too deep for a top-n: only the buckets it touches are numbered."""
    rows = filters.drop_control(filters.eq_filter(stored(spark, sf_dir), {"chain": CHAIN}))
    return shown(access.page(rows, 30, 25, bits=(4,), top_n=0))


@query("file_row_counts", with_views(["fx_stored"], (
    "SELECT chain, file_name, count(*) AS num_of_rows FROM fx_stored WHERE file_complete IS NULL "
    "GROUP BY chain, file_name")))
def file_row_counts(spark, sf_dir):
    """A10: rows per file, markers left out."""
    return access.row_counts(filters.drop_control(view(spark, sf_dir, "fx_stored")))


def documents(spark, sf_dir):
    docs = view(spark, sf_dir, "fx_docs")
    return docs.withColumn("files", F.array("file_a", "file_b"))


_FILES = "(SELECT *, file_a AS file_name FROM fx_docs UNION ALL SELECT *, file_b FROM fx_docs) d"


@query("list_files", with_views(["fx_docs"], f"SELECT file_name FROM {_FILES} WHERE chain = '{CHAIN}'"))
def list_files(spark, sf_dir):
    """Files of a chain; the equality is pushed to the scan."""
    return access.explode_files(filters.match_columns(documents(spark, sf_dir), CHAIN))


@query("list_files_by_index", with_views(["fx_docs"], (
    f"SELECT doc_id, file_name FROM {_FILES} WHERE regexp_matches(file_type || '@' || chain || '@' || status, "
    f"'.*PRICE_FILE.*{CHAIN}.*')")))
def list_files_by_index(spark, sf_dir):
    """F2 as the regex on the composite index."""
    docs = documents(spark, sf_dir).withColumn(
        "index", names.encode_index("file_type", "chain", "status"))
    return access.explode_files(filters.match_index(docs, CHAIN, "PRICE_FILE"), keep=["doc_id"])


@query("list_files_filtered", with_views(["fx_docs"], (
    f"SELECT doc_id, file_name FROM {_FILES} WHERE chain = '{CHAIN}' AND file_type = 'PROMO_FILE' "
    "AND contains(file_name, '01') AND (ts IS NULL OR ts >= TIMESTAMP '1998-01-01')")))
def list_files_filtered(spark, sf_dir):
    """files of a chain and type, of a store, since a date."""
    docs = filters.match_columns(documents(spark, sf_dir), CHAIN, "PROMO_FILE")
    docs = filters.since(docs, "ts", values.parse_ts(F.lit("1998-01-01T00:00:00Z")))
    return access.explode_files(filters.with_store(docs, "01"), keep=["doc_id"])


@query("list_files_latest", with_views(["fx_docs"], (
    "SELECT chain, file_type, ts, file_name FROM (SELECT *, row_number() OVER (PARTITION BY chain, file_type "
    f"ORDER BY ts DESC NULLS LAST, file_name DESC) AS rn FROM {_FILES}) t WHERE rn = 1")))
def list_files_latest(spark, sf_dir):
    """The newest file per chain and type."""
    files = access.explode_files(documents(spark, sf_dir), keep=["chain", "file_type", "ts"])
    return access.latest_file(files, ["chain", "file_type"])


@query("latest_documents", with_views(["fx_docs"], (
    "SELECT chain, doc_id, ts, status FROM (SELECT *, row_number() OVER (PARTITION BY chain "
    "ORDER BY ts DESC NULLS LAST, doc_id DESC) AS rn FROM fx_docs) t WHERE rn = 1")))
def latest_documents(spark, sf_dir):
    """The newest document per chain, technical columns dropped."""
    docs = view(spark, sf_dir, "fx_docs").select(
        "chain", "doc_id", "ts", "status", F.col("doc_id").alias("_id"))
    return access.drop_technical(access.latest(docs, ["chain"], F.struct("ts", "doc_id")))


@query("freshness", with_views(["fx_events"], (
    "SELECT task_id, max(ts) AS last_update, coalesce(max(ts) > TIMESTAMP '" + AS_OF + "' - "
    f"INTERVAL {DEFAULT_SECONDS} SECOND, false) AS is_updated FROM fx_events GROUP BY task_id")))
def freshness(spark, sf_dir):
    """Which tables were written within the last three hours of a given clock."""
    events = view(spark, sf_dir, "fx_events").select("task_id", "ts")
    as_of = values.backfill(F.lit(AS_OF).cast("timestamp_ntz"), 0)
    return access.freshness(events, ["task_id"], "ts", as_of, DEFAULT_SECONDS)


@query("name_parts", with_views(["fx_stored"], (
    "SELECT file_name, 'PRICE_FULL_FILE' AS file_type, substr(file_name, 10, 13) AS chain_id, "
    "substr(file_name, 24, 3) AS store_number, '2024-01-01' AS file_date, '00:00' AS file_time, "
    "replace(file_name, '.xml', '') AS stem, count(*) AS n_rows FROM fx_stored GROUP BY file_name")))
def name_parts(spark, sf_dir):
    """Type, chain id, store and date of file names."""
    files = view(spark, sf_dir, "fx_stored").groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return files.select("file_name", "n_rows", names.file_type("file_name").alias("file_type"),
                        names.strip_ext("file_name").alias("stem"),
                        names.name_parts("file_name").alias("p")).select("*", "p.*").drop("p")


@query("index_codec", with_views(["fx_docs"], (
    "SELECT doc_id, file_type || '@' || chain || coalesce('@' || strftime(ts, '%Y-%m-%d %H:%M:%S'), '') AS idx, "
    "file_type, chain, strftime(ts, '%Y-%m-%d %H:%M:%S') AS when_date, "
    "lower(file_type) || '_' || lower(chain) AS table_name FROM fx_docs")))
def index_codec(spark, sf_dir):
    """Composite index written and read back, without its last part where a document has no time."""
    docs = view(spark, sf_dir, "fx_docs")
    encoded = docs.select("doc_id", names.encode_index("file_type", "chain", values.format_ts("ts")).alias("idx"))
    decoded = encoded.withColumn("p", names.decode_index("idx", ["file_type", "chain", "when_date"]))
    return (decoded.select("doc_id", "idx", "p.*")
            .withColumn("table_name", names.table_name("file_type", "chain")))


@query("int_guard", with_views(["fx_events"], (
    "SELECT event_id, TRY_CAST(t AS BIGINT) AS int_value, CASE WHEN TRY_CAST(t AS BIGINT) IS NULL THEN t END "
    "AS text_value FROM (SELECT event_id, CAST(event_id AS STRING) || '000000000000000' AS t FROM fx_events) e")))
def int_guard(spark, sf_dir):
    """Integers beyond 64 bits stay as text."""
    events = view(spark, sf_dir, "fx_events").select(
        "event_id", F.concat(F.col("event_id").cast("string"), F.lit("000000000000000")).alias("t"))
    return events.select("event_id", values.int_guard("t").alias("g")).select("event_id", "g.*")


@query("coercions", with_views(["fx_docs"], (
    "SELECT doc_id, CAST(doc_id % 40 AS STRING) AS store_number, CASE WHEN status = 'P' THEN -1 ELSE doc_id END AS "
    "request_limit, CASE WHEN status = 'P' THEN CAST(0 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS n_links FROM fx_docs")))
def coercions(spark, sf_dir):
    """Store numbers as text, empty limits and empty link lists."""
    docs = view(spark, sf_dir, "fx_docs")
    limit = F.when(F.col("status") == "P", "").otherwise(F.col("doc_id").cast("string"))
    links = F.when(F.col("status") == "P", "").otherwise(F.to_json(F.array("file_a", "file_b")))
    return docs.select("doc_id", values.coerce_store(F.col("doc_id") % 40).alias("store_number"),
                       values.coerce_limit(limit).alias("request_limit"),
                       F.size(values.coerce_links(links)).cast("bigint").alias("n_links"))


@query("parse_timestamps", with_views(["fx_docs"], (
    "SELECT doc_id, ts AS from_iso, ts - INTERVAL 2 HOUR AS from_offset, "
    "strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS started FROM fx_docs")))
def parse_timestamps(spark, sf_dir):
    """ISO text with ``Z`` or an offset, and the run clock hours back."""
    docs = view(spark, sf_dir, "fx_docs")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return docs.select(
        "doc_id", values.parse_ts(F.concat(iso, F.lit("Z"))).alias("from_iso"),
        values.parse_ts(F.concat(iso, F.lit("+02:00"))).alias("from_offset"),
        values.format_ts(values.backfill("ts", 3)).alias("started"))

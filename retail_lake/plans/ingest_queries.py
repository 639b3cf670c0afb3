"""Registered queries of the ingest path (W1-W3, P1, F9, A1, S1, ST1, SNK1, SNK2)."""

from pyspark.sql import functions as F

from retail_lake.functions.values import encode_doc, micros
from retail_lake.operators import ingest, merge, scan
from retail_lake.plans.fixtures import view, with_views
from retail_lake.plans.registry import query

TABLE = ["table_name"]
CONTENT = ["item_code", "item_price", "unit"]
FILLED = ["found_folder", "file_name", *CONTENT]
CUT = "2024-01-16 00:00:00"
# Rows of a table that a first load has stored; in a small table they may be all there are.
MARK = "20 + CAST(substr(chain, 6) AS BIGINT) * 5"

_WIN = "PARTITION BY table_name ORDER BY row_index"
_FFILL = ("ffill AS (SELECT table_name, chain, row_index, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER ({_WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in FILLED) + " FROM fx_rows)")
_RUNS = (
    f"filled AS (SELECT table_name, row_index, last_value(file_name IGNORE NULLS) OVER ({_WIN} "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS file_name FROM fx_rows), "
    "flagged AS (SELECT *, CASE WHEN file_name IS DISTINCT FROM lag(file_name) OVER "
    f"({_WIN}) THEN 1 ELSE 0 END AS begins FROM filled), "
    f"runs AS (SELECT *, CAST(sum(begins) OVER ({_WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    "AS BIGINT) AS run_id FROM flagged)"
)
_MARKERS = (
    "markers AS (SELECT table_name, 'true' AS file_complete, file_name, count(*) AS total_expected_records, "
    "min(row_index) AS first_row, max(row_index) AS last_row, run_id "
    "FROM runs GROUP BY table_name, run_id, file_name)"
)


@query("ingest_number_rows", with_views(["fx_events"], (
    "SELECT event_id, chain, row_index FROM (SELECT event_id, chain, ts, CAST(row_number() OVER "
    "(PARTITION BY chain ORDER BY ts) - 1 AS BIGINT) AS row_index FROM fx_events) n "
    f"WHERE ts >= TIMESTAMP '{CUT}'")))
def number_rows(spark, sf_dir):
    """Rows of a second load, numbered on from the stored high-water mark of each table."""
    events = view(spark, sf_dir, "fx_events").select("event_id", "chain", "ts")
    cut = F.lit(CUT).cast("timestamp_ntz")
    stored = (events.where(F.col("ts") < cut).groupBy("chain")
              .agg((F.count(F.lit(1)) - 1).alias("last_row")))
    fresh = events.where(F.col("ts") >= cut).withColumn("at", micros("ts"))
    return (scan.number_rows(fresh, ["chain"], "at", stored, bits=scan.TIME_BITS)
            .select("event_id", "chain", "row_index"))


@query("ingest_ffill", with_views(["fx_rows"], f", {_FFILL} SELECT table_name, row_index, "
                                  f"{', '.join(FILLED)} FROM ffill"))
def ffill(spark, sf_dir):
    """Forward fill of every column in row order, across file boundaries."""
    rows = view(spark, sf_dir, "fx_rows").select("table_name", "row_index", *FILLED)
    return scan.forward_fill(rows, TABLE, "row_index", FILLED)


@query("ingest_ffill_within_file", with_views(["fx_rows"], (
    f", {_RUNS} SELECT table_name, row_index, file_name, item_code, item_price FROM ("
    "SELECT r.table_name, r.row_index, r.file_name, " + ", ".join(
        f"last_value(f.{c} IGNORE NULLS) OVER (PARTITION BY r.table_name, r.run_id ORDER BY r.row_index "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in ("item_code", "item_price"))
    + " FROM runs r JOIN fx_rows f ON f.table_name = r.table_name AND f.row_index = r.row_index) t")))
def ffill_within_file(spark, sf_dir):
    """W2 with the fill confined to a file's run."""
    cols = ["file_name", "item_code", "item_price"]
    rows = view(spark, sf_dir, "fx_rows").select("table_name", "row_index", *cols)
    return scan.forward_fill(rows, TABLE, "row_index", cols, within="file_name")


@query("ingest_pack", with_views(["fx_rows"], (
    f", {_FFILL} SELECT chain, row_index, found_folder, file_name, CAST(json_object("
    + ", ".join(f"'{c}', {c}" for c in CONTENT) + ") AS STRING) AS content FROM ffill")))
def pack(spark, sf_dir):
    """W2 + P1: filled rows packed into the stored shape; the content map is shown as JSON."""
    rows = view(spark, sf_dir, "fx_rows")
    packed, _ = ingest.ingest(rows, ["chain"], CONTENT)
    return packed.withColumn("content", F.to_json("content"))


@query("ingest_run_ids", with_views(["fx_rows"], f", {_RUNS} SELECT table_name, row_index, run_id FROM runs"))
def run_ids(spark, sf_dir):
    """Number of the contiguous file run each row belongs to."""
    rows = view(spark, sf_dir, "fx_rows").select("table_name", "row_index", "file_name")
    return scan.run_ids(rows, TABLE, "row_index", "file_name").select("table_name", "row_index", "run_id")


@query("ingest_markers", with_views(["fx_rows"], (
    f", {_RUNS}, {_MARKERS} SELECT table_name, file_complete, file_name, total_expected_records, "
    "first_row, last_row, run_id FROM markers")))
def markers(spark, sf_dir):
    """A1: a completion marker per file run, with the exact row count."""
    return ingest.completion_markers(view(spark, sf_dir, "fx_rows"), TABLE)


@query("ingest_marked_union", with_views(["fx_rows"], (
    f", {_RUNS}, {_MARKERS} "
    "SELECT table_name, row_index, row_index * 2 AS seq, file_name, CAST(NULL AS STRING) AS file_complete, "
    "CAST(NULL AS BIGINT) AS total_expected_records FROM filled UNION ALL "
    "SELECT table_name, NULL, last_row * 2 + 1, file_name, file_complete, total_expected_records FROM markers")))
def marked_union(spark, sf_dir):
    """Data rows and completion markers in one destination."""
    rows = view(spark, sf_dir, "fx_rows").select("table_name", "row_index", "file_name")
    filled = scan.forward_fill(rows, TABLE, "row_index", ["file_name"])
    return ingest.with_markers(filled, ingest.completion_markers(rows, TABLE))


@query("ingest_quarantine", with_views(["fx_rows"], (
    "SELECT table_name, count(*) AS n_rows, bool_or(ok) AS ok FROM (SELECT f.table_name, "
    "(d.file_name IS NOT NULL AND d.found_folder IS NOT NULL) AS ok FROM fx_rows f JOIN "
    "(SELECT table_name, CASE WHEN table_name LIKE '%7' THEN NULL ELSE file_name END AS file_name, found_folder "
    "FROM fx_rows WHERE row_index = 0) d ON d.table_name = f.table_name) t GROUP BY table_name")))
def quarantine(spark, sf_dir):
    """tables whose first row lacks a key are set aside; the others go on."""
    rows = view(spark, sf_dir, "fx_rows")
    holed = rows.withColumn("file_name", F.when(
        ~(F.col("table_name").endswith("7") & (F.col("row_index") == 0)), F.col("file_name")))
    good, bad = ingest.split_quarantine(holed, TABLE)
    return (good.select("table_name", F.lit(True).alias("ok"))
            .unionByName(bad.select("table_name", F.lit(False).alias("ok")))
            .groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or("ok").alias("ok")))


@query("ingest_resume", with_views(["fx_rows"], (
    f", {_FFILL} SELECT f.chain, f.row_index, f.file_name, CAST(json_object("
    + ", ".join(f"'{c}', f.{c}" for c in CONTENT)
    + f") AS STRING) AS content FROM ffill f WHERE f.row_index > {MARK}")))
def resume(spark, sf_dir):
    """ST1: a second load reads past the mark of each table and fills from the last stored row.

    The first load is replayed here to get the stored row; a real load reads it from the store.
    """
    rows = view(spark, sf_dir, "fx_rows")
    mark = F.expr(MARK)
    marks = rows.select("table_name", mark.alias("last_row")).distinct()
    carry = rows.where(F.col("row_index") <= mark).groupBy("chain").agg(
        F.max("row_index").alias("row_index"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("row_index"))).alias(c) for c in FILLED])
    fresh = ingest.rows_after(rows, marks)
    packed, _ = ingest.ingest(fresh, ["chain"], CONTENT, carry=carry)
    return packed.select("chain", "row_index", "file_name", F.to_json("content").alias("content"))


@query("ingest_progress", with_views(["fx_rows"], (
    "SELECT table_name, max(row_index) AS last_row FROM fx_rows GROUP BY table_name")))
def progress(spark, sf_dir):
    """ST1: marks after a load, merged with older ones."""
    rows = view(spark, sf_dir, "fx_rows")
    old = ingest.progress_of(rows.where(F.col("row_index") <= F.expr(MARK)))
    return ingest.merge_progress(old, ingest.progress_of(rows))


_BUCKET = "CAST(floor(CAST(value AS DOUBLE)) AS BIGINT)"


@query("insert_ignore", with_views(["fx_events"], (
    f", keyed AS (SELECT *, {_BUCKET} AS bucket FROM fx_events) SELECT task_id, bucket, min(event_id) AS event_id FROM keyed n "
    f"WHERE ts >= TIMESTAMP '{CUT}' AND NOT EXISTS (SELECT 1 FROM keyed e WHERE e.ts < TIMESTAMP '{CUT}' "
    "AND e.task_id IS NOT DISTINCT FROM n.task_id AND e.bucket IS NOT DISTINCT FROM n.bucket) GROUP BY task_id, bucket")))
def insert_ignore(spark, sf_dir):
    """SNK1: first writer wins; keys that any earlier event has stored are ignored."""
    events = view(spark, sf_dir, "fx_events").select("task_id", F.expr(_BUCKET).alias("bucket"), "event_id", "ts")
    cut = F.lit(CUT).cast("timestamp_ntz")
    stored = events.where(F.col("ts") < cut).drop("ts")
    items = events.where(F.col("ts") >= cut).drop("ts")
    return merge.insert_ignore(stored.dropDuplicates(["task_id", "bucket"]), items, ["task_id", "bucket"], "event_id")


@query("upsert_latest", with_views(["fx_events"], (
    "SELECT task_id, status, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY task_id, status "
    "ORDER BY event_id DESC) AS rn FROM fx_events) t WHERE rn = 1")))
def upsert_latest(spark, sf_dir):
    """SNK2: last writer wins."""
    events = view(spark, sf_dir, "fx_events").select("task_id", "status", "event_id", "value", "ts")
    cut = F.lit(CUT).cast("timestamp_ntz")
    return merge.upsert(events.where(F.col("ts") < cut).drop("ts"),
                        events.where(F.col("ts") >= cut).drop("ts"),
                        ["task_id", "status"], "event_id")


@query("document_encode", with_views(["fx_rows"], (
    "SELECT CAST(json_object('item_code', item_code, 'unit', unit) AS STRING) AS doc, count(*) AS n_rows "
    "FROM fx_rows GROUP BY item_code, unit")))
def document_encode(spark, sf_dir):
    """Content as JSON documents, nulls kept."""
    rows = view(spark, sf_dir, "fx_rows").groupBy("item_code", "unit").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(encode_doc(["item_code", "unit"]).alias("doc"), "n_rows")

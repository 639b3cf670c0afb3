"""Ingest of wide landing rows: fill, pack, completion markers, resume (P1, F9, A1, S1, ST1)."""

from pyspark.sql import functions as F

from retail_lake.operators.scan import ROW_BITS, run_counts, running
from retail_lake.operators.sizing import broadcast_if_small
from retail_lake.schemas import KEY_COLUMNS

# Fixed value: what a completion marker carries.
COMPLETE = "true"


def pack_rows(df, keep=(), content=None):
    """Wide row to (keep..., row_index, found_folder, file_name, content map of the rest)."""
    names = content or [c for c in df.columns if c not in KEY_COLUMNS and c not in keep]
    pairs = [part for n in names for part in (F.lit(n), F.col(n).cast("string"))]
    packed = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(*keep, F.col("row_index").cast("bigint").alias("row_index"),
                     "found_folder", "file_name", packed.alias("content"))


def has_keys():
    """Whether a row carries its file name and folder."""
    return F.col("file_name").isNotNull() & F.col("found_folder").isNotNull()


def split_quarantine(df, by, order="row_index", bits=ROW_BITS):
    """(good rows, bad rows): a table whose first row lacks a key column is set aside whole."""
    flagged = running(df, by, order, {"_ok": ("first", has_keys(), True)}, bits)
    return flagged.where("_ok").drop("_ok"), flagged.where("NOT _ok").drop("_ok")


def completion_markers(df, by, order="row_index", key="file_name", bits=ROW_BITS):
    """A1/ST4: a marker per contiguous run of a file, with its exact row count."""
    runs = run_counts(df, by, order, key, bits)
    return runs.select(
        *by, F.lit(COMPLETE).alias("file_complete"), F.col(key).alias("file_name"),
        F.col("n_rows").alias("total_expected_records"), "first_row", "last_row", "run_id")


def continued_runs(rows, open_runs, by, order="row_index", key="file_name", bits=ROW_BITS):
    """A1/ST4 over a later load: runs of the new rows, where the first one may go on an open run.

    ``open_runs`` has the last run of each table so far (key, first_row, last_row, n_rows). Its last
    row goes in front of the new ones; the run that begins with it takes over start and count.
    """
    held = open_runs.select(*by, F.col("last_row").alias(order), key)
    runs = run_counts(rows.select(*by, order, key).unionByName(held), by, order, key, bits)
    prior = open_runs.select(*by, F.col("last_row").alias("first_row"), F.col("first_row").alias("_begun"),
                             F.col("n_rows").alias("_had"))
    goes_on = F.col("_begun").isNotNull()
    return (runs.join(prior, [*by, "first_row"], "left")
            .select(*by, "run_id", key,
                    F.coalesce("_begun", "first_row").alias("first_row"), "last_row",
                    F.when(goes_on, F.col("n_rows") - 1 + F.col("_had")).otherwise(F.col("n_rows"))
                    .alias("n_rows"),
                    (~goes_on | (F.col("last_row") > F.col("first_row"))).alias("has_new_rows")))


def with_markers(rows, markers):
    """Data rows and markers in one frame; ``seq`` puts a marker right after its last row."""
    data = rows.withColumn("seq", F.col("row_index") * 2)
    ends = markers.withColumn("seq", F.col("last_row") * 2 + 1).drop("first_row", "last_row", "run_id")
    return data.unionByName(ends, allowMissingColumns=True)


def rows_after(df, progress, table="table_name", order="row_index"):
    """ST1: rows beyond the stored high-water mark; a table without a mark is read whole.

    ``progress`` has one row per table, so the rows are filtered where they are.
    """
    marks = progress.select(F.col("table_name").alias(table), F.col("last_row").alias("_mark"))
    return (df.join(broadcast_if_small(marks), table, "left")
            .where(F.col(order) > F.coalesce(F.col("_mark"), F.lit(-1)))
            .drop("_mark"))


def progress_of(df, table="table_name", order="row_index"):
    """ST1: the high-water mark per table."""
    return df.groupBy(F.col(table).alias("table_name")).agg(F.max(order).alias("last_row"))


def merge_progress(old, new):
    """ST1: marks after a load; a mark never moves back."""
    return old.unionByName(new).groupBy("table_name").agg(F.max("last_row").alias("last_row"))


def ingest(df, by, content, carry=None, bits=ROW_BITS):
    """Fill, set bad tables aside and pack, in one pass over the rows: (data rows, quarantined rows).

    ``carry`` holds the last stored row of each table (filled, with its ``row_index``); with it a
    resumed load fills from the stored row, and the carried row itself is left out of the result.
    Quarantined rows are packed as they came.
    """
    wide = [*by, *KEY_COLUMNS, *content]
    rows = df.select(*wide, F.lit(False).alias("_held"))
    if carry is not None:
        rows = rows.unionByName(carry.select(*wide, F.lit(True).alias("_held")))
    fill = ["found_folder", "file_name", *content]
    scanned = running(rows, by, "row_index", {
        "_ok": ("first", has_keys(), True), **{f"_f_{c}": ("last", F.col(c), True) for c in fill}}, bits)
    scanned = scanned.where(~F.col("_held"))
    good = scanned.where("_ok").select(*by, "row_index", *[F.col(f"_f_{c}").alias(c) for c in fill])
    bad = scanned.where("NOT _ok").select(*wide)
    return pack_rows(good, by, content), pack_rows(bad, by, content)

"""Completion markers over a stream of landing rows (ST4)."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from retail_lake.operators.access import latest
from retail_lake.operators.ingest import COMPLETE, continued_runs
from retail_lake.operators.scan import ROW_BITS


def _markers(runs, by):
    return runs.select(*by, F.lit(COMPLETE).alias("file_complete"), "file_name",
                       F.col("n_rows").alias("total_expected_records"), "first_row", "last_row")


def marker_writer(spark, root, by, schema, order="row_index", key="file_name", bits=ROW_BITS):
    """``foreachBatch`` function that writes a marker for each file run that ended in the batch.

    Rows of a table must arrive in order across batches. Per batch the runs are found by the
    distributed operators, so a table that fills the batch is no single task, and only the last run
    of each table is kept as state. Runs, markers and state go to a folder of the batch; a retried
    batch starts from the state of the one before and overwrites its own folders. ``schema`` is the
    DDL of ``by``.
    """
    open_schema = f"{schema}, {key} string, first_row bigint, last_row bigint, n_rows bigint"

    def write(batch, batch_id):
        before = open_runs(spark, root, batch_id - 1, open_schema)
        runs = continued_runs(batch, before, by, order, key, bits)
        runs.write.mode("overwrite").parquet(f"{root}/runs/batch_id={batch_id}")
        runs = spark.read.parquet(f"{root}/runs/batch_id={batch_id}")
        still_open = latest(runs, by, F.col("run_id"))
        closed = runs.join(still_open.select(*by, "run_id"), [*by, "run_id"], "left_anti")
        _markers(closed, by).write.mode("overwrite").parquet(f"{root}/markers/batch_id={batch_id}")
        (still_open.select(*by, key, "first_row", "last_row", "n_rows")
         .write.mode("overwrite").parquet(f"{root}/open/batch_id={batch_id}"))

    return write


def idle_markers(rows, by, ts, gap, delay, order="row_index", key="file_name"):
    """ST4: markers by time: a file is complete once no row of it has come for ``gap``, though none follows it.

    A stream of rows with their keys and a time ``ts``; rows late by more than ``delay`` are left out. The state
    holds one row per open file, aggregated before it is shuffled, and is forgotten with the marker. Rows of a
    file that stand apart by more than ``gap`` are runs of their own; nearer ones are one run, whatever lies between.
    """
    runs = rows.withWatermark(ts, delay).groupBy(*by, key, F.session_window(ts, gap)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(order).alias("first_row"), F.max(order).alias("last_row"))
    return _markers(runs, by)


def open_runs(spark, root, batch_id, open_schema):
    """The open run of each table after a batch; none before the first batch."""
    try:
        return spark.read.schema(open_schema).parquet(f"{root}/open/batch_id={batch_id}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], open_schema)


def all_markers(spark, root, by, last_batch):
    """Markers written so far, and at the end of the input one for each file still open."""
    written = spark.read.parquet(f"{root}/markers").drop("batch_id")
    final = _markers(spark.read.parquet(f"{root}/open/batch_id={last_batch}"), by)
    return written.unionByName(final)

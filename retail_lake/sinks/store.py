"""Row store: one folder per batch under each table, so that a rerun replaces its own output (SNK1, SNK5-SNK7)."""

from pyspark.sql import functions as F

from retail_lake.operators.scan import ROW_BITS
from retail_lake.session import PACKED, swept


def write_batch(df, path, batch_id, partitions=()):
    """Write a batch of a table. A retry of the batch overwrites what an earlier try left."""
    writer = df.drop("batch_id").write.options(**PACKED).mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    with swept(df.sparkSession):
        writer.parquet(f"{path}/batch_id={batch_id}")


def write_rows(df, path, batch_id, bits=ROW_BITS, placed=False):
    """Write data rows by (file type, chain): a file holds buckets of row numbers in order.

    A hot table is spread over many tasks, a task writes few tables, and both ``file_name`` and
    ``row_index`` are clustered, so that file and page reads skip row groups. ``placed`` says that
    the rows are already partitioned by table and bucket, as the ingest pass leaves them.
    """
    keys = ["file_type", "chain"]
    if not placed:
        df = df.repartition(*keys, F.shiftright("row_index", bits[0]))
    write_batch(df.sortWithinPartitions(*keys, "row_index"), path, batch_id, keys)


def create_empty(spark, path, schema, batch_id=-1):
    """SNK5: a typed empty table."""
    write_batch(spark.createDataFrame([], schema), path, batch_id)


def write_report(df, path):
    """SNK10: validation results as JSON."""
    df.write.mode("overwrite").json(path)

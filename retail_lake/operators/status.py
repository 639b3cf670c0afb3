"""Status events: dedup against the ledger, task groups, lifecycle and cardinality checks (JN1, A5-A7, A12)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.functions.values import digest
from retail_lake.operators.scan import TIME_BITS, number_rows

# Rows per list cell of ``by_task``.
LIST_ROWS = 1000


def with_digest(events, fields, source="source_file"):
    """Add the stable id of each event; ``fields`` maps document fields to columns."""
    return events.withColumn("digest", digest(source, fields))


def new_events(events, ledger, seq=None, by=()):
    """JN1/ST2: events whose digest the ledger does not hold for their file, each once.

    A missing file or digest counts as a value of its own. Events and global rows of a file share the ledger; ``seq`` says which copy of a digest is kept.
    Events and ledger may be told apart by more columns, ``by``.
    """
    keys = [*by, "source_file", "digest"]
    # Ledger and events are stacked, so the documents are moved once. What the ledger holds comes first of its key; the
    # first rows of a key are told before any is moved, so a digest with many copies costs no more than any.
    rows = events.withColumn("_known", F.lit(False)).unionByName(
        ledger.select(*keys, F.lit(True).alias("_known")), allowMissingColumns=True)
    order = [F.col("_known").desc(), *([] if seq is None else [F.col(seq).asc_nulls_last()])]
    first = F.row_number().over(Window.partitionBy(*reversed(keys)).orderBy(*order))
    return rows.withColumn("_nth", first).where("_nth = 1").where("NOT _known").select(*events.columns)


def by_task(events, global_events, order, fields, task="task_id", size=LIST_ROWS, bits=TIME_BITS):
    """A5: events and global events of a task as ordered lists of at most ``size`` entries.

    A task with more entries has several chunks, so no cell grows with the data. ``order`` is a
    BIGINT unique within (task, part).
    """
    tagged = (events.withColumn("part", F.lit("events"))
              .unionByName(global_events.withColumn("part", F.lit("global_status"))))
    placed = number_rows(tagged, [task, "part"], order, out="_pos", bits=bits)
    return (placed.groupBy(task, "part", F.floor(F.col("_pos") / size).cast("bigint").alias("chunk"))
            .agg(F.sort_array(F.collect_list(F.struct("_pos", *fields))).alias("_items"))
            .select(task, "part", "chunk",
                    F.transform("_items", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
                    .alias("items")))


def lifecycle(events, start, terminal, expected_events=None, task="task_id", status="status", ts="ts"):
    """One row per task: exactly one start, exactly one terminal event, in that order.

    ``expected_events`` also fixes the number of events of a task.
    """
    is_start = F.col(status) == start
    is_end = F.col(status).isin(*terminal)
    counted = events.groupBy(task).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(is_start).alias("n_started"),
        F.count_if(is_end).alias("n_terminal"),
        F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        F.min(F.when(is_start, F.col(ts))).alias("_start"),
        F.max(F.when(is_end, F.col(ts))).alias("_end"),
    )
    valid = ((F.col("n_started") == 1) & (F.col("n_terminal") == 1)
             & F.col("_start").eqNullSafe(F.col("_first")) & F.col("_end").eqNullSafe(F.col("_last")))
    if expected_events is not None:
        valid = valid & (F.col("n_events") == expected_events)
    return counted.select(task, "n_events", "n_started", "n_terminal", valid.alias("is_valid"))


def set_diff(a, b):
    """Values on one side only, with the side; no row means the sets are equal."""
    cols = a.columns
    left, right = a.distinct(), b.select(*cols).distinct()
    return (left.join(right, cols, "left_anti").withColumn("side", F.lit("left"))
            .unionByName(right.join(left, cols, "left_anti").withColumn("side", F.lit("right"))))


def cardinality_check(df, name, distinct, expected):
    """One row (check, actual, expected, passed): distinct values against what must be there.

    Values are grouped before they are counted, so a value with many rows costs no more than any.
    """
    return (df.select(*distinct).distinct().agg(F.count(F.lit(1)).alias("actual"))
            .select(F.lit(name).alias("check"), "actual", F.lit(expected).cast("bigint").alias("expected"),
                    (F.col("actual") == expected).alias("passed")))


def documents_per_group(df, by, expected):
    """Documents per group against a fixed number (4 scraper, 2 parser documents per chain)."""
    return (df.groupBy(*by).agg(F.count(F.lit(1)).alias("actual"))
            .withColumn("expected", F.lit(expected).cast("bigint"))
            .withColumn("passed", F.col("actual") == expected))

"""Read queries: file lists, pages, latest documents, counts, freshness."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.operators.filters import drop_control, eq_filter
from retail_lake.operators.scan import BEFORE_ALL, ROW_BITS, number_rows
from retail_lake.schemas import PAGE_SIZE

# A page this deep is still cheap as a top-n (each task keeps offset + size rows).
TOP_N_ROWS = 100_000


def to_row_content(df):
    """Response row: ``content`` becomes ``row_content``."""
    return df.select("row_index", "found_folder", "file_name", F.col("content").alias("row_content"))


def drop_technical(df, cols=("_id", "index")):
    """Drop store-internal columns."""
    return df.drop(*cols)


def explode_files(docs, files="files", keep=()):
    """One row per file of a document; documents without a list give none."""
    return docs.select(*keep, F.explode(files).alias("file_name"))


def explode_logs(docs, path, keep=()):
    """Nested log entries of all documents as rows."""
    return docs.select(*keep, F.explode(path).alias("log")).select(*keep, "log.*")


def file_rows(df, chain, file_type, file):
    """L3: rows of one file, markers dropped. Chain and type prune partitions, the name is pushed."""
    rows = eq_filter(df, {"chain": chain, "file_type": file_type, "file_name": file})
    return drop_control(rows)


def page(df, offset=0, size=PAGE_SIZE, order="row_index", bits=ROW_BITS, top_n=TOP_N_ROWS):
    """L1: rows ``[offset, offset + size)`` in order. ``order`` is unique in ``df``.

    A shallow page is a top-n. A deep page finds the buckets it falls into from per-bucket counts
    and numbers the rows of those buckets alone, so no task holds the skipped rows.
    """
    if offset < 0 or size < 0:
        raise ValueError("offset and size must not be negative")
    if offset + size <= top_n:
        return df.orderBy(order).offset(offset).limit(size)
    # A row without order key comes first, as in the top-n.
    bucketed = df.withColumn("_b", F.coalesce(F.shiftright(order, bits[0]).cast("bigint"), F.lit(BEFORE_ALL)))
    counts = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_b")  # one row per bucket
    starts = counts.withColumn("_end", F.sum("_n").over(upto))
    wanted = (starts.where((F.col("_end") > offset) & (F.col("_end") - F.col("_n") < offset + size))
              .select("_b", (F.col("_end") - F.col("_n")).alias("_start")))
    # No bucket is empty, so a page meets at most size + 1 of them.
    if size < TOP_N_ROWS:
        wanted = F.broadcast(wanted)
    inside = number_rows(bucketed.join(wanted, "_b"), ["_b"], order, out="_pos", bits=bits)
    at = F.col("_start") + F.col("_pos")
    return (inside.where((at >= offset) & (at < offset + size))
            .select(*df.columns).orderBy(order))


def page_meta(df, offset=0, size=PAGE_SIZE):
    """L1: one row: total_count, has_more, offset, chunk_size, next_cursor, prev_cursor."""
    if offset < 0 or size < 0:
        raise ValueError("offset and size must not be negative")
    more = F.lit(offset + size) < F.col("total_count")
    prev = F.lit(str(max(0, offset - size)) if offset > 0 else None).cast("string")
    return df.agg(F.count(F.lit(1)).alias("total_count")).select(
        "total_count", more.alias("has_more"),
        F.lit(offset).cast("bigint").alias("offset"), F.lit(size).cast("bigint").alias("chunk_size"),
        F.when(more, F.lit(str(offset + size))).alias("next_cursor"), prev.alias("prev_cursor"))


def parse_cursor(cursor):
    """L2: the offset a cursor stands for; anything but a non-negative integer is refused."""
    if not cursor:
        return 0
    try:
        offset = int(cursor)
    except ValueError:
        raise ValueError(f"a cursor is a row offset, not '{cursor}'") from None
    if offset < 0:
        raise ValueError(f"a cursor cannot be negative: {offset}")
    return offset


def page_after(df, last=None, size=PAGE_SIZE, order="row_index"):
    """L2 as keyset paging: the next rows after key ``last``; nothing is skipped over."""
    rows = df if last is None else df.where(F.col(order) > last)
    return rows.orderBy(order).limit(size)


def latest(df, by, ts):
    """The newest document per group; ``ts`` may be a struct with tie-breakers.

    Documents without ``ts`` count as oldest; a group that has no others keeps one of them.
    """
    rest = [c for c in df.columns if c not in by]
    at = F.col(ts) if isinstance(ts, str) else ts
    return (df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(at.isNotNull(), at)).alias("_row"))
            .select(*by, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def latest_file(df, by, ts="ts", name="file_name"):
    """The newest file per group; ties go to the last name, untimed files come first."""
    return (df.groupBy(*by)
            .agg(F.max(F.struct(F.col(ts).alias("ts"), F.col(name).alias("name"))).alias("_top"))
            .select(*by, F.col("_top.ts").alias(ts), F.col("_top.name").alias(name)))


def row_counts(df, by=("chain", "file_name")):
    """A10: rows per file."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("num_of_rows"))


def freshness(df, by, ts, as_of, seconds):
    """Latest write per table and whether it is less than ``seconds`` old at ``as_of``."""
    last = df.groupBy(*by).agg(F.max(ts).alias("last_update"))
    bound = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)"))
    return last.withColumn("is_updated", F.coalesce(F.col("last_update") > bound, F.lit(False)))

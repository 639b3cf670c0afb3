"""Shards of bounded size by extendible hashing.

A directory maps hash prefixes to shards. A prefix whose documents are over the byte limit is split on
one more bit, and only that one, until every shard fits. All steps are DataFrame functions: documents
are summed into cells of a prefix longer than the final depth should be, each cell sees the totals of
its prefixes of every length, and takes the shortest that fits. Cells that do not fit even whole are
cut again with more bits, alone. So what is handled per bit is the directory, not the documents.

Defined cases: a null text has 0 bytes; a null doc_id hashes as an empty string; an empty table has no
shard. Documents with one hash (repeated rows) cannot be told apart by bits; where they are over the
limit together, they are cut by their running size (``part``). A single document over the limit is a
shard of its own with ``oversized`` true. Only doc_id and text are read.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.llm.mixing import KEY_BITS, shuffle_key
from retail_lake.llm.scratch import written

# The tables at hand are small; for files of a large corpus take 256 MB or more.
SHARD_BYTES = 1 << 20
# Cells per shard, as bits: how much further than the expected depth one round looks.
SPARE_BITS = 4


def _prefix(bits):
    return F.shiftright("key", KEY_BITS - bits) if bits < KEY_BITS else F.col("key")


def _depths(cells, low, high, limit):
    """Shortest fitting prefix length in [low, high] for each cell of ``high`` bits; null if none."""
    levels = cells.select("cell", "cell_bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    totals = levels.groupBy("depth", "prefix").agg(F.sum("cell_bytes").alias("bytes")).where(F.col("bytes") <= limit)
    fits = levels.select("cell", "depth", "prefix").join(totals.select("depth", "prefix"), ["depth", "prefix"])
    return cells.join(fits.groupBy("cell").agg(F.min("depth").alias("depth")), "cell", "left").select("cell", "depth")


def directory(rows, limit, total):
    """(low bits, high bits, cells with depth) for each round; ``rows`` has key and n_bytes."""
    rounds, low, left = [], 0, rows
    high = min(KEY_BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    while True:
        cells = left.groupBy(_prefix(high).alias("cell")).agg(F.sum("n_bytes").alias("cell_bytes"))
        found = written(_depths(cells, low, high, limit), "shard-cells")
        rounds.append((high, found))
        open_cells = found.where(F.col("depth").isNull()).select("cell")
        if high == KEY_BITS or open_cells.isEmpty():
            return rounds
        left = left.withColumn("cell", _prefix(high)).join(open_cells, "cell", "left_semi").drop("cell")
        low, high = high + 1, min(KEY_BITS, high + 8)


def shards(docs, limit=SHARD_BYTES):
    """doc_id, n_bytes, shard, depth, shard_bytes, shard_docs and oversized of every document.

    ``shard`` is the hash prefix in bits, then ``-`` and a number where one hash had to be cut.
    """
    rows = written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"),
        shuffle_key(F.col("doc_id")).alias("key")), "shard-sizes")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    left, done = rows, []
    for high, cells in directory(rows, limit, total):
        placed = left.withColumn("cell", _prefix(high)).join(cells, "cell", "left").drop("cell")
        done.append(placed.where(F.col("depth").isNotNull()).withColumn("part", F.lit(0).cast("bigint")))
        left = placed.where(F.col("depth").isNull()).drop("depth")
    # One hash over the limit: parts by running size; a part takes whole documents only.
    running = Window.partitionBy("key").orderBy("doc_id", "n_bytes").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("n_bytes").over(running)
    done.append(left.select("doc_id", "n_bytes", "key", F.lit(KEY_BITS).alias("depth"),
                            (1 + F.floor((upto - 1) / F.greatest(F.lit(1), F.lit(limit) - F.max("n_bytes").over(
                                Window.partitionBy("key"))))).cast("bigint").alias("part")))
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    bits = F.lpad(F.conv(F.col("key").cast("string"), 10, 2), KEY_BITS, "0")
    placed = placed.select("doc_id", "n_bytes", "depth", F.concat(
        F.substring(bits, F.lit(1), F.col("depth")),
        F.when(F.col("part") > 0, F.concat(F.lit("-"), F.col("part"))).otherwise("")).alias("shard"))
    sizes = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return placed.join(sizes, "shard").select(
        "doc_id", "n_bytes", "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_docs",
        (F.col("shard_bytes") > limit).alias("oversized"))


# DuckDB: every prefix length of every document; the shortest with a total within the limit.
SQL = f"""
WITH sized AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
levels AS (
  SELECT doc_id, n_bytes, key, depth, sum(n_bytes) OVER (PARTITION BY depth, key >> ({KEY_BITS} - depth)) AS shard_bytes,
         count(*) OVER (PARTITION BY depth, key >> ({KEY_BITS} - depth)) AS shard_docs
  FROM sized, (SELECT CAST(unnest(range({KEY_BITS} + 1)) AS INTEGER) AS depth)),
fits AS (
  SELECT * FROM levels WHERE shard_bytes <= {SHARD_BYTES} OR depth = {KEY_BITS}
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY depth) = 1)
SELECT doc_id, n_bytes, substr(lpad(bin(key), {KEY_BITS}, '0'), 1, depth) AS shard, depth,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, CAST(shard_docs AS BIGINT) AS shard_docs,
       shard_bytes > {SHARD_BYTES} AS oversized
FROM fits
"""

"""Mix sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, up to ``REPEATS`` times over. A copy's virtual
finish time is the source's cumulative size up to and with it, divided by the source's target; the
copies of all sources are ordered by that time and cut where their running total passes the budget.

All steps are DataFrame functions. Cumulative sums run inside buckets of the shuffle key, and carry
the totals of earlier buckets in, so a source with a third of all documents is spread like any other.
The global order is cut the same way: only the bucket of virtual time in which the budget ends is
sorted row by row; all earlier ones are in and all later ones are out.

Defined cases: a null text has size 0; sizes 0 are never taken; a null source is a source of its own,
after all others; an empty table gives an empty result; repeated rows are documents of their own; ties
in the shuffle key go by doc_id and size. Only doc_id, source and text are read.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.llm.scratch import all_columns, written

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3
WEIGHTS = (1, 2, 3)
# Documents in one bucket of the shuffle key, and documents per bucket of virtual time, about.
BUCKET_ROWS = 1 << 10
SLOT_ROWS = 1 << 16
KEY_BITS = 60


def shuffle_key(doc_id):
    """A 60-bit key that orders documents at random but alike in every run."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def sized(docs):
    """doc_id, source, size in words, and shuffle key of every document."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        shuffle_key(F.col("doc_id")).alias("key"))


def source_targets(totals, weights=WEIGHTS, repeats=REPEATS):
    """Add rank, weight and target to (source, source_size).

    The whole size is shared by weight; a target stops at ``repeats`` times its source's size and the
    excess is shared again by weight until none is above. Each round is one aggregate of the sources.
    """
    ordered = written(totals.orderBy(F.asc_nulls_last("source"))
                      .select("*", F.monotonically_increasing_id().alias("place")), "mix-sources")
    # Places are (partition, row in it); ranks continue over the partitions.
    part = F.shiftright("place", 33)
    firsts = (ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
              .select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before")))
    ranked = ordered.withColumn("part", part).join(firsts, "part").select(
        "source", "source_size",
        (F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"))
    each = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = written(ranked.select("*", F.element_at(
        each, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")), "mix-ranks")
    cap = repeats * F.col("source_size")
    share, held, found = None, F.lit(False), 0
    while True:
        row = ranked.agg(
            F.sum("source_size").alias("all"), F.count(F.when(held, 1)).alias("held"),
            F.sum(F.when(held, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(~held, F.col("weight")).otherwise(0)).alias("rest"),
        ).first()
        if share is not None and row["held"] == found:
            break
        found = row["held"]
        share = (row["all"] - row["capped"]) / row["rest"] if row["rest"] else 0.0
        held = held | (F.col("weight") * F.lit(share) > cap)
    target = F.when(held, cap.cast("double")).otherwise(F.col("weight") * F.lit(share))
    return ranked.withColumn("target", target), row["all"] or 0


def _bits(rows):
    return max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))


def queued(docs_sized, targets):
    """Add source_size, rank, target and ``upto``: the source's cumulative size with the document."""
    bucket = F.shiftright("key", KEY_BITS - _bits(docs_sized.count()))
    rows = docs_sized.withColumn("bucket", bucket).withColumn("has_source", F.col("source").isNotNull())
    rows = rows.withColumn("source", F.coalesce("source", F.lit("")))
    group = ["has_source", "source"]
    totals = rows.groupBy(*group, "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = totals.select(*group, "bucket", (F.sum("bucket_size").over(
        Window.partitionBy(*group).orderBy("bucket")) - F.col("bucket_size")).alias("before"))
    named = targets.select(F.col("source").isNotNull().alias("has_source"),
                           F.coalesce("source", F.lit("")).alias("source"), "source_size", "rank", "target")
    inside = Window.partitionBy(*group, "bucket").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("local", F.sum("size").over(inside))
            .join(earlier.join(named, group), [*group, "bucket"])
            .select("doc_id", "key", "size", F.when(F.col("has_source"), F.col("source")).alias("source"),
                    "source_size", "rank", "target", (F.col("before") + F.col("local")).alias("upto")))


def _copies(queue, repeats):
    """One row per copy, with its virtual finish time."""
    copies = queue.where(F.col("size") > 0).withColumn(
        "copy", F.explode(F.array(*[F.lit(i) for i in range(repeats)])))
    return copies.withColumn("finish", (F.col("copy") * F.col("source_size") + F.col("upto")) / F.col("target"))


def last_taken(queue, budget, repeats=REPEATS):
    """(finish, rank, copy, key, doc_id, size) of the last copy within the budget, or None."""
    copies = _copies(queue, repeats)
    per_unit = max(1, queue.count() // SLOT_ROWS)
    copies = copies.withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(4.0)) * per_unit))
    slots = copies.groupBy("slot").agg(F.sum("size").alias("slot_size"))
    upto = slots.withColumn("upto_slot", F.sum("slot_size").over(Window.orderBy("slot")))
    end = upto.agg(F.min(F.when(F.col("upto_slot") > budget, F.struct("slot", "upto_slot", "slot_size"))).alias("at"),
                   F.max("slot").alias("last"), F.sum("slot_size").alias("all")).first()
    if end["last"] is None:
        return None
    slot, before = (end["last"] + 1, end["all"]) if end["at"] is None else (
        end["at"]["slot"], end["at"]["upto_slot"] - end["at"]["slot_size"])
    order = ["finish", "rank", "copy", "key", "doc_id", "size"]
    running = F.sum("size").over(Window.partitionBy("slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    inside = (copies.where(F.col("slot") == slot).withColumn("total", running + F.lit(before))
              .where(F.col("total") <= budget).agg(F.max(F.struct(*order)).alias("end")).first()["end"])
    return inside or copies.where(F.col("slot") < slot).agg(F.max(F.struct(*order)).alias("end")).first()["end"]


def mix(docs, weights=WEIGHTS, repeats=REPEATS):
    """doc_id, source, key, size, source_size, target, n_copies and taken of every document."""
    rows = written(sized(docs), "mix-sizes")
    targets, budget = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    queue = written(queued(rows, targets), "mix-queue")
    end = last_taken(queue, budget, repeats)
    copies = F.lit(0)
    if end is not None:
        cut = F.struct(F.lit(end["finish"]).cast("double"), *[
            F.lit(end[c]).cast("int" if c == "copy" else "bigint") for c in ("rank", "copy", "key", "doc_id", "size")])
        for i in range(repeats):
            finish = (F.lit(i) * F.col("source_size") + F.col("upto")) / F.col("target")
            at = F.struct(finish, "rank", F.lit(i), "key", "doc_id", "size")
            copies = copies + F.when((F.col("size") > 0) & (at <= cut), 1).otherwise(0)
    return queue.select("doc_id", "source", "key", "size", "source_size", "target", copies.alias("n_copies"),
                        (F.col("size") * copies).cast("bigint").alias("taken"))


def mixed_documents(docs, weights=WEIGHTS, repeats=REPEATS):
    """The documents the mix takes, with all their columns, as often as it takes them."""
    plan = mix(docs, weights, repeats).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "n_copies")
    # Rows alike in id, source and size are told apart by number, so that a join pairs them one to one.
    nth = Window.partitionBy("_id", "_source", "_size")
    key = [F.coalesce(F.col("_id").cast("string"), F.lit("")), F.coalesce("_source", F.lit("")), F.col("_size"),
           F.col("_id").isNull(), F.col("_source").isNull()]
    plan = plan.withColumn("_nth", F.row_number().over(nth.orderBy(F.desc("n_copies"))))
    plan = plan.select(*[k.alias(f"_k{i}") for i, k in enumerate(key)], F.col("_nth"), "n_copies").where("n_copies > 0")
    rows = docs.select(
        F.struct(*all_columns(docs)).alias("_row"), F.col("doc_id").cast("bigint").alias("_id"),
        F.col("source").cast("string").alias("_source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("_size"))
    rows = rows.withColumn("_nth", F.row_number().over(nth.orderBy(F.xxhash64("_row"))))
    rows = rows.select("_row", *[k.alias(f"_k{i}") for i, k in enumerate(key)], "_nth")
    return (rows.join(plan, [*[f"_k{i}" for i in range(len(key))], "_nth"])
            .select("_row", F.explode(F.array_repeat(F.lit(1), F.col("n_copies")))).select("_row.*"))


# DuckDB: the same mix with one window over all copies.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (SELECT *, 1 + rank % 3 AS weight, 3 * source_size AS cap FROM sources),
-- Sources in the order in which their caps bind; the first k of them are held at their cap.
capped AS (
  SELECT *, coalesce(sum(cap) OVER before_it, 0) AS held, sum(weight) OVER from_it AS rest,
         sum(source_size) OVER () AS whole
  FROM weighed
  WINDOW before_it AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         from_it AS (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
shared AS (
  SELECT (CAST(whole AS BIGINT) - CAST(held AS BIGINT)) / CAST(rest AS BIGINT) AS share FROM capped
  WHERE weight * ((whole - held) / rest) <= cap ORDER BY cap / weight, rank LIMIT 1),
targets AS (
  SELECT source, source_size, rank, CAST(least(weight * coalesce((SELECT share FROM shared), 0), cap) AS DOUBLE) AS target
  FROM weighed),
queue AS (
  SELECT d.*, t.source_size, t.rank, t.target,
         CAST(sum(size) OVER (PARTITION BY t.rank ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, size, source_size, rank, target, key, upto, copy, (copy * source_size + upto) / target AS finish
  FROM queue, (SELECT unnest([0, 1, 2]) AS copy) WHERE size > 0),
taken AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, copy, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS total FROM copies),
kept AS (
  SELECT doc_id, rank, upto, CAST(sum(size) AS BIGINT) AS words FROM taken
  WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id, rank, upto)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.words, 0) AS taken
FROM queue q LEFT JOIN kept k ON q.size > 0 AND q.doc_id IS NOT DISTINCT FROM k.doc_id AND q.rank = k.rank AND q.upto = k.upto
"""

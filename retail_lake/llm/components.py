"""Connected components of an edge table by alternating large-star and small-star steps.

Every step keeps at most as many rows as there are edges and never gathers the neighbours of a node:
it joins each edge with the least neighbour of its end, an aggregate with map-side combine, so a hub
with a third of all edges is split like any skewed join.
"""

from functools import reduce

from pyspark.sql import functions as F

from retail_lake.llm.scratch import drop, written_at


def _large(edges):
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges, rounds=60):
    """(a, b): every node of ``edges`` (a, b of one type) but the least of its component, and that least.

    The tables of earlier rounds are dropped. ``rounds`` is no bound in practice: a chain of n links in a row
    takes about log2(n) rounds, so 60 are enough for any table; more mean a fault, and raise RuntimeError.
    """
    spark = edges.sparkSession
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    current, path = written_at(edges.where(F.col("a") != F.col("b")).select(*ends).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        row = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if row["n"] == 0 or (row["n"], row["s"]) == mark:
            return current
        mark, before = (row["n"], row["s"]), path
        current, path = written_at(reduce(lambda e, step: step(e), (_large, _small), current), "edges")
        drop(spark, [before])
    raise RuntimeError(f"components are not settled after {rounds} rounds")

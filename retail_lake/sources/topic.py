"""Bounded and streaming reads of a topic (SRC7, ST5)."""

from pyspark.sql import functions as F

from retail_lake.functions.values import canonical_json, once


def read_messages(spark, target, fmt="parquet", **options):
    """All messages of a topic store, from the earliest on, without a row cap."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "subscribe": target, **options}
        return spark.read.format("kafka").options(**options).load().select(
            "topic", F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"))
    return spark.read.format(fmt).options(**options).load(target)


def with_canonical(df, value="value"):
    """Add ``canonical``: the document with sorted keys, null where the value is no JSON."""
    return df.withColumn("canonical", canonical_json(value))


def is_control_message(value="value"):
    """Whether a message is a warm-up or flush message."""
    def marked(name):
        return F.contains(F.col(value), F.lit(name)) & F.coalesce(
            F.get_json_object(value, f"$.{name}") == "true", F.lit(False))

    return marked("warmup") | marked("flush")


def drop_control_messages(df, value="value"):
    """F3 on messages: warm-up and flush messages are no data."""
    return df.where(~is_control_message(value))


def topic_updated(df, topic="topic", value="value"):
    """A8 for topics: a topic counts as updated once it holds any data message."""
    return df.groupBy(topic).agg(F.bool_or(~is_control_message(value)).alias("is_updated"))


def clean_topic(df, value="value", topic="topic", ts=None, delay=None):
    """SRC7/S5/ST5: data messages, each document of a topic once whatever its key order; raw text passes as is.

    Works on a stream too, where the seen digests are kept in checkpointed state; ``ts`` and ``delay``
    bound that state for a stream whose repeats come within ``delay``.
    """
    # A generator's columns are computed once: no filter on them is pushed to where they are made.
    told = once(canonical_json(value), lambda c: F.struct(c.alias("canonical"), F.sha2(c, 256).alias("digest")))
    tagged = drop_control_messages(df, value).select("*", F.inline(F.array(told)))
    keys = [topic, "digest"] if topic in df.columns else ["digest"]
    if not df.isStreaming:
        # One pass: raw text has a key of its own, so that it is never a repeat.
        own = F.when(F.col("digest").isNull(), F.monotonically_increasing_id())
        return tagged.withColumn("_own", own).dropDuplicates([*keys, "_own"]).drop("digest", "_own")
    docs = tagged.where(F.col("canonical").isNotNull())
    docs = (docs.dropDuplicates(keys) if ts is None
            else docs.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys))
    return docs.unionByName(tagged.where(F.col("canonical").isNull())).drop("digest")

"""Topic messages: keyed JSON rows, flush and warm-up messages (SNK3-SNK5)."""

from pyspark.sql import functions as F

from retail_lake.functions.values import encode_doc

# Control messages.
FLUSH = '{"flush":"true"}'
WARMUP_KEY = "this is a warmup message"
WARMUP = '{"file_name":"this is a warmup message","warmup":"true"}'


def messages(df, topic, key="file_name", cols=None):
    """SNK3: one message per row: topic, key, JSON value."""
    name = topic if not isinstance(topic, str) else F.lit(topic)
    return df.select(name.alias("topic"), F.col(key).alias("key"),
                     encode_doc(cols or df.columns).alias("value"))


def flush_messages(batch, topic, key="file_name"):
    """SNK4: one flush message per distinct key of a batch; written after the batch."""
    name = topic if not isinstance(topic, str) else F.lit(topic)
    return (batch.select(name.alias("topic"), F.col(key).alias("key")).distinct()
            .withColumn("value", F.lit(FLUSH)))


def warmup_messages(registry):
    """SNK5: the row that makes a topic exist, one per table."""
    return registry.select(F.col("table_name").alias("topic"), F.lit(WARMUP_KEY).alias("key"),
                           F.lit(WARMUP).alias("value"))


def append(rows, target, fmt="parquet", **options):
    """Write messages: ``fmt="kafka"`` with its options on a cluster, a file format elsewhere."""
    writer = rows.write.format(fmt).mode("append").options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.save(target)

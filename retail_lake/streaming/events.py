"""Streaming reads, event dedup and topic flow (ST2, ST3, ST5, SNK3, SNK4)."""

from pyspark.sql import functions as F

from retail_lake.sinks import topic as topic_sink
from retail_lake.sources.topic import clean_topic


def read_stream(spark, path, schema, fmt="parquet", max_files=None, max_bytes=None, **options):
    """ST3: files of a folder as a stream; batches are bounded by files or bytes, not by rows."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def new_events(events, ts=None, delay=None):
    """ST2: each (source file, digest) once; the checkpointed state is the ledger.

    With ``ts`` and ``delay`` ids are forgotten once the watermark passes them, for a stream whose
    repeats come within ``delay``.
    """
    keys = ["source_file", "digest"]
    if ts is None:
        return events.dropDuplicates(keys)
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def clean_messages(messages, ts=None, delay=None):
    """ST5: the stream of a topic without control messages, each document once.

    With ``ts`` and ``delay`` documents are forgotten once the watermark passes them.
    """
    return clean_topic(messages, ts=ts, delay=delay)


def topic_writer(target, topic, key="file_name", cols=None, fmt="parquet", **options):
    """SNK3/SNK4: ``foreachBatch`` function: the messages of a batch, then a flush per key.

    The batch is computed once for both. File targets get a folder per batch, which a retry overwrites;
    messages of a broker carry the batch id in a header, so that readers can drop those of a retry.
    """
    def write(batch, batch_id):
        batch = batch.persist()
        try:
            _write(batch, batch_id)
        finally:
            batch.unpersist()

    def _write(batch, batch_id):
        rows = topic_sink.messages(batch, topic, key, cols)
        flush = topic_sink.flush_messages(batch, topic, key)
        for part, frame in (("0", rows), ("1", flush)):
            if fmt == "kafka":
                header = F.struct(F.lit("batch_id").alias("key"), F.lit(str(batch_id)).cast("binary").alias("value"))
                (frame.withColumn("headers", F.array(header)).write.format("kafka")
                 .option("includeHeaders", "true").options(**options).save())
            else:
                (frame.write.format(fmt).mode("overwrite").options(**options)
                 .save(f"{target}/batch_id={batch_id}/part={part}"))
    return write


def run_available(stream, sink, checkpoint, **options):
    """Run a stream over all input there is, then stop; returns the query, whose progress can be read.

    ``sink`` is a path or a batch function.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if callable(sink):
        started = writer.foreachBatch(sink).start()
    else:
        started = writer.format("parquet").outputMode("append").options(**options).start(sink)
    started.awaitTermination()
    return started

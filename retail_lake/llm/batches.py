"""Arrow batches cut to a bounded number of bytes inside Python workers."""

import ctypes
import os

import pyarrow as pa
import pyarrow.compute as pc

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Bytes of text that one numpy or Python step works on at a time.
CHUNK_BYTES = 512 << 10


# Rows of a record batch sent to Python, unless the session says otherwise: texts are long.
BATCH_ROWS = "1000"
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark):
    """Let Python workers on the same files import this package, wherever the session was started.

    On a cluster the package reaches the executors by spark-submit's ``--py-files`` as usual. Record
    batches of a session that left them at Spark's default are made smaller.
    """
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def give_back():
    """Return freed memory, which a long-lived worker would keep, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df, fn, schema):
    """``df.mapInArrow`` with a function of this package; a worker gives memory back after each task."""
    importable(df.sparkSession)

    def run(parts):
        yield from fn(parts)
        give_back()

    return df.mapInArrow(run, schema)


def chunks(batches, column, limit=CHUNK_BYTES):
    """Yield slices of the record batches that hold about ``limit`` bytes of ``column`` at most.

    A single longer value comes alone. Null values count as empty.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def records(columns, schema):
    """A record batch of plain lists or arrays in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

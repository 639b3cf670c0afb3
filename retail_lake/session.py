"""Session settings and the shared scratch folder."""

import contextlib
import gc
import os
import tempfile
import time
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Tables with texts and digests in hexadecimal take about half of what they take with Spark's default.
PACKED = {"compression": "zstd"}
# A write of at least so many seconds may have moved much.
SWEEP_SECONDS = 2.0
# The listeners of a session hold the plan of a write for a moment after its end.
LISTENERS_SECONDS = 0.3


def build_session(master=None, app="retail-lake", **conf):
    """A session with the settings the jobs are written for; ``conf`` wins over them.

    ``master`` is left to spark-submit on a cluster, and so is every setting given there. Shuffles
    start with many partitions; AQE merges the small ones and splits skewed join partitions.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # The state of a stream lives on disk beside the heap, and grows with what the stream has seen.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if master and master.startswith("local"):
        settings |= {"spark.ui.enabled": "false", "spark.driver.bindAddress": "127.0.0.1",
                     "spark.driver.host": "127.0.0.1"}
    else:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "20000"
    given = SparkConf()
    settings = {k: v for k, v in settings.items() if not given.contains(k)} | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark, name):
    """A new folder every executor can reach, under the cluster's checkpoint folder.

    Only where the session names none and runs on one machine (a test) is a local folder used.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    if not root:
        root = tempfile.mkdtemp(prefix="retail-lake-")
        return os.path.join(root, name)
    return f"{root.rstrip('/')}/retail-lake/{name}-{uuid.uuid4().hex}"


def remove(spark, path):
    """Delete a scratch folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def swept(spark):
    """Around the write of a table: if it took long, the shuffle files of jobs that have ended go after it.

    They go with the driver's garbage, which else is collected when memory gets short, and a query of many steps may hold
    those of all its steps. What can still be asked for stays.
    """
    began = time.monotonic()
    yield
    if time.monotonic() - began >= SWEEP_SECONDS:
        gc.collect()
        time.sleep(LISTENERS_SECONDS)
        spark.sparkContext._jvm.System.gc()

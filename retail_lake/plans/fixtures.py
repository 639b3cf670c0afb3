"""Views that give the driver's tables the shape of price-file data.

Each view is one projection of one table, written in SQL that Spark and DuckDB read alike; Spark
evaluates it in the scan stage, and the same text opens the check SQL.
"""

import os
import urllib.parse

from pyspark.sql import functions as F

_CHAIN20 = "'chain' || CAST({k} % 20 AS STRING)"
_ORDER_CHAIN = _CHAIN20.format(k="o_orderkey")
_STARTS = "(o_orderkey < 20 OR o_custkey % 7 = 0)"
_FILE = ("'PriceFull' || CAST(7290000000000 + o_orderkey % 20 AS STRING) || '-' "
         "|| lpad(CAST(o_custkey % 5 AS STRING), 3, '0') || '-202401010000.xml'")
_ROW = "CAST((o_orderkey - o_orderkey % 20) / 20 AS BIGINT)"
_EVENT_CHAIN = "'chain' || CAST(user_id % 7 AS STRING)"
_DOC_CHAIN = _CHAIN20.format(k="o_custkey")
_LINE_CHAIN = _CHAIN20.format(k="l_suppkey")
_DOC_TYPE = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'STORE_FILE' WHEN '2-HIGH' THEN 'PRICE_FILE' "
             "WHEN '3-MEDIUM' THEN 'PROMO_FILE' WHEN '5-LOW' THEN 'PROMO_FULL_FILE' "
             "ELSE 'PRICE_FULL_FILE' END")

VIEWS = {
    # Wide landing rows: keys only where a file begins, gaps in the content.
    "fx_rows": ("orders", [
        f"'price_full_file_' || {_ORDER_CHAIN} AS table_name",
        "'PRICE_FULL_FILE' AS file_type",
        f"{_ORDER_CHAIN} AS chain",
        f"{_ROW} AS row_index",
        f"CASE WHEN {_STARTS} THEN 'dumps/' || {_ORDER_CHAIN} END AS found_folder",
        f"CASE WHEN {_STARTS} THEN {_FILE} END AS file_name",
        "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS item_code",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS STRING) END AS item_price",
        "CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderpriority END AS unit",
    ]),
    # The same rows as the store holds them: keys on every row.
    "fx_stored": ("orders", [
        f"'price_full_file_' || {_ORDER_CHAIN} AS table_name",
        "'PRICE_FULL_FILE' AS file_type",
        f"{_ORDER_CHAIN} AS chain",
        f"{_ROW} AS row_index",
        f"'dumps/' || {_ORDER_CHAIN} AS found_folder",
        f"{_FILE} AS file_name",
        "CAST(o_custkey AS STRING) AS item_code",
        "CAST(o_totalprice AS STRING) AS item_price",
        "CASE WHEN o_custkey % 97 = 0 THEN 'true' END AS file_complete",
    ]),
    # Status events.
    "fx_events": ("events", [
        "event_id", "ts", "CAST(user_id AS STRING) AS task_id", "event_type AS status",
        "CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS value",
        f"{_EVENT_CHAIN} AS chain", f"{_EVENT_CHAIN} || '.json' AS source_file", "props",
    ]),
    # Parser status documents, some without a timestamp, with three files each.
    "fx_docs": ("orders", [
        "o_orderkey AS doc_id", f"{_DOC_CHAIN} AS chain", f"{_DOC_TYPE} AS file_type",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS ts",
        "o_orderstatus AS status",
        "'PriceFull-' || lpad(CAST(o_custkey % 40 AS STRING), 3, '0') || '-a' || CAST(o_orderkey AS STRING) AS file_a",
        "'PriceFull-' || lpad(CAST(o_orderkey % 40 AS STRING), 3, '0') || '-b' || CAST(o_orderkey AS STRING) AS file_b",
    ]),
    # Files of a document with their fate; a run is (chain, year), files recur across runs.
    "fx_doc_files": ("lineitem", [
        f"{_LINE_CHAIN} AS chain",
        "CAST(year(l_shipdate) AS BIGINT) AS run",
        "'PriceFull-' || CAST(l_suppkey % 20 AS STRING) || '-' || lpad(CAST(l_partkey % 200 AS STRING), 3, '0') AS file_name",
        "l_returnflag <> 'R' AND l_partkey % 200 >= CASE WHEN l_suppkey % 20 = 3 THEN 8 ELSE 1 END AS downloaded",
        "l_tax > 0.01 AS in_parser",
        "l_discount >= 0.02 AS parsed",
        "CASE WHEN l_linestatus = 'F' THEN 'timeout' END AS error",
        "l_quantity > 10 AS loaded",
    ]),
}


def table(spark, sf_dir, name):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def view(spark, sf_dir, name):
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*columns)


def view_sql(name):
    source, columns = VIEWS[name]
    return f"SELECT {', '.join(columns)} FROM {source}"


def with_views(names, body):
    """Check SQL over the named views."""
    heads = ", ".join(f"{n} AS ({view_sql(n)})" for n in names)
    return f"WITH RECURSIVE {heads} {body}"


def log_lines(events, log, order, is_global, event):
    """(log, part, at, value): the lines of status logs, one event a line; in this order they are the files.

    ``order`` is unique in a log. No list of events is gathered: a comma stands before every event but the first.
    """
    body = events.select(log.alias("log"), is_global.cast("int").alias("part"), order.cast("bigint").alias("at"),
                         F.to_json(event).alias("text"))
    first = body.groupBy("log", "part").agg(F.min("at").alias("at")).withColumn("first", F.lit(True))
    body = body.join(first, ["log", "part", "at"], "left").select(
        "log", "part", "at", F.when(F.col("first"), F.col("text")).otherwise(F.concat(F.lit(","), F.col("text"))).alias("value"))
    marks = [(0, '{"events":['), (1, '],"global_status":['), (2, "]}")]
    frame = F.explode(F.array(*[F.struct(F.lit(n).alias("part"), F.lit(-1).cast("bigint").alias("at"), F.lit(v).alias("value"))
                                for n, v in marks])).alias("m")
    return body.unionByName(body.select("log").distinct().select("log", frame).select("log", "m.*"))


def empty_folder(spark, folder):
    """A new folder without files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def give_names(spark, source, target, suffix):
    """Move the one file of every folder ``dir=NAME`` of ``source`` to ``target/NAME.suffix``; a name may have folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target))
    for folder in system.listStatus(path(source)):
        name = folder.getPath().getName()
        if name.startswith("dir="):
            parts = [f.getPath() for f in system.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise ValueError(f"{len(parts)} files in {name}")
            named = path(f"{target}/{urllib.parse.unquote(name.removeprefix('dir='))}.{suffix}")
            system.mkdirs(named.getParent())
            system.rename(parts[0], named)

"""Registered queries through files and streams (SRC1, SRC5, SRC6, SRC10, SNK1, SNK8, SNK9, ST2-ST5, ST7, A9, F8)."""

from pyspark.sql import functions as F

from retail_lake.functions.names import snapshot_message
from retail_lake.operators import access, catalog, filters, versions
from retail_lake.operators.status import with_digest
from retail_lake.plans.fixtures import VIEWS, give_names, log_lines, table, view, with_views
from retail_lake.plans.ingest_queries import _MARKERS, _RUNS, MARK
from retail_lake.plans.registry import query
from retail_lake.plans.status_queries import FIELDS, copied as copied_events, topic_rows
from retail_lake.session import shared_dir
from retail_lake.sinks import snapshot, store
from retail_lake.sources import files, tables
from retail_lake.sources.status_logs import read_logs
from retail_lake.streaming import events as event_stream
from retail_lake.streaming import markers as marker_stream

SLICE = 5000


@query("csv_rows", with_views(["fx_rows"], (
    f"SELECT table_name, row_index AS landed_at, row_index % {SLICE} AS row_index, item_code, unit FROM fx_rows")))
def csv_rows(spark, sf_dir):
    """SRC1-SRC3: CSV files with the position of each row in its file.

    A file holds one slice of a table in row order, so a row's position in it is known.
    """
    rows = view(spark, sf_dir, "fx_rows").select(
        F.col("table_name").alias("landed_in"), F.col("row_index").alias("landed_at"), "item_code", "unit",
        F.col("table_name").alias("dir"), F.floor(F.col("row_index") / SLICE).alias("slice"))
    folder = shared_dir(spark, "csv")
    (rows.repartition("dir", "slice").sortWithinPartitions("dir", "slice", "landed_at")
     .write.partitionBy("dir", "slice").option("header", True).csv(folder))
    columns = ["landed_in", "landed_at", "item_code", "unit"]
    landed = files.read_csv_rows(spark, folder, columns)
    return landed.select(F.col("landed_in").alias("table_name"), F.col("landed_at").cast("bigint").alias("landed_at"),
                         "row_index", "item_code", "unit")


@query("xml_rows", (
    "SELECT p_partkey AS item_code, p_name AS item_name, p_retailprice AS item_price, 'dump' AS folder FROM part"))
def xml_rows(spark, sf_dir):
    """SRC5: XML dumps as rows with the dump folder."""
    folder = f"{shared_dir(spark, 'xml')}/dump"
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_code"), F.col("p_name").alias("item_name"),
        F.col("p_retailprice").alias("item_price"))
    parts.write.format("xml").option("rowTag", "Item").option("rootTag", "Root").save(folder)
    rows = files.read_xml_rows(spark, folder, "Item", "item_code bigint, item_name string, item_price double")
    return rows.select("item_code", "item_name", "item_price", F.col("found_folder").alias("folder"))


@query("status_logs", with_views(["fx_events"], (
    "SELECT CAST(event_id AS STRING) AS event_id, CASE WHEN status = 'error' THEN 'global_status' ELSE 'events' END AS part, "
    "status, task_id FROM fx_events")))
def status_logs(spark, sf_dir):
    """SRC4, X12: one status log that holds all events, read in blocks as one row per event."""
    events, folder = view(spark, sf_dir, "fx_events"), shared_dir(spark, "logs")
    lines = log_lines(events, F.lit("all"), F.col("event_id"), F.col("status") == "error", F.struct("event_id", "status", "task_id"))
    (lines.withColumnRenamed("log", "dir").repartition("dir").sortWithinPartitions("dir", "part", "at")
     .select("dir", "value").write.partitionBy("dir").text(f"{folder}/parts"))
    give_names(spark, f"{folder}/parts", f"{folder}/files", "json")
    rows, _ = read_logs(spark, f"{folder}/files")
    event = F.from_json("payload", "map<string,string>")
    return rows.select(
        event["event_id"].alias("event_id"), "part", event["status"].alias("status"), event["task_id"].alias("task_id"))


@query("dataset_file", "SELECT CAST(s_suppkey AS STRING) AS s_suppkey, s_name FROM supplier")
def dataset_file(spark, sf_dir):
    """SRC9: a file of the dataset, read by its extension."""
    folder = shared_dir(spark, "dataset")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").write.option("header", True).csv(f"{folder}/suppliers.csv")
    return files.read_file(spark, folder, "suppliers.csv")


@query("report_export", with_views(["fx_events"], (
    "SELECT task_id, count(*) AS num_of_rows FROM fx_events GROUP BY task_id")))
def report_export(spark, sf_dir):
    """SNK10, A10: results written as JSON and read back."""
    folder = shared_dir(spark, "report")
    counts = access.row_counts(view(spark, sf_dir, "fx_events"), ["task_id"])
    store.write_report(counts, f"{folder}/counts.json")
    return spark.read.schema(counts.schema).json(f"{folder}/counts.json")


@query("stored_rows", with_views(["fx_stored"], (
    "SELECT row_index, file_name, item_code, chain, false AS by_partition FROM fx_stored UNION ALL "
    "SELECT row_index, file_name, item_code, chain, true FROM fx_stored WHERE chain = 'chain4' AND file_name LIKE '%-003-%'")))
def stored_rows(spark, sf_dir):
    """SNK1, SRC6, F1: rows written to the store, all read back, and those of a chain and store by partition and file."""
    root = shared_dir(spark, "rows")
    rows = view(spark, sf_dir, "fx_stored").withColumn("batch_id", F.lit(0))
    store.write_rows(rows, root, 0)

    columns = ["row_index", "file_name", "item_code", "chain"]
    every = tables.read_table(spark, root, rows.schema, {}).select(*columns, F.lit(False).alias("by_partition"))
    some = tables.read_table(spark, root, rows.schema, {"chain": "chain4", "file_type": "PRICE_FULL_FILE"})
    return every.unionByName(some.where(F.col("file_name").contains("-003-")).select(*columns, F.lit(True).alias("by_partition")))



@query("snapshot_restore", with_views(["fx_stored"], (
    "SELECT table_name, file_type, lpad(substr(chain, 6), 3, '0') AS chain, row_index, found_folder, file_name, item_code, "
    "item_price, file_complete FROM fx_stored")))
def snapshot_restore(spark, sf_dir):
    """SNK8, SRC10: a published version read back whole; the chains have names like numbers."""
    root = shared_dir(spark, "snapshot")
    events = view(spark, sf_dir, "fx_events").select("event_id", "source_file", "status")
    rows = view(spark, sf_dir, "fx_stored").withColumn("chain", F.lpad(F.substring("chain", 6, 9), 3, "0"))
    snapshot.write_snapshot(rows, events, root, 0)
    back = snapshot.read_snapshot(spark, root, 0, chains=[f"{i:03d}" for i in range(20)])
    return back.select(*rows.columns)


def version_rows(spark, sf_dir):
    """One version per day of events: the day number, made at the last event of the day."""
    events = view(spark, sf_dir, "fx_events").select("ts")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint")
    return events.groupBy(day.alias("version")).agg(F.max("ts").alias("created_at"))


_VERSIONS = ("versions AS (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS version, "
             "max(ts) AS created_at FROM fx_events GROUP BY 1)")


@query("version_index", with_views(["fx_events"], (
    f", {_VERSIONS} SELECT version, created_at FROM versions UNION ALL "
    "SELECT max(version) + 1, TIMESTAMP '2024-02-01 00:00:00' FROM versions")))
def version_index(spark, sf_dir):
    """ST7, A9: the version table after an increase."""
    return versions.add_version(version_rows(spark, sf_dir), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("version_as_of", with_views(["fx_events"], (
    f", {_VERSIONS} SELECT e.ts AS at, v.version FROM (SELECT DISTINCT ts FROM fx_events) e "
    "ASOF LEFT JOIN versions v ON e.ts >= v.created_at")))
def version_as_of(spark, sf_dir):
    """ST7: the version current at each event."""
    moments = view(spark, sf_dir, "fx_events").select(F.col("ts").alias("at"))
    return versions.version_at(version_rows(spark, sf_dir), moments)


def status_files(spark, sf_dir):
    events = view(spark, sf_dir, "fx_events").select(
        F.col("source_file").alias("file_name"),
        F.when(F.col("status") == "error", "Parser").otherwise("Scraper").alias("stage"))
    return events.distinct()


@query("snapshot_manifest", with_views(["fx_events"], (
    "SELECT source_file AS path, s || ' status file for ''' || source_file || ''' execution.' AS description FROM "
    "(SELECT DISTINCT source_file, CASE WHEN status = 'error' THEN 'Parser' ELSE 'Scraper' END AS s FROM fx_events) f "
    "UNION ALL VALUES ('index.json', 'When each version of the dataset was made'), "
    "('parser-status.json', 'Parser status file')")))
def snapshot_manifest(spark, sf_dir):
    """SNK9: path and description of every published status file."""
    return versions.manifest(status_files(spark, sf_dir))


@query("snapshot_messages", with_views(["fx_events"], (
    f", {_VERSIONS} SELECT version, 'Update-Time: ' || strftime(created_at, '%Y-%m-%d %H:%M:%S') || "
    "', Scrapers:ALL, Files:PRICE_FILE,PROMO_FILE' AS message FROM versions")))
def snapshot_messages(spark, sf_dir):
    """Message of each version."""
    made = version_rows(spark, sf_dir).withColumn("at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    return made.select("version", snapshot_message("at", None, ["PRICE_FILE", "PROMO_FILE"]).alias("message"))


_LISTING = ("listing AS (SELECT DISTINCT table_name || '.csv' AS file_name FROM fx_rows UNION ALL SELECT DISTINCT source_file "
            "FROM fx_events UNION ALL SELECT 'parser-status.json' UNION ALL SELECT 'index.json')")
ENABLED = ["CHAIN1", "Chain2"]

_datasets = {}


def dataset_folder(spark, sf_dir):
    """A dataset folder, made once per session and input: a CSV per table with the sizes of its files, a JSON per
    status log and one of the parser with counts by status, and the index with the versions."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _datasets:
        root = shared_dir(spark, "dataset")
        sizes = view(spark, sf_dir, "fx_rows").groupBy(F.col("table_name").alias("dir"), "file_name").agg(F.count(F.lit(1)).alias("n_rows"))
        (sizes.repartition("dir").sortWithinPartitions("dir", "file_name").write.partitionBy("dir").option("header", True)
         .csv(f"{root}/tables"))
        events = view(spark, sf_dir, "fx_events")
        counts = events.groupBy(F.regexp_replace("source_file", "[.]json$", "").alias("dir"), "status").agg(F.count(F.lit(1)).alias("n"))
        named = counts.select("dir", F.to_json(F.struct("status", "n")).alias("value"))
        parser = counts.groupBy("status").agg(F.sum("n").alias("n")).select(
            F.lit("parser-status").alias("dir"), F.to_json(F.struct("status", "n")).alias("value"))
        index = version_rows(spark, sf_dir).select(F.lit("index").alias("dir"), F.to_json(F.struct("version", "created_at")).alias("value"))
        (named.unionByName(parser).unionByName(index).repartition("dir").sortWithinPartitions("dir", "value")
         .write.partitionBy("dir").text(f"{root}/documents"))
        give_names(spark, f"{root}/tables", f"{root}/files", "csv")
        give_names(spark, f"{root}/documents", f"{root}/files", "json")
        _datasets[key] = f"{root}/files"
    return _datasets[key]


_ENABLED = "(contains(lower(file_name), 'chain1') OR contains(lower(file_name), 'chain2'))"


@query("restore_files", with_views(["fx_rows", "fx_events"], (
    f", {_LISTING} SELECT file_name, CASE WHEN file_name LIKE '%.csv' OR file_name = 'parser-status.json' "
    f"THEN 'data' ELSE 'status' END AS target FROM listing WHERE {_ENABLED} OR file_name = 'parser-status.json'")))
def restore_files(spark, sf_dir):
    """SRC10, F8: files of a dataset folder to restore for the enabled chains, and where to."""
    return versions.route_files(files.list_files(spark, dataset_folder(spark, sf_dir)), ENABLED)


@query("dataset_files", with_views(["fx_rows", "fx_events"], (
    f", {_LISTING} SELECT file_name FROM listing WHERE file_name LIKE '%chain1.csv' OR file_name LIKE '%.json'")))
def dataset_files(spark, sf_dir):
    """SRC8, X11: files of a dataset folder by chain and extension, and all of an extension."""
    folder = dataset_folder(spark, sf_dir)
    return files.list_files(spark, folder, "CHAIN1", "csv").unionByName(files.list_files(spark, folder, extension="json"))


@query("list_destinations", (
    "SELECT lower(t) || '_' || lower(n_name) AS table_name, 'row_index' AS key_column FROM (SELECT DISTINCT n_name FROM nation) n, "
    "(VALUES ('STORE_FILE'), ('PRICE_FILE'), ('PROMO_FILE'), ('PRICE_FULL_FILE'), ('PROMO_FULL_FILE')) v(t) UNION ALL "
    "VALUES ('ParserStatus', 'index'), ('GlobalParserStatus', 'index'), ('ScraperStatus', 'index'), "
    "('GlobalScraperStatus', 'index')"))
def list_destinations(spark, sf_dir):
    """SNK5-SNK7: all tables with their key columns."""
    registry = catalog.table_registry(table(spark, sf_dir, "nation").select(F.upper("n_name").alias("chain")))
    return registry.select("table_name", "key_column").unionByName(catalog.status_registry(spark))


@query("enabled_csv_files", with_views(["fx_rows", "fx_events"], (
    f", {_LISTING} SELECT file_name FROM listing WHERE {_ENABLED} AND file_name LIKE '%.csv'")))
def enabled_csv_files(spark, sf_dir):
    """F8: files of a dataset folder by extension and enabled chain."""
    return filters.enabled_files(files.list_files(spark, dataset_folder(spark, sf_dir)), "file_name", ENABLED, "csv")


@query("stream_dedup", with_views(["fx_events"], "SELECT event_id, source_file FROM fx_events"))
def stream_dedup(spark, sf_dir):
    """ST2, ST3: a stream of events, some repeated, each kept once; the state is the ledger."""
    source, columns = VIEWS["fx_events"]
    schema = table(spark, sf_dir, source).schema
    stream = event_stream.read_stream(spark, sf_dir, schema, max_files=1, pathGlobFilter=f"{source}.parquet")
    events = with_digest(stream.selectExpr(*columns), {f: F.col(f) for f in FIELDS})
    copied = copied_events(events)
    root = shared_dir(spark, "stream-dedup")
    event_stream.run_available(
        event_stream.new_events(copied).select("event_id", "source_file", "digest"),
        f"{root}/events", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/events").select("event_id", "source_file")


@query("stream_markers", with_views(["fx_rows"], (
    f", {_RUNS}, {_MARKERS} SELECT table_name, file_name, file_complete, total_expected_records, first_row, last_row "
    "FROM markers")))
def stream_markers(spark, sf_dir):
    """ST4: landing rows arrive in three loads; a marker is written when a file's run has ended."""
    wide = view(spark, sf_dir, "fx_rows")
    rows = wide.select("table_name", "row_index", "file_name")
    load = F.when(F.col("row_index") <= F.expr(MARK), 0).when(F.col("row_index") <= 2 * F.expr(MARK), 1).otherwise(2)
    root = shared_dir(spark, "stream-markers")
    wide.select(*rows.columns, load.alias("load")).write.partitionBy("load").parquet(f"{root}/all")
    write = marker_stream.marker_writer(spark, f"{root}/state", ["table_name"], "table_name string")
    for n in range(3):
        landing = spark.read.parquet(f"{root}/all/load={n}")
        landing.write.mode("append").parquet(f"{root}/landing")
        stream = event_stream.read_stream(spark, f"{root}/landing", rows.schema)
        event_stream.run_available(stream, write, f"{root}/checkpoint")
    return marker_stream.all_markers(spark, f"{root}/state", ["table_name"], 2)


@query("stream_topic", with_views(["fx_events"], (
    "SELECT CAST(event_id AS STRING) AS id, status FROM fx_events UNION ALL "
    "SELECT 'broken ' || CAST(event_id AS STRING), NULL FROM fx_events WHERE status = 'error'")))
def stream_topic(spark, sf_dir):
    """ST5, SNK3, SNK4: a topic written as files and read as a stream, cleaned of control rows and repeats."""
    root = shared_dir(spark, "stream-topic")
    messages = topic_rows(spark, sf_dir)
    messages.write.parquet(f"{root}/topic")
    stream = event_stream.read_stream(spark, f"{root}/topic", messages.schema)
    event_stream.run_available(event_stream.clean_messages(stream), f"{root}/clean", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/clean").select(
        F.coalesce(F.get_json_object("canonical", "$.event_id"), F.col("value")).alias("id"),
        F.get_json_object("canonical", "$.status").alias("status"))


# The times of a stream's three loads, its delay, and the mark that the third one meets.
LOADS = ("2024-01-10", "2024-01-20")
_TIMED = (", timed AS (SELECT event_id, ts AS seen_at, event_id % 50 = 0 AS late FROM fx_events UNION ALL SELECT event_id, "
          "ts + INTERVAL 1 DAY, false FROM fx_events WHERE event_id % 3 = 0 AND event_id % 50 <> 0), mark AS (SELECT "
          "date_trunc('millisecond', max(seen_at)) - INTERVAL 2 DAY AS w FROM timed WHERE NOT late AND seen_at < TIMESTAMP "
          f"'{LOADS[1]}')")


@query("stream_topic_bounded", with_views(["fx_events"], (
    f"{_TIMED} SELECT CAST(event_id AS STRING) AS id, status FROM fx_events WHERE event_id % 50 <> 0 OR ts > (SELECT w FROM mark)")))
def stream_topic_bounded(spark, sf_dir):
    """ST5: a topic in three loads, each a run from the checkpoint: repeats a day later go, and so do late documents."""
    docs = view(spark, sf_dir, "fx_events").select(
        F.lit("events").alias("topic"), "ts", (F.col("event_id") % 50 == 0).alias("late"), "event_id",
        F.to_json(F.struct("event_id", "status")).alias("value"))
    again = docs.where("event_id % 3 = 0 AND NOT late").select(
        "topic", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), "late", "event_id",
        F.regexp_replace("value", ":", ": ").alias("value"))
    load = F.when(F.col("late"), 2).when(F.col("ts") < F.lit(LOADS[0]).cast("timestamp_ntz"), 0).when(
        F.col("ts") < F.lit(LOADS[1]).cast("timestamp_ntz"), 1).otherwise(2)
    root = shared_dir(spark, "stream-bounded")
    docs.unionByName(again).select(
        "topic", F.col("ts").cast("timestamp").alias("ts"), "value", load.alias("load")).write.partitionBy("load").parquet(f"{root}/all")
    for n in range(3):
        landing = spark.read.parquet(f"{root}/all/load={n}")
        landing.write.mode("append").parquet(f"{root}/topic")
        stream = event_stream.read_stream(spark, f"{root}/topic", landing.schema)
        event_stream.run_available(event_stream.clean_messages(stream, "ts", "2 days"), f"{root}/clean", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/clean").select(
        F.get_json_object("canonical", "$.event_id").alias("id"), F.get_json_object("canonical", "$.status").alias("status"))


@query("stream_idle_markers", (
    "WITH arrived AS (SELECT 'chain' || CAST(o_custkey % 20 AS STRING) AS chain, 'PriceFull' || CAST(year(o_orderdate) AS STRING) "
    "AS file_name, o_orderkey AS row_index, o_orderdate AS seen_at FROM orders), flagged AS (SELECT *, CASE WHEN seen_at <= lag(seen_at) OVER "
    "(PARTITION BY chain, file_name ORDER BY seen_at, row_index) + INTERVAL 10 DAY THEN 0 ELSE 1 END AS begins FROM arrived), runs AS "
    "(SELECT *, sum(begins) OVER (PARTITION BY chain, file_name ORDER BY seen_at, row_index ROWS BETWEEN UNBOUNDED PRECEDING AND "
    "CURRENT ROW) AS run FROM flagged) SELECT chain, file_name, 'true' AS file_complete, count(*) AS total_expected_records, "
    "min(row_index) AS first_row, max(row_index) AS last_row FROM runs GROUP BY chain, file_name, run HAVING max(seen_at) + "
    "INTERVAL 10 DAY <= (SELECT max(seen_at) - INTERVAL 1 DAY FROM arrived)"))
def stream_idle_markers(spark, sf_dir):
    """ST4: rows in three loads; the marker of a file comes once it had no row for ten days."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("chain"), (F.col("o_custkey") % 20).cast("string")).alias("chain"),
        F.concat(F.lit("PriceFull"), F.year("o_orderdate").cast("string")).alias("file_name"),
        F.col("o_orderkey").alias("row_index"), F.col("o_orderdate").cast("timestamp").alias("at"))
    root = shared_dir(spark, "idle-markers")
    load = F.when(F.year("at") < 1997, 0).when(F.year("at") < 1999, 1).otherwise(2)
    rows.select("*", load.alias("load")).write.partitionBy("load").parquet(f"{root}/all")
    for n in range(3):
        spark.read.parquet(f"{root}/all/load={n}").write.mode("append").parquet(f"{root}/landing")
        stream = event_stream.read_stream(spark, f"{root}/landing", rows.schema)
        event_stream.run_available(marker_stream.idle_markers(stream, ["chain"], "at", "10 days", "1 day"),
                                   f"{root}/markers", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/markers")

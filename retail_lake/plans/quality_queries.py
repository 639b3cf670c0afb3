"""Registered queries of the pipeline audit (JN2-JN8, A2-A4, A11, W4, S2-S4, P5)."""

from pyspark.sql import functions as F

from retail_lake.functions.values import error_label, is_ok
from retail_lake.operators import access, catalog, merge, quality
from retail_lake.plans.fixtures import table, view, with_views
from retail_lake.plans.registry import query
from retail_lake.schemas import FILE_TYPES

CUT = "2024-01-16 00:00:00"

_FATES = (
    "fates AS (SELECT chain, run, file_name, count(*) AS n_seen, CASE WHEN bool_or(NOT downloaded) THEN "
    "'fail_downloaded' WHEN NOT bool_or(in_parser) THEN 'not_collected_by_parser' WHEN "
    "bool_or(in_parser AND NOT parsed) THEN 'fail_parsed' WHEN bool_or(in_parser AND parsed) THEN "
    "'succesful_processed' ELSE 'unclassified' END AS stage, "
    "max(CASE WHEN NOT downloaded THEN error END) AS dl_error, max(CASE WHEN in_parser AND NOT parsed THEN "
    "coalesce(error, CASE WHEN loaded THEN 'unknown' ELSE 'empty file' END) END) AS parse_error "
    "FROM fx_doc_files GROUP BY chain, run, file_name)"
)
_LOST = "stage IN ('fail_downloaded', 'fail_parsed')"


def fates_of(spark, sf_dir):
    """The four logs of a run, taken from the file view in one scan."""
    files = view(spark, sf_dir, "fx_doc_files")
    facts = F.array(
        quality.seen_fact(F.concat("file_name", F.lit(".xml.gz"))),
        quality.download_fact(F.concat("file_name", F.lit(".gz")), is_ok("downloaded"), F.col("error")),
        F.when(F.col("in_parser"), quality.listed_fact(F.concat("file_name", F.lit(".xml")))),
        F.when(F.col("in_parser"), quality.parse_fact("file_name", is_ok("parsed"), error_label("error", "loaded"))))
    return quality.fates_of_facts(files.select("chain", "run", F.explode(facts).alias("fact")))


@query("file_fates", with_views(["fx_doc_files"], (
    f", {_FATES} SELECT chain, run, file_name, n_seen, stage, CASE WHEN stage = 'fail_downloaded' THEN dl_error "
    "WHEN stage = 'fail_parsed' THEN parse_error END AS error FROM fates")))
def file_fates(spark, sf_dir):
    """JN4, X1, F7, X13: what became of every seen file."""
    return fates_of(spark, sf_dir)


@query("file_funnel", with_views(["fx_doc_files"], (
    f", {_FATES}, firsts AS (SELECT chain, run, count(*) AS new_files FROM (SELECT chain, file_name, min(run) AS run "
    "FROM fates GROUP BY chain, file_name) f GROUP BY chain, run) SELECT f.chain, f.run, CAST(sum(n_seen) AS BIGINT) AS saw, "
    + ", ".join(f"CAST(sum(CASE WHEN stage = '{s}' THEN n_seen ELSE 0 END) AS BIGINT) AS {s}" for s in (
        "fail_downloaded", "not_collected_by_parser", "fail_parsed", "succesful_processed", "unclassified"))
    + ", coalesce(max(w.new_files), 0) AS new_files FROM fates f LEFT JOIN firsts w ON w.chain = f.chain AND w.run = f.run "
    "GROUP BY f.chain, f.run")))
def file_funnel(spark, sf_dir):
    """Files of every run by stage, and how many were new."""
    fates = fates_of(spark, sf_dir)
    return (quality.funnel(fates).join(quality.new_files(fates), ["chain", "run"], "left")
            .withColumn("new_files", F.coalesce("new_files", F.lit(0).cast("bigint"))))


@query("new_files", with_views(["fx_doc_files"], (
    "SELECT chain, file_name, min(run) AS run FROM fx_doc_files GROUP BY chain, file_name")))
def first_seen(spark, sf_dir):
    """The run in which each file was first seen."""
    return quality.first_seen(view(spark, sf_dir, "fx_doc_files"), ["chain"], "file_name", "run")


@query("loss_rate", with_views(["fx_doc_files"], (
    f", {_FATES}, per_file AS (SELECT chain, file_name, bool_or({_LOST}) AS lost, "
    "bool_or(stage = 'succesful_processed') AS ok FROM fates GROUP BY chain, file_name) "
    "SELECT chain, count(*) FILTER (lost AND NOT ok) AS n_lost, count(*) AS n_seen, "
    "count(*) FILTER (lost AND NOT ok) / count(*) AS loss_rate, "
    "count(*) FILTER (lost AND NOT ok) / count(*) < 0.02 AS within_limit FROM per_file GROUP BY chain")))
def loss_rate(spark, sf_dir):
    """A4, S3: share of files lost and never recovered, against the limit."""
    return quality.loss_rate(fates_of(spark, sf_dir))


@query("error_counts", with_views(["fx_doc_files"], (
    f", {_FATES} SELECT chain, stage, error, CAST(sum(n_seen) AS BIGINT) AS n_files FROM (SELECT *, CASE WHEN stage = "
    f"'fail_downloaded' THEN dl_error ELSE parse_error END AS error FROM fates WHERE {_LOST}) e "
    "GROUP BY chain, stage, error")))
def error_counts(spark, sf_dir):
    """Errors per chain and stage."""
    return quality.error_counts(fates_of(spark, sf_dir))


@query("lost_files", with_views(["fx_doc_files"], (
    f", {_FATES} SELECT chain, file_name FROM fates WHERE {_LOST} EXCEPT "
    "SELECT chain, file_name FROM fates WHERE stage = 'succesful_processed'")))
def lost_files(spark, sf_dir):
    """S3: files lost in some run and processed in none."""
    fates = fates_of(spark, sf_dir)
    lost = fates.where(F.col("stage").isin(quality.FAIL_DOWNLOADED, quality.FAIL_PARSED))
    done = fates.where(F.col("stage") == quality.PROCESSED)
    return merge.subtract(lost.select("chain", "file_name"), done.select("chain", "file_name"))


@query("overall_seen", with_views(["fx_doc_files"], (
    "SELECT chain, file_name FROM fx_doc_files WHERE run <= 1997 UNION "
    "SELECT chain, file_name FROM fx_doc_files WHERE run > 1997")))
def overall_seen(spark, sf_dir):
    """Files seen up to a run, with those of later runs."""
    files = view(spark, sf_dir, "fx_doc_files").select("chain", "run", "file_name")
    return merge.union_seen(files.where("run <= 1997").drop("run"), files.where("run > 1997").drop("run"))


@query("run_timestamps", with_views(["fx_events"], (
    "SELECT task_id, ts, row_number() OVER (PARTITION BY task_id ORDER BY ts) AS run_no FROM "
    "(SELECT DISTINCT task_id, date_trunc('hour', ts) AS ts FROM fx_events) t")))
def run_timestamps(spark, sf_dir):
    """A2, L4: distinct run timestamps of each task, in order."""
    events = view(spark, sf_dir, "fx_events")
    hours = events.select("task_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return quality.run_timestamps(hours, ["task_id"], "ts")


@query("asof_greedy", with_views(["fx_events"], (
    ", s AS (SELECT task_id, ts, row_number() OVER (PARTITION BY task_id ORDER BY ts) AS i FROM "
    "(SELECT DISTINCT task_id, ts FROM fx_events WHERE status IN ('view', 'error')) a), "
    "p AS (SELECT task_id, ts, row_number() OVER (PARTITION BY task_id ORDER BY ts) AS k FROM "
    "(SELECT DISTINCT task_id, ts FROM fx_events WHERE status NOT IN ('view', 'error')) b), "
    "lb AS (SELECT s.task_id, s.ts, s.i, 1 + count(p.ts) AS lb FROM s LEFT JOIN p ON p.task_id = s.task_id "
    "AND p.ts < s.ts GROUP BY s.task_id, s.ts, s.i), "
    "g AS (SELECT task_id, i, ts, lb AS k FROM lb WHERE i = 1 UNION ALL SELECT lb.task_id, lb.i, lb.ts, "
    "greatest(g.k + 1, lb.lb) FROM g JOIN lb ON lb.task_id = g.task_id AND lb.i = g.i + 1) "
    "SELECT g.task_id, g.ts AS scraped_at, p.ts AS parsed_at FROM g LEFT JOIN p ON p.task_id = g.task_id AND p.k = g.k")))
def asof_greedy(spark, sf_dir):
    """JN2: each scrape takes the nearest unused parse at or after it."""
    events = view(spark, sf_dir, "fx_events").select("task_id", "status", "ts")
    scrapes = events.where("status IN ('view', 'error')").withColumnRenamed("ts", "scraped_at")
    parses = events.where("status NOT IN ('view', 'error')").withColumnRenamed("ts", "parsed_at")
    return quality.asof_greedy(scrapes, parses, ["task_id"], "scraped_at", "parsed_at")


@query("pair_status", with_views(["fx_events"], (
    "SELECT c.task_id, c.day, c.event_id AS collected_event_id, d.event_id AS downloaded_event_id FROM "
    "(SELECT task_id, CAST(ts AS DATE) AS day, min(event_id) AS event_id FROM fx_events WHERE status IN ('view', 'error') "
    "GROUP BY 1, 2) c JOIN (SELECT task_id, CAST(ts AS DATE) AS day, min(event_id) AS event_id FROM fx_events "
    "WHERE status NOT IN ('view', 'error') GROUP BY 1, 2) d ON d.task_id = c.task_id AND d.day = c.day")))
def pair_status(spark, sf_dir):
    """JN3: the collected and the downloaded document of each run."""
    events = view(spark, sf_dir, "fx_events").select(
        "task_id", F.col("ts").cast("date").alias("day"), "event_id", "status")
    return quality.pair_status(events.where("status IN ('view', 'error')").drop("status"),
                               events.where("status NOT IN ('view', 'error')").drop("status"),
                               ["task_id", "day"], "event_id")


@query("reconcile_counts", with_views(["fx_rows", "fx_stored"], (
    "SELECT coalesce(s.table_name, t.table_name) AS table_name, coalesce(s.n, 0) AS source_rows, "
    "coalesce(t.n, 0) AS stored_rows, t.last_row, coalesce(s.n = t.n AND t.last_row = s.n - 1, false) AS matches "
    "FROM (SELECT table_name, count(*) AS n FROM fx_rows GROUP BY table_name) s FULL JOIN (SELECT table_name, "
    "count(*) AS n, max(row_index) AS last_row FROM fx_stored WHERE file_complete IS NULL OR chain <> 'chain5' "
    "GROUP BY table_name) t ON t.table_name = s.table_name")))
def reconcile_counts(spark, sf_dir):
    """JN7: source rows against stored rows per table."""
    stored = view(spark, sf_dir, "fx_stored").where(F.col("file_complete").isNull() | (F.col("chain") != "chain5"))
    return quality.reconcile(view(spark, sf_dir, "fx_rows"), stored)


def chains_of(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.upper("n_name").alias("chain"))


_TYPES = ", ".join(f"('{t}')" for t in FILE_TYPES)
_REGISTRY = ("registry AS (SELECT lower(file_type) || '_' || lower(n_name) AS table_name, file_type, "
             "upper(n_name) AS chain, 'row_index' AS key_column FROM (SELECT DISTINCT n_name FROM nation) n, "
             f"(VALUES {_TYPES}) t(file_type))")


@query("table_registry", f"WITH {_REGISTRY} SELECT table_name, file_type, chain, key_column FROM registry")
def table_registry(spark, sf_dir):
    """JN6, X4, SNK5: every (file type, chain) table with its key column."""
    return catalog.table_registry(chains_of(spark, sf_dir))


@query("missing_expected", (
    f"WITH {_REGISTRY}, expected AS (SELECT table_name || '.csv' AS file_name FROM registry UNION "
    "SELECT lower(chain) || '_' || lower(file_type) || '.json' FROM registry UNION "
    "SELECT lower(chain) || '.json' FROM registry UNION SELECT 'index.json') "
    "SELECT file_name FROM expected WHERE file_name NOT IN (SELECT 'price_file_' || lower(n_name) || '.csv' FROM nation "
    "WHERE n_regionkey <> 1) AND file_name <> 'index.json'"))
def missing_expected(spark, sf_dir):
    """JN8: files a snapshot should list but does not."""
    nation = table(spark, sf_dir, "nation")
    listing = nation.where("n_regionkey <> 1").select(
        F.concat(F.lit("price_file_"), F.lower("n_name"), F.lit(".csv")).alias("file_name"))
    index = spark.createDataFrame([("index.json",)], "file_name string")
    expected = catalog.expected_files(catalog.table_registry(chains_of(spark, sf_dir)))
    return catalog.missing_expected(expected, listing.unionByName(index))


@query("chain_dimension", (
    "SELECT chain, count(s_suppkey) AS n_files, count(s_suppkey) FILTER (s_acctbal < -500) AS n_low FROM "
    "(SELECT n_name AS chain, n_nationkey AS key FROM nation UNION ALL SELECT 'NEW ' || n_name, n_nationkey + 100 FROM nation) n "
    "LEFT JOIN supplier ON s_nationkey = key GROUP BY chain"))
def chain_dimension(spark, sf_dir):
    """JN5: counts per dump folder under the chain's name; chains without data still appear."""
    nation = table(spark, sf_dir, "nation").select(F.explode(F.array(
        F.struct(F.col("n_name").alias("chain"), F.col("n_nationkey").alias("key")),
        F.struct(F.concat(F.lit("NEW "), "n_name").alias("chain"), (F.col("n_nationkey") + 100).alias("key")))).alias("n"))
    dim = nation.select("n.chain", F.concat(F.lit("Folder"), F.col("n.key").cast("string")).alias("folder"))
    data = (table(spark, sf_dir, "supplier")
            .groupBy(F.concat(F.lit("folder"), F.col("s_nationkey").cast("string")).alias("folder"))
            .agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("s_acctbal") < -500).alias("n_low")))
    zero = F.lit(0).cast("bigint")
    return catalog.with_chain(data, dim).select(
        "chain", F.coalesce("n_files", zero).alias("n_files"), F.coalesce("n_low", zero).alias("n_low"))


@query("execution_logs", with_views(["fx_docs"], (
    "SELECT doc_id, file_a AS file_name, status = 'F' AS succeeded FROM fx_docs UNION ALL "
    "SELECT doc_id, file_b, status <> 'O' FROM fx_docs")))
def execution_logs(spark, sf_dir):
    """Nested log entries of all documents as rows."""
    docs = view(spark, sf_dir, "fx_docs")
    entry = F.array(
        F.struct(F.col("file_a").alias("file_name"), (F.col("status") == "F").alias("succeeded")),
        F.struct(F.col("file_b").alias("file_name"), (F.col("status") != "O").alias("succeeded")))
    nested = docs.select("doc_id", F.struct(entry.alias("execution_log")).alias("response"))
    return access.explode_logs(nested, "response.execution_log", keep=["doc_id"])

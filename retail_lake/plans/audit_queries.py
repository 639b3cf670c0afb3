"""Registered queries of the audit of a whole deployment: from nested status documents to its three results.

The documents are written as JSON from the file view: per chain and run one that lists what was collected, one with
the downloads, and one of the parser with its log. The last run of a chain has no parse, and one chain has no run.
(A2-A4, A11, JN2-JN5, W4, P4, P5, S2)
"""

from pyspark.sql import functions as F

from retail_lake.operators import catalog
from retail_lake.plans.audit import audit
from retail_lake.plans.fixtures import view, with_views
from retail_lake.plans.registry import query
from retail_lake.schemas import PARSER_STATUS, SCRAPER_STATUS
from retail_lake.session import shared_dir

LAST_RUN = 1998
CHAINS = {f"CHAIN{i}": f"Chain{i}" for i in [*range(20), 99]}

_audits = {}

_FILES = (
    "files AS (SELECT upper(chain) AS chain, run, file_name, bool_and(downloaded) AS downloaded, bool_or(in_parser) AS in_parser, "
    "bool_and(parsed) AS parsed, bool_or(loaded) AS loaded, max(error) AS error FROM fx_doc_files GROUP BY chain, run, file_name)")
_FATES = (
    "fates AS (SELECT chain, run, file_name, coalesce(error, CASE WHEN NOT downloaded THEN NULL WHEN loaded THEN 'unknown' ELSE "
    "'empty file' END) AS error, CASE WHEN NOT downloaded THEN 'fail_downloaded' WHEN NOT in_parser THEN "
    "'not_collected_by_parser' WHEN NOT parsed THEN 'fail_parsed' ELSE 'succesful_processed' END AS stage FROM files "
    f"WHERE run < {LAST_RUN})")


def documents(spark, sf_dir, folder):
    """The scraper and the parser documents as JSON files; a list holds the distinct files of a run of a chain."""
    files = view(spark, sf_dir, "fx_doc_files").groupBy("chain", "run", "file_name").agg(
        F.bool_and("downloaded").alias("downloaded"), F.bool_or("in_parser").alias("in_parser"),
        F.bool_and("parsed").alias("parsed"), F.bool_or("loaded").alias("loaded"), F.max("error").alias("error"))
    result = F.struct(F.concat("file_name", F.lit(".gz")).alias("file_name"), "downloaded",
                      F.lit(True).alias("extract_succefully"), F.when(~F.col("downloaded"), F.col("error")).alias("error"))
    entry = F.struct("file_name", F.col("parsed").alias("succusfull"), "loaded", "error")
    runs = files.groupBy("chain", "run").agg(
        F.collect_list(F.concat("file_name", F.lit(".xml.gz"))).alias("files"), F.collect_list(result).alias("results"),
        F.collect_list(F.when(F.col("in_parser"), F.concat("file_name", F.lit(".xml")))).alias("to_parse"),
        F.collect_list(F.when(F.col("in_parser"), entry)).alias("log"))
    runs.write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    stamp = F.format_string("%d-01-01 00:00:00", "run")
    by_run = runs.select(F.col("chain").alias("file_name"), stamp.alias("timestamp"), "files", "results")
    scraped = [by_run.select("file_name", "timestamp", F.lit(s).alias("status"), F.concat_ws("@", "file_name", "timestamp", F.lit(s)).alias("index"),
                             F.struct(data).alias("status_data"))
               for s, data in (("collected", F.col("files").alias("file_name_collected_from_site")), ("downloaded", F.col("results")))]
    for n, docs in enumerate(scraped):
        docs.write.json(f"{folder}/scraper/part={n}")
    runs.where(F.col("run") < LAST_RUN).select(
        F.upper("chain").alias("requested_store_enum"), F.format_string("%d-01-02 06:00:00", "run").alias("when_date"),
        F.struct(F.col("to_parse").alias("files_to_process"), F.col("log").alias("execution_log")).alias("response")
    ).write.json(f"{folder}/parser")
    return (spark.read.schema(SCRAPER_STATUS).json(f"{folder}/scraper"), spark.read.schema(PARSER_STATUS).json(f"{folder}/parser"))


def audit_of(spark, sf_dir):
    """The audit; made once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _audits:
        scraper, parser = documents(spark, sf_dir, shared_dir(spark, "audit-documents"))
        _audits[key] = audit(scraper, parser, catalog.chain_dim(spark, CHAINS))
    return _audits[key]


_STAGES = ("fail_downloaded", "not_collected_by_parser", "fail_parsed", "succesful_processed", "unclassified")


@query("audit_funnel", with_views(["fx_doc_files"], (
    f", {_FILES}, {_FATES}, counted AS (SELECT chain, run, count(*) AS saw, "
    + ", ".join(f"count(*) FILTER (stage = '{s}') AS {s}" for s in _STAGES) + " FROM fates GROUP BY chain, run), "
    "firsts AS (SELECT chain, run, count(*) AS new_files FROM (SELECT chain, file_name, min(run) AS run FROM fates "
    "GROUP BY chain, file_name) f GROUP BY chain, run), "
    "runs AS (SELECT DISTINCT chain, run FROM files UNION ALL SELECT name, CAST(NULL AS BIGINT) FROM "
    "(SELECT i, 'CHAIN' || CAST(i AS STRING) AS name FROM (SELECT unnest(range(100)) AS i) u) g "
    "WHERE (i < 20 OR i = 99) AND name NOT IN (SELECT chain FROM files)) "
    "SELECT r.chain, make_timestamp(r.run, 1, 1, 0, 0, 0) AS run, saw, " + ", ".join(_STAGES) +
    ", CASE WHEN saw IS NOT NULL THEN coalesce(new_files, 0) END AS new_files FROM runs r "
    "LEFT JOIN counted c ON c.chain = r.chain AND c.run = r.run LEFT JOIN firsts w ON w.chain = r.chain AND w.run = r.run")))
def audit_funnel(spark, sf_dir):
    """A3, W4, JN2, JN3, JN5: the funnel of every run; runs without a parse and chains without a run are empty."""
    return audit_of(spark, sf_dir).funnel


@query("audit_errors", with_views(["fx_doc_files"], (
    f", {_FILES}, {_FATES} SELECT chain, stage, error, count(*) AS n_files FROM fates WHERE stage IN "
    "('fail_downloaded', 'fail_parsed') GROUP BY chain, stage, error")))
def audit_errors(spark, sf_dir):
    """Errors of the downloads and parses in the nested logs."""
    return audit_of(spark, sf_dir).errors


@query("audit_loss", with_views(["fx_doc_files"], (
    f", {_FILES}, {_FATES}, per_file AS (SELECT chain, file_name, bool_or(stage IN ('fail_downloaded', 'fail_parsed')) AS lost, "
    "bool_or(stage = 'succesful_processed') AS ok FROM fates GROUP BY chain, file_name) SELECT chain, "
    "count(*) FILTER (lost AND NOT ok) AS n_lost, count(*) AS n_seen, count(*) FILTER (lost AND NOT ok) / count(*) AS loss_rate, "
    "count(*) FILTER (lost AND NOT ok) / count(*) < 0.02 AS within_limit FROM per_file GROUP BY chain")))
def audit_loss(spark, sf_dir):
    """A4, S3: share of the files of a chain that no run recovered."""
    return audit_of(spark, sf_dir).loss

"""Audit of a whole deployment from its status documents: funnel, errors and loss per chain (A2-A4, A11, JN2-JN5)."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.values import parse_ts
from retail_lake.operators import access, catalog, quality
from retail_lake.schemas import LOSS_LIMIT
from retail_lake.session import shared_dir
from retail_lake.sinks.store import write_report


@dataclass
class Audit:
    """``funnel``: one row per chain and run; ``errors``: per chain, stage and label; ``loss``: per chain."""

    funnel: DataFrame
    errors: DataFrame
    loss: DataFrame

    def write(self, folder):
        """SNK10: the three results as JSON."""
        for name in ("funnel", "errors", "loss"):
            write_report(getattr(self, name), f"{folder}/{name}")


def audit(scraper_docs, parser_docs, chains, limit=LOSS_LIMIT, folder=None):
    """Audit all chains from one read of the documents.

    ``scraper_docs`` and ``parser_docs`` have the document schemas, ``chains`` is (chain, folder).
    A run is a scrape timestamp of a chain. A run without a collected and a downloaded document, or
    without a matching parse, has an empty funnel row; so has a chain without any run.

    Documents nest long lists and are read by many branches, so the columns in use are written once to ``folder``
    (a new shared one by default) as a columnar table, and so is the fate of every file, which all three
    results count.
    """
    folder = folder or shared_dir(scraper_docs.sparkSession, "audit")

    def staged(df, name):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    scraped = staged(scraper_docs.select(
        F.col("file_name").alias("folder"), parse_ts("timestamp").alias("run"), "index", "status",
        F.col("status_data.file_name_collected_from_site").alias("files"), F.col("status_data.results").alias("results"))
        .where(F.col("run").isNotNull()), "scraped")
    parsed = staged(parser_docs.select(
        F.col("requested_store_enum").alias("chain"), parse_ts("when_date").alias("parsed_at"),
        F.col("response.files_to_process").alias("to_parse"), F.col("response.execution_log").alias("log_entries")), "parsed")
    scraped = catalog.with_chain(scraped, chains).where(F.col("run").isNotNull())
    runs = scraped.select("chain", "run").distinct()
    collected = scraped.where("status = 'collected'").select("chain", "run", "index", "files")
    downloaded = scraped.where("status = 'downloaded'").select("chain", "run", "index", "results")
    paired = quality.pair_status(collected, downloaded, ["chain", "run"], "index")

    matched = quality.asof_greedy(
        runs.withColumnRenamed("run", "scraped_at"), parsed.select("chain", "parsed_at"),
        ["chain"], "scraped_at", "parsed_at").where(F.col("parsed_at").isNotNull())
    matched = matched.select("chain", F.col("scraped_at").alias("run"), "parsed_at")
    full_runs = paired.join(matched, ["chain", "run"])
    parse_docs = full_runs.select("chain", "run", "parsed_at").join(parsed, ["chain", "parsed_at"])

    key = ["chain", "run"]
    seen = access.explode_files(full_runs, "collected_files", key)
    downloads = access.explode_logs(full_runs, "downloaded_results", key).select(
        *key, "file_name", "downloaded", F.col("extract_succefully").alias("extracted"), "error")
    to_parse = access.explode_files(parse_docs, "to_parse", key)
    parses = access.explode_logs(parse_docs, "log_entries", key).select(
        *key, "file_name", F.col("succusfull").alias("succeeded"), "loaded", "error")

    fates = staged(quality.file_fates(seen, downloads, to_parse, parses), "fates")
    new = quality.new_files(fates.select("chain", "run", "file_name"))
    counted = quality.funnel(fates).join(new, key, "left").withColumn(
        "new_files", F.coalesce("new_files", F.lit(0).cast("bigint")))
    every = chains.select("chain").join(runs.join(counted, key, "left"), "chain", "left")
    return Audit(every, quality.error_counts(fates), quality.loss_rate(fates, limit))

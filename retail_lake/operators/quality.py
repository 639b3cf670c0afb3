"""Audit of the pipeline: run matching, file fates, funnel, loss, reconciliation (JN2-JN4, JN7, A2-A4, A11, W4)."""

import functools

from pyspark.sql import functions as F

from retail_lake.functions.names import SCRAPED, STRIPPED, strip_ext
from retail_lake.functions.values import error_label, is_ok, micros
from retail_lake.operators.merge import first_per_key
from retail_lake.operators.scan import TIME_BITS, number_rows, slots
from retail_lake.schemas import LOSS_LIMIT

# The stages a seen file can end in, in order of precedence.
FAIL_DOWNLOADED = "fail_downloaded"
NOT_COLLECTED = "not_collected_by_parser"
FAIL_PARSED = "fail_parsed"
PROCESSED = "succesful_processed"
UNCLASSIFIED = "unclassified"


def run_timestamps(status, by, ts, bits=TIME_BITS):
    """A2/L4: distinct run timestamps per group, numbered from 1 in time order."""
    runs = status.where(F.col(ts).isNotNull()).select(*by, ts).distinct()
    placed = number_rows(runs.withColumn("_at", micros(ts)), by, "_at", out="_pos", bits=bits)
    return placed.select(*by, ts, (F.col("_pos") + 1).alias("run_no"))


def asof_greedy(left, right, by, lts, rts, bits=TIME_BITS):
    """JN2: in time order, each left stamp takes the nearest unused right stamp at or after it.

    Both sides are stacked and numbered in one pass (see ``slots``); pairs then meet on
    (group, slot), which has at most one row of each side. A left stamp whose slot lies past the
    last right stamp stays without one. One row per distinct left stamp.
    """
    def side(df, ts, flag):
        present = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, ts)])
        return (df.where(present).select(*by, F.col(ts).alias("_ts")).distinct()
                .withColumn("_right", F.lit(flag)))

    stamps = side(left, lts, 0).unionByName(side(right, rts, 1))
    # A left stamp sorts before an equal right stamp, which it may take.
    keyed = stamps.withColumn("_order", micros("_ts") * 2 + F.col("_right"))
    placed = slots(keyed, by, "_order", F.col("_right") == 1, bits)
    return (placed.select(*by, "_ts", "_right", F.col("slot").alias("_slot"))
            .groupBy(*by, "_slot")
            .agg(F.max(F.when(F.col("_right") == 0, F.col("_ts"))).alias(lts),
                 F.max(F.when(F.col("_right") == 1, F.col("_ts"))).alias(rts))
            .where(F.col(lts).isNotNull())
            .select(*by, lts, rts))


def pair_status(collected, downloaded, on, seq):
    """JN3: one collected and one downloaded document per run (the first by ``seq``); both needed."""
    left = first_per_key(collected, on, seq)
    right = first_per_key(downloaded, on, seq)
    rest_l = [F.col(c).alias(f"collected_{c}") for c in left.columns if c not in on]
    rest_r = [F.col(c).alias(f"downloaded_{c}") for c in right.columns if c not in on]
    return left.select(*on, *rest_l).join(right.select(*on, *rest_r), list(on), "inner")


def file_fates(seen, downloads, to_parse, parses, by=("chain", "run")):
    """JN4: what became of every seen file of a run.

    Inputs are rows with ``by`` and ``file_name``; ``downloads`` adds (downloaded, extracted, error),
    ``parses`` adds (succeeded, loaded, error). The four inputs are stacked and reduced to flags in
    one aggregation on (run, file), combined map-side, in place of four joins. ``n_seen`` is how
    often the run lists the file.
    """
    parts = [(seen, seen_fact("file_name")),
             (downloads, download_fact("file_name", is_ok("downloaded", "extracted"), F.col("error"))),
             (to_parse, listed_fact("file_name")),
             (parses, parse_fact("file_name", is_ok("succeeded"), error_label("error", "loaded")))]
    return fates_of_facts(functools.reduce(
        lambda a, b: a.unionByName(b), [df.select(*by, fact.alias("fact")) for df, fact in parts]), by)


# What one log line says about a file: the fields of a fact.
_FACT = {"n_seen": "bigint", "_listed": "boolean", "_dl_ok": "boolean", "_dl_fail": "boolean",
         "_ok": "boolean", "_fail": "boolean", "_dl_error": "string", "_error": "string"}


def _fact(name, suffixes, **given):
    return F.struct(strip_ext(name, suffixes).alias("file_name"), *[
        given.get(n, F.lit(None)).cast(t).alias(n) for n, t in _FACT.items()])


def seen_fact(name):
    """The run lists the file."""
    return _fact(name, SCRAPED, n_seen=F.lit(1))


def download_fact(name, ok, error):
    """The file was fetched and unpacked, or not."""
    return _fact(name, SCRAPED, _dl_ok=ok, _dl_fail=~ok, _dl_error=F.when(~ok, error))


def listed_fact(name):
    """The parser was given the file."""
    return _fact(name, STRIPPED, _listed=F.lit(True))


def parse_fact(name, ok, error):
    """The file was parsed, or not."""
    return _fact(name, STRIPPED, _ok=ok, _fail=~ok, _error=F.when(~ok, error))


def fates_of_facts(facts, by=("chain", "run")):
    """JN4 on rows with ``by`` and ``fact``, a null fact says nothing. Logs that lie in one table give
    their facts in one scan: explode an array of them."""
    stacked = facts.where(F.col("fact").isNotNull()).select(*by, "fact.*")

    def has(name):
        return F.coalesce(F.bool_or(name), F.lit(False)).alias(name)

    merged = stacked.groupBy(*by, "file_name").agg(
        F.sum("n_seen").alias("n_seen"), has("_listed"), has("_dl_ok"), has("_dl_fail"),
        has("_ok"), has("_fail"), F.max("_dl_error").alias("_dl_error"), F.max("_error").alias("_error"))
    stage = (
        F.when(F.col("_dl_fail"), FAIL_DOWNLOADED)
        .when(~F.col("_dl_ok"), UNCLASSIFIED)
        .when(~F.col("_listed"), NOT_COLLECTED)
        .when(F.col("_fail"), FAIL_PARSED)
        .when(F.col("_ok"), PROCESSED)
        .otherwise(UNCLASSIFIED)
    )
    error = (F.when(F.col("stage") == FAIL_DOWNLOADED, F.col("_dl_error"))
             .when(F.col("stage") == FAIL_PARSED, F.col("_error")))
    return (merged.where(F.col("n_seen").isNotNull()).withColumn("stage", stage)
            .select(*by, "file_name", "n_seen", "stage", error.alias("error")))


def funnel(fates, by=("chain", "run")):
    """A3: files of each run by stage; a file in no list is counted as unclassified."""
    def files(stage):
        return F.sum(F.when(F.col("stage") == stage, F.col("n_seen")).otherwise(0)).alias(stage)

    return fates.groupBy(*by).agg(
        F.sum("n_seen").alias("saw"),
        *[files(s) for s in (FAIL_DOWNLOADED, NOT_COLLECTED, FAIL_PARSED, PROCESSED, UNCLASSIFIED)])


def first_seen(df, by, key, run):
    """The run in which a key first appears in its group."""
    return df.groupBy(*by, key).agg(F.min(run).alias(run))


def new_files(seen, chain="chain", run="run"):
    """Number of files a run sees for the first time in its chain."""
    return (first_seen(seen, [chain], "file_name", run)
            .groupBy(chain, run).agg(F.count(F.lit(1)).alias("new_files")))


def loss_rate(fates, limit=LOSS_LIMIT, chain="chain"):
    """A4: share of a chain's files that were lost in some run and processed in none."""
    lost = F.col("stage").isin(FAIL_DOWNLOADED, FAIL_PARSED)
    per_file = fates.groupBy(chain, "file_name").agg(
        F.bool_or(lost).alias("_lost"), F.bool_or(F.col("stage") == PROCESSED).alias("_ok"))
    rate = F.col("n_lost") / F.nullif(F.col("n_seen"), F.lit(0).cast("bigint"))
    return (per_file.groupBy(chain)
            .agg(F.count_if(F.col("_lost") & ~F.col("_ok")).alias("n_lost"),
                 F.count(F.lit(1)).alias("n_seen"))
            .withColumn("loss_rate", rate)
            .withColumn("within_limit", F.col("loss_rate") < limit))


def error_counts(fates, chain="chain"):
    """Errors per chain and stage, with how many file sightings each one cost."""
    failed = fates.where(F.col("stage").isin(FAIL_DOWNLOADED, FAIL_PARSED))
    return (failed.groupBy(chain, "stage", "error")
            .agg(F.sum("n_seen").alias("n_files")))


def reconcile(source, stored, by=("table_name",), order="row_index"):
    """JN7: source rows against stored data rows per table: equal counts, last index = count - 1."""
    return reconcile_counts(source.groupBy(*by).agg(F.count(F.lit(1)).alias("source_rows")), stored, by, order)


def reconcile_counts(left, stored, by=("table_name",), order="row_index"):
    """JN7 from counts of the source: ``by`` and ``source_rows``."""
    right = stored.groupBy(*by).agg(F.count(F.lit(1)).alias("stored_rows"),
                                    F.max(order).alias("last_row"))
    joined = left.join(right, list(by), "full")
    same = ((F.col("source_rows") == F.col("stored_rows"))
            & (F.col("last_row") == F.col("source_rows") - 1))
    return joined.select(
        *by, F.coalesce("source_rows", F.lit(0).cast("bigint")).alias("source_rows"),
        F.coalesce("stored_rows", F.lit(0).cast("bigint")).alias("stored_rows"), "last_row",
        F.coalesce(same, F.lit(False)).alias("matches"))

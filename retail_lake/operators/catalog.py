"""Dimensions and the table registry (JN5, JN6, JN8)."""

from pyspark.sql import functions as F

from retail_lake.functions.names import table_name
from retail_lake.operators.sizing import broadcast_if_small
from retail_lake.schemas import FILE_TYPES, STATUS_TABLES


def chain_dim(spark, folders):
    """Chain dimension from ``{chain: dump folder}``."""
    return spark.createDataFrame(sorted(folders.items()), "chain string, folder string")


def with_chain(df, dim, folder="folder"):
    """JN5: rows keyed by dump folder get their chain name; chains without rows still appear.

    The dimension is the broadcast side, so a chain with very many rows stays spread out.
    """
    keyed = dim.select("chain", F.lower("folder").alias("_folder"))
    rows = df.withColumn("_folder", F.lower(folder)).drop(folder)
    found = rows.join(broadcast_if_small(keyed), "_folder")
    absent = keyed.join(rows.select("_folder").distinct(), "_folder", "left_anti")
    return found.unionByName(absent, allowMissingColumns=True).drop("_folder")


def table_registry(chains, file_types=FILE_TYPES, chain="chain"):
    """JN6/SNK5: every (file type, chain) table with its key column; the types are a literal list."""
    return (chains.select(chain).distinct()
            .select(F.explode(F.array(*[F.lit(t) for t in file_types])).alias("file_type"),
                    F.col(chain).alias("chain"))
            .select(table_name("file_type", "chain").alias("table_name"), "file_type", "chain",
                    F.lit("row_index").alias("key_column")))


def status_registry(spark):
    """SNK6: the status tables and their key columns."""
    return spark.createDataFrame(sorted(STATUS_TABLES.items()), "table_name string, key_column string")


def expected_files(registry):
    """JN6: names a published snapshot must list: a CSV and a parser status file per table,
    a scraper status file per chain, and the version index."""
    csv = registry.select(F.concat("table_name", F.lit(".csv")).alias("file_name"))
    parser = registry.select(F.concat_ws(
        "_", F.lower("chain"), F.concat(F.lower("file_type"), F.lit(".json"))).alias("file_name"))
    scraper = registry.select("chain").distinct().select(
        F.concat(F.lower("chain"), F.lit(".json")).alias("file_name"))
    index = registry.sparkSession.createDataFrame([("index.json",)], "file_name string")
    return csv.unionByName(parser).unionByName(scraper).unionByName(index)


def missing_expected(expected, listing, name="file_name"):
    """JN8: expected names that the listing lacks; both sides are stacked and grouped by name."""
    stacked = (expected.select(name, F.lit(False).alias("_listed"))
               .unionByName(listing.select(name, F.lit(True).alias("_listed"))))
    return (stacked.groupBy(name)
            .agg(F.bool_or("_listed").alias("_listed"), F.bool_or(~F.col("_listed")).alias("_expected"))
            .where(F.col("_expected") & ~F.col("_listed")).select(name))

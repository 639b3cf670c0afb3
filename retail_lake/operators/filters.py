"""Filters of the read path."""

import functools
import re

from pyspark.sql import functions as F

from retail_lake.functions.names import file_type_of
from retail_lake.schemas import FILE_TYPES


def eq_filter(df, conditions):
    """conjunction of equalities; a condition of None matches rows without the value.

    A column that ``df`` lacks is missing in every row.
    """
    def value_of(name):
        return F.col(name) if name in df.columns else F.lit(None)

    tests = [value_of(c).isNull() if v is None else value_of(c) == F.lit(v) for c, v in conditions.items()]
    return df.where(functools.reduce(lambda a, b: a & b, tests)) if tests else df


def match_index(df, chain, file_type=None, index="index"):
    """regex on the composite index, operands taken literally. Cannot prune; see match_columns."""
    parts = [re.escape(p) for p in (file_type, chain) if p is not None]
    return df.where(F.rlike(F.col(index), F.lit(".*" + ".*".join(parts) + ".*")))


def match_columns(df, chain, file_type=None):
    """F2 on real columns: equality on partition columns, pruned at planning time."""
    out = df.where(F.col("chain") == chain)
    return out if file_type is None else out.where(F.col("file_type") == file_type)


def is_control(df):
    """Predicate of marker, warm-up and flush rows, over whichever of these columns exist."""
    tests = [F.coalesce(F.col(c).cast("string") == "true", F.lit(False))
             for c in ("warmup", "flush") if c in df.columns]
    if "file_complete" in df.columns:
        tests.append(F.col("file_complete").isNotNull())
    return functools.reduce(lambda a, b: a | b, tests, F.lit(False))


def drop_control(df):
    """drop completion markers and the topic's warm-up and flush messages."""
    return df.where(~is_control(df))


def with_store(df, store, files="files"):
    """keep the array elements that contain the store number."""
    if not store:
        return df
    return df.withColumn(files, F.filter(files, lambda f: F.contains(f, F.lit(store))))


def since(df, ts, bound):
    """rows at or after the bound; rows without a timestamp are kept."""
    if bound is None:
        return df
    return df.where(F.col(ts).isNull() | (F.col(ts) >= bound))


def check_domain(chains, chain=None, file_type=None, file=None, needs_file=False):
    """validate arguments before any job runs; returns the file type of ``file`` if given."""
    if not chain:
        raise ValueError("name a chain")
    if needs_file and not file:
        raise ValueError("name a file")
    if chain not in chains:
        raise ValueError(f"no chain '{chain}' among {', '.join(sorted(chains))}")
    if file_type is not None and file_type not in FILE_TYPES:
        raise ValueError(f"no file type '{file_type}' among {', '.join(FILE_TYPES)}")
    if file is None:
        return None
    kind = file_type_of(file)
    if kind is None:
        raise ValueError(f"the name '{file}' tells no file type")
    return kind


def enabled_files(df, name, chains, extension=None, always=()):
    """F8: file names that mention an enabled chain (any case), or are always kept."""
    lowered = F.lower(F.col(name))
    keep = functools.reduce(lambda a, b: a | b,
                            [F.contains(lowered, F.lit(c.lower())) for c in chains], F.lit(False))
    if extension:
        keep = keep & lowered.endswith("." + extension)
    return df.where(keep | F.col(name).isin(*always)) if always else df.where(keep)

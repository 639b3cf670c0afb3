"""Keyed writes and set operations as DataFrame merges (SNK1, SNK2, S3-S6)."""

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def first_per_key(df, keys, seq):
    """One row per key, the one with the lowest ``seq``; combined map-side, so a hot key is cheap.

    Rows without ``seq`` come last; a key that has no others keeps one of them.
    """
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*rest), F.struct(_col(seq).isNull(), _col(seq))).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
            .select(*df.columns))


def last_per_key(df, keys, seq):
    """One row per key, the one with the highest ``seq``; rows without ``seq`` count as lowest."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct(_col(seq).isNotNull(), _col(seq))).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
            .select(*df.columns))


def insert_ignore(existing, items, keys, seq, exempt=None):
    """SNK1: the rows of ``items`` to append: first writer wins, stored keys are ignored.

    ``exempt`` is a predicate of rows the unique key does not cover (markers without content);
    they are always appended. Both join sides have one row per key, so no key is hot in the join.
    """
    covered = items if exempt is None else items.where(~exempt)
    fresh = first_per_key(covered, keys, seq).join(existing.select(*keys), list(keys), "left_anti")
    fresh = fresh.select(*items.columns)
    return fresh if exempt is None else fresh.unionByName(items.where(exempt))


def upsert(existing, items, keys, seq):
    """SNK2: the table after the write: the highest ``seq`` of each key wins."""
    return last_per_key(existing.unionByName(items), keys, seq)


def dedup_documents(df, cols=None):
    """Drop repeated documents; ``cols`` are the parsed fields (key order plays no part)."""
    return df.dropDuplicates(list(cols) if cols else df.columns)


def subtract(a, b):
    """S3: distinct rows of ``a`` that are not in ``b``."""
    return a.distinct().join(
        b.select(*a.columns).distinct(), a.columns, "left_anti")


def union_seen(a, b):
    """Set union."""
    return a.unionByName(b).distinct()


def append_ledger(ledger, new):
    """Old ids first, then the new ones that are not there yet, each once."""
    keys = ["source_file", "digest"]
    return ledger.unionByName(
        new.select(*keys).distinct().join(ledger.select(*keys), keys, "left_anti"))

"""Intermediate tables in the shared folder of the session."""

from pyspark.sql import functions as F

from retail_lake.session import remove, shared_dir, swept

# Folders written in this session and not dropped yet, oldest first.
_held = []


def written_at(df, name):
    """``df`` written once as Parquet under the shared scratch folder and read back, and its folder.

    What follows no longer depends on the lineage before, so a lost executor costs no more than its
    own tasks. The folder comes from ``spark.checkpoint.dir``. Shuffle files of earlier steps go if the write was long.
    """
    path = shared_dir(df.sparkSession, name)
    with swept(df.sparkSession):
        df.write.parquet(path)
    _held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df, name):
    """As ``written_at``, without the folder."""
    return written_at(df, name)[0]


def all_columns(df):
    """The columns of ``df``, also where a name has a dot or a backtick."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def drop(spark, paths):
    """Delete folders that nothing reads any more."""
    for path in paths:
        remove(spark, path)
        _held.remove(path)


def held():
    """The folders written so far. A stage of the pipeline drops those of the stages before it, as its
    input has been written outside of them."""
    return list(_held)

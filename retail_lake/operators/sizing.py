"""Broadcasts behind a size check."""

from pyspark.sql import functions as F

# A side of at most this many narrow rows is sent to every executor.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df, rows=BROADCAST_ROWS):
    """Broadcast ``df`` if it has at most ``rows`` rows; else leave the join to the planner.

    The check counts no further than ``rows`` + 1. It is meant for state and dimension tables,
    where counting is a read of one small table.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

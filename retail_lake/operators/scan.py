"""Running values over long ordered groups, without one task per group.

A window over (table) puts a whole table in one task, and one table may hold a third of the data.
``running`` cuts the order key into buckets of ``2**bits`` key values, runs the window inside
(group, bucket), and carries the total of all earlier buckets in from a summary that has one row
per bucket. The summary is scanned the same way with the next entry of ``bits``. The order key is
unique within a group, so ``2**bits`` bounds the rows of a window at each level.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

# Dense keys (row numbers): 1M rows per bucket; a table of 10**12 rows has 10**6 buckets.
ROW_BITS = (20,)
# Microsecond keys: buckets of 4.5 minutes, grouped by 200 days.
TIME_BITS = (28, 16)

# An order value before every other one.
BEFORE_ALL = -(1 << 62)

_BUCKET = "_bucket"


def _bucket_of(order, bits):
    """Bucket of an order key. It cannot be null, and says so: the planner then adds no null filter
    on one side of a join only, which would keep the two sides from sharing an exchange."""
    return F.coalesce(F.shiftright(F.col(order), bits), F.lit(0).cast("bigint"))


def _local(kind, col, window):
    if kind == "last":
        return F.last(col, ignorenulls=True).over(window)
    if kind == "first":
        return F.first(col).over(window)
    if kind == "sum":
        return F.sum(col).over(window)
    if kind == "max":
        return F.max(col).over(window)
    raise ValueError(f"unknown running kind '{kind}'")


def _total(kind, col, order):
    if kind == "last":
        return F.max_by(col, F.when(col.isNotNull(), F.col(order)))
    if kind == "first":
        return F.min_by(col, F.col(order))
    return F.sum(col) if kind == "sum" else F.max(col)


def _combine(kind, carry, local):
    if kind == "last":
        return F.coalesce(local, carry)
    if kind == "first":
        return F.coalesce(carry, local)
    if kind == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    return F.greatest(local, carry)


def running(df, by, order, outputs, bits=ROW_BITS, totals_of=None):
    """Add running columns in ``order`` (BIGINT, unique per group) within ``by`` (never null).

    ``outputs`` maps a new column to ``(kind, column, inclusive)``; kind is ``last`` (last value
    that is not null), ``first`` (value of the first row, never null), ``sum`` or ``max``. With
    ``inclusive`` false the current row is left out. ``totals_of`` may give the same rows by a
    shorter plan for the bucket totals.
    """
    if not bits:
        window = Window.partitionBy(*by).orderBy(order)
        return df.select("*", *[
            _combine(kind, F.lit(None),
                     _local(kind, col, window.rowsBetween(Window.unboundedPreceding, 0 if inc else -1)))
            .alias(name)
            for name, (kind, col, inc) in outputs.items()
        ])

    def bucketed(rows):
        return rows.select(
            "*", _bucket_of(order, bits[0]).alias(_BUCKET),
            *[col.alias(f"_in_{name}") for name, (_, col, _) in outputs.items()])

    keys = [*by, _BUCKET]
    window = Window.partitionBy(*keys).orderBy(order)
    local = bucketed(df).select("*", *[
        _local(kind, F.col(f"_in_{name}"),
               window.rowsBetween(Window.unboundedPreceding, 0 if inc else -1)).alias(f"_local_{name}")
        for name, (kind, _, inc) in outputs.items()
    ])
    totals = bucketed(df if totals_of is None else totals_of).groupBy(*keys).agg(*[
        _total(kind, F.col(f"_in_{name}"), order).alias(f"_total_{name}")
        for name, (kind, _, _) in outputs.items()
    ]).withColumnRenamed(_BUCKET, "_key")
    carry = running(
        totals, by, "_key",
        {f"_carry_{name}": (kind, F.col(f"_total_{name}"), False)
         for name, (kind, _, _) in outputs.items()},
        bits[1:],
    ).select(*by, F.col("_key").alias(_BUCKET), *[f"_carry_{n}" for n in outputs])
    return local.join(carry, keys, "left").select(
        *df.columns,
        *[_combine(kind, F.col(f"_carry_{name}"), F.col(f"_local_{name}")).alias(name)
          for name, (kind, _, _) in outputs.items()],
    )


def number_rows(df, by, order, start=None, out="row_index", bits=ROW_BITS):
    """0-based row number per group; ``start`` (by..., last_row) continues a stored table.

    The stored rows of a group go in front as one row that weighs as much as all of them.
    """
    weighed = df.withColumn("_weight", F.lit(1).cast("bigint")).withColumn("_stored", F.lit(False))
    if start is not None:
        held = start.select(*by, F.lit(BEFORE_ALL).alias(order), (F.col("last_row") + 1).alias("_weight"),
                            F.lit(True).alias("_stored"))
        weighed = weighed.unionByName(held, allowMissingColumns=True)
    counted = running(weighed, by, order, {out: ("sum", F.col("_weight"), False)}, bits)
    return counted.where(~F.col("_stored")).drop("_weight", "_stored")


def forward_fill(df, by, order, cols, within=None, bits=ROW_BITS):
    """Replace each null by the last earlier value of its column; leading nulls stay.

    The fill crosses file boundaries. With ``within`` (a column that is filled first, such as the
    file name) the other columns are filled only from rows of the same run of that column.
    """
    rest = [c for c in df.columns if c not in cols]
    if within is None:
        filled = running(df, by, order, {f"_f_{c}": ("last", F.col(c), True) for c in cols}, bits)
        return filled.select(*rest, *[F.col(f"_f_{c}").alias(c) for c in cols]).select(*df.columns)

    rest = [c for c in rest if c != within]
    others = [c for c in cols if c != within]
    dated = {
        f"_f_{c}": ("last",
                    F.when(F.col(c).isNotNull(),
                           F.struct(F.col(order).alias("at"), F.col(c).alias("value"))), True)
        for c in others
    }
    marked = runs(df, by, order, within, bits)
    filled = running(marked, by, order, {**dated, "_f_key": ("last", F.col(within), True)}, bits,
                     totals_of=df)
    return filled.select(
        *rest, F.col("_f_key").alias(within),
        *[F.when(F.col(f"_f_{c}.at") >= F.coalesce(F.col("run_start"), F.col(f"_f_{c}.at")),
                 F.col(f"_f_{c}.value")).alias(c) for c in others]).select(*df.columns)


def _runs_before(df, by, order, bits):
    """For each element: name, number and start of the run in progress before it.

    An element is a stretch of rows: ``_f`` and ``_l`` are its first and last name, ``_n`` its runs,
    ``_b`` where its last run begins. A row is a stretch of one; a bucket is again a stretch, so the
    bucket summary goes through the same steps. Adds ``_p``, ``_c`` and ``_s``.
    """
    named = F.col("_f").isNotNull()
    keys = [*by, _BUCKET] if bits else by
    source = df.withColumn(_BUCKET, _bucket_of(order, bits[0])) if bits else df
    past = (Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1))
    begun = F.col("_n") - (named & F.col("_f").eqNullSafe(F.col("_p"))).cast("bigint")
    local = (
        source.withColumn("_p", F.last("_l", ignorenulls=True).over(past))
        .withColumn("_new", begun)
        .withColumn("_c", F.coalesce(F.sum("_new").over(past), F.lit(0)))
        .withColumn("_s", F.max(F.when(F.col("_new") > 0, F.col("_b"))).over(past))
    )
    if not bits:
        return local.drop("_new")

    stretches = local.groupBy(*keys).agg(
        F.min_by("_f", F.when(named, F.col(order))).alias("_f"),
        F.max_by("_l", F.when(F.col("_l").isNotNull(), F.col(order))).alias("_l"),
        F.sum("_new").alias("_n"),
        F.max(F.when(F.col("_new") > 0, F.col("_b"))).alias("_b"),
    ).withColumnRenamed(_BUCKET, "_key")
    carry = _runs_before(stretches, by, "_key", bits[1:])
    goes_on = F.col("_f").isNotNull() & F.col("_f").eqNullSafe(F.col("_p"))
    carry = carry.select(*by, F.col("_key").alias(_BUCKET), goes_on.cast("bigint").alias("_on"),
                         F.col("_p").alias("_p0"), F.col("_c").alias("_c0"), F.col("_s").alias("_s0"))
    fresh = F.col("_p").isNull()
    first_goes_on = (F.col("_c") == 1) & (F.col("_on") == 1)
    return local.join(carry, keys, "left").select(
        *df.columns,
        F.coalesce("_p", "_p0").alias("_p"),
        F.when(fresh, F.col("_c0")).otherwise(F.col("_c0") + F.col("_c") - F.col("_on")).alias("_c"),
        F.when(fresh | first_goes_on, F.col("_s0")).otherwise(F.col("_s")).alias("_s"),
    )


def runs(df, by, order, key, bits=ROW_BITS):
    """Add ``run_id`` and ``run_start`` of the contiguous run of ``key`` each row belongs to.

    A null key continues the current run; rows before the first key have run 0 and no start.
    """
    has_key = F.col(key).isNotNull()
    rows = df.select("*", F.col(key).alias("_f"), F.col(key).alias("_l"),
                     has_key.cast("bigint").alias("_n"), F.when(has_key, F.col(order)).alias("_b"))
    begins = has_key & ~F.col(key).eqNullSafe(F.col("_p"))
    return _runs_before(rows, by, order, bits).select(
        *df.columns, (F.col("_c") + begins.cast("bigint")).alias("run_id"),
        F.when(begins, F.col(order)).otherwise(F.col("_s")).alias("run_start"))


def run_ids(df, by, order, key, out="run_id", bits=ROW_BITS):
    """Number the contiguous runs of ``key`` from 1."""
    return runs(df, by, order, key, bits).drop("run_start").withColumnRenamed("run_id", out)


def run_counts(df, by, order, key, bits=ROW_BITS):
    """A1: one row per contiguous run of ``key``: run id, first and last row, row count.

    Counts are combined inside each bucket before they are shuffled. Rows before the first key
    belong to no run and are left out.
    """
    rows = df.select(*by, F.col(order).alias("_at"), F.col(key).alias("_name"))
    return (
        runs(rows, by, "_at", "_name", bits).where(F.col("run_id") > 0)
        .groupBy(*by, "run_id")
        .agg(F.max("_name").alias(key), F.min("_at").alias("first_row"), F.max("_at").alias("last_row"),
             F.count(F.lit(1)).alias("n_rows"))
    )


def slots(df, by, order, is_right, bits=TIME_BITS):
    """Greedy one-to-one slots: add ``slot`` to stacked left and right rows.

    Right rows have their own position. Left row ``i`` with ``lb`` right rows before it has slot
    ``i + max(lb - i)`` over the left rows so far: the nearest right row no earlier left row took.
    """
    rows = df.select("*", is_right.cast("bigint").alias("_r"), (~is_right).cast("bigint").alias("_l"),
                     F.when(~is_right, F.lit(0).cast("bigint")).alias("_m"))
    before = _slots_before(rows, by, order, bits)
    ahead = F.col("_r0") - F.col("_l0")
    return before.select(
        *df.columns,
        F.when(is_right, F.col("_r0"))
        .otherwise(F.col("_l0") + F.greatest(ahead, F.col("_m0"))).alias("slot"))


def _slots_before(df, by, order, bits, nested=False):
    """Exclusive totals: right rows, left rows, and the greatest lead of rights at a left row so far.

    An element has ``_r`` rights, ``_l`` lefts and the greatest lead ``_m`` counted from its start.
    """
    keys = [*by, _BUCKET] if bits else by
    source = df.withColumn(_BUCKET, _bucket_of(order, bits[0])) if bits else df
    if nested:
        source = source.repartition(*keys)  # one exchange for both uses below
    past = (Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast("bigint")
    local = (
        source.withColumn("_r0", F.coalesce(F.sum("_r").over(past), zero))
        .withColumn("_l0", F.coalesce(F.sum("_l").over(past), zero))
        .withColumn("_lead", F.col("_r0") - F.col("_l0") + F.col("_m"))
        .withColumn("_m0", F.max("_lead").over(past))
    )
    if not bits:
        return local.drop("_lead")

    totals = local.groupBy(*keys).agg(
        F.sum("_r").alias("_r"), F.sum("_l").alias("_l"), F.max("_lead").alias("_m"),
    ).withColumnRenamed(_BUCKET, "_key")
    carry = _slots_before(totals, by, "_key", bits[1:], nested=True).select(
        *by, F.col("_key").alias(_BUCKET), F.col("_r0").alias("_rc"), F.col("_l0").alias("_lc"),
        F.col("_m0").alias("_mc"))
    return local.join(carry, keys, "left").select(
        *df.columns, (F.col("_r0") + F.col("_rc")).alias("_r0"), (F.col("_l0") + F.col("_lc")).alias("_l0"),
        F.greatest(F.col("_m0") + F.col("_rc") - F.col("_lc"), F.col("_mc")).alias("_m0"))

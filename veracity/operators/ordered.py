"""Skew-safe ordered operations: medians, running sums, carried values, ranks.

A window ``OVER (PARTITION BY g ORDER BY x)`` sends a whole group to one task;
with a hot group (a third of all rows) that task is the job. Every function
here works in two levels instead, by one plan at every size:

* the order is cut into buckets by a monotone function of the order column, so
  that a hot group becomes many (group, bucket) windows;
* one row per (group, bucket) gives what the earlier buckets add: a count, a
  sum, the last value. Only that small table is ordered per group;
* where values may crowd into one bucket, fine buckets inside it do the same
  once more.

Buckets depend on nothing but the row itself, so both levels agree whatever is
recomputed after a lost executor, and nothing has to be written in between.
Callers aggregate equal values to one row first, so a tied value is one row.

Medians need no order at all: they are selected by counts over the bits of the values.

Ranks over text keys have no such function. They are range-partitioned, numbered
where they lie and written once (key columns only) to the checkpoint folder, so
that the row numbers and the counts per partition come from the same placement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Buckets per power of two of a double, and fine buckets, of which a bucket holds 65,536. A fine one holds at most four
#: million different doubles, however close together the values of a hot group lie.
STEPS, FINE = 1 << 14, 1 << 30
#: Integer positions per bucket.
SPAN = 4096
_TINY, _HUGE = 1e-300, 1e300


def value_bucket(v: Column, steps: int | None = None) -> Column:
    """Monotone whole number of a double: equal buckets of the logarithm, mirrored below zero; null stays null."""
    steps = steps or STEPS
    size = F.least(F.greatest(F.abs(v), F.lit(_TINY)), F.lit(_HUGE))
    step = F.floor(F.log2(size) * steps) + 1000 * steps
    return F.when(v.isNull(), F.lit(None).cast("long")).when(v > 0, step).when(v < 0, -step).otherwise(F.lit(0).cast("long"))


def fine_bucket(v: Column) -> Column:
    """The same in steps so small that close values part."""
    return value_bucket(v, FINE)


def position_bucket(order: list[str]) -> Column:
    """Bucket of rows ordered by whole numbers: all but the last column, and spans of the last."""
    return F.struct(*[F.col(c) for c in order[:-1]], F.floor(F.col(order[-1]) / SPAN).alias("_span"))


def _cells(df: DataFrame, group_cols: list[str], bucket: Column) -> DataFrame:
    """Adds ``_k``, group and bucket in one struct. Structs compare null fields as equal, so a plain equi-join on ``_k`` is
    null-safe, and windows, aggregates and joins over ``_k`` share one placement."""
    return df.withColumn("_k", F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group_cols)], bucket.alias("b")))


def _group(group_cols: list[str]) -> list[Column]:
    return [F.col(f"_k.g{i}") for i in range(len(group_cols))]


def _earlier(group_cols: list[str], descending: bool = False) -> "Window":
    b = F.col("_k.b")
    return Window.partitionBy(*_group(group_cols)).orderBy(b.desc() if descending else b).rowsBetween(Window.unboundedPreceding, -1)


def running_sums(df: DataFrame, group_cols: list[str], order: list[Column], weights: list[str], bucket: Column,
                 fine: Column | None = None) -> DataFrame:
    """Inclusive running sums ``cum_w`` and totals ``tot_w`` per group in ``order``; ``bucket`` ascends with the order, and
    so does ``fine`` inside a bucket, for orders that may lie close together.

    Sort keys should be unique within a group. Without group columns all rows are one group."""
    if not group_cols:
        return running_sums(df.withColumn("_all", F.lit(0)), ["_all"], order, weights, bucket, fine).drop("_all")
    d = _cells(df, group_cols, bucket)
    d = d.withColumn("_f", F.struct("_k", (F.lit(0) if fine is None else fine).alias("b")))
    small = d.groupBy("_f").agg(*[F.sum(w).alias("_t_" + w) for w in weights])
    large = small.groupBy(F.col("_f._k").alias("_k")).agg(*[F.sum("_t_" + w).alias("_t_" + w) for w in weights])
    before, whole = _earlier(group_cols), Window.partitionBy(*_group(group_cols))
    large = large.select(
        "_k", *[F.coalesce(F.sum("_t_" + w).over(before), F.lit(0)).alias("_o_" + w) for w in weights],
        *[F.sum("_t_" + w).over(whole).alias("tot_" + w) for w in weights])
    if fine is None:
        offsets = large.withColumn("_f", F.struct("_k", F.lit(0).alias("b"))).drop("_k")
    else:
        near = Window.partitionBy("_k").orderBy("_f.b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (small.withColumn("_k", F.col("_f._k")).select(
            "_k", "_f", *[F.coalesce(F.sum("_t_" + w).over(near), F.lit(0)).alias("_i_" + w) for w in weights])
            .join(large, "_k").select("_f", *["tot_" + w for w in weights], *[(F.col("_i_" + w) + F.col("_o_" + w)).alias("_o_" + w)
                                                                             for w in weights]))
    inside = Window.partitionBy("_f").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.sum(w).over(inside).alias("_l_" + w) for w in weights])
    return local.join(offsets, "_f").select(*df.columns, *[(F.col("_l_" + w) + F.col("_o_" + w)).alias("cum_" + w) for w in weights],
                                            *["tot_" + w for w in weights])


def carry_forward(df: DataFrame, group_cols: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Last non-null value of each of ``cols`` up to and including the row, per group in ascending ``order`` (columns
    ``ffill_<c>``, any type). The last order column holds whole numbers; rows of equal order are not ordered further."""
    d = _cells(df, group_cols, position_bucket(order))
    at = F.struct(*order)
    ends = d.groupBy("_k").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias("_e_" + c) for c in cols])
    before = _earlier(group_cols)
    offsets = ends.select("_k", *[F.last("_e_" + c, ignorenulls=True).over(before).alias("_p_" + c) for c in cols])
    inside = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.last(c, ignorenulls=True).over(inside).alias("_f_" + c) for c in cols])
    return local.join(offsets, "_k").select(*df.columns, *[F.coalesce("_f_" + c, "_p_" + c).alias("ffill_" + c) for c in cols])


def neighbours(df: DataFrame, group_cols: list[str], position: str, before_col: str, after_col: str) -> DataFrame:
    """One row per (group, whole-number position): adds ``left``, the last non-null ``before_col`` at a smaller position,
    and ``right``, the first non-null ``after_col`` at the same or a larger one."""
    d = _cells(df, group_cols, F.floor(F.col(position) / SPAN))
    b, a, p = F.col(before_col), F.col(after_col), F.col(position)
    ends = d.groupBy("_k").agg(F.max_by(b, F.when(b.isNotNull(), p)).alias("_e"), F.min_by(a, F.when(a.isNotNull(), p)).alias("_s"))
    offsets = ends.select("_k", F.last("_e", ignorenulls=True).over(_earlier(group_cols)).alias("_pe"),
                          F.last("_s", ignorenulls=True).over(_earlier(group_cols, descending=True)).alias("_ns"))
    inside = Window.partitionBy("_k")
    local = d.select("*", F.last(b, ignorenulls=True).over(inside.orderBy(p).rowsBetween(Window.unboundedPreceding, -1)).alias("_le"),
                     F.last(a, ignorenulls=True).over(inside.orderBy(p.desc()).rowsBetween(Window.unboundedPreceding, 0)).alias("_ls"))
    return local.join(offsets, "_k").select(*df.columns, F.coalesce("_le", "_pe").alias("left"), F.coalesce("_ls", "_ns").alias("right"))


_MANTISSA, _LEAST_NORMAL, _LEAST, _INF = 1 << 52, 2.0 ** -1022, 2.0 ** -1074, float("inf")
_MOST = 1.7976931348623157e308
#: Bits of an order key that a pass of the median has not looked at yet: a pass counts at most 2 ** 22 cells beside each
#: middle row (2 ** 20 in the first), whatever the group's size.
_PASSES = (44, 22, 0)


def order_key(v: Column) -> Column:
    """64-bit whole number of a double that orders as doubles do, and tells all doubles apart (both zeros are one, NaN is
    last): biased exponent above 52 bits of mantissa, negated below zero. Powers of two divide exactly."""
    a = F.greatest(F.least(F.abs(v), F.lit(_MOST)), F.lit(_LEAST_NORMAL))
    near = F.floor(F.log2(a))
    e = near + (a >= F.pow(F.lit(2.0), near + 1)).cast("int") - (a < F.pow(F.lit(2.0), near)).cast("int")
    size = (e + 1023) * F.lit(_MANTISSA) + ((a / F.pow(F.lit(2.0), e) - 1) * float(_MANTISSA)).cast("long")
    odd = (F.when(F.isnan(v), F.lit(2047 * _MANTISSA + 1)).when(v == _INF, F.lit(2047 * _MANTISSA))
           .when(v == -_INF, F.lit(-2047 * _MANTISSA)).when(F.abs(v) < _LEAST_NORMAL, (v / _LEAST).cast("long")))
    return F.coalesce(odd, size * F.signum(v).cast("int"))


def key_value(key: Column) -> Column:
    """The double of an :func:`order_key`."""
    k = F.abs(key)
    e, m = F.shiftright(k, 52), k.bitwiseAND(F.lit(_MANTISSA - 1)).cast("double")
    size = (F.when(k > 2047 * _MANTISSA, F.lit(float("nan"))).when(e == 2047, F.lit(_INF)).when(e == 0, m * _LEAST)
            .otherwise((1 + m / float(_MANTISSA)) * F.pow(F.lit(2.0), (e - 1023).cast("double"))))
    return F.when(key < 0, -size).otherwise(size)


def group_median(df: DataFrame, group_cols: list[str], value: str, out: str = "median", times: str | None = None) -> DataFrame:
    """Exact median (midpoint for even counts) of the non-null ``value`` per group; one row per group that has a value.
    ``times`` names a column that says how often the row's value counts.

    Radix selection: a pass counts the rows of every group per cell of the next bits of the order key (map-side), keeps the
    cells of the two middle rows, and the next pass counts inside these alone. The last pass has seen all bits, so the
    median is read off its cells: values are never sorted, shuffled one by one or written, a hot group's no more than
    others."""
    rows = df.where(F.col(value).isNotNull()).select(F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group_cols)]).alias("_g"),
                     order_key(F.col(value).cast("double")).alias("_x"), (F.col(times) if times else F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_g")
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    middle, seen = None, 64
    for rest in _PASSES:
        cell = F.shiftright("_x", rest).alias("_b")
        if middle is None:
            sizes = (rows.groupBy("_g", cell).agg(F.sum("_c").alias("_n")).withColumn("_all", F.sum("_n").over(whole))
                     .select("_g", "_b", "_n", F.floor((F.col("_all") - 1) / 2).alias("_lo"), F.floor(F.col("_all") / 2).alias("_hi")))
        else:
            # no row lies between the cells of the two middle rows
            inside = rows.join(middle, "_g").where(F.shiftright("_x", seen).between(F.col("_first"), F.col("_last")))
            sizes = inside.groupBy("_g", "_lo", "_hi", cell).agg(F.sum("_c").alias("_n"))
        end = F.col("_off") + F.col("_n")
        middle = (sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).groupBy("_g").agg(
            F.min(F.when(end > F.col("_lo"), F.col("_b"))).alias("_first"), F.min(F.when(end > F.col("_hi"), F.col("_b"))).alias("_last"),
            F.min(F.when(end > F.col("_lo"), F.col("_off"))).alias("_base"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")).select(
                "_g", "_first", "_last", (F.col("_lo") - F.col("_base")).alias("_lo"), (F.col("_hi") - F.col("_base")).alias("_hi")))
        seen = rest
    return middle.select(*[F.col(f"_g.g{i}").alias(c) for i, c in enumerate(group_cols)],
                         ((key_value(F.col("_first")) + key_value(F.col("_last"))) / 2).alias(out))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and continue from the
    files: cuts lineage (executor loss re-reads instead of recomputing) and
    stops multi-branch plans from recomputing their common input."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in global order: ``_pid``, the range partition, and ``_at``, the row's place there."""
    s = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    # the generated id holds the partition above 33 bits of row number
    return s.select("*", F.shiftright("_id", 33).alias("_pid"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")).drop("_id")


def global_rank(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """0-based position of every row in a global order (use on distinct keys to get a dense rank).

    The driver reads one count per range partition, nothing that grows with the rows."""
    s = _placed(df, order)
    sizes, offset, rows = s.groupBy("_pid").count().collect(), 0, []
    for r in sorted(sizes, key=lambda r: r["_pid"]):
        rows.append((r["_pid"], offset))
        offset += r["count"]
    offsets = df.sparkSession.createDataFrame(rows, "_pid long, _off long")
    return s.join(offsets, "_pid").select(*df.columns, (F.col("_at") + F.col("_off")).alias(out))


def group_rank(df: DataFrame, group_cols: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """0-based position of every row in its group; a hot group spans many range partitions, also where its first order
    column is tied."""
    s = _cells(_placed(df, [*[F.col(c) for c in group_cols], *order]), group_cols, F.col("_pid"))
    runs = s.groupBy("_k").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    offsets = runs.select("_k", "_first", F.coalesce(F.sum("_n").over(_earlier(group_cols)), F.lit(0)).alias("_off"))
    return s.join(offsets, "_k").select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_off")).alias(out))

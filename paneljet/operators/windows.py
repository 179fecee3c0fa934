"""Window operators W1, W2, W4-W9 and exact positions without a single-task window.

Windows are partitioned by entity/key; each partition holds the rows of one key ordered by
period, so its size is bounded by the number of periods in the panel. One-row-per-key
selections use ``row_number() == 1``: Spark inserts a partial window group limit before the
shuffle, so a hot key sends one row per input partition, not all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import round_half_even
from . import util
from .util import cut_lineage, cut_lineage_counted, every_period

Order = str | Column


def _order_cols(order: Sequence[Order]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def ffill(df: DataFrame, keys: Sequence[str], order: Sequence[Order], col: str,
          out: str | None = None) -> DataFrame:
    """Last non-NULL value so far within each key."""
    w = (Window.partitionBy(*keys).orderBy(*_order_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out or col, F.last(col, ignorenulls=True).over(w))


def bfill(df: DataFrame, keys: Sequence[str], order: Sequence[Order], col: str,
          out: str | None = None) -> DataFrame:
    """Next non-NULL value from here on within each key."""
    w = (Window.partitionBy(*keys).orderBy(*_order_cols(order))
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return df.withColumn(out or col, F.first(col, ignorenulls=True).over(w))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Order], col: str,
                out: str | None = None) -> DataFrame:
    """Cumulative total per key (rows frame: ties are counted one by one)."""
    w = (Window.partitionBy(*keys).orderBy(*_order_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out or f"cum_{col}", F.sum(col).over(w))


def positions(df: DataFrame, order: str, name: str = "pos") -> DataFrame:
    """1-based dense position of each distinct ``order`` value."""
    return _positions(df, order, name)[0]


def _positions(df: DataFrame, order: str, name: str) -> tuple[DataFrame, int]:
    """``positions`` and their number. A calendar-sized table is ranked as it is; a larger one is
    ranked inside ranges of the values, shifted by the sizes of the earlier ranges."""
    d, n = cut_lineage_counted(df.select(order).where(F.col(order).isNotNull()).distinct())
    if n <= util.MAX_CALENDAR_ROWS:
        return d.withColumn(name, F.dense_rank().over(Window.orderBy(order)).cast("int")), n
    # materialised once: ranks and offsets must see the same ranges
    ranged = cut_lineage(d.repartitionByRange(order).withColumn("_pid", F.spark_partition_id()))
    inner = F.row_number().over(Window.partitionBy("_pid").orderBy(order))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (ranged.withColumn("_r", inner).join(F.broadcast(sizes), "_pid")    # a row a partition
            .select(order, (F.col("_off") + F.col("_r")).cast("int").alias(name))), n


def expanding_ratio(df: DataFrame, keys: Sequence[str], order: str, num: str, den: str,
                    digits: int = 4, out: str = "ratio") -> DataFrame:
    """Ratio of cumulative sums for each prefix of the observed periods.

    Periods are the distinct ``order`` values of the whole input, numbered 1..n (``pos``). Every
    key of the input has a row for every position x: ``sum(num) / sum(den)`` over its rows with
    position <= x, NULL before its first row or while the denominator sum is 0, rounded half-even.

    Plan: sums per (key, period) (partial aggregate), cumulative sums over each key's own
    rows (window bounded by #periods), then each row covers the positions up to the next
    row of its key by ``explode(sequence)``, a key's first row also those before it - no
    key x period grid is shuffled. Positions are broadcast only while they are a calendar.
    """
    per = df.groupBy(*keys, order).agg(F.sum(num).alias("_n"), F.sum(den).alias("_d"))
    pos, n = _positions(per, order, "pos")
    if n <= util.MAX_CALENDAR_ROWS:
        pos = F.broadcast(pos)
    w = Window.partitionBy(*keys).orderBy("pos")
    wc = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (per.join(pos, order)
           .withColumn("_cn", F.sum(F.coalesce("_n", F.lit(0))).over(wc))
           .withColumn("_cd", F.sum(F.coalesce("_d", F.lit(0))).over(wc))
           .withColumn("_prev", F.lag("pos").over(w)).withColumn("_next", F.lead("pos").over(w)))
    ratio = round_half_even(F.try_divide(F.col("_cn"), F.col("_cd")), digits)
    first = F.when(F.col("_prev").isNull(), F.lit(1)).otherwise(F.col("pos"))
    expanded = cum.select(*keys, F.col("pos").alias("_from"), ratio.alias(out), F.explode(F.sequence(
        first, F.coalesce(F.col("_next") - 1, F.lit(n)))).alias("pos"))
    value = F.when(F.col("pos") >= F.col("_from"), F.col(out)).alias(out)
    return expanded.join(pos, "pos").select(*keys, order, "pos", value)


def scale_baseline(ratios: DataFrame, baseline: DataFrame, keys: Sequence[str],
                   ratio: str = "ratio", base: str = "baseline", out: str = "stock",
                   calendar: DataFrame | None = None) -> DataFrame:
    """Rounded ratio x initial stock, rounded half-even to units.

    Every baseline key appears for every position; keys without data get NULL. ``calendar``
    lists the positions (all columns of ``ratios`` but the keys and the ratio); without it they
    are taken from ``ratios``.
    """
    when = [c for c in ratios.columns if c not in keys and c != ratio]
    periods = (calendar if calendar is not None else ratios).select(*when).distinct()
    grid = every_period(baseline.select(*keys, base), periods)
    j = grid.join(ratios, [*keys, *when], "left")
    return j.withColumn(out, round_half_even(F.col(ratio) * F.col(base), 0))


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             rank_col: str = "_rn") -> DataFrame:
    """One row per key, the first in ``order`` (explicit, total tie-break).

    ``order`` should end in a unique column so the pick never depends on row order.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def best_value_row(df: DataFrame, keys: Sequence[str], value: str, tiebreak: Sequence[str]) -> DataFrame:
    """Highest ``value`` first, NULLs last, ties by ``tiebreak`` ascending."""
    return best_row(df, keys, [F.col(value).desc_nulls_last(), *[F.col(t).asc() for t in tiebreak]])


def first_wins_dedup(df: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """First occurrence per key by an explicit rank (never bare ``dropDuplicates``)."""
    return best_row(df, keys, [F.col(r).asc_nulls_last() for r in rank])


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per group by ``order``."""
    return best_row(df, keys, [F.col(o).desc_nulls_last() for o in order])


def weighted_positions(df: DataFrame, group: Sequence[str], value: str, weight: str) -> DataFrame:
    """Rank ranges of distinct values carrying a count: each row ``(group, value, weight)``
    gets ``first_rank`` and ``last_rank`` (1-based) of the rows it stands for, and ``n``.

    No group is sorted in one task: the (much smaller) table of value counts is
    range-partitioned on (group, value), summed inside each range, and offset by the totals
    of the group's earlier ranges. The ranged table is materialised once, so both branches see
    the same ranges.
    """
    d = cut_lineage(df.select(*group, value, weight).where(F.col(value).isNotNull())
                    .repartitionByRange(*group, value).withColumn("_pid", F.spark_partition_id()))
    local = d.withColumn("_cum", F.sum(weight).over(
        Window.partitionBy("_pid", *group).orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sizes = d.groupBy("_pid", *group).agg(F.sum(weight).alias("_c"))
    wg = Window.partitionBy(*group).orderBy("_pid")
    offsets = (sizes.withColumn("_off", F.coalesce(F.sum("_c").over(
        wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n", F.sum("_c").over(Window.partitionBy(*group))))
    j = local.join(offsets.select("_pid", *group, "_off", "n"), ["_pid", *group])
    return (j.withColumn("last_rank", F.col("_off") + F.col("_cum"))
            .withColumn("first_rank", F.col("last_rank") - F.col(weight) + 1)
            .drop("_pid", "_cum", "_off"))

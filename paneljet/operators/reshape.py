"""Reshape operators R1-R6.

Pivots always take an explicit value list: no extra job to discover the values, and a
schema that does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import period_step
from .util import every_period


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable",
         value: str = "value", drop_null: bool = False) -> DataFrame:
    """Wide to long. NULL values are kept unless ``drop_null``."""
    out = df.unpivot(list(ids), list(cols), var, value)
    return out.filter(F.col(value).isNotNull()) if drop_null else out


def stack_levels(df: DataFrame, ids: Sequence[str], col_levels: Mapping[str, tuple],
                 level_names: Sequence[str] = ("level0", "level1"), value: str = "value",
                 drop_null: bool = False) -> DataFrame:
    """R2: columns that stand for a (level0, level1) pair to long rows.

    ``col_levels`` maps each wide column to its tuple of labels. ``drop_null=True`` is the
    legacy stack (missing cells vanish), ``False`` keeps them.
    """
    structs = []
    for c, labels in col_levels.items():
        fields = [F.lit(lbl).cast("string").alias(n) for lbl, n in zip(labels, level_names)]
        structs.append(F.struct(*fields, F.col(c).alias(value)))
    out = (df.select(*ids, F.explode(F.array(*structs)).alias("_s"))
           .select(*ids, *[F.col(f"_s.{n}").alias(n) for n in level_names],
                   F.col(f"_s.{value}").alias(value)))
    return out.filter(F.col(value).isNotNull()) if drop_null else out


def _pivot_name(v, prefix: str, suffix: str) -> str:
    return f"{prefix}{v}{suffix}"


def _rename_pivoted(wide: DataFrame, keys: Sequence[str], pivot_values: Sequence, names: Mapping,
                    prefix: str, suffix: str, fill=None) -> DataFrame:
    cols = []
    for v in pivot_values:
        c = F.col(f"`{v}`")
        if fill is not None:
            c = F.coalesce(c, F.lit(fill))
        cols.append(c.alias(names.get(v, _pivot_name(v, prefix, suffix))))
    return wide.select(*keys, *cols)


def pivot_first(df: DataFrame, keys: Sequence[str], on: str, values: str,
                pivot_values: Sequence, names: Mapping | None = None, prefix: str = "",
                suffix: str = "") -> DataFrame:
    """Long to wide, one value per cell; every listed column exists even when empty.

    ``groupBy().pivot(on, values)`` with the explicit list (no job to discover values). Cells
    take the single non-NULL value of the group (``max`` keeps it deterministic if the
    input broke the one-value rule; check with ``assert_unique`` when that matters).
    """
    wide = df.groupBy(*keys).pivot(on, list(pivot_values)).agg(F.max(values))
    return _rename_pivoted(wide, keys, pivot_values, names or {}, prefix, suffix)


def pivot_sum(df: DataFrame, keys: Sequence[str], on: str, values: str | None,
              pivot_values: Sequence, names: Mapping | None = None, prefix: str = "",
              suffix: str = "", fill: float | int | None = 0) -> DataFrame:
    """Long to wide sum (``values``) or row count (``values=None``); gaps filled."""
    g = df.groupBy(*keys).pivot(on, list(pivot_values))
    wide = g.count() if values is None else g.agg(F.sum(values))
    return _rename_pivoted(wide, keys, pivot_values, names or {}, prefix, suffix, fill)


def period_table(spark_or_df, lo, hi, grain: str = "month", name: str = "period") -> DataFrame:
    """Calendar of period starts from ``lo`` to ``hi`` inclusive (literals or date strings).

    Its size is the length of the calendar, independent of the data volume.
    """
    spark = spark_or_df.sparkSession if isinstance(spark_or_df, DataFrame) else spark_or_df
    lo_c = F.to_date(F.lit(str(lo)))
    hi_c = F.to_date(F.lit(str(hi)))
    return spark.range(1).select(F.explode(F.sequence(lo_c, hi_c, period_step(grain))).alias(name))


def periods_of(df: DataFrame, col: str, grain: str = "month", name: str = "period") -> DataFrame:
    """Calendar spanning min..max of ``col`` (already period starts) in ``df``."""
    return (df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
            .select(F.explode(F.sequence("_lo", "_hi", period_step(grain))).alias(name)))


def densify(df: DataFrame, keys: Sequence[str], period: str, periods: DataFrame,
            fill_cols: Sequence[str], fill=0) -> DataFrame:
    """Every key group gets every period of ``periods``; gaps filled with ``fill``.

    ``periods`` meets the distinct keys in ``every_period`` (broadcast if it is a calendar, dealt
    over slices if it is larger); the data joins the grid on (keys, period).
    """
    grid = every_period(df.select(*keys).distinct(), periods.select(period))
    out = grid.join(df, [*keys, period], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in fill_cols})


def split_label(c: str | Column, sep: str = "_") -> tuple[Column, Column]:
    """Split at the first separator into (head, rest)."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(col, sep, 2)
    return F.get(parts, 0), F.get(parts, 1)

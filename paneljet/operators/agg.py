"""Aggregation operators A1-A13 (A7 lives in ``lifecycle``).

All are single ``groupBy().agg`` passes with partial (map-side) aggregation; the validation
operators are the only actions and are opt-in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import safe_ratio
from .util import ValidationError, cut_lineage
from .windows import weighted_positions


def _keyed(df: DataFrame, keys: Sequence[str], drop_null_keys: bool) -> DataFrame:
    """Rows with a NULL grouping key form no group (pandas ``groupby`` semantics) unless
    ``drop_null_keys`` is False (Spark keeps a NULL group)."""
    return df.dropna(subset=list(keys)) if drop_null_keys and keys else df


def group_sum(df: DataFrame, keys: Sequence[str], cols: Sequence[str], empty: str = "null",
              suffix: str = "", drop_null_keys: bool = True) -> DataFrame:
    """A1: sums per key; an all-NULL group gives NULL (``empty="null"``, pandas
    ``min_count=1``) or 0 (``empty="zero"``, the pandas default)."""
    df = _keyed(df, keys, drop_null_keys)
    aggs = []
    for c in cols:
        s = F.sum(c)
        if empty == "zero":
            s = F.coalesce(s, F.lit(0))
        aggs.append(s.alias(f"{c}{suffix}"))
    return df.groupBy(*keys).agg(*aggs)


def missing_profile(df: DataFrame, by: Sequence[str], id_col: str, col: str,
                    digits: int | None = None, drop_null_keys: bool = True) -> DataFrame:
    """A2: distinct entities, rows with ``col`` missing, and % missing by group."""
    out = _keyed(df, by, drop_null_keys).groupBy(*by).agg(F.countDistinct(id_col).alias("number_station"),
                              F.count_if(F.col(col).isNull()).alias("n_missing"))
    return out.withColumn("percent_missing",
                          safe_ratio("n_missing", "number_station", pct=True, digits=digits))


def with_total_row(df: DataFrame, label_col: str, sum_cols: Sequence[str],
                   ratio: tuple[str, str, str] | None = None, total_label: str = "Total",
                   order: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """A3: groups plus a total row whose sums add up the groups and whose percentage is
    recomputed from the totals (not averaged). ``ratio = (out, num, den)``.

    With ``order`` the rows get ``row_order``: groups in that order, the total last.
    """
    agg = df.rollup(label_col).agg(*[F.sum(c).alias(c) for c in sum_cols],
                                   F.grouping(label_col).alias("_is_total"))
    agg = agg.withColumn(label_col, F.when(F.col("_is_total") == 1, F.lit(total_label))
                         .otherwise(F.col(label_col)))
    if ratio:
        out, num, den = ratio
        agg = agg.withColumn(out, safe_ratio(num, den, pct=True, digits=digits))
    if order:
        pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(label_col))
        agg = agg.withColumn("row_order", F.when(F.col("_is_total") == 1, F.lit(len(order) + 1))
                             .otherwise(pos).cast("int"))
    return agg.drop("_is_total")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n",
             drop_null_keys: bool = True) -> DataFrame:
    """A4."""
    return _keyed(df, keys, drop_null_keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_share(df: DataFrame, id_col: str, cond_a: Column, cond_b: Column,
                   by: Sequence[str] = ()) -> DataFrame:
    """A5: distinct ids meeting a and b, meeting b, and their ratio."""
    out = df.groupBy(*by).agg(
        F.countDistinct(F.when(cond_a & cond_b, F.col(id_col))).alias("n_both"),
        F.countDistinct(F.when(cond_b, F.col(id_col))).alias("n_b"))
    return out.withColumn("share", safe_ratio("n_both", "n_b"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A6 (lazy part): keys with more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "frame", show: int = 10) -> None:
    """A6 (action): fail listing up to ``show`` keys that have more than one row."""
    dups = duplicate_keys(df, keys).limit(show).collect()
    if dups:
        raise ValidationError(f"{what}: duplicate keys {list(keys)}: "
                              + "; ".join(str(r.asDict()) for r in dups))


def date_range(df: DataFrame, col: str, grain_col: Column | None = None) -> DataFrame:
    """Min and max date and number of distinct months."""
    m = grain_col if grain_col is not None else F.trunc(F.to_date(F.col(col)), "MM")
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"),
                  F.countDistinct(m).alias("n_months"))


def missing_all(df: DataFrame, cols: Sequence[str]) -> Column:
    """Predicate true where every listed column is NULL."""
    return F.coalesce(*[F.col(c) for c in cols]).isNull()


ACCURACY = 10_000       # a sketched rank is off by at most one part in so many
QUARTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def describe(df: DataFrame, cols: Sequence[str], var: str = "variable") -> DataFrame:
    """A10: count, mean, sd, min, p25, p50, p75, max per variable (Stata ``summarize,
    detail`` quantile rule: with R = n*p, whole R -> mean of x_R and x_{R+1}, else
    x_ceil(R)).

    Exact selection in two passes over the melted columns. The first takes the moments and, from
    a mergeable sketch with a bounded rank error, values on either side of every quartile; the
    second counts the rows below each bracket and the values inside it (partial aggregates).
    Only those, under a thousandth of the rows apart from ties, are ordered; a quartile
    outside its bracket would be an error, never a wrong value.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(var), F.col(c).cast("double").alias("x")) for c in cols
    ])).alias("_s")).select(f"_s.{var}", "_s.x").where(F.col("x").isNotNull())
    sides = [min(1.0, max(0.0, p + s * 2 / ACCURACY)) for _, p in QUARTILES for s in (-1, 1)]
    moments = cut_lineage(long.groupBy(var).agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.percentile_approx("x", sides, ACCURACY).alias("_edge")))
    edges = moments.select(F.col(var).alias("_v"), F.col("count").alias("_total"), "_edge")
    rows = long.join(F.broadcast(edges), F.col(var) == F.col("_v"))      # a row per column
    low = [F.col("_edge")[2 * q] for q in range(len(QUARTILES))]
    high = [F.col("_edge")[2 * q + 1] for q in range(len(QUARTILES))]
    below = rows.groupBy(F.col(var).alias("_v"), "_total").agg(
        *[F.count_if(F.col("x") < a).alias(f"_b{q}") for q, a in enumerate(low)])
    held = F.array_compact(F.array(*[F.when(F.col("x").between(a, b), F.lit(q))
                                     for q, (a, b) in enumerate(zip(low, high))]))
    counts = rows.select(var, "x", F.explode(held).alias("_q")).groupBy(var, "_q", "x").agg(
        F.count(F.lit(1)).alias("_w"))
    ranked = weighted_positions(counts, [var, "_q"], "x", "_w").join(below, F.col(var) == F.col("_v"))
    picks = []
    for q, (name, p) in enumerate(QUARTILES):
        r = F.col("_total") * F.lit(p)
        whole = r == F.floor(r)
        lo = F.when(whole, F.floor(r)).otherwise(F.ceil(r)).cast("long")
        hi = F.when(whole, F.floor(r) + 1).otherwise(F.ceil(r)).cast("long")

        def at(k, q=q):
            k = k - F.col(f"_b{q}")
            hit = (F.col("_q") == q) & (F.col("first_rank") <= k) & (F.col("last_rank") >= k)
            return F.max(F.when(hit, F.col("x")))

        pick = (at(lo) + at(hi)) / 2
        picks.append(F.coalesce(pick, F.raise_error(F.lit(f"{name} lies outside its bracket")).cast("double")).alias(name))
    quart = ranked.groupBy(var).agg(*picks)
    return moments.join(quart, var).select(var, "count", "mean", "sd", "min", "p25", "p50",
                                           "p75", "max")


def pairwise_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation matrix in long form (var1, var2, corr); pairwise complete rows
    (Spark's ``corr`` skips rows where either side is NULL).

    One aggregate computes the K(K+1)/2 distinct coefficients; the matrix is mirrored.
    """
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
                        .alias(f"{a}\u0001{b}"))
    wide = df.agg(*aggs)

    def cell(a, b):
        i, j = cols.index(a), cols.index(b)
        x, y = (a, b) if i <= j else (b, a)
        return F.col(f"`{x}\u0001{y}`")

    pairs = [F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), cell(a, b).alias("corr"))
             for a in cols for b in cols]
    return wide.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def share_of_flag(df: DataFrame, keys: Sequence[str], flag: Column, measure: str,
                  out: str = "share", drop_null_keys: bool = True) -> DataFrame:
    """Flagged total over total by key (NULL when the total is 0)."""
    return (_keyed(df, keys, drop_null_keys).groupBy(*keys).agg(F.sum(F.when(flag, F.col(measure))).alias("flagged"),
                                  F.sum(measure).alias("total"))
            .withColumn(out, safe_ratio("flagged", "total")))


def category_split_totals(long: DataFrame, date: str, category: str, unit: str, value: str,
                          central_units: Sequence[str], categories: Sequence[str],
                          prefix: str, unit_out: str = "unit") -> DataFrame:
    """Local values per (unit, date) pivoted by category; central = sum over the
    central units per (date, category) (NULL when all missing); total = local + central
    with missing as 0.

    The central table has one row per date (a calendar-sized frame), joined m:1 by date.
    Missing values are dropped first (the long table comes from a stack that drops them),
    so a unit-date with no value at all has no row. A value without a unit, a category outside
    ``categories`` and a local (unit, date, category) that occurs twice are errors.
    """
    long = long.where(F.col(value).isNotNull()).withColumn(unit, F.coalesce(
        F.col(unit), F.raise_error(F.lit("a value without a unit")).cast(long.schema[unit].dataType)))
    known = F.coalesce(F.col(category).isin(list(categories)), F.lit(False))
    long = long.withColumn(category, F.when(known, F.col(category)).otherwise(F.raise_error(
        F.concat(F.lit("unknown category: "), F.coalesce(F.col(category).cast("string"), F.lit("null"))))))

    def only(c):
        mine = F.when(F.col(category) == F.lit(c), F.col(value))
        return F.when(F.count(mine) > 1, F.raise_error(F.lit(f"duplicate local key in category {c}"))
                      ).otherwise(F.max(mine))

    is_central = F.col(unit).isin(list(central_units))
    local = long.where(~is_central)
    local_wide = local.groupBy(F.col(unit).alias(unit_out), date).agg(*[
        only(c).alias(f"{prefix}_{c}_local")
        for c in categories])
    cent = long.where(is_central).groupBy(date).agg(*[
        F.sum(F.when(F.col(category) == F.lit(c), F.col(value))).alias(f"central_{c}")
        for c in categories])
    j = local_wide.join(cent, date, "left")
    totals = {f"{prefix}_{c}_total": F.coalesce(F.col(f"{prefix}_{c}_local").cast("double"),
                                                F.lit(0.0))
              + F.coalesce(F.col(f"central_{c}").cast("double"), F.lit(0.0))
              for c in categories}
    return j.withColumns(totals).drop(*[f"central_{c}" for c in categories])


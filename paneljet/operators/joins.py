"""Join operators J1-J12.

Catalyst chooses the physical join. Explicit broadcast hints are only put on calendars, whose
size is checked (``every_period``). Validations are opt-in actions; everything else is lazy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import add_periods
from .agg import assert_unique
from .reshape import densify
from .util import ValidationError, every_period


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], validate: str | None = None,
              require_match: str | None = None, what: str = "join") -> DataFrame:
    """Left join with optional cardinality check (``"m:1"``: right keys unique,
    ``"1:1"``: both unique) and optional completeness check: ``require_match`` names a
    right-side column that must be non-NULL for every left row after the join.

    NULL keys never match (Spark equality), unlike pandas merges.
    """
    if validate in ("m:1", "1:1"):
        assert_unique(right, keys, f"{what}: right side")
    if validate in ("1:m", "1:1"):
        assert_unique(left, keys, f"{what}: left side")
    out = left.join(right, list(keys), "left")
    if require_match:
        missing = out.where(F.col(require_match).isNull()).select(*keys).limit(10).collect()
        if missing:
            raise ValidationError(f"{what}: unmatched rows, e.g. {[r.asDict() for r in missing]}")
    return out


def outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str], prefer: str = "right",
               fill_zero: Sequence[str] = ()) -> DataFrame:
    """Full outer join. Columns on both sides are merged with the preferred side first;
    ``fill_zero`` measures become 0 when missing on both."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    l = left.select(*keys, *[F.col(c).alias(f"{c}__l") if c in shared else F.col(c)
                             for c in left.columns if c not in keys])
    r = right.select(*keys, *[F.col(c).alias(f"{c}__r") if c in shared else F.col(c)
                              for c in right.columns if c not in keys])
    j = l.join(r, list(keys), "full")
    for c in shared:
        a, b = (f"{c}__r", f"{c}__l") if prefer == "right" else (f"{c}__l", f"{c}__r")
        j = j.withColumn(c, F.coalesce(F.col(a), F.col(b))).drop(f"{c}__l", f"{c}__r")
    if fill_zero:
        j = j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in fill_zero})
    return j


def grid(ids: DataFrame, periods: DataFrame) -> DataFrame:
    """Every id with every period; a calendar is broadcast, more periods are dealt over slices."""
    return every_period(ids, periods)


def calendar_lag(df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str],
                 months: int = 12, prefix: str = "lag1y_") -> DataFrame:
    """Value exactly ``months`` earlier, matched by calendar date (not by row).

    Self-join on (keys, date + months). Dates that a shorter month cuts off meet on its last
    day (29 Feb + 12 months is 28 Feb); the latest of them gives the value. (keys, date) must be
    unique; a repeated one is an error. Must run on the full history, before any filtering to
    the panel months.
    """
    def only(c):
        repeated = F.count(F.lit(1)) > F.size(F.collect_set("_from"))
        return F.when(repeated, F.raise_error(F.lit("calendar_lag: keys and date repeat"))
                      ).otherwise(F.max_by(c, "_from"))

    lagged = (df.withColumn("_from", F.col(date))
              .groupBy(*keys, add_periods(date, months, "month").alias(date))
              .agg(*[only(c).alias(f"{prefix}{c}") for c in cols]))
    return df.join(lagged, [*keys, date], "left")


def calendar_shift(df: DataFrame, date: str, years: int = -1) -> DataFrame:
    """Re-date rows by whole years (proxy for another year)."""
    return df.withColumn(date, F.add_months(F.col(date), 12 * years))


def _first_open_month(open_col):
    """Earliest month start M with open <= M (timestamps compare at full precision)."""
    m = F.trunc(F.to_date(open_col), "MM")
    return F.when(open_col.cast("timestamp_ntz") <= m.cast("timestamp_ntz"), m).otherwise(
        F.add_months(m, 1))


def open_spans(df: DataFrame, open_col: str, close_col: str, by: Sequence[str],
               status_col: str | None = None, active_value=1,
               weight: str | None = None) -> DataFrame:
    """J7, step 1: for each entity the first and the last month start at which it is open -
    ``a`` = earliest month start >= open, ``b`` = month of close (NULL when it never closes:
    no close date, or ``status == active_value``) - plus ``open_month``, the month of the
    open date. Identical spans are counted in ``w`` by a partial aggregate, so the result is
    bounded by groups x months x span lengths, whatever the number of entities. NULL
    ``open`` never counts.
    """
    close = F.col(close_col)
    if status_col:
        close = F.when(F.col(status_col) == F.lit(active_value), F.lit(None)).otherwise(close)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return (df.where(F.col(open_col).isNotNull())
            .select(*by, F.trunc(F.to_date(open_col), "MM").alias("open_month"),
                    _first_open_month(F.col(open_col)).alias("a"),
                    F.trunc(F.to_date(close), "MM").alias("b"), w.alias("_w"))
            .groupBy(*by, "open_month", "a", "b").agg(F.sum("_w").alias("w")))


def count_open(spans: DataFrame, by: Sequence[str], periods: DataFrame, period: str = "month",
               name: str = "n_open") -> DataFrame:
    """J7, step 2: clamp the spans to the calendar and count, per group, the entities open at
    each month start. A difference array instead of a range join: +w at a span's first month,
    -w after its last; running sums per group over the calendar (bounded by #months) give
    the counts, and every (group, month) of the calendar is present (0 when none is open).
    """
    from pyspark.sql import Window

    cal = periods.select(F.col(period).alias("_m"))
    bounds = cal.agg(F.min("_m").alias("_lo"), F.max("_m").alias("_hi"))
    ent = (spans.crossJoin(F.broadcast(bounds))
           .select(*by, "w", F.greatest("a", "_lo").alias("_a"),
                   F.when(F.col("b").isNull(), F.col("_hi")).otherwise(F.least("b", "_hi")).alias("_b"))
           .where(F.col("_a") <= F.col("_b")))
    deltas = (ent.select(*by, F.explode(F.array(
        F.struct(F.col("_a").alias("_m"), F.col("w").alias("_d")),
        F.struct(F.add_months("_b", 1).alias("_m"), (-F.col("w")).alias("_d")))).alias("_x"))
        .select(*by, "_x._m", "_x._d")
        .groupBy(*by, "_m").agg(F.sum("_d").alias("_d")))
    dense = densify(deltas, by, "_m", cal, ["_d"], 0)
    win = Window.partitionBy(*by).orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    return (dense.withColumn(name, F.sum("_d").over(win).cast("long"))
            .select(*by, F.col("_m").alias(period), name))


def active_count(df: DataFrame, open_col: str, close_col: str, by: Sequence[str],
                 periods: DataFrame, period: str = "month", status_col: str | None = None,
                 active_value=1, name: str = "n_open", weight: str | None = None) -> DataFrame:
    """Entities open at each month start M: ``open <= M`` and (``close`` NULL or
    ``close >= M``), counted by ``by`` x month; rows with ``status == active_value`` have no
    close date; NULL ``open`` never counts. ``open_spans`` then ``count_open``: cost is
    O(entities) for a partial aggregate plus O(groups x months), independent of interval
    lengths. ``weight`` names a count column when rows stand for several entities.
    """
    spans = open_spans(df, open_col, close_col, by, status_col, active_value, weight)
    return count_open(spans, by, periods, period, name)


def semi_join(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in another set (columns in input order)."""
    return df.join(keys_df.select(*keys), list(keys), "left_semi").select(*df.columns)


def anti_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (columns in input order)."""
    return left.join(right.select(*keys), list(keys), "left_anti").select(*left.columns)


def union_sources(frames: Sequence[tuple[DataFrame, Mapping[str, str]]], rank_col: str = "source_rank") -> DataFrame:
    """S3: rename each input to one shape, tag its rank (list order), union by name."""
    out = None
    for i, (df, renames) in enumerate(frames, start=1):
        shaped = df.select(*[F.col(src).alias(dst) for src, dst in renames.items()],
                           F.lit(i).alias(rank_col))
        out = shaped if out is None else out.unionByName(shaped, allowMissingColumns=True)
    return out


def priority_lookup(frames: Sequence[tuple[DataFrame, Mapping[str, str]]], key: str,
                    required: Sequence[str], tiebreak: Sequence[str] = (),
                    rank_col: str = "source_rank") -> DataFrame:
    """One row per key, taken from the best-ranked source whose required attributes
    are all present; ties by source order, then ``tiebreak`` columns ascending."""
    from .windows import first_wins_dedup

    u = union_sources(frames, rank_col).dropna(subset=[key, *required])
    return first_wins_dedup(u, [key], [rank_col, *tiebreak])


def alias_expand(df: DataFrame, aliases: DataFrame, name: str, alias_col: str = "alias",
                 target_col: str = "name") -> DataFrame:
    """Rows also appear under each alternative name of their name.

    ``aliases`` is ``(alias, name)``. It is grouped to one list of alternatives per name; each
    input row is then exploded into itself plus its aliases in a single pass (the input is not
    read twice). The join is broadcast or shuffled by measured size.
    """
    a = aliases.groupBy(target_col).agg(F.collect_list(alias_col).alias("_alts"))
    j = df.join(a, df[name] == a[target_col], "left")
    names = F.concat(F.array(df[name]), F.coalesce(F.col("_alts"), F.array().cast("array<string>")))
    return j.select(*[F.explode(names).alias(name) if c == name else df[c] for c in df.columns])


def attach(df: DataFrame, lookup: DataFrame, on: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Left join on a name, then drop rows without the required attributes
    (Catalyst turns this into an inner join)."""
    return df.join(lookup, list(on), "left").dropna(subset=list(required))

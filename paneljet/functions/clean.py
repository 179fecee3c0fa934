"""Cleaning and projection operators (P1-P20) as column expressions.

Everything here is a built-in Spark expression, so it stays inside whole-stage codegen and
runs where the data is. Functions that take a DataFrame return a DataFrame; the others
return a ``Column``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------------------
# Periods (P2 and the grain used by lifecycle/panel operators)
# ---------------------------------------------------------------------------------------

_GRAINS = {"day", "week", "month", "quarter", "year"}


def period_start(c: ColumnOrName, grain: str = "month") -> Column:
    """P2 generalised: first day of the period containing ``c``, as DATE."""
    if grain not in _GRAINS:
        raise ValueError(f"unknown grain {grain!r}; use one of {sorted(_GRAINS)}")
    if grain == "day":
        return F.to_date(_col(c))
    return F.to_date(F.date_trunc(grain, _col(c)))


def month_start(c: ColumnOrName) -> Column:
    """Truncate a date/timestamp to the first of its month."""
    return F.trunc(F.to_date(_col(c)), "MM")


def period_step(grain: str) -> Column:
    """Interval literal of one period, for ``sequence``."""
    unit = {"day": "1 DAY", "week": "7 DAYS", "month": "1 MONTH", "quarter": "3 MONTHS",
            "year": "12 MONTHS"}[grain]
    return F.expr(f"INTERVAL {unit}")


def add_periods(c: ColumnOrName, n: int | Column, grain: str = "month") -> Column:
    """Shift a period start by ``n`` periods (calendar arithmetic, not row arithmetic)."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    if grain == "day":
        return F.date_add(_col(c), n_col)
    if grain == "week":
        return F.date_add(_col(c), n_col * 7)
    months = {"month": 1, "quarter": 3, "year": 12}[grain]
    return F.add_months(_col(c), n_col * months)


# ---------------------------------------------------------------------------------------
# Dates from text
# ---------------------------------------------------------------------------------------

def parse_date_col(c: ColumnOrName, formats: Sequence[str]) -> Column:
    """Try each pattern in order; NULL when none matches (never raises)."""
    parts = [F.try_to_date(F.trim(_col(c)), f) for f in formats]
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def parse_date(df: DataFrame, col: str, formats: Sequence[str], on_invalid: str = "drop",
               out: str | None = None, observation: Observation | None = None) -> DataFrame:
    """Parse ``col`` with ``formats``.

    ``on_invalid``: ``"null"`` keeps the row with NULL, ``"drop"`` removes it, ``"fail"``
    raises at execution time on the first non-blank text that no format reads. Pass an
    ``Observation`` to receive ``n_rows``/``n_invalid`` counts from the same pass.
    """
    out = out or col
    raw = F.col(col)
    parsed = parse_date_col(raw, formats)
    blank = raw.isNull() | (F.trim(raw.cast("string")) == "")
    invalid = parsed.isNull() & ~blank
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("n_rows"),
                        F.count_if(parsed.isNull()).alias("n_invalid"))
    if on_invalid == "null":
        return df.withColumn(out, parsed)
    if on_invalid == "drop":
        return df.withColumn(out, parsed).filter(F.col(out).isNotNull())
    if on_invalid == "fail":
        checked = F.when(invalid, F.raise_error(F.concat(
            F.lit(f"unparseable date in column {col}: "), raw.cast("string")))).otherwise(parsed)
        return df.withColumn(out, checked.cast("date"))
    raise ValueError("on_invalid must be 'drop', 'fail' or 'null'")


def roc_date(c: ColumnOrName) -> Column:
    """7-digit ROC calendar text ``yyyMMdd`` (year + 1911) to DATE; invalid -> NULL.

    Short inputs are left-padded with zeros first, as the digits are positional.
    """
    s = F.lpad(F.trim(_col(c).cast("string")), 7, "0")
    year = F.substring(s, 1, 3).try_cast("int") + F.lit(1911)
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.substring(s, 4, 4))
    ok = s.rlike(r"^[0-9]{7}$")
    return F.when(ok, F.try_to_date(text, "yyyyMMdd"))


# ---------------------------------------------------------------------------------------
# Text and values
# ---------------------------------------------------------------------------------------

def normalize_text(c: ColumnOrName, pairs: Sequence[tuple[str, str]] = (), strip: bool = True,
                   case: str | None = None) -> Column:
    """Literal replacements in order, then optional trim and case change."""
    out = _col(c).cast("string")
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    if strip:
        out = F.trim(out)
    if case == "title":
        out = F.initcap(out)
    elif case == "upper":
        out = F.upper(out)
    elif case == "lower":
        out = F.lower(out)
    return out


def map_values(c: ColumnOrName, mapping: Mapping, default: str = "keep") -> Column:
    """P5: dictionary recode through a literal map.

    ``default="keep"`` keeps unmapped values, ``default="null"`` turns them into NULL. For
    mappings too large to inline, join with a lookup DataFrame instead.
    """
    if not mapping:
        return _col(c) if default == "keep" else F.lit(None)
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    looked = F.try_element_at(m, _col(c))
    return F.coalesce(looked, _col(c)) if default == "keep" else looked


def recode_join(df: DataFrame, col: str, lookup: DataFrame, key: str = "from", value: str = "to",
                default: str = "keep", out: str | None = None) -> DataFrame:
    """P5 for large mappings: recode ``col`` through a lookup table ``(key, value)``.

    The join is broadcast or shuffled by measured size; ``default="keep"`` keeps unmapped
    values, ``"null"`` turns them into NULL. Lookup keys must be unique.
    """
    lk = lookup.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = df.join(lk, df[col] == lk["_k"], "left")
    new = F.coalesce(F.col("_v"), F.col(col)) if default == "keep" else F.col("_v")
    return j.withColumn(out or col, new).drop("_k", "_v")


def to_number(c: ColumnOrName, dtype: str = "double") -> Column:
    """Lenient numeric cast; text that is not a number becomes NULL.

    Surrounding blanks are removed first; ``1,234`` is not a number; NaN becomes NULL.
    """
    s = F.trim(_col(c).cast("string"))
    v = s.try_cast(dtype)
    if dtype in ("double", "float"):
        v = F.when(~F.isnan(v), v)
    return v


# ---------------------------------------------------------------------------------------
# Projections, missing data and predicates
# ---------------------------------------------------------------------------------------

def keep_columns(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, dict]:
    """Project ``wanted`` in order, skipping absent names; report kept/missing/dropped."""
    present = set(df.columns)
    kept = [c for c in wanted if c in present]
    report = {"kept": kept, "missing": [c for c in wanted if c not in present],
              "dropped": [c for c in df.columns if c not in set(kept)]}
    return df.select(*kept), report


def drop_if_exists(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Idempotent drop before a re-merge."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def first_missing_column(cols: Sequence[str]) -> Column:
    """Name of the first column (in list order) that is NULL, else NULL."""
    expr = F.lit(None).cast("string")
    for c in reversed(cols):
        expr = F.when(F.col(c).isNull(), F.lit(c)).otherwise(expr)
    return expr


def drop_missing(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Listwise deletion and a lazy report of rows lost at each step.

    The report has one row per column that removed something: ``(step, col, n_dropped)``
    where a row is charged to the first listed column it is missing. Both frames are lazy;
    the report costs one aggregation pass.
    """
    kept = df.dropna(subset=list(cols))
    order = {c: i + 1 for i, c in enumerate(cols)}
    first = first_missing_column(cols)
    report = (df.select(first.alias("col")).filter(F.col("col").isNotNull())
              .groupBy("col").agg(F.count(F.lit(1)).alias("n_dropped"))
              .withColumn("step", map_values(F.col("col"), order, default="null").cast("int"))
              .select("step", "col", "n_dropped"))
    return kept, report


def fill_missing(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    """Constant fill for genuine zeros."""
    return df.fillna(value, subset=list(cols))


def filter_members(df: DataFrame, col: str, values: Sequence, keep: bool = True) -> DataFrame:
    """P10: keep (or drop) rows whose value is in a list. NULL is never a member."""
    cond = F.col(col).isin(list(values))
    return df.filter(cond if keep else (~cond | F.col(col).isNull()))


def starts_with_any(c: ColumnOrName, prefixes: Sequence[str]) -> Column:
    """Prefix predicate."""
    out = F.lit(False)
    for p in prefixes:
        out = out | _col(c).startswith(p)
    return out


# ---------------------------------------------------------------------------------------
# Extraction and keys
# ---------------------------------------------------------------------------------------

def extract_ll(c: ColumnOrName) -> tuple[Column, Column]:
    """``(lat, lon)`` from an ``ll=lat,lon`` URL parameter; NULL when absent."""
    pat = r"ll=(-?[0-9]+(?:\.[0-9]+)?),(-?[0-9]+(?:\.[0-9]+)?)"
    lat = F.nullif(F.regexp_extract(_col(c), pat, 1), F.lit("")).try_cast("double")
    lon = F.nullif(F.regexp_extract(_col(c), pat, 2), F.lit("")).try_cast("double")
    return lat, lon


def extract_between(c: ColumnOrName, start: str, stop: str = "/") -> Column:
    """Text between a marker and the next ``stop`` character; NULL when absent."""
    import re

    pat = re.escape(start) + "([^" + re.escape(stop) + "]+)"
    return F.nullif(F.regexp_extract(_col(c), pat, 1), F.lit(""))


def extract_path_id(c: ColumnOrName, marker: str = "/vmid/") -> Column:
    """Id between ``marker`` and the next ``/``."""
    return extract_between(c, marker, "/")


def composite_key(cols: Sequence[ColumnOrName], sep: str = "") -> Column:
    """Concatenated key; NULL if any part is NULL (``concat_ws`` alone would skip it)."""
    parts = [_col(c).cast("string") for c in cols]
    any_null = F.lit(False)
    for p in parts:
        any_null = any_null | p.isNull()
    return F.when(~any_null, F.concat_ws(sep, *parts))


def first_non_null(*cols: ColumnOrName) -> Column:
    """P14."""
    return F.coalesce(*[_col(c) for c in cols])


# ---------------------------------------------------------------------------------------
# arithmetic
# ---------------------------------------------------------------------------------------

def log_col(c: ColumnOrName, kind: str) -> Column:
    """The four log transforms of the panel code. NULL stays NULL in every kind.

    * ``log1p_nonneg``: ln(1+x) if x >= 0 else NULL
    * ``log1p_clip0``:  ln(max(x, 0) + 1)
    * ``log_clip1``:    ln(max(x, 1))
    * ``log1p``:        ln(x + 1) (NULL when x <= -1)
    """
    x = _col(c).cast("double")
    if kind == "log1p_nonneg":
        return F.when(x >= 0, F.log1p(x))
    if kind == "log1p_clip0":
        return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))
    if kind == "log_clip1":
        return F.when(x.isNotNull(), F.ln(F.greatest(x, F.lit(1.0))))
    if kind == "log1p":
        return F.when(x > -1, F.log1p(x))
    raise ValueError(f"unknown log kind {kind!r}")


def log_columns(df: DataFrame, cols: Sequence[str], kind: str, prefix: str = "ln_") -> DataFrame:
    """P15 over several columns, output named ``prefix + col``."""
    return df.withColumns({f"{prefix}{c}": log_col(c, kind) for c in cols})


def interactions(df: DataFrame, base: str, terms: Mapping[str, Sequence[str]],
                 base_kind: str = "log_clip1", prefix: str = "iv_") -> DataFrame:
    """``log(base) * log1p(sum of the listed lagged columns)`` per named term.

    A term whose inputs contain a NULL is NULL (sum of chains propagates missing).
    """
    lb = log_col(base, base_kind)
    new = {}
    for name, cols in terms.items():
        total = None
        for c in cols:
            total = F.col(c) if total is None else total + F.col(c)
        new[f"{prefix}{name}"] = lb * log_col(total, "log1p_clip0")
    return df.withColumns(new)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, pct: bool = False, digits: int | None = None,
               zero: str = "null") -> Column:
    """num/den, NULL (``zero="null"``) or 0 (``zero="zero"``) when den is 0 or NULL."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    r = F.try_divide(n, d)
    if pct:
        r = r * 100.0
    if zero == "zero":
        r = F.coalesce(r, F.lit(0.0))
    if digits is not None:
        r = round_half_even(r, digits)
    return r


def round_half_even(c: ColumnOrName, digits: int = 0) -> Column:
    """Numpy-style rounding: scale, round half to even on the double, unscale."""
    scale = float(10 ** digits)
    x = _col(c).cast("double")
    if digits == 0:
        return F.rint(x)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def encode_ids(df: DataFrame, col: str, out: str, hot_share: float = 0.001) -> DataFrame:
    """Dense integer ids 1..n in sort order of the distinct values; NULL has no id.

    No single-task global window: the distinct values are range-partitioned, ranked inside
    each range, and offset by the sizes of the preceding ranges (a table with one row per
    partition). The codes are joined back in two parts: values with more than ``hot_share`` of
    the rows (at most ``1 / hot_share`` of them) are broadcast, so their rows are not gathered
    by value; the rest meet by an ordinary join, for which hot rows are spread by a hash.
    """
    from pyspark.sql import Window

    from ..operators.util import cut_lineage

    # materialised once: all branches below must see the same ranges
    vals = cut_lineage(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_rows"))
                       .repartitionByRange(col).withColumn("_pid", F.spark_partition_id()))
    local = vals.withColumn("_r", F.row_number().over(Window.partitionBy("_pid").orderBy(col)))
    sizes = vals.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum("_rows").alias("_all"))
    offsets = sizes.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "_all", F.sum("_all").over(Window.partitionBy()))
    codes = (local.join(F.broadcast(offsets.select("_pid", "_off", "_all")), "_pid")
             .select(F.col(col).alias("_v"), (F.col("_off") + F.col("_r")).cast("int").alias("_id"),
                     (F.col("_rows") > F.lit(hot_share) * F.col("_all")).alias("_hot")))
    hot = F.broadcast(codes.where("_hot").select("_v", F.col("_id").alias("_hot_id")))
    rest = codes.where("NOT _hot").select("_v", "_id", F.lit(0).cast("long").alias("_s"))
    keep, hashed = df.columns, [c for c, kind in df.dtypes if "map<" not in kind]
    spread = F.when(F.col("_hot_id").isNotNull() | F.col(col).isNull(),
                    F.xxhash64(*hashed).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0))
    rows = df.join(hot, F.col(col) == F.col("_v"), "left").drop("_v").withColumn("_at", spread)
    # hot and NULL rows have an odd _at and find nothing here; their id is at hand
    return (rows.join(rest, (F.col(col) == F.col("_v")) & (F.col("_at") == F.col("_s")), "left")
            .select(*keep, F.coalesce("_hot_id", "_id").alias(out)))


def indicator_product(status: ColumnOrName, value: ColumnOrName) -> Column:
    """P20: status (0/1) times value, or times has-data when ``value`` is a flag."""
    return _col(status) * _col(value)

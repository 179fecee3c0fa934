"""Panel queries on the orders chain: cleaning, reshaping, joins, aggregates and windows.

Roles: county = region name, district = nation name (of the ordering customer), month =
order month, series = order priority, flag = ``c_mktsegment = 'BUILDING'``. Doubles are
rounded at the output (6 digits, money to 2) so that results do not depend on the order
in which partial sums were combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import agg, joins, reshape, windows
from ..operators.util import cut_lineage
from ..sources import io
from .catalog import register
from .tables import table

# Fixed values of the TPC-H style dimension tables (specification constants).
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIORITY_NAMES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
                  "4-NOT SPECIFIED": "not_specified", "5-LOW": "low"}

FACTS_SQL = """
facts AS (
  SELECT r.r_name AS county, n.n_name AS district,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         o.o_orderpriority AS series, o.o_orderstatus AS status, o.o_totalprice AS price,
         o.o_orderkey, c.c_mktsegment = 'BUILDING' AS flag
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
panel AS (
  SELECT county, district, month, count(*) AS n_orders, round(sum(price), 2) AS revenue,
         CAST(count(*) FILTER (WHERE flag) AS BIGINT) AS n_building
  FROM facts GROUP BY county, district, month)"""


def districts(spark, sf) -> DataFrame:
    """Nation -> (district, county); 25 rows by the TPC-H specification."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("district"), F.col("r_name").alias("county"))


def order_facts(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                         "o_orderstatus", "o_orderpriority", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(districts(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("county", "district", clean.month_start("o_orderdate").alias("month"),
                    F.col("o_orderpriority").alias("series"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
                    "o_orderkey", (F.col("c_mktsegment") == "BUILDING").alias("flag")))


CUBE_KEYS = ("county", "district", "month", "series", "status", "flag")


def order_cube(spark, sf) -> DataFrame:
    """One pass over orders x customer x nation x region: order counts and price sums at the
    finest grain any panel query needs (district x month x priority x status x flag: at most
    25 x months x 5 x 3 x 2 rows, whatever the data volume).

    The partial aggregate shrinks each input partition before the shuffle, and the result
    is materialised with a reliable checkpoint so that a query that uses it several times reads
    the fact join once: filters applied later cannot be pushed into it and split the plan.
    """
    cube = order_facts(spark, sf).groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum"))
    return cut_lineage(cube)


def order_rows(spark, sf) -> DataFrame:
    """The cube's columns with one row per order, not materialised: for queries that read them
    once, so that their filters reach the scan and one aggregate does the work of two."""
    return order_facts(spark, sf).select(*CUBE_KEYS, F.lit(1).cast("long").alias("n"),
                                         F.col("price").alias("price_sum"))


def nsum(cond=None) -> F.Column:
    """Order count (sum of cube counts), optionally only where ``cond``."""
    return F.sum("n") if cond is None else F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))


def money(cond=None) -> F.Column:
    """Price sum rounded to cents; NULL when no order qualifies."""
    v = F.col("price_sum") if cond is None else F.when(cond, F.col("price_sum"))
    return F.round(F.sum(v), 2)


def nation_month(cube: DataFrame) -> DataFrame:
    """The county x district x month panel."""
    return cube.groupBy("county", "district", "month").agg(
        nsum().alias("n_orders"), money().alias("revenue"),
        nsum(F.col("flag")).alias("n_building"))


def r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------------------------------
# Running totals, year-end values, custom order
# --------------------------------------------------------------------------------------

C3_ORDER = ["ASIA", "EUROPE", "AMERICA"]


@register("c3_running_totals", f"""
WITH {FACTS_SQL},
cm AS (SELECT county, month, sum(n_orders) AS n_orders FROM panel
       WHERE county IN ('ASIA', 'EUROPE', 'AMERICA') GROUP BY county, month)
SELECT county,
       CASE county WHEN 'ASIA' THEN 'Asia' WHEN 'EUROPE' THEN 'Europe' ELSE county END AS label,
       month, CAST(n_orders AS BIGINT) AS n_orders,
       CAST(sum(n_orders) OVER (PARTITION BY county ORDER BY month
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_orders,
       CASE WHEN row_number() OVER (PARTITION BY county, year(month) ORDER BY month DESC) = 1
            THEN 1 ELSE 0 END AS is_year_end,
       CAST(list_position(['ASIA', 'EUROPE', 'AMERICA'], county) AS INTEGER) AS county_order
FROM cm""")
def c3_running_totals(spark, sf):
    """C3 (W4, W8, O2, P5, P10): county-month orders, running total, year-end flag, custom order."""
    p = nation_month(order_rows(spark, sf))
    cm = clean.filter_members(p, "county", C3_ORDER).groupBy("county", "month").agg(
        F.sum("n_orders").cast("long").alias("n_orders"))
    cm = cm.withColumn("label", clean.map_values("county", {"ASIA": "Asia", "EUROPE": "Europe"}))
    cm = windows.running_sum(cm, ["county"], ["month"], "n_orders", "cum_orders")
    ye = Window.partitionBy("county", F.year("month")).orderBy(F.col("month").desc())
    cm = cm.withColumn("is_year_end", (F.row_number().over(ye) == 1).cast("int"))
    order = F.array_position(F.array(*[F.lit(c) for c in C3_ORDER]), F.col("county"))
    return cm.select("county", "label", "month", "n_orders",
                     F.col("cum_orders").cast("long").alias("cum_orders"), "is_year_end",
                     order.cast("int").alias("county_order"))


@register("c3_monthly_total", f"""
WITH {FACTS_SQL}
SELECT month, CAST(sum(n_orders) AS BIGINT) AS n_orders,
       CAST(sum(sum(n_orders)) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS cum_orders
FROM panel WHERE county IN ('ASIA', 'EUROPE', 'AMERICA') GROUP BY month""")
def c3_monthly_total(spark, sf):
    """Monthly sum over the selected counties and its running total (the series behind
    the national trend plot). The running sum is over a calendar-sized table."""
    p = clean.filter_members(nation_month(order_rows(spark, sf)), "county", C3_ORDER)
    m = p.groupBy("month").agg(F.sum("n_orders").cast("long").alias("n_orders"))
    m = m.withColumn("_all", F.lit(1))
    out = windows.running_sum(m, ["_all"], ["month"], "n_orders", "cum_orders")
    return out.select("month", "n_orders", F.col("cum_orders").cast("long").alias("cum_orders"))


# --------------------------------------------------------------------------------------
# C4: missing-data profile with a total row
# --------------------------------------------------------------------------------------

_C4_BODY = """
g AS (SELECT source, count(DISTINCT doc_id) AS number_station,
             count(*) FILTER (WHERE quality IS NULL) AS n_missing FROM d GROUP BY source),
t AS (SELECT source, number_station, n_missing FROM g
      UNION ALL SELECT 'Total', sum(number_station), sum(n_missing) FROM g)
SELECT source, CAST(number_station AS BIGINT) AS number_station,
       CAST(n_missing AS BIGINT) AS n_missing,
       round(100.0 * n_missing / number_station, 6) AS percent_missing
FROM t"""


def _c4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    d = docs.select("doc_id", "source").join(labels.select("doc_id", "quality"), "doc_id", "left")
    prof = agg.missing_profile(d, ["source"], "doc_id", "quality")
    tot = agg.with_total_row(prof, "source", ["number_station", "n_missing"],
                             ratio=("percent_missing", "n_missing", "number_station"))
    return tot.select("source", F.col("number_station").cast("long"),
                      F.col("n_missing").cast("long"), r6(F.col("percent_missing")).alias("percent_missing"))


@register("c4_missing_profile", f"""
WITH d AS (SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
{_C4_BODY}""")
def c4_missing_profile(spark, sf):
    """C4 (A2, A3, P17): documents and unlabelled documents per source with a total row."""
    return _c4(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("c4_missing_profile_active", f"""
WITH act AS (SELECT DISTINCT d.source FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1),
d AS (SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
      WHERE d.source IN (SELECT source FROM act)),
{_C4_BODY}""")
def c4_missing_profile_active(spark, sf):
    """C4 (J8): the same profile for sources with a toxic-labelled document."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    active = docs.join(labels.where(F.col("toxic") == 1), "doc_id").select("source").distinct()
    return _c4(joins.semi_join(docs, active, ["source"]), labels)


@register("a5_distinct_share", """
SELECT CAST(count(DISTINCT CASE WHEN value > 90 AND event_type = 'purchase' THEN user_id END) AS BIGINT) AS n_both,
       CAST(count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS BIGINT) AS n_b,
       round(count(DISTINCT CASE WHEN value > 90 AND event_type = 'purchase' THEN user_id END)
             / count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END), 6) AS share
FROM events""")
def a5_distinct_share(spark, sf):
    """A5: distinct users with a large purchase among purchasing users, and the share."""
    ev = table(spark, sf, "events")
    out = agg.distinct_share(ev, "user_id", F.col("value") > 90, F.col("event_type") == "purchase")
    return out.select(F.col("n_both").cast("long"), F.col("n_b").cast("long"), r6(F.col("share")).alias("share"))


# --------------------------------------------------------------------------------------
# Wide county x series table by month, back to long
# --------------------------------------------------------------------------------------

@register("s2_wide_long", f"""
WITH {FACTS_SQL},
m AS (SELECT DISTINCT month FROM facts),
lab AS (SELECT r_name AS county, p AS series FROM region,
        (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) v(p)),
c AS (SELECT month, county, series, count(*) AS n FROM facts GROUP BY month, county, series)
SELECT m.month, lab.county, lab.series, CAST(coalesce(c.n, 0) AS BIGINT) AS n_orders
FROM m CROSS JOIN lab LEFT JOIN c ON c.month = m.month AND c.county = lab.county AND c.series = lab.series""")
def s2_wide_long(spark, sf):
    """Region x priority wide table by month, melted back and labels split."""
    f = order_rows(spark, sf).withColumn("label", clean.composite_key(["county", "series"], "_"))
    labels = [f"{r}_{p}" for r in REGIONS for p in PRIORITIES]
    wide = reshape.pivot_sum(f, ["month"], "label", "n", labels)
    long = reshape.melt(wide, ["month"], labels, "label", "n_orders")
    county, series = reshape.split_label("label", "_")
    return long.select("month", county.alias("county"), series.alias("series"),
                       F.col("n_orders").cast("long"))


@register("r2_stack_dropnull", f"""
WITH {FACTS_SQL}
SELECT month, county, series, round(sum(price), 2) AS revenue FROM facts
WHERE status = 'F' GROUP BY month, county, series""")
def r2_stack_dropnull(spark, sf):
    """R3 pivot with NULL cells, then the legacy stack that drops them (R2)."""
    f = order_rows(spark, sf).where(F.col("status") == "F").withColumn(
        "label", clean.composite_key(["county", "series"], "_"))
    per = f.groupBy("month", "label").agg(money().alias("revenue"))
    pairs = {f"{r}_{p}": (r, p) for r in REGIONS for p in PRIORITIES}
    wide = reshape.pivot_first(per, ["month"], "label", "revenue", list(pairs))
    return reshape.stack_levels(wide, ["month"], pairs, ("county", "series"), "revenue",
                                drop_null=True)


# --------------------------------------------------------------------------------------
# R3 / R4 pivots
# --------------------------------------------------------------------------------------

_R3_NAMES = {**{p: f"n_{v}" for p, v in PRIORITY_NAMES.items()}, "6-NONE": "n_none"}


@register("r3_pivot", f"""
WITH {FACTS_SQL},
s AS (SELECT district, month, series, count(*) AS n FROM facts GROUP BY district, month, series)
SELECT district, month,
  max(CASE WHEN series = '1-URGENT' THEN n END) AS n_urgent,
  max(CASE WHEN series = '2-HIGH' THEN n END) AS n_high,
  max(CASE WHEN series = '3-MEDIUM' THEN n END) AS n_medium,
  max(CASE WHEN series = '4-NOT SPECIFIED' THEN n END) AS n_not_specified,
  max(CASE WHEN series = '5-LOW' THEN n END) AS n_low,
  CAST(NULL AS BIGINT) AS n_none
FROM s GROUP BY district, month""")
def r3_pivot(spark, sf):
    """Order counts per district-month pivoted by priority, with an absent priority column."""
    s = order_rows(spark, sf).groupBy("district", "month", "series").agg(nsum().alias("n"))
    return reshape.pivot_first(s, ["district", "month"], "series", "n", list(_R3_NAMES),
                               names=_R3_NAMES)


@register("r4_pivot", f"""
WITH {FACTS_SQL}
SELECT district, month,
  count(*) FILTER (WHERE status = 'F') AS n_F, count(*) FILTER (WHERE status = 'O') AS n_O,
  count(*) FILTER (WHERE status = 'P') AS n_P, CAST(0 AS BIGINT) AS n_X
FROM facts GROUP BY district, month""")
def r4_pivot(spark, sf):
    """Order counts per district-month pivoted by status, gaps 0."""
    f = order_rows(spark, sf)
    out = reshape.pivot_sum(f, ["district", "month"], "status", "n", ["F", "O", "P", "X"],
                            prefix="n_")
    return out.select("district", "month", *[F.col(f"n_{s}").cast("long") for s in "FOPX"])


# --------------------------------------------------------------------------------------
# Local and central split (two regions play the central agencies)
# --------------------------------------------------------------------------------------

CENTRAL = ["AMERICA", "EUROPE"]


@register("a13_local_central", f"""
WITH {FACTS_SQL},
long AS (SELECT month, status AS category, county AS unit, CAST(count(*) AS DOUBLE) AS value
         FROM facts GROUP BY month, status, county),
loc AS (SELECT unit, month,
          max(CASE WHEN category = 'F' THEN value END) AS ord_F_local,
          max(CASE WHEN category = 'O' THEN value END) AS ord_O_local,
          max(CASE WHEN category = 'P' THEN value END) AS ord_P_local
        FROM long WHERE unit NOT IN ('AMERICA', 'EUROPE') GROUP BY unit, month),
cen AS (SELECT month,
          sum(CASE WHEN category = 'F' THEN value END) AS c_F,
          sum(CASE WHEN category = 'O' THEN value END) AS c_O,
          sum(CASE WHEN category = 'P' THEN value END) AS c_P
        FROM long WHERE unit IN ('AMERICA', 'EUROPE') GROUP BY month)
SELECT loc.unit, loc.month, ord_F_local, ord_O_local, ord_P_local,
       coalesce(ord_F_local, 0) + coalesce(c_F, 0) AS ord_F_total,
       coalesce(ord_O_local, 0) + coalesce(c_O, 0) AS ord_O_total,
       coalesce(ord_P_local, 0) + coalesce(c_P, 0) AS ord_P_total
FROM loc LEFT JOIN cen USING (month)""")
def a13_local_central(spark, sf):
    """Local order counts per region and status, central total from two regions, total."""
    f = order_cube(spark, sf)
    long = f.groupBy("month", F.col("status").alias("category"), F.col("county").alias("unit")).agg(
        nsum().cast("double").alias("value"))
    return agg.category_split_totals(long, "month", "category", "unit", "value", CENTRAL,
                                     ["F", "O", "P"], "ord")


# --------------------------------------------------------------------------------------
# Exact calendar lag on the full history, then restricted to the main panel months
# --------------------------------------------------------------------------------------

@register("j5_calendar_lag", f"""
WITH {FACTS_SQL},
lagged AS (
  SELECT p.county, p.district, p.month, p.n_orders, q.n_orders AS lag1y_n_orders,
         q.revenue AS lag1y_revenue
  FROM panel p LEFT JOIN panel q ON q.county = p.county AND q.district = p.district
   AND CAST(q.month + INTERVAL 12 MONTH AS DATE) = p.month)
SELECT county, district, month, n_orders, lag1y_n_orders, lag1y_revenue,
       round(CASE WHEN lag1y_n_orders >= 0 THEN ln(1 + lag1y_n_orders) END, 6) AS ln_lag1y_n_orders
FROM lagged WHERE month IN (SELECT month FROM panel WHERE month >= DATE '1996-01-01')""")
def j5_calendar_lag(spark, sf):
    """Orders twelve months earlier by date, from 1996 on, with log1p."""
    cube = order_cube(spark, sf)
    p = nation_month(cube)
    lagged = joins.calendar_lag(p.select("county", "district", "month", "n_orders", "revenue"),
                                ["county", "district"], "month", ["n_orders", "revenue"])
    main_months = cube.where(F.col("month") >= F.lit("1996-01-01").cast("date")).select("month")
    kept = joins.semi_join(lagged, main_months, ["month"])
    return kept.select("county", "district", "month", "n_orders", "lag1y_n_orders", "lag1y_revenue",
                       r6(clean.log_col("lag1y_n_orders", "log1p_nonneg")).alias("ln_lag1y_n_orders"))


# --------------------------------------------------------------------------------------
# Proxy panel from another year, first source wins
# --------------------------------------------------------------------------------------

@register("j6_shifted_panel", f"""
WITH {FACTS_SQL},
s1 AS (SELECT district, month, count(*) AS n, 1 AS source_rank FROM facts WHERE status = 'F'
       GROUP BY district, month),
s2 AS (SELECT district, CAST(month - INTERVAL 12 MONTH AS DATE) AS month, count(*) AS n,
              2 AS source_rank FROM facts WHERE status = 'O' GROUP BY district, month),
u AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2)
SELECT district, month, n, source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY district, month ORDER BY source_rank) AS rn FROM u)
WHERE rn = 1""")
def j6_shifted_panel(spark, sf):
    """Finished-order panel, open-order panel shifted a year back as proxy, first wins."""
    f = order_cube(spark, sf)
    s1 = f.where(F.col("status") == "F").groupBy("district", "month").agg(nsum().alias("n"))
    s2 = joins.calendar_shift(
        f.where(F.col("status") == "O").groupBy("district", "month").agg(nsum().alias("n")),
        "month", -1)
    u = joins.union_sources([(s1, {"district": "district", "month": "month", "n": "n"}),
                             (s2, {"district": "district", "month": "month", "n": "n"})])
    return windows.first_wins_dedup(u, ["district", "month"], ["source_rank"]).select(
        "district", "month", "n", "source_rank")


# --------------------------------------------------------------------------------------
# Instrument interactions from lagged series chains
# --------------------------------------------------------------------------------------

IV_TERMS = {"urgent": ["lag1y_n_urgent"], "high": ["lag1y_n_high"],
            "urgent_high": ["lag1y_n_urgent", "lag1y_n_high"], "low": ["lag1y_n_low"],
            "medium_low": ["lag1y_n_medium", "lag1y_n_low"],
            "not_specified": ["lag1y_n_not_specified"]}
SERIES_COLS = [f"n_{v}" for v in PRIORITY_NAMES.values()]

_SERIES_WIDE_SQL = """
s AS (SELECT district, month, series, count(*) AS n FROM facts GROUP BY district, month, series),
w AS (SELECT district, month,
  max(CASE WHEN series = '1-URGENT' THEN n END) AS n_urgent,
  max(CASE WHEN series = '2-HIGH' THEN n END) AS n_high,
  max(CASE WHEN series = '3-MEDIUM' THEN n END) AS n_medium,
  max(CASE WHEN series = '4-NOT SPECIFIED' THEN n END) AS n_not_specified,
  max(CASE WHEN series = '5-LOW' THEN n END) AS n_low
  FROM s GROUP BY district, month),
wl AS (SELECT a.district, a.month, b.n_urgent AS l_urgent, b.n_high AS l_high,
              b.n_medium AS l_medium, b.n_not_specified AS l_not_specified, b.n_low AS l_low
       FROM w a LEFT JOIN w b ON b.district = a.district
        AND CAST(b.month + INTERVAL 12 MONTH AS DATE) = a.month),
base AS (SELECT district, month, sum(n_orders) AS n_orders FROM panel GROUP BY district, month),
iv AS (SELECT base.district, base.month, CAST(base.n_orders AS BIGINT) AS n_orders,
  ln(greatest(n_orders, 1)) * ln(1 + CASE WHEN l_urgent IS NOT NULL THEN greatest(l_urgent, 0) END) AS iv_urgent,
  ln(greatest(n_orders, 1)) * ln(1 + CASE WHEN l_high IS NOT NULL THEN greatest(l_high, 0) END) AS iv_high,
  ln(greatest(n_orders, 1)) * ln(1 + CASE WHEN l_urgent + l_high IS NOT NULL THEN greatest(l_urgent + l_high, 0) END) AS iv_urgent_high,
  ln(greatest(n_orders, 1)) * ln(1 + CASE WHEN l_low IS NOT NULL THEN greatest(l_low, 0) END) AS iv_low,
  ln(greatest(n_orders, 1)) * ln(1 + CASE WHEN l_medium + l_low IS NOT NULL THEN greatest(l_medium + l_low, 0) END) AS iv_medium_low,
  ln(greatest(n_orders, 1)) * ln(1 + CASE WHEN l_not_specified IS NOT NULL THEN greatest(l_not_specified, 0) END) AS iv_not_specified
  FROM base JOIN wl USING (district, month))"""


def series_lags(cube: DataFrame) -> DataFrame:
    s = cube.groupBy("district", "month", "series").agg(nsum().alias("n"))
    names = {p: f"n_{v}" for p, v in PRIORITY_NAMES.items()}
    wide = reshape.pivot_first(s, ["district", "month"], "series", "n", PRIORITIES, names=names)
    lagged = joins.calendar_lag(wide, ["district"], "month", SERIES_COLS)
    return lagged.select("district", "month", *[f"lag1y_{c}" for c in SERIES_COLS])


def instruments(cube: DataFrame) -> DataFrame:
    base = cube.groupBy("district", "month").agg(nsum().alias("n_orders"))
    j = base.join(series_lags(cube), ["district", "month"])
    return clean.interactions(j, "n_orders", IV_TERMS)


@register("p16_instruments", f"""
WITH {FACTS_SQL}, {_SERIES_WIDE_SQL}
SELECT district, month, n_orders, round(iv_urgent, 6) AS iv_urgent, round(iv_high, 6) AS iv_high,
       round(iv_urgent_high, 6) AS iv_urgent_high, round(iv_low, 6) AS iv_low,
       round(iv_medium_low, 6) AS iv_medium_low, round(iv_not_specified, 6) AS iv_not_specified
FROM iv""")
def p16_instruments(spark, sf):
    """P16 (J5, P15): log base x log1p of lagged priority counts, six named terms."""
    iv = instruments(order_cube(spark, sf))
    return iv.select("district", "month", "n_orders",
                     *[r6(F.col(f"iv_{t}")).alias(f"iv_{t}") for t in IV_TERMS])


# --------------------------------------------------------------------------------------
# Best row per key, highest value first, NULLs last
# --------------------------------------------------------------------------------------

@register("w7_best_row", f"""
WITH {FACTS_SQL},
s AS (SELECT district, month, series, round(sum(price) FILTER (WHERE status = 'F'), 2) AS revenue_f
      FROM facts GROUP BY district, month, series)
SELECT district, month, series, revenue_f FROM (
  SELECT *, row_number() OVER (PARTITION BY district, month
                               ORDER BY revenue_f DESC NULLS LAST, series) AS rn FROM s)
WHERE rn = 1""")
def w7_best_row(spark, sf):
    """Per district-month the priority with the highest finished revenue, NULLs last."""
    s = order_rows(spark, sf).groupBy("district", "month", "series").agg(
        money(F.col("status") == "F").alias("revenue_f"))
    return windows.best_value_row(s, ["district", "month"], "revenue_f", ["series"]).select(
        "district", "month", "series", "revenue_f")


# --------------------------------------------------------------------------------------
# Expanding share and reconstructed stock
# --------------------------------------------------------------------------------------

_W5_SQL = f"""
WITH {FACTS_SQL},
per AS (SELECT county, district, month, sum(n_building) AS n, sum(n_orders) AS d FROM panel
        GROUP BY county, district, month),
pos AS (SELECT month, CAST(dense_rank() OVER (ORDER BY month) AS INTEGER) AS pos
        FROM (SELECT DISTINCT month FROM per)),
base AS (SELECT r.r_name AS county, n.n_name AS district, count(*) AS baseline
         FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
         JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name, n.n_name),
grid AS (SELECT b.county, b.district, b.baseline, p.month, p.pos FROM base b CROSS JOIN pos p),
cum AS (SELECT g.county, g.district, g.baseline, g.month, g.pos,
          sum(coalesce(per.n, 0)) OVER w AS cn, sum(coalesce(per.d, 0)) OVER w AS cd,
          count(per.d) OVER w AS cr
        FROM grid g LEFT JOIN per ON per.county = g.county AND per.district = g.district
         AND per.month = g.month
        WINDOW w AS (PARTITION BY g.county, g.district ORDER BY g.pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ratio AS (SELECT *, CASE WHEN cr > 0 AND cd <> 0 THEN round_even(CAST(cn AS DOUBLE) / cd, 4) END AS ratio
          FROM cum)"""


def installed_base(spark, sf, cube: DataFrame) -> DataFrame:
    p = nation_month(cube)
    ratios = windows.expanding_ratio(p, ["county", "district"], "month", "n_building", "n_orders",
                                     digits=4)
    cust = table(spark, sf, "customer")
    base = (cust.join(districts(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("county", "district").agg(F.count(F.lit(1)).alias("baseline")))
    calendar = windows.positions(p, "month", "pos")
    return windows.scale_baseline(ratios, base, ["county", "district"], "ratio", "baseline", "stock",
                                  calendar=calendar)


@register("w5_expanding_ratio", _W5_SQL + """
SELECT county, district, month, pos, ratio, baseline, round_even(ratio * baseline, 0) AS stock
FROM ratio""")
def w5_expanding_ratio(spark, sf):
    """Cumulative BUILDING share by observed month and reconstructed stock."""
    return installed_base(spark, sf, order_cube(spark, sf)).select("county", "district", "month", "pos", "ratio",
                                            "baseline", "stock")


@register("w5_ratio_rows", f"""
WITH {FACTS_SQL},
per AS (SELECT district, series, month, count(*) FILTER (WHERE status = 'F') AS n, count(*) AS d
        FROM facts GROUP BY district, series, month),
pos AS (SELECT month, CAST(dense_rank() OVER (ORDER BY month) AS INTEGER) AS pos
        FROM (SELECT DISTINCT month FROM per)),
cum AS (SELECT k.district, k.series, p.month, p.pos, sum(n) OVER w AS cn, sum(d) OVER w AS cd
        FROM (SELECT DISTINCT district, series FROM per) k CROSS JOIN pos p
        LEFT JOIN per ON per.district = k.district AND per.series = k.series AND per.month = p.month
        WINDOW w AS (PARTITION BY k.district, k.series ORDER BY p.pos))
SELECT district, series, month, pos, round_even(CAST(cn AS DOUBLE) / cd, 4) AS ratio FROM cum""")
def w5_ratio_rows(spark, sf):
    """Cumulative share of finished orders for every district, priority and month, NULL
    before a pair's first order."""
    p = order_rows(spark, sf).groupBy("district", "series", "month").agg(
        nsum().alias("d"), nsum(F.col("status") == "F").alias("n"))
    return windows.expanding_ratio(p, ["district", "series"], "month", "n", "d").select(
        "district", "series", "month", "pos", "ratio")


# --------------------------------------------------------------------------------------
# Open intervals counted per month start
# --------------------------------------------------------------------------------------

_J7_SQL = """
li AS (SELECT n.n_name AS district, l.l_returnflag AS chain, l.l_shipdate AS open_ts,
              CASE WHEN l.l_linestatus = 'O' THEN NULL
                   ELSE l.l_shipdate + to_days(CAST(l.l_quantity AS INTEGER)) END AS close_ts
       FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey),
cal AS (SELECT CAST(m AS DATE) AS month
        FROM (SELECT min(date_trunc('month', l_shipdate)) AS lo,
                     max(date_trunc('month', l_shipdate)) AS hi FROM lineitem),
             generate_series(lo, hi, INTERVAL 1 MONTH) AS t(m)),
cnt AS (SELECT li.district, li.chain, cal.month, count(*) AS n FROM li JOIN cal
          ON li.open_ts <= cal.month AND (li.close_ts IS NULL OR li.close_ts >= cal.month)
        GROUP BY li.district, li.chain, cal.month),
grp AS (SELECT DISTINCT district, chain FROM cnt),
j7 AS (SELECT g.district, g.chain, cal.month, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_open
       FROM grp g CROSS JOIN cal LEFT JOIN cnt ON cnt.district = g.district
        AND cnt.chain = g.chain AND cnt.month = cal.month)"""


def shipments_open(spark, sf) -> DataFrame:
    """Lineitems as entities open from their ship date until ship date + quantity days
    (still open when the line status is 'O').

    One pass over lineitem: rows collapse to month spans per (district, chain) by a partial
    aggregate (``open_spans``, a few thousand rows at any scale), materialised so that the
    calendar (ship months) and the counting both read the small table.
    """
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus",
                                             "l_shipdate", "l_quantity")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = (li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("district"), F.col("l_returnflag").alias("chain"),
                    "l_linestatus", F.col("l_shipdate").alias("open_ts"),
                    F.timestamp_add("DAY", F.col("l_quantity").cast("int"), F.col("l_shipdate"))
                    .alias("close_ts")))
    spans = cut_lineage(joins.open_spans(rows, "open_ts", "close_ts", ["district", "chain"],
                                         status_col="l_linestatus", active_value="O"))
    cal = reshape.periods_of(spans, "open_month", "month", "month")
    return joins.count_open(spans, ["district", "chain"], cal, "month", "n_open")


@register("j7_active_count", f"WITH {_J7_SQL} SELECT district, chain, month, n_open FROM j7")
def j7_active_count(spark, sf):
    """Lineitems open at each month start (ship date to ship date + quantity days) per district and flag."""
    return shipments_open(spark, sf)


@register("c6_store_counts", f"""WITH {_J7_SQL}
SELECT n.n_name AS district, cal.month,
  CAST(coalesce(sum(n_open) FILTER (WHERE chain = 'A'), 0) AS BIGINT) AS open_A,
  CAST(coalesce(sum(n_open) FILTER (WHERE chain = 'N'), 0) AS BIGINT) AS open_N,
  CAST(coalesce(sum(n_open) FILTER (WHERE chain = 'R'), 0) AS BIGINT) AS open_R
FROM nation n CROSS JOIN cal LEFT JOIN j7 ON j7.district = n.n_name AND j7.month = cal.month
GROUP BY n.n_name, cal.month""")
def c6_store_counts(spark, sf):
    """C6 (J7, J4, R4): open lineitem counts per district-month pivoted by return flag, for every
    district of the full list, with 0 where it has none."""
    long = cut_lineage(shipments_open(spark, sf))
    wide = reshape.pivot_sum(long, ["district", "month"], "chain", "n_open", ["A", "N", "R"],
                             prefix="open_", fill=0)
    every = joins.grid(table(spark, sf, "nation").select(F.col("n_name").alias("district")),
                       long.select("month").distinct())
    wide = every.join(wide, ["district", "month"], "left")
    return wide.select("district", "month", *[
        F.coalesce(F.col(f"open_{c}"), F.lit(0)).cast("long").alias(f"open_{c}") for c in "ANR"])


# --------------------------------------------------------------------------------------
# Best source per name, plus alias rows
# --------------------------------------------------------------------------------------

@register("j10_priority_lookup", """
WITH u AS (
  SELECT n.n_name AS name, s.s_suppkey AS id, CASE WHEN s.s_acctbal >= 0 THEN s.s_acctbal END AS x,
         1 AS source_rank FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL
  SELECT n.n_name, c.c_custkey, CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END, 2
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
best AS (SELECT name, id, x, source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY source_rank, id) AS rn
  FROM u WHERE x IS NOT NULL) WHERE rn = 1),
al AS (SELECT n.n_name || '/' || r.r_name AS alias, n.n_name AS name
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT name, id, x, source_rank FROM best
UNION ALL SELECT al.alias, best.id, best.x, best.source_rank FROM best JOIN al ON best.name = al.name""")
def j10_priority_lookup(spark, sf):
    """Best source per nation (suppliers before customers) plus alias rows."""
    n = table(spark, sf, "nation")
    s = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).withColumn(
        "x", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")))
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "x", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    best = joins.priority_lookup([(s, {"n_name": "name", "s_suppkey": "id", "x": "x"}),
                                  (c, {"n_name": "name", "c_custkey": "id", "x": "x"})],
                                 "name", ["x"], ["id"])
    r = table(spark, sf, "region")
    aliases = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat_ws("/", "n_name", "r_name").alias("alias"), F.col("n_name").alias("name"))
    return joins.alias_expand(best.select("name", "id", "x", "source_rank"), aliases, "name")


# --------------------------------------------------------------------------------------
# URL parts
# --------------------------------------------------------------------------------------

@register("p12_url_parts", r"""
SELECT page_id,
  nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host,
  nullif(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1), '') AS lang,
  TRY_CAST(nullif(regexp_extract(url, '/[a-z]{2}/([^/?#]+)', 1), '') AS BIGINT) AS path_id,
  TRY_CAST(nullif(regexp_extract(url, 'page=([^&#]+)', 1), '') AS BIGINT) AS page_no,
  array_to_string(list_transform(string_split(lower(trim(replace(
     nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), ''), '.example.', ' '))), ' '),
     lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS host_label
FROM pages""")
def p12_url_parts(spark, sf):
    """Host, language, path id, page number and a title-cased host label from URLs."""
    pg = table(spark, sf, "pages").select("page_id", "url")
    host = F.nullif(F.regexp_extract("url", r"^https?://([^/?#]+)", 1), F.lit(""))
    return pg.select(
        "page_id", host.alias("host"),
        F.nullif(F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1), F.lit("")).alias("lang"),
        clean.to_number(F.nullif(F.regexp_extract("url", r"/[a-z]{2}/([^/?#]+)", 1), F.lit("")),
                        "bigint").alias("path_id"),
        clean.to_number(clean.extract_between("url", "page=", "&#"), "bigint").alias("page_no"),
        clean.normalize_text(host, [(".example.", " ")], strip=True, case="title").alias("host_label"))


@register("s1_read_panel", """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
       c_mktsegment FROM customer""")
def s1_read_panel(spark, sf):
    """Typed read of a Parquet table with required columns."""
    return io.read_panel(spark, f"{sf}/customer.parquet", {
        "c_custkey": "bigint", "c_nationkey": "bigint", "c_acctbal": "double", "c_mktsegment": "string"},
        fmt="parquet")


@register("p12_ids", r"""
WITH t AS (SELECT page_id, url, CASE WHEN page_id % 3 <> 0 THEN url || '&ll=' || (page_id % 90) || '.'
             || (page_id % 1000) || ',-' || (page_id % 180) || '.5' ELSE url END AS u FROM pages)
SELECT page_id,
  TRY_CAST(nullif(regexp_extract(u, 'll=(-?[0-9]+(?:\.[0-9]+)?),(-?[0-9]+(?:\.[0-9]+)?)', 1), '') AS DOUBLE) AS lat,
  TRY_CAST(nullif(regexp_extract(u, 'll=(-?[0-9]+(?:\.[0-9]+)?),(-?[0-9]+(?:\.[0-9]+)?)', 2), '') AS DOUBLE) AS lon,
  nullif(regexp_extract(url, '/en/([^/]+)', 1), '') AS en_id
FROM t""")
def p12_ids(spark, sf):
    """Coordinates from an ll= parameter (two pages in three get one) and the id after a marker."""
    pg = table(spark, sf, "pages").select("page_id", "url")
    n = F.col("page_id")
    ll = F.concat(F.col("url"), F.lit("&ll="), (n % 90).cast("string"), F.lit("."), (n % 1000).cast("string"),
                  F.lit(",-"), (n % 180).cast("string"), F.lit(".5"))
    pg = pg.withColumn("u", F.when(n % 3 != 0, ll).otherwise(F.col("url")))
    lat, lon = clean.extract_ll("u")
    return pg.select("page_id", lat.alias("lat"), lon.alias("lon"),
                     clean.extract_path_id("url", "/en/").alias("en_id"))


# --------------------------------------------------------------------------------------
# Dates from text in several formats, some broken on purpose
# --------------------------------------------------------------------------------------

@register("p1_dates", """
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a ' || o_orderkey
         WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%Y%m%d') END AS txt,
    CASE WHEN o_orderkey % 89 = 0 THEN lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || '1340'
         ELSE lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || strftime(o_orderdate, '%m%d')
    END AS roc
  FROM orders),
p AS (SELECT o_orderkey,
        CAST(coalesce(try_strptime(txt, '%Y-%m-%d'), try_strptime(txt, '%d/%m/%Y'),
                      try_strptime(txt, '%Y%m%d')) AS DATE) AS dt,
        CAST(try_strptime(CAST(CAST(substr(roc, 1, 3) AS INTEGER) + 1911 AS VARCHAR) || substr(roc, 4, 4),
                          '%Y%m%d') AS DATE) AS roc_dt
      FROM t)
SELECT o_orderkey, dt, CAST(date_trunc('month', dt) AS DATE) AS month, roc_dt FROM p""")
def p1_dates(spark, sf):
    """Order dates from text in three formats (some broken), month, ROC dates."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    roc_year = F.lpad((F.year("o_orderdate") - 1911).cast("string"), 3, "0")
    txt = (F.when(k % 97 == 0, F.concat(F.lit("n/a "), k.cast("string")))
           .when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(k % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
           .otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    roc = F.when(k % 89 == 0, F.concat(roc_year, F.lit("1340"))).otherwise(
        F.concat(roc_year, F.date_format("o_orderdate", "MMdd")))
    t = o.select("o_orderkey", txt.alias("txt"), roc.alias("roc"))
    parsed = clean.parse_date(t, "txt", ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd"], on_invalid="null",
                              out="dt")
    return parsed.select("o_orderkey", "dt", clean.month_start("dt").alias("month"),
                         clean.roc_date("roc").alias("roc_dt"))


# --------------------------------------------------------------------------------------
# Missing-data reports
# --------------------------------------------------------------------------------------

def _doc_labels(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left").withColumn("toxic_pos", F.when(F.col("toxic") == 1, F.lit(1)))
    kept, _ = clean.keep_columns(j, ["doc_id", "lang", "quality", "toxic_pos", "not_there"])
    return kept


@register("p8_missing_report", """
WITH d AS (SELECT d.lang, l.quality, CASE WHEN l.toxic = 1 THEN 1 END AS toxic_pos
           FROM documents d LEFT JOIN labels l USING (doc_id)),
f AS (SELECT CASE WHEN lang IS NULL THEN 'lang' WHEN quality IS NULL THEN 'quality'
                  WHEN toxic_pos IS NULL THEN 'toxic_pos' END AS col FROM d)
SELECT CAST(CASE col WHEN 'lang' THEN 1 WHEN 'quality' THEN 2 ELSE 3 END AS INTEGER) AS step,
       col, count(*) AS n_dropped
FROM f WHERE col IS NOT NULL GROUP BY col""")
def p8_missing_report(spark, sf):
    """Rows lost at each step of listwise deletion."""
    _, report = clean.drop_missing(_doc_labels(spark, sf), ["lang", "quality", "toxic_pos"])
    return report


@register("p8_complete_rows", """
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE d.lang IS NOT NULL AND l.quality IS NOT NULL AND l.toxic = 1""")
def p8_complete_rows(spark, sf):
    """Documents complete on language, quality and a positive toxic flag."""
    kept, _ = clean.drop_missing(_doc_labels(spark, sf), ["lang", "quality", "toxic_pos"])
    return kept.select("doc_id", "lang", "quality")


@register("a9_missing_all", """
SELECT count(*) FILTER (WHERE l.quality IS NULL AND l.toxic IS NULL) AS n_missing_all,
       count(*) AS n_rows
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def a9_missing_all(spark, sf):
    """Documents whose label fields are all missing."""
    d = table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    return d.agg(F.count_if(agg.missing_all(d, ["quality", "toxic"])).alias("n_missing_all"),
                 F.count(F.lit(1)).alias("n_rows"))


@register("a8_date_range", """
SELECT CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date,
       count(DISTINCT date_trunc('month', o_orderdate)) AS n_months FROM orders""")
def a8_date_range(spark, sf):
    """First and last order date and the number of distinct order months."""
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    return agg.date_range(o, "d")


# --------------------------------------------------------------------------------------
# Dense ids; A6/J9: duplicates and anti report; O3: head
# --------------------------------------------------------------------------------------

@register("p19_ids", """
SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS brand_id
FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)""")
def p19_ids(spark, sf):
    """Dense brand ids."""
    p = table(spark, sf, "part").select("p_brand")
    return clean.encode_ids(p, "p_brand", "brand_id").where(F.col("p_brand").isNotNull()).distinct()


@register("a6_duplicates", """
SELECT l_orderkey, l_partkey, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_partkey HAVING count(*) > 1""")
def a6_duplicates(spark, sf):
    """(order, part) keys of lineitem with more than one row."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return agg.duplicate_keys(li, ["l_orderkey", "l_partkey"])


@register("j9_anti_report", """
SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem
  WHERE l_partkey IS NOT NULL)""")
def j9_anti_report(spark, sf):
    """Parts that no lineitem refers to."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return joins.anti_report(p, li, ["p_partkey"])


@register("j9_unlabelled_docs", """
SELECT d.doc_id, d.source, d.lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def j9_unlabelled_docs(spark, sf):
    """J9 with a non-empty answer: documents that have no label."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return joins.anti_report(d, table(spark, sf, "labels"), ["doc_id"])


@register("o3_head", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o3_head(spark, sf):
    """O3: the ten most expensive orders (top-k report)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(10)


# --------------------------------------------------------------------------------------
# Descriptive statistics and correlations
# --------------------------------------------------------------------------------------

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _q_sql(p: float, name: str) -> str:
    return (f"avg(x) FILTER (WHERE rk = CASE WHEN n*{p} = floor(n*{p}) THEN floor(n*{p}) "
            f"ELSE ceil(n*{p}) END OR rk = CASE WHEN n*{p} = floor(n*{p}) THEN floor(n*{p}) + 1 "
            f"ELSE ceil(n*{p}) END) AS {name}")


@register("a10_describe", f"""
WITH long AS ({' UNION ALL '.join(f"SELECT '{m}' AS variable, CAST({m} AS DOUBLE) AS x FROM lineitem" for m in _MEASURES)}),
r AS (SELECT variable, x, row_number() OVER (PARTITION BY variable ORDER BY x) AS rk,
             count(*) OVER (PARTITION BY variable) AS n FROM long WHERE x IS NOT NULL),
q AS (SELECT variable, {_q_sql(0.25, 'p25')}, {_q_sql(0.5, 'p50')}, {_q_sql(0.75, 'p75')}
      FROM r GROUP BY variable),
m AS (SELECT variable, count(x) AS count, avg(x) AS mean, stddev_samp(x) AS sd, min(x) AS min,
             max(x) AS max FROM long GROUP BY variable)
SELECT m.variable, count, round(mean, 6) AS mean, round(sd, 6) AS sd, min, round(p25, 6) AS p25,
       round(p50, 6) AS p50, round(p75, 6) AS p75, max
FROM m JOIN q USING (variable)""")
def a10_describe(spark, sf):
    """A10: count, mean, sd, min, quartiles (summarize rule), max of four lineitem measures."""
    li = table(spark, sf, "lineitem").select(*_MEASURES)
    d = agg.describe(li, _MEASURES)
    return d.select("variable", "count", *[r6(F.col(c)).alias(c) for c in ("mean", "sd")], "min",
                    *[r6(F.col(c)).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("a11_corr", "WITH " + ", ".join(
    f"c{i}{j} AS (SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS corr FROM lineitem)"
    for i, a in enumerate(_MEASURES) for j, b in enumerate(_MEASURES))
    + " " + " UNION ALL ".join(f"SELECT * FROM c{i}{j}" for i in range(4) for j in range(4)))
def a11_corr(spark, sf):
    """Pairwise-complete correlation matrix of four lineitem measures."""
    li = table(spark, sf, "lineitem").select(*_MEASURES)
    return agg.pairwise_corr(li, _MEASURES).select("var1", "var2", r6(F.col("corr")).alias("corr"))


# --------------------------------------------------------------------------------------
# Keys whose output does not exist yet
# --------------------------------------------------------------------------------------

@register("s6_pending", f"""
WITH {FACTS_SQL},
cal AS (SELECT CAST(m AS DATE) AS month FROM (SELECT min(month) AS lo, max(month) AS hi FROM facts),
        generate_series(lo, hi, INTERVAL 1 MONTH) AS t(m)),
grid AS (SELECT n_name AS district, month FROM nation CROSS JOIN cal)
SELECT district, month FROM grid
EXCEPT SELECT DISTINCT district, month FROM facts WHERE status = 'F'""")
def s6_pending(spark, sf):
    """Nation-months without finished orders (keys with no output yet)."""
    from ..sources import io

    f = order_cube(spark, sf)
    cal = reshape.periods_of(f, "month", "month", "month")
    grid = table(spark, sf, "nation").select(F.col("n_name").alias("district")).crossJoin(F.broadcast(cal))
    done = f.where(F.col("status") == "F").select("district", "month")
    return io.pending_keys(grid, done, ["district", "month"])


# --------------------------------------------------------------------------------------
# A1/A4/A12, W1/W2/W8, P9/P14 used directly
# --------------------------------------------------------------------------------------

def _finished_revenue(spark, sf) -> DataFrame:
    """Cube rows with the price sum of finished orders (NULL for other statuses)."""
    return order_cube(spark, sf).withColumn(
        "price_f", F.when(F.col("status") == "F", F.col("price_sum")))


@register("a1_group_sum", f"""WITH {FACTS_SQL}
SELECT district, month, round(sum(CASE WHEN status = 'F' THEN price END), 2) AS revenue_f,
       round(coalesce(sum(CASE WHEN status = 'F' THEN price END), 0), 2) AS revenue_f0
FROM facts GROUP BY district, month""")
def a1_group_sum(spark, sf):
    """A1: finished-order revenue per district-month, NULL-when-empty and zero-when-empty."""
    f = _finished_revenue(spark, sf)
    a = agg.group_sum(f, ["district", "month"], ["price_f"], empty="null")
    b = agg.group_sum(f, ["district", "month"], ["price_f"], empty="zero", suffix="0")
    return a.join(b, ["district", "month"]).select(
        "district", "month", F.round("price_f", 2).alias("revenue_f"),
        F.round("price_f0", 2).alias("revenue_f0"))


@register("a4_count_by", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def a4_count_by(spark, sf):
    """A4: order counts by status and priority."""
    return agg.count_by(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("a12_share_of_flag", f"""WITH {FACTS_SQL}
SELECT county, round(sum(price) FILTER (WHERE flag), 2) AS flagged, round(sum(price), 2) AS total,
       round(sum(price) FILTER (WHERE flag) / sum(price), 6) AS share
FROM facts GROUP BY county""")
def a12_share_of_flag(spark, sf):
    """BUILDING-segment share of order value per county."""
    out = agg.share_of_flag(order_rows(spark, sf), ["county"], F.col("flag"), "price_sum")
    return out.select("county", F.round("flagged", 2).alias("flagged"), F.round("total", 2).alias("total"),
                      F.round("share", 6).alias("share"))


@register("w1_fill_gaps", f"""WITH {FACTS_SQL},
s AS (SELECT district, month, round(sum(CASE WHEN status = 'F' AND series = '1-URGENT' THEN price END), 2) AS v
      FROM facts GROUP BY district, month),
w AS (SELECT district, month, v,
        last_value(v IGNORE NULLS) OVER (PARTITION BY district ORDER BY month
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v_ffill,
        first_value(v IGNORE NULLS) OVER (PARTITION BY district ORDER BY month
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v_bfill FROM s)
SELECT district, month, v, v_ffill, v_bfill, coalesce(v_ffill, v_bfill) AS v_either,
       coalesce(v, 0.0) AS v_zero FROM w""")
def w1_fill_gaps(spark, sf):
    """Urgent finished revenue per district-month, filled forward/backward/zero."""
    f = order_rows(spark, sf)
    s = f.groupBy("district", "month").agg(
        money((F.col("status") == "F") & (F.col("series") == "1-URGENT")).alias("v"))
    s = windows.ffill(s, ["district"], ["month"], "v", "v_ffill")
    s = windows.bfill(s, ["district"], ["month"], "v", "v_bfill")
    s = s.withColumn("v_either", clean.first_non_null("v_ffill", "v_bfill")).withColumn("v_zero", F.col("v"))
    s = clean.fill_missing(s, ["v_zero"], 0.0)
    return s.select("district", "month", "v", "v_ffill", "v_bfill", "v_either", "v_zero")


@register("w8_last_per_group", f"""WITH {FACTS_SQL},
cm AS (SELECT county, month, count(*) AS n_orders FROM facts GROUP BY county, month)
SELECT county, CAST(year(month) AS INTEGER) AS year, month, n_orders FROM (
  SELECT *, row_number() OVER (PARTITION BY county, year(month) ORDER BY month DESC) AS rn FROM cm)
WHERE rn = 1""")
def w8_last_per_group(spark, sf):
    """Last month of each county-year."""
    cm = order_rows(spark, sf).groupBy("county", "month").agg(nsum().alias("n_orders"))
    cm = cm.withColumn("year", F.year("month").cast("int"))
    return windows.last_per_group(cm, ["county", "year"], ["month"]).select(
        "county", "year", "month", "n_orders")

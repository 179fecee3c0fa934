"""Composed outputs C1, C2, C5, C7-C10: what a user of the panel code asks for.

Entities of the lifecycle panel are users; a user's district is nation ``user_id % 25``
(25 nations by the TPC-H specification), its battery count is its number of purchases
(missing when it never purchased), and its coordinates come from the supplier with key
``user_id % #suppliers`` (several users can share one point, as stations share an id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import agg, joins, lifecycle, windows
from .catalog import W3_SQL, register, user_periods, user_status
from .panel_queries import (_SERIES_WIDE_SQL, _W5_SQL, CENTRAL, FACTS_SQL, IV_TERMS, districts,
                            installed_base, instruments, money, nation_month, nsum, order_cube)
from .tables import table

N_NATIONS = 25

_C1_SQL = W3_SQL.rstrip() + """,
users AS (SELECT user_id,
                 CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') > 0
                      THEN count(*) FILTER (WHERE event_type = 'purchase') END AS batteries
          FROM events GROUP BY user_id),
dim AS (SELECT n.n_nationkey, n.n_name AS district, r.r_name AS county
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
c1 AS (SELECT st.user_id, st.day, st.status, u.batteries, dim.district, dim.county
       FROM st JOIN users u USING (user_id) LEFT JOIN dim ON dim.n_nationkey = st.user_id % 25)"""


def user_attributes(spark, sf, periods: DataFrame) -> DataFrame:
    """Per user: battery count = purchases (missing when none) and district, from the same
    per-(user, day) aggregate that gives the status (no second pass over the event log)."""
    u = periods.groupBy("user_id").agg(F.sum("purchases").alias("_p"))
    u = u.select("user_id", F.when(F.col("_p") > 0, F.col("_p")).alias("batteries"),
                 F.pmod("user_id", F.lit(N_NATIONS)).cast("int").alias("_nk"))
    dim = districts(spark, sf)
    return u.join(dim, u["_nk"] == dim["n_nationkey"], "left").select(
        "user_id", "batteries", "district", "county")


def station_status(spark, sf) -> DataFrame:
    """Entity x day status with the entity's region and battery count."""
    periods = user_periods(spark, sf)
    return user_status(spark, sf, periods).join(user_attributes(spark, sf, periods), "user_id")


@register("c1_station_status", _C1_SQL + """
SELECT user_id, day, status, batteries, district, county FROM c1""")
def c1_station_status(spark, sf):
    """User-day status with district, region and battery count."""
    return station_status(spark, sf).select("user_id", "day", "status", "batteries", "district",
                                            "county")


@register("c2_region_day_active", _C1_SQL + """,
td AS (SELECT county, district, day, sum(status) AS nstation,
              coalesce(sum(status * batteries), 0) AS nbattery,
              sum(status * CASE WHEN batteries IS NOT NULL THEN 1 ELSE 0 END) AS nstation_w_battery
       FROM c1 GROUP BY county, district, day),
cal AS (SELECT DISTINCT day FROM st),
dense AS (SELECT g.county, g.district, cal.day, coalesce(td.nstation, 0) AS nstation,
                 coalesce(td.nbattery, 0) AS nbattery,
                 coalesce(td.nstation_w_battery, 0) AS nstation_w_battery
          FROM (SELECT DISTINCT county, district FROM td) g CROSS JOIN cal
          LEFT JOIN td ON td.county IS NOT DISTINCT FROM g.county
           AND td.district IS NOT DISTINCT FROM g.district AND td.day = cal.day),
fullp AS (SELECT dim.county, dim.district, cal.day FROM dim CROSS JOIN cal)
SELECT coalesce(fullp.county, dense.county) AS county,
       coalesce(fullp.district, dense.district) AS district,
       coalesce(fullp.day, dense.day) AS day,
       CAST(coalesce(dense.nstation, 0) AS BIGINT) AS nstation,
       CAST(coalesce(dense.nbattery, 0) AS BIGINT) AS nbattery,
       CAST(coalesce(dense.nstation_w_battery, 0) AS BIGINT) AS nstation_w_battery
FROM dense FULL JOIN fullp ON dense.district = fullp.district AND dense.day = fullp.day""")
def c2_region_day_active(spark, sf):
    """C2 (R5, J3, A1, P20): active users, batteries and users with batteries per district-day."""
    periods = user_periods(spark, sf)
    out = lifecycle.region_panel(user_status(spark, sf, periods), user_attributes(spark, sf, periods),
                                 districts(spark, sf), "user_id", ["county", "district"],
                                 "district", period="day", value="batteries", grain="day")
    return out.select("county", "district", "day", F.col("n_active").alias("nstation"),
                      F.col("value_active").alias("nbattery"),
                      F.col("active_with_value").alias("nstation_w_battery"))


@register("c5_snapshots", _C1_SQL + """,
ns AS (SELECT count(*) AS n FROM supplier),
coords AS (SELECT s_suppkey AS vmid, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS x,
                  CAST(s_nationkey AS DOUBLE) AS y FROM supplier),
a AS (SELECT c1.day, c1.user_id, coords.vmid, coords.x, coords.y
      FROM c1, ns JOIN coords ON coords.vmid = c1.user_id % ns.n
      WHERE c1.status = 1 AND coords.x IS NOT NULL)
SELECT day, vmid, x, y, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY day, vmid ORDER BY user_id) AS rn FROM a) WHERE rn = 1""")
def c5_snapshots(spark, sf):
    """Per day, active entities with coordinates, one row per point id (first wins)."""
    sup = table(spark, sf, "supplier")
    n_supp = sup.agg(F.count(F.lit(1)).alias("_n"))
    coords = sup.select(F.col("s_suppkey").alias("vmid"),
                        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("x"),
                        F.col("s_nationkey").cast("double").alias("y"))
    act = (station_status(spark, sf).where(F.col("status") == 1)
           .crossJoin(F.broadcast(n_supp)).withColumn("vmid", F.pmod("user_id", F.col("_n"))))
    att = joins.attach(act, coords, ["vmid"], ["x", "y"])
    return windows.first_wins_dedup(att, ["day", "vmid"], ["user_id"]).select(
        "day", "vmid", "x", "y", "user_id")


@register("c7_instrument_panel", f"""WITH {FACTS_SQL}, {_SERIES_WIDE_SQL},
sr AS (SELECT district, month, series, round(sum(price) FILTER (WHERE status = 'F'), 2) AS revenue_f
       FROM facts GROUP BY district, month, series),
best AS (SELECT district, month, series AS top_series, revenue_f FROM (
  SELECT *, row_number() OVER (PARTITION BY district, month ORDER BY revenue_f DESC NULLS LAST, series) AS rn
  FROM sr) WHERE rn = 1)
SELECT iv.district, iv.month, top_series, revenue_f, n_orders,
       round(iv_urgent, 6) AS iv_urgent, round(iv_high, 6) AS iv_high,
       round(iv_urgent_high, 6) AS iv_urgent_high, round(iv_low, 6) AS iv_low,
       round(iv_medium_low, 6) AS iv_medium_low, round(iv_not_specified, 6) AS iv_not_specified
FROM iv JOIN best ON best.district = iv.district AND best.month = iv.month""")
def c7_instrument_panel(spark, sf):
    """One row per district-month: the best series row (W7) and the instruments."""
    cube = order_cube(spark, sf)
    s = cube.groupBy("district", "month", "series").agg(
        money(F.col("status") == "F").alias("revenue_f"))
    best = windows.best_value_row(s, ["district", "month"], "revenue_f", ["series"]).select(
        "district", "month", F.col("series").alias("top_series"), "revenue_f")
    iv = instruments(cube)
    return iv.join(best, ["district", "month"]).select(
        "district", "month", "top_series", "revenue_f", "n_orders",
        *[F.round(F.col(f"iv_{t}"), 6).alias(f"iv_{t}") for t in IV_TERMS])


@register("c8_installed_base", _W5_SQL + """
SELECT county, district, 'first_' || pos || '_m' AS label, ratio,
       round_even(ratio * baseline, 0) AS stock FROM ratio""")
def c8_installed_base(spark, sf):
    """Cumulative share and reconstructed stock labelled by prefix length."""
    ib = installed_base(spark, sf, order_cube(spark, sf))
    return ib.select("county", "district",
                     F.concat(F.lit("first_"), F.col("pos").cast("string"), F.lit("_m")).alias("label"),
                     "ratio", "stock")


@register("c9_attach_base", _W5_SQL + """,
pn AS (SELECT county, district, month, sum(d) AS n_orders FROM per GROUP BY county, district, month)
SELECT pn.county, pn.district, pn.month, CAST(pn.n_orders AS BIGINT) AS n_orders,
       ratio.ratio, round_even(ratio.ratio * ratio.baseline, 0) AS stock,
       round(ln(round_even(ratio.ratio * ratio.baseline, 0) + 1), 6) AS ln_stock
FROM pn LEFT JOIN ratio ON ratio.county = pn.county AND ratio.district = pn.district
 AND ratio.month = pn.month""")
def c9_attach_base(spark, sf):
    """The panel with the installed base attached (m:1 validated, completeness checked)."""
    cube = order_cube(spark, sf)
    panel = nation_month(cube).select("county", "district", "month", "n_orders")
    ib = installed_base(spark, sf, cube).select("county", "district", "month", "ratio", "stock", "baseline")
    out = joins.left_join(panel, ib, ["county", "district", "month"], validate="m:1",
                          require_match="stock", what="attach installed base")
    out = out.withColumn("ln_stock", F.round(clean.log_col("stock", "log1p"), 6))
    return out.select("county", "district", "month", "n_orders", "ratio", "stock", "ln_stock")


@register("c10_policy_panel", f"""WITH {FACTS_SQL},
long AS (SELECT month, status AS category, county AS unit, CAST(count(*) AS DOUBLE) AS value
         FROM facts GROUP BY month, status, county),
loc AS (SELECT unit, month, max(CASE WHEN category = 'F' THEN value END) AS ord_F_local,
               max(CASE WHEN category = 'O' THEN value END) AS ord_O_local
        FROM long WHERE unit NOT IN ('AMERICA', 'EUROPE') GROUP BY unit, month),
cen AS (SELECT month, sum(CASE WHEN category = 'F' THEN value END) AS c_F,
               sum(CASE WHEN category = 'O' THEN value END) AS c_O
        FROM long WHERE unit IN ('AMERICA', 'EUROPE') GROUP BY month),
pol AS (SELECT loc.unit, loc.month, coalesce(ord_F_local, 0) + coalesce(c_F, 0) AS ord_F_total,
               coalesce(ord_O_local, 0) + coalesce(c_O, 0) AS ord_O_total
        FROM loc LEFT JOIN cen USING (month)),
pl AS (SELECT a.*, b.ord_F_total AS lag1y_ord_F_total, b.ord_O_total AS lag1y_ord_O_total
       FROM pol a LEFT JOIN pol b ON b.unit = a.unit AND CAST(b.month + INTERVAL 12 MONTH AS DATE) = a.month
       WHERE a.month IN (SELECT month FROM panel))
SELECT p.county, p.district, p.month, p.n_orders, pl.ord_F_total, pl.ord_O_total,
       pl.lag1y_ord_F_total, pl.lag1y_ord_O_total,
       round(CASE WHEN pl.lag1y_ord_F_total >= 0 THEN ln(1 + pl.lag1y_ord_F_total) END, 6) AS ln_lag1y_ord_F_total,
       round(CASE WHEN pl.lag1y_ord_O_total >= 0 THEN ln(1 + pl.lag1y_ord_O_total) END, 6) AS ln_lag1y_ord_O_total
FROM panel p LEFT JOIN pl ON pl.unit = p.county AND pl.month = p.month""")
def c10_policy_panel(spark, sf):
    """Panel + policy totals (A13), exact 1-year lags on the full policy history (J5),
    restricted to the panel months (J8), logs (P15), attached m:1 (J1)."""
    f = order_cube(spark, sf)
    long = f.groupBy("month", F.col("status").alias("category"), F.col("county").alias("unit")).agg(
        nsum().cast("double").alias("value"))
    pol = clean.drop_if_exists(
        agg.category_split_totals(long, "month", "category", "unit", "value", CENTRAL, ["F", "O", "P"],
                                  "ord"),
        ["ord_F_local", "ord_O_local", "ord_P_local", "ord_P_total"])
    totals = ["ord_F_total", "ord_O_total"]
    lagged = joins.calendar_lag(pol, ["unit"], "month", totals)
    panel = nation_month(f).select("county", "district", "month", "n_orders")
    lagged = joins.semi_join(lagged, panel.select("month").distinct(), ["month"])
    lagged = clean.log_columns(lagged, [f"lag1y_{t}" for t in totals], "log1p_nonneg")
    lagged = lagged.withColumnRenamed("unit", "county")
    out = joins.left_join(panel, lagged, ["county", "month"], validate="m:1", what="attach policy")
    return out.select("county", "district", "month", "n_orders", *totals,
                      *[f"lag1y_{t}" for t in totals],
                      *[F.round(F.col(f"ln_lag1y_{t}"), 6).alias(f"ln_lag1y_{t}") for t in totals])

"""Regression queries (E1-E10, C12) on the nation-month panel.

Model: ``ln_revenue`` on ``ln_orders`` with month fixed effects, errors clustered by
district (nation); instruments ``z_building = ln(1 + BUILDING-segment orders)`` and
``z_urgent = ln(1 + urgent orders)``; control ``share_f`` (share of finished orders).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import agg, econ, joins
from .catalog import register
from .econ_oracle import coefficient_rows, regression_ctes
from .panel_queries import FACTS_SQL, money, nsum, order_cube

REG_SQL = f"""{FACTS_SQL},
reg AS (
  SELECT county, district, month, ln(round(sum(price), 2)) AS ln_revenue, ln(count(*)) AS ln_orders,
         ln(1 + count(*) FILTER (WHERE flag)) AS z_building,
         ln(1 + count(*) FILTER (WHERE series = '1-URGENT')) AS z_urgent,
         count(*) FILTER (WHERE status = 'F') / count(*) AS share_f
  FROM facts GROUP BY county, district, month),
s AS (SELECT * FROM reg WHERE month IN (SELECT month FROM reg GROUP BY month HAVING count(*) > 1)),
d AS (SELECT district, month,
             ln_revenue - avg(ln_revenue) OVER (PARTITION BY month) AS yd,
             ln_orders - avg(ln_orders) OVER (PARTITION BY month) AS xd,
             z_building - avg(z_building) OVER (PARTITION BY month) AS zd FROM s),
lv AS (SELECT count(DISTINCT month) AS lv FROM s)"""


def reg_panel(spark, sf) -> DataFrame:
    f = order_cube(spark, sf)
    p = f.groupBy("county", "district", "month").agg(
        money().alias("revenue"), nsum().alias("n"), nsum(F.col("flag")).alias("nb"),
        nsum(F.col("series") == "1-URGENT").alias("nu"), nsum(F.col("status") == "F").alias("nf"))
    return p.select("county", "district", "month", F.ln("revenue").alias("ln_revenue"),
                    F.ln("n").alias("ln_orders"), F.log1p("nb").alias("z_building"),
                    F.log1p("nu").alias("z_urgent"), (F.col("nf") / F.col("n")).alias("share_f"))


def r6(c):
    return F.round(c, 6)


@register("e1_demean", f"WITH {REG_SQL} SELECT district, month, round(yd, 6) AS y_dm, round(xd, 6) AS x_dm FROM d")
def e1_demean(spark, sf):
    """Log revenue and log orders with month effects removed."""
    s = econ.drop_singletons(reg_panel(spark, sf), ["month"])
    d = econ.demean(s, ["ln_revenue", "ln_orders"], ["month"])
    return d.select("district", "month", r6(F.col("ln_revenue")).alias("y_dm"),
                    r6(F.col("ln_orders")).alias("x_dm"))


@register("e3_ols", f"""WITH {REG_SQL},
b AS (SELECT sum(xd * yd) / sum(xd * xd) AS b, sum(xd * xd) AS sxx, count(*) AS n,
             count(DISTINCT district) AS g FROM d),
sc AS (SELECT d.district, sum(d.xd * (d.yd - b.b * d.xd)) AS s FROM d, b GROUP BY d.district),
m AS (SELECT sum(s * s) AS meat FROM sc),
v AS (SELECT b.*, (g / (g - 1.0)) * ((n - 1.0) / (n - (1 + lv))) * meat / (sxx * sxx) AS var
      FROM b, m, lv)
SELECT 'ln_orders' AS term, round(b, 6) AS coef, round(sqrt(var), 6) AS se,
       round(b / sqrt(var), 6) AS t, n AS n_obs, g AS n_clusters FROM v""")
def e3_ols(spark, sf):
    """E3 (E2, E5): OLS with month effects, errors clustered by district."""
    fit = econ.ols_fe(reg_panel(spark, sf), "ln_revenue", ["ln_orders"], ["month"], "district")
    return _coef_frame(spark, fit)


def _coef_frame(spark, fit, terms=None) -> DataFrame:
    rows = []
    for r in fit.table():
        if terms and r["term"] not in terms:
            continue
        rows.append((r["term"], _r(r["coef"]), _r(r["se"]), _r(r["t"]), int(fit.n), int(fit.g)))
    return spark.createDataFrame(rows, "term string, coef double, se double, t double, "
                                       "n_obs long, n_clusters long")


def _r(v):
    return None if v is None or not math.isfinite(v) else round(v, 6)


@register("e4_iv", f"""WITH {REG_SQL},
b AS (SELECT sum(zd * yd) / sum(zd * xd) AS b, sum(zd * xd) AS szx, sum(zd * zd) AS szz,
             count(*) AS n, count(DISTINCT district) AS g FROM d),
sc AS (SELECT d.district, sum(d.zd * (d.yd - b.b * d.xd)) AS s FROM d, b GROUP BY d.district),
m AS (SELECT sum(s * s) AS meat FROM sc),
v AS (SELECT b.*, (g / (g - 1.0)) * ((n - 1.0) / (n - (1 + lv)))
                  * meat * (szx / szz) * (szx / szz) / ((szx / szz) * szx * (szx / szz) * szx) AS var
      FROM b, m, lv)
SELECT 'ln_orders' AS term, round(b, 6) AS coef, round(sqrt(var), 6) AS se,
       round(b / sqrt(var), 6) AS t, n AS n_obs, g AS n_clusters FROM v""")
def e4_iv(spark, sf):
    """2SLS with one instrument, month effects, clustered errors."""
    fits = econ.iv_2sls(reg_panel(spark, sf), "ln_revenue", ["ln_orders"], ["z_building"], [],
                        ["month"], "district")
    return _coef_frame(spark, fits["iv"])


@register("e6_first_stage", f"""WITH {REG_SQL},
b AS (SELECT sum(zd * xd) / sum(zd * zd) AS pi, sum(zd * zd) AS szz, count(*) AS n,
             count(DISTINCT district) AS g FROM d),
sc AS (SELECT d.district, sum(d.zd * (d.xd - b.pi * d.zd)) AS s FROM d, b GROUP BY d.district),
m AS (SELECT sum(s * s) AS meat FROM sc),
v AS (SELECT b.*, (g / (g - 1.0)) * ((n - 1.0) / (n - (1 + lv))) * meat / (szz * szz) AS var
      FROM b, m, lv)
SELECT 'ln_orders' AS endog, round(pi * pi / var, 6) AS f_stat, 1 AS df1, CAST(g - 1 AS BIGINT) AS df2
FROM v""")
def e6_first_stage(spark, sf):
    """First-stage F of the instrument, clustered."""
    fits = econ.iv_2sls(reg_panel(spark, sf), "ln_revenue", ["ln_orders"], ["z_building"], [],
                        ["month"], "district")
    st = fits["first:ln_orders"].stats
    return spark.createDataFrame([("ln_orders", _r(st["F"]), int(st["F_df1"]), int(st["F_df2"]))],
                                 "endog string, f_stat double, df1 int, df2 long")


@register("e8_overid")
def e8_overid(spark, sf):
    """Hansen J with two instruments for one endogenous regressor (no SQL oracle; checked
    against numpy in the unit tests)."""
    fits = econ.iv_2sls(reg_panel(spark, sf), "ln_revenue", ["ln_orders"],
                        ["z_building", "z_urgent"], ["share_f"], ["month"], "district")
    st = fits["iv"].stats
    rows = [(k, float(st[k])) for k in ("hansen_j", "hansen_j_df", "hansen_j_p",
                                        "first_F_ln_orders", "r2_fitted_second_stage")]
    return spark.createDataFrame(rows, "stat string, value double")


_TERMS = {"y": "ln_revenue", "x": "ln_orders", "w": "share_f", "z1": "z_building", "z2": "z_urgent"}


def _demeaned_sql(source: str, over: str) -> str:
    cols = ", ".join(f"{v} - avg({v}) OVER ({over}) AS {k}" for k, v in _TERMS.items())
    return f"SELECT district, {cols} FROM {source}"


def _two_way_sql(source: str, stem: str, levels: int) -> str:
    """CTEs ending in ``{stem}``: the variables less month and county effects, and the rank of the
    effects' dummies. Month means are subtracted from variables and county dummies; then every
    column is made orthogonal to one demeaned dummy after the other (a dummy that earlier ones
    span has no norm left: it takes no degree of freedom)."""
    dums = [f"c{k}" for k in range(1, levels + 1)]
    ranked = f"SELECT *, dense_rank() OVER (ORDER BY county) AS ck FROM {source}"
    demeaned = [f"{v} - avg({v}) OVER (PARTITION BY month) AS {k}" for k, v in _TERMS.items()]
    demeaned += [f"(ck = {k})::DOUBLE - avg((ck = {k})::DOUBLE) OVER (PARTITION BY month) AS {c}"
                 for k, c in enumerate(dums, 1)]
    ctes = [f"{stem}_0 AS (SELECT district, 0 AS used, {', '.join(demeaned)} FROM ({ranked}))"]
    for k, c in enumerate(dums, 1):
        left = [*_TERMS, *dums[k:]]
        norm = f"sum({c} * {c}) OVER ()"
        fit = [f"{v} - CASE WHEN {norm} > 1e-9 THEN sum({v} * {c}) OVER () / {norm} ELSE 0 END * {c} AS {v}"
               for v in left]
        ctes.append(f"{stem}_{k} AS (SELECT district, used + CASE WHEN {norm} > 1e-9 THEN 1 ELSE 0 END AS used, "
                    f"{', '.join(fit)} FROM {stem}_{k - 1})")
    return ",\n".join(ctes) + f",\n{stem} AS (SELECT * FROM {stem}_{levels})"


_TABLES_SQL = f"""WITH {REG_SQL},
d0 AS ({_demeaned_sql("reg", "")}), d1 AS ({_demeaned_sql("s", "PARTITION BY month")}),
{_two_way_sql("s", "d2", 5)},
{regression_ctes("r0", "d0", "1")},
{regression_ctes("r1", "d1", "(SELECT lv FROM lv)")},
{regression_ctes("r2", "d2", "(SELECT lv + (SELECT max(used) FROM d2) FROM lv)")}"""
SPECS = [("none", []), ("month", ["month"]), ("month_county", ["month", "county"])]


def _tables(spark, sf):
    return econ.spec_grid(reg_panel(spark, sf), "ln_revenue", ["ln_orders"],
                          ["z_building", "z_urgent"], ["share_f"], "district", SPECS)


_COEFFICIENTS_SQL = " UNION ALL ".join(coefficient_rows(f"r{i}", name, _TERMS) for i, (name, _) in enumerate(SPECS))


@register("e9_specs", f"""{_TABLES_SQL},
rows AS ({" UNION ALL ".join(coefficient_rows(f"r{i}", name, _TERMS, "+".join(a) or "none") for i, (name, a) in enumerate(SPECS))}),
a AS (SELECT *, atan(abs(raw) / sqrt(n_clusters - 1)) AS th, (n_clusters - 1)::INT AS df FROM rows),
p AS (SELECT *, CASE WHEN df % 2 = 0
    THEN 1 - sin(th) * list_sum([cos(th) ** (2 * k) * coalesce(list_aggregate(
           [(2 * j - 1) / (2.0 * j) for j in range(1, k + 1)], 'product'), 1) for k in range(df // 2)])
    ELSE 1 - 2 / pi() * (th + sin(th) * cos(th) * coalesce(list_sum([cos(th) ** (2 * k) * coalesce(list_aggregate(
           [2 * j / (2.0 * j + 1) for j in range(1, k + 1)], 'product'), 1) for k in range((df - 1) // 2)]), 0))
    END AS p0 FROM a)
SELECT spec, model, term, coef, se, t, round(p0, 6) AS p,
       CASE WHEN p0 < 0.01 THEN '***' WHEN p0 < 0.05 THEN '**' WHEN p0 < 0.1 THEN '*' ELSE '' END AS stars, fe
FROM p""")
def e9_specs(spark, sf):
    """Three specifications, one with two effects, x (OLS, 2SLS, first stage): tidy
    coefficient table with p-values and stars."""
    coefs, _ = _tables(spark, sf)
    return coefs.select("spec", "model", "term", r6(F.col("coef")).alias("coef"), r6(F.col("se")).alias("se"),
                        F.round("t", 5).alias("t"), r6(F.col("p")).alias("p"), "stars", "fe")


@register("c12_coefficients", f"{_TABLES_SQL}\nSELECT * EXCLUDE (raw, fe) FROM ({_COEFFICIENTS_SQL})")
def c12_coefficients(spark, sf):
    """Coefficient tables of three specifications x (OLS, 2SLS, first stage)."""
    coefs, stats = _tables(spark, sf)
    n = stats.where("stat IN ('N', 'N_clust')").groupBy("spec").agg(
        F.max(F.when(F.col("stat") == "N", F.col("value"))).cast("long").alias("n_obs"),
        F.max(F.when(F.col("stat") == "N_clust", F.col("value"))).cast("long").alias("n_clusters"))
    return coefs.join(n, "spec").select("spec", "model", "term", r6(F.col("coef")).alias("coef"),
                                        r6(F.col("se")).alias("se"), F.round("t", 5).alias("t"),
                                        "n_obs", "n_clusters")


@register("e8_overid_stats", _TABLES_SQL + """
SELECT 'none' AS spec, round(hansen_j, 5) AS hansen_j, 1 AS hansen_j_df, round(f_stat, 4) AS first_f FROM r0
UNION ALL SELECT 'month', round(hansen_j, 5), 1, round(f_stat, 4) FROM r1
UNION ALL SELECT 'month_county', round(hansen_j, 5), 1, round(f_stat, 4) FROM r2""")
def e8_overid_stats(spark, sf):
    """Hansen J with its degrees of freedom and the first-stage F, three specifications."""
    _, stats = _tables(spark, sf)
    pick = lambda name: F.max(F.when(F.col("stat") == name, F.col("value")))
    return stats.where("model = 'iv'").groupBy("spec").agg(
        F.round(pick("hansen_j"), 5).alias("hansen_j"),
        pick("hansen_j_df").cast("int").alias("hansen_j_df"),
        F.round(pick("first_F_ln_orders"), 4).alias("first_f"))


@register("e7_fitted", f"""WITH {REG_SQL}, d1 AS ({_demeaned_sql("s", "PARTITION BY month")}),
{regression_ctes("r1", "d1", "(SELECT lv FROM lv)")}
SELECT district, month, round(b_iv_x * ln_orders + b_iv_w * share_f, 5) AS fitted FROM reg, r1""")
def e7_fitted(spark, sf):
    """Linear prediction of every panel row from the 2SLS fit."""
    panel = reg_panel(spark, sf)
    fit = econ.iv_2sls(panel, "ln_revenue", ["ln_orders"], ["z_building", "z_urgent"], ["share_f"],
                       ["month"], "district")["iv"]
    return econ.fitted(panel, fit).select("district", "month", F.round("fitted", 5).alias("fitted"))


@register("e10_sample", f"""WITH {FACTS_SQL},
reg AS (
  SELECT district, month, ln(round(sum(price), 2)) AS ln_revenue, ln(count(*)) AS ln_orders,
         ln(1 + count(*) FILTER (WHERE flag)) AS z_building FROM facts GROUP BY district, month),
lag AS (SELECT a.*, b.ln_orders AS lag_ln_orders FROM reg a LEFT JOIN reg b
        ON b.district = a.district AND CAST(b.month + INTERVAL 12 MONTH AS DATE) = a.month),
f AS (SELECT CASE WHEN ln_revenue IS NULL THEN 1 WHEN ln_orders IS NULL THEN 2
                  WHEN lag_ln_orders IS NULL THEN 3 WHEN z_building IS NULL THEN 4 END AS fm FROM lag),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE fm = 1) AS d1, count(*) FILTER (WHERE fm = 2) AS d2,
             count(*) FILTER (WHERE fm = 3) AS d3, count(*) FILTER (WHERE fm = 4) AS d4 FROM f)
SELECT 1 AS step, 'ln_revenue' AS col, n AS n_before, d1 AS n_dropped, n - d1 AS n_after FROM c
UNION ALL SELECT 2, 'ln_orders', n - d1, d2, n - d1 - d2 FROM c
UNION ALL SELECT 3, 'lag_ln_orders', n - d1 - d2, d3, n - d1 - d2 - d3 FROM c
UNION ALL SELECT 4, 'z_building', n - d1 - d2 - d3, d4, n - d1 - d2 - d3 - d4 FROM c""")
def e10_sample(spark, sf):
    """Listwise deletion with rows lost at each step (incl. a one-year lag)."""
    reg = reg_panel(spark, sf).select("district", "month", "ln_revenue", "ln_orders", "z_building")
    lagged = joins.calendar_lag(reg, ["district"], "month", ["ln_orders"], prefix="lag_")
    _, report = econ.estimation_sample(lagged, ["ln_revenue", "ln_orders", "lag_ln_orders", "z_building"])
    return report


_VARS = ["ln_revenue", "ln_orders", "z_building", "share_f"]


def _q_sql(p: float, name: str) -> str:
    return (f"avg(x) FILTER (WHERE rk = CASE WHEN n*{p} = floor(n*{p}) THEN floor(n*{p}) "
            f"ELSE ceil(n*{p}) END OR rk = CASE WHEN n*{p} = floor(n*{p}) THEN floor(n*{p}) + 1 "
            f"ELSE ceil(n*{p}) END) AS {name}")


@register("c12_regression", f"""WITH {REG_SQL},
long AS ({' UNION ALL '.join(f"SELECT '{v}' AS variable, {v} AS x FROM s" for v in _VARS)}),
r AS (SELECT variable, x, row_number() OVER (PARTITION BY variable ORDER BY x) AS rk,
             count(*) OVER (PARTITION BY variable) AS n FROM long WHERE x IS NOT NULL),
q AS (SELECT variable, {_q_sql(0.25, 'p25')}, {_q_sql(0.5, 'p50')}, {_q_sql(0.75, 'p75')}
      FROM r GROUP BY variable),
m AS (SELECT variable, count(x) AS count, avg(x) AS mean, stddev_samp(x) AS sd, min(x) AS min,
             max(x) AS max FROM long GROUP BY variable)
SELECT m.variable, count, round(mean, 6) AS mean, round(sd, 6) AS sd, round(min, 6) AS min,
       round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(max, 6) AS max
FROM m JOIN q USING (variable)""")
def c12_regression(spark, sf):
    """C12 descriptive table of the estimation sample (the coefficient tables are e9)."""
    s = econ.drop_singletons(reg_panel(spark, sf), ["month"])
    d = agg.describe(s, _VARS)
    return d.select("variable", "count", *[r6(F.col(c)).alias(c)
                                           for c in ("mean", "sd", "min", "p25", "p50", "p75", "max")])

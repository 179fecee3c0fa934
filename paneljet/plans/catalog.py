"""Registered queries on the driver tables.

Roles: county = region name, district = nation name, month = order month, series = order
priority; lifecycle entity = ``events.user_id`` with ``signup`` as activation and ``error`` as
removal at day grain. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lifecycle
from .tables import table

W3_SQL = """
WITH ev AS (
  SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type
  FROM events WHERE event_type IN ('signup', 'error') AND ts IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS rf,
            row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS rl
  FROM ev),
fl AS (
  SELECT user_id, day,
         max(CASE WHEN rf = 1 THEN CASE WHEN event_type LIKE 'error%' THEN 1 ELSE 0 END END) AS s0,
         max(CASE WHEN rl = 1 THEN CASE WHEN event_type LIKE 'signup%' THEN 1 ELSE 0 END END) AS s1
  FROM ranked GROUP BY user_id, day),
span AS (SELECT min(day) AS lo, max(day) AS hi FROM ev),
days AS (SELECT CAST(d AS DATE) AS day FROM span, generate_series(lo, hi, INTERVAL 1 DAY) AS t(d)),
grid AS (SELECT u.user_id, d.day FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN days d),
j AS (SELECT g.user_id, g.day, fl.s0, fl.s1 FROM grid g LEFT JOIN fl USING (user_id, day)),
st AS (
  SELECT user_id, day,
    CAST(coalesce(
      last_value(s1 IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(s0 IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      0) AS INTEGER) AS status
  FROM j)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query; ``sql`` is its DuckDB oracle (omitted for non-SQL operators)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------------------
# Lifecycle
# --------------------------------------------------------------------------------------

def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole event log: signup = activation, error = removal; other event types are not
    lifecycle events but their users are entities (one pass gives both)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("user_id", F.col("event_type").alias("event"), "ts",
                     F.col("event_id").alias("seq"))


def user_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the event log: lifecycle flags and purchase counts per user and day."""
    return lifecycle.event_periods(
        lifecycle_events(spark, sf_dir), entity="user_id", grain="day", activate=("signup",),
        remove=("error",), period="day",
        extra={"purchases": F.count_if(F.col("event") == "purchase")})


def user_status(spark: SparkSession, sf_dir: str, periods: DataFrame | None = None) -> DataFrame:
    periods = periods if periods is not None else user_periods(spark, sf_dir)
    return lifecycle.status_from_periods(periods, None, entity="user_id", grain="day", period="day")


@register("w3_entity_status", W3_SQL + "SELECT user_id, day, status FROM st")
def w3_entity_status(spark, sf_dir):
    """Status of every user on every day from signup/error events."""
    return user_status(spark, sf_dir)


@register("w3_daily_active", W3_SQL + """
SELECT day, CAST(sum(status) AS BIGINT) AS n_active, count(*) AS n_entities
FROM st GROUP BY day""")
def w3_daily_active(spark, sf_dir):
    """Number of active users per day (the flagship aggregate)."""
    return lifecycle.active_per_period(user_status(spark, sf_dir), period="day")

"""Sources, sinks and road edges on the driver tables: what a query writes, it reads back.

Files go to a new folder beside the session's checkpoints, which driver and executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import network, reshape
from ..session import ensure_checkpoint_dir
from ..sources import io
from .catalog import register
from .panel_queries import FACTS_SQL, PRIORITIES, REGIONS, money, nsum, order_rows
from .tables import table


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_wide2(wide: DataFrame, path: str, index: str, pairs: dict[str, tuple[str, str]]) -> None:
    """The two-header layout that ``read_wide2`` reads: a level0 label stands over the first of
    its columns only. One file, for calendar-sized tables (a row per period)."""
    spark = wide.sparkSession
    tops, last = [], None
    for top, _ in pairs.values():
        tops.append(None if top == last else top)
        last = top
    names = [index, *pairs]
    head = spark.createDataFrame([(0, None, *tops), (1, None, *[b for _, b in pairs.values()])],
                                 "_at int, " + ", ".join(f"`{c}` string" for c in names))
    rows = wide.select(F.lit(2).alias("_at"), *[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    (head.unionByName(rows).repartition(1).sortWithinPartitions("_at", index).drop("_at")
     .write.option("header", False).csv(path))


@register("s2_read_wide2", f"""
WITH {FACTS_SQL},
m AS (SELECT DISTINCT month FROM facts),
lab AS (SELECT r.r_name AS county, v.p AS series FROM region r CROSS JOIN
        (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) v(p)),
c AS (SELECT month, county, series, count(*) AS n FROM facts
      WHERE status = 'F' GROUP BY month, county, series)
SELECT m.month AS date, lab.county, lab.series, CAST(c.n AS DOUBLE) AS value
FROM m CROSS JOIN lab LEFT JOIN c ON c.month = m.month AND c.county = lab.county
  AND c.series = lab.series""")
def s2_read_wide2(spark, sf):
    """Filled orders by month, region and priority, written as a CSV with two header rows and
    read back long; months without a filled order of a kind are blank cells and NULL values."""
    labels = {f"{r}_{p}": (r, p) for r in REGIONS for p in PRIORITIES}
    per = (order_rows(spark, sf).withColumn("label", clean.composite_key(["county", "series"], "_"))
           .groupBy("month", "label")
           .agg(F.sum(F.when(F.col("status") == "F", F.col("n"))).alias("n")))
    path = _new_path(spark, "wide2")
    write_wide2(reshape.pivot_first(per, ["month"], "label", "n", list(labels)), path, "month", labels)
    long = io.read_wide2(spark, path, ("county", "series"))
    return clean.parse_date(long, "date", ["yyyy-MM-dd"], on_invalid="fail")


@register("s4_write_panel", f"""
WITH {FACTS_SQL}
SELECT county, district, month, n_orders, revenue, CAST(NULL AS VARCHAR) AS note FROM panel""")
def s4_write_panel(spark, sf):
    """The district x month panel written as sorted CSV files and read back with its types;
    a column that the files lack is NULL."""
    panel = order_rows(spark, sf).groupBy("county", "district", "month").agg(
        nsum().alias("n_orders"), money().alias("revenue"))
    path = _new_path(spark, "panel")
    io.write_panel(panel, path, ["county", "district", "month"], fmt="csv")
    types = {"county": "string", "district": "string", "month": "date", "n_orders": "bigint",
             "revenue": "double"}
    return io.read_panel(spark, path, {**types, "note": "string"}, required=list(types))


@register("s5_write_partitioned", f"""
WITH {FACTS_SQL}
SELECT county, CAST(year(month) AS INTEGER) AS yr, district, month, count(*) AS n_orders
FROM facts WHERE status = 'F' OR year(month) >= 1996
GROUP BY county, year(month), district, month""")
def s5_write_partitioned(spark, sf):
    """Filled orders written by region and year, then the years from 1996 on written again with
    all orders: only these slices are replaced."""
    rows = order_rows(spark, sf).withColumn("yr", F.year("month"))
    keys = ["county", "yr", "district", "month"]
    path = _new_path(spark, "slices")
    for part in (rows.where(F.col("status") == "F"), rows.where(F.col("yr") >= 1996)):
        io.write_partitioned(part.groupBy(*keys).agg(nsum().alias("n_orders")), path,
                             ["county", "yr"], sort_keys=["district", "month"])
    return spark.read.schema("district string, month date, n_orders bigint, county string, yr int"
                             ).parquet(path).select(*keys, "n_orders")


@register("n4_road_edges", """
WITH p AS (SELECT vec_id, label, 1000 * CAST(embedding[3] AS DOUBLE) AS x0,
    1000 * CAST(embedding[4] AS DOUBLE) AS y0, 1000 * CAST(embedding[5] AS DOUBLE) AS x1,
    1000 * CAST(embedding[6] AS DOUBLE) AS y1, 1000 * CAST(embedding[7] AS DOUBLE) AS x2,
    1000 * CAST(embedding[8] AS DOUBLE) AS y2 FROM embeddings),
e AS (SELECT label, vec_id, vec_id || ':0' AS edge_id, x0 AS ux, y0 AS uy, x1 AS vx, y1 AS vy FROM p
      UNION ALL SELECT label, vec_id, vec_id || ':2', x1, y1, x2, y2 FROM p)
SELECT label AS town, vec_id AS road_id, edge_id, ux, uy, vx, vy,
       round(sqrt((vx - ux) * (vx - ux) + (vy - uy) * (vy - uy)), 6) AS len_m
FROM e WHERE vx <> ux OR vy <> uy""")
def n4_road_edges(spark, sf):
    """Every embedding as a road of four vertices, two of them equal (no edge of length zero)."""
    def at(i):
        return F.struct(*[(F.get("embedding", j).cast("double") * 1000).alias(c) for c, j in (("x", i), ("y", i + 1))])

    roads = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("road_id"), F.col("label").alias("town"),
        F.array(at(2), at(4), at(4), at(6)).alias("path"))
    edges = network.road_edges(roads, [], "road_id", town="town")
    return edges.select("town", "road_id", "edge_id", F.col("u.x").alias("ux"), F.col("u.y").alias("uy"),
                        F.col("v.x").alias("vx"), F.col("v.y").alias("vy"),
                        F.round("len_m", 6).alias("len_m"))

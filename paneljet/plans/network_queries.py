"""Network and geometry queries (N1-N10, J13, J14, S7) on tables derived from the driver data.

Road graph: suppliers are nodes; every lineitem links its supplier ``u`` to the next or the
one after in key order, ``v = (u + 1 + partkey % 2) % #suppliers``; an edge's length is
``floor(20 * avg(quantity))`` metres over all its lineitems, and its town is the nation of
``u``. Stations of a year are the suppliers whose returned quantity of that year's lineitems
exceeds 1.3 times the year's mean over suppliers (year = the search key, playing the month). Geometry: points
and segments come from embedding coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import network, spatial
from ..operators.util import cut_lineage
from ..sources import io
from .catalog import register
from .tables import table

GRAPH_SQL = """
ns AS (SELECT count(*) AS n FROM supplier),
e0 AS (SELECT l.l_suppkey AS u, (l.l_suppkey + 1 + l.l_partkey % 2) % ns.n AS v, l.l_quantity
       FROM lineitem l, ns),
edges AS (SELECT e0.u, e0.v, CAST(u AS VARCHAR) || '-' || CAST(v AS VARCHAR) AS edge_id,
                 CAST(floor(avg(e0.l_quantity) * 20) AS BIGINT) AS len_m, n.n_name AS town
          FROM e0 JOIN supplier s ON s.s_suppkey = e0.u JOIN nation n ON n.n_nationkey = s.s_nationkey
          GROUP BY e0.u, e0.v, n.n_name),
ret AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, l_suppkey AS node,
               sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS q
        FROM lineitem GROUP BY ALL),
usual AS (SELECT yr, sum(q) AS total, count(*) AS n FROM ret GROUP BY yr),
src AS (SELECT ret.yr, node FROM ret JOIN usual USING (yr) WHERE 10 * q * n > 13 * total),
adj AS (SELECT u AS a, v AS b, len_m AS len FROM edges UNION ALL SELECT v, u, len_m FROM edges),
walk(yr, node, d) AS (
  SELECT yr, node, CAST(0 AS BIGINT) FROM src
  UNION SELECT w.yr, adj.b, w.d + adj.len FROM walk w JOIN adj ON adj.a = w.node
  WHERE w.d + adj.len <= 1500),
dist AS (SELECT yr, node, CAST(min(d) AS DOUBLE) AS d FROM walk GROUP BY yr, node),
ends AS (SELECT y.yr, e.edge_id, e.town, CAST(e.len_m AS DOUBLE) AS L, t.D,
                CASE WHEN du.d < t.D THEN t.D - du.d END AS a,
                CASE WHEN dv.d < t.D THEN t.D - dv.d END AS b
         FROM (SELECT DISTINCT yr FROM src) y CROSS JOIN edges e
         CROSS JOIN (VALUES (CAST(500 AS DOUBLE)), (CAST(1000 AS DOUBLE)), (CAST(1500 AS DOUBLE))) t(D)
         LEFT JOIN dist du ON du.yr = y.yr AND du.node = e.u
         LEFT JOIN dist dv ON dv.yr = y.yr AND dv.node = e.v),
cov AS (SELECT yr, edge_id, town, D, least(L, coalesce(a, 0) + coalesce(b, 0)) AS covered_m
        FROM ends WHERE a IS NOT NULL OR b IS NOT NULL)"""


def supplier_graph(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n_supp = sup.agg(F.count(F.lit(1)).alias("_n"))  # one row
    e = (li.crossJoin(F.broadcast(n_supp))
         .select(F.col("l_suppkey").alias("u"),
                 ((F.col("l_suppkey") + 1 + F.col("l_partkey") % 2) % F.col("_n")).alias("v"),
                 "l_quantity")
         .groupBy("u", "v").agg(F.floor(F.avg("l_quantity") * 20).cast("long").alias("len_m")))
    towns = sup.join(table(spark, sf, "nation").select("n_nationkey", "n_name"),
                     F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("u"), F.col("n_name").alias("town"))
    return (e.join(towns, "u")
            .withColumn("edge_id", F.concat_ws("-", F.col("u").cast("string"), F.col("v").cast("string"))))


def station_sets(spark, sf) -> DataFrame:
    """Stations from an aggregate over all lineitems: suppliers with unusually many returns."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)
    by = (table(spark, sf, "lineitem")
          .groupBy(F.year("l_shipdate").cast("int").alias("yr"), F.col("l_suppkey").alias("node"))
          .agg(F.sum(returned).alias("q")))
    usual = by.groupBy("yr").agg(F.sum("q").alias("total"), F.count(F.lit(1)).alias("n"))
    return (by.join(usual, "yr").where(10 * F.col("q") * F.col("n") > 13 * F.col("total"))
            .select("yr", "node"))


def _distances(spark, sf):
    edges = cut_lineage(supplier_graph(spark, sf))
    return edges, network.network_distance(edges, station_sets(spark, sf), [], ["yr"], 1500.0)


@register("n4_edges", "WITH " + GRAPH_SQL.split("src AS")[0].rstrip().rstrip(",")
          + " SELECT u, v, edge_id, len_m, town FROM edges")
def n4_edges(spark, sf):
    """Supplier road graph edges with lengths and towns, from all lineitems."""
    return supplier_graph(spark, sf).select("u", "v", "edge_id", "len_m", "town")


@register("n5_network_distance", f"WITH RECURSIVE {GRAPH_SQL} SELECT yr, node, d FROM dist")
def n5_network_distance(spark, sf):
    """Least network distance of each supplier node from that year's stations (<= 1500 m)."""
    _, dist = _distances(spark, sf)
    return dist.select("yr", "node", "d")


@register("n6_covered_length", f"""WITH RECURSIVE {GRAPH_SQL}
SELECT yr, edge_id, D, covered_m FROM cov WHERE covered_m > 0""")
def n6_covered_length(spark, sf):
    """Covered length per edge, year and threshold."""
    edges, dist = _distances(spark, sf)
    return network.covered_length(edges, dist, [], ["yr"]).select("yr", "edge_id", "D", "covered_m")


@register("n7_covered_intervals", f"""WITH RECURSIVE {GRAPH_SQL}
SELECT yr, edge_id, D, 0.0 AS from_m, L AS to_m FROM ends
  WHERE a IS NOT NULL AND b IS NOT NULL AND a + b >= L
UNION ALL SELECT yr, edge_id, D, 0.0, least(L, a) FROM ends
  WHERE a IS NOT NULL AND (b IS NULL OR a + b < L)
UNION ALL SELECT yr, edge_id, D, greatest(0.0, L - b), L FROM ends
  WHERE b IS NOT NULL AND (a IS NULL OR a + b < L)""")
def n7_covered_intervals(spark, sf):
    """Covered parts of each edge as merged intervals."""
    edges, dist = _distances(spark, sf)
    return network.covered_intervals(edges, dist, [], ["yr"]).select(
        "yr", "edge_id", "D", "from_m", "to_m")


_C11_SQL = f"""WITH RECURSIVE {GRAPH_SQL},
tot AS (SELECT town, CAST(sum(len_m) AS DOUBLE) AS len_total_m, count(*) AS n_pieces
        FROM edges GROUP BY town),
cv AS (SELECT yr, town, sum(covered_m) FILTER (WHERE D = 500) AS c500,
              sum(covered_m) FILTER (WHERE D = 1000) AS c1000,
              sum(covered_m) FILTER (WHERE D = 1500) AS c1500 FROM cov GROUP BY yr, town),
g AS (SELECT y.yr, tot.town, tot.len_total_m, tot.n_pieces,
             least(coalesce(cv.c500, 0), len_total_m) AS k500,
             least(coalesce(cv.c1000, 0), len_total_m) AS k1000,
             least(coalesce(cv.c1500, 0), len_total_m) AS k1500
      FROM (SELECT DISTINCT yr FROM src) y CROSS JOIN tot
      LEFT JOIN cv ON cv.yr = y.yr AND cv.town = tot.town)
SELECT yr, town, round(len_total_m, 1) AS len_total_m, n_pieces,
       round(k500, 1) AS len_0_500_m, round(k1000 - k500, 1) AS len_500_1000_m,
       round(k1500 - k1000, 1) AS len_1000_1500_m, round(len_total_m - k1500, 1) AS len_gt1500_m,
       round(CASE WHEN len_total_m <> 0 THEN 100 * k500 / len_total_m ELSE 0 END, 6) AS reach500_pct,
       round(CASE WHEN len_total_m <> 0 THEN 100 * k1000 / len_total_m ELSE 0 END, 6) AS reach1k_pct,
       round(CASE WHEN len_total_m <> 0 THEN 100 * k1500 / len_total_m ELSE 0 END, 6) AS reach1500_pct
FROM g"""


def coverage(spark, sf, keys: DataFrame | None = None) -> DataFrame:
    """N6 + N8 + N9 for every search key (or only the given ``keys``)."""
    edges = cut_lineage(supplier_graph(spark, sf))
    sources = station_sets(spark, sf)
    if keys is not None:
        sources = sources.join(keys, ["yr"], "left_semi")
    dist = network.network_distance(edges, sources, [], ["yr"], 1500.0)
    cov = network.covered_length(edges, dist, [], ["yr"])
    by_town = network.length_by_region(edges, cov, [], ["yr"], sources.select("yr").distinct(),
                                       town="town")
    bands = network.coverage_bands(by_town, digits_pct=6)
    return bands.select("yr", "town", "len_total_m", "n_pieces", "len_0_500_m", "len_500_1000_m",
                        "len_1000_1500_m", "len_gt1500_m", "reach500_pct", "reach1k_pct",
                        "reach1500_pct")


def _by_town(spark, sf) -> DataFrame:
    edges = cut_lineage(supplier_graph(spark, sf))
    sources = station_sets(spark, sf)
    dist = network.network_distance(edges, sources, [], ["yr"], 1500.0)
    cov = network.covered_length(edges, dist, [], ["yr"])
    return network.length_by_region(edges, cov, [], ["yr"], sources.select("yr").distinct(),
                                    town="town")


@register("n8_length_by_region", _C11_SQL.split("\nSELECT yr, town, round(len_total_m, 1)")[0] + """
SELECT g.yr, g.town, g.len_total_m, g.n_pieces, coalesce(cv.c500, 0) AS cum_500,
       coalesce(cv.c1000, 0) AS cum_1000, coalesce(cv.c1500, 0) AS cum_1500
FROM g LEFT JOIN cv ON cv.yr = g.yr AND cv.town = g.town""")
def n8_length_by_region(spark, sf):
    """Total length and pieces per town, covered length per threshold (unclamped)."""
    return _by_town(spark, sf).select("yr", "town", "len_total_m", "n_pieces",
                                      "cum_500", "cum_1000", "cum_1500")


@register("n9_coverage", _C11_SQL)
def n9_coverage(spark, sf):
    """Bands and reach from the N8 table."""
    bands = network.coverage_bands(_by_town(spark, sf), digits_pct=6)
    return bands.select("yr", "town", "len_total_m", "n_pieces", "len_0_500_m", "len_500_1000_m",
                        "len_1000_1500_m", "len_gt1500_m", "reach500_pct", "reach1k_pct",
                        "reach1500_pct")


@register("c11_coverage", _C11_SQL)
def c11_coverage(spark, sf):
    """C11 (N6-N9): covered road length bands and reach % per year and town."""
    return coverage(spark, sf)


SNAPSHOT_YEARS = [1997, 1999, 2001]


@register("n10_coverage_panel", _C11_SQL + " WHERE yr IN (1997, 1999, 2001)")
def n10_coverage_panel(spark, sf):
    """N10 with S6: the snapshot keys (chosen years) that have no output yet are computed;
    here nothing has been written, so all snapshot keys are pending."""
    grid = station_sets(spark, sf).select("yr").distinct()
    pending = io.pending_keys(grid.where(F.col("yr").isin(SNAPSHOT_YEARS)), None, ["yr"])
    return coverage(spark, sf, pending)


# --------------------------------------------------------------------------------------
# projection
# --------------------------------------------------------------------------------------

def _tm2_sql(lon: str, lat: str) -> tuple[str, str]:
    e2, ep2, (m0, m2, m4, m6) = spatial._tm_constants()
    a, k0 = spatial.GRS80_A, spatial.TM2_K0
    phi = f"radians({lat})"
    n = f"({a!r} / sqrt(1 - {e2!r} * sin({phi}) * sin({phi})))"
    tt = f"(tan({phi}) * tan({phi}))"
    cc = f"({ep2!r} * cos({phi}) * cos({phi}))"
    aa = f"(radians({lon} - {spatial.TM2_LON0!r}) * cos({phi}))"
    mm = (f"({a!r} * ({m0!r} * {phi} - {m2!r} * sin(2 * {phi}) + {m4!r} * sin(4 * {phi})"
          f" - {m6!r} * sin(6 * {phi})))")
    x = (f"({spatial.TM2_FALSE_EASTING!r} + {k0!r} * {n} * ({aa} + (1 - {tt} + {cc}) * pow({aa}, 3) / 6"
         f" + (5 - 18 * {tt} + {tt} * {tt} + 72 * {cc} - 58 * {ep2!r}) * pow({aa}, 5) / 120))")
    y = (f"({spatial.TM2_FALSE_NORTHING!r} + {k0!r} * ({mm} + {n} * tan({phi}) * (pow({aa}, 2) / 2"
         f" + (5 - {tt} + 9 * {cc} + 4 * {cc} * {cc}) * pow({aa}, 4) / 24"
         f" + (61 - 58 * {tt} + {tt} * {tt} + 600 * {cc} - 330 * {ep2!r}) * pow({aa}, 6) / 720)))")
    return x, y


_LON = "(121.0 + CAST(embedding[1] AS DOUBLE) * 2)"
_LAT = "(23.5 + CAST(embedding[2] AS DOUBLE) * 3)"
_X, _Y = _tm2_sql(_LON, _LAT)


@register("n1_project", f"SELECT vec_id, round({_X}, 3) AS x, round({_Y}, 3) AS y FROM embeddings")
def n1_project(spark, sf):
    """Embedding coordinates as lon/lat projected to TWD97 TM2 metres."""
    e = table(spark, sf, "embeddings")
    lon = F.lit(121.0) + F.get("embedding", 0).cast("double") * 2
    lat = F.lit(23.5) + F.get("embedding", 1).cast("double") * 3
    x, y = spatial.project_tm2(lon, lat)
    return e.select("vec_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


# --------------------------------------------------------------------------------------
# Points in polygons
# --------------------------------------------------------------------------------------

# Fixed test polygons in embedding units (square, triangle, concave L shape).
POLYGONS = {
    "P1": [(-0.2, -0.2), (0.2, -0.2), (0.2, 0.2), (-0.2, 0.2)],
    "P2": [(0.0, 0.0), (0.4, 0.0), (0.0, 0.4)],
    "P3": [(-0.4, -0.4), (0.0, -0.4), (0.0, -0.1), (-0.1, -0.1), (-0.1, 0.3), (-0.4, 0.3)],
}


def _edges_values(polys) -> str:
    rows = []
    for pid, ring in polys.items():
        for i, (ax, ay) in enumerate(ring):
            bx, by = ring[(i + 1) % len(ring)]
            rows.append(f"('{pid}', {float(ax)!r}, {float(ay)!r}, {float(bx)!r}, {float(by)!r})")
    return ", ".join(rows)


def polygons_df(spark, polys) -> DataFrame:
    rows = [(pid, [(float(x), float(y)) for x, y in ring]) for pid, ring in polys.items()]
    return spark.createDataFrame(rows, "poly_id string, ring array<struct<x: double, y: double>>")


_J13_SQL = f"""
WITH pts AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
             FROM embeddings),
ed AS (SELECT * FROM (VALUES {_edges_values(POLYGONS)}) t(poly_id, xa, ya, xb, yb)),
inside AS (SELECT p.vec_id, e.poly_id FROM pts p JOIN ed e
             ON ((e.ya > p.y) <> (e.yb > p.y))
            AND p.x < (e.xb - e.xa) * (p.y - e.ya) / (e.yb - e.ya) + e.xa
           GROUP BY p.vec_id, e.poly_id HAVING count(*) % 2 = 1)"""


def _points(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.get("embedding", 0).cast("double").alias("x"),
                    F.get("embedding", 1).cast("double").alias("y"))


@register("j13_point_polygon", _J13_SQL + " SELECT vec_id, poly_id FROM inside")
def j13_point_polygon(spark, sf):
    """Embedding points inside three fixed polygons (crossing number)."""
    return spatial.points_in_polygons(_points(spark, sf), polygons_df(spark, POLYGONS), 0.1).select(
        "vec_id", "poly_id")


@register("n2_clip_points", _J13_SQL + " SELECT poly_id, count(*) AS n_points FROM inside GROUP BY poly_id")
def n2_clip_points(spark, sf):
    """Points per polygon."""
    return spatial.clip_points(_points(spark, sf), polygons_df(spark, POLYGONS), 0.1)


# --------------------------------------------------------------------------------------
# Segments from embeddings (metres)
# --------------------------------------------------------------------------------------

TOWNS = {"T1": spatial.rect_ring(-500, -500, 0, 0), "T2": spatial.rect_ring(0, -500, 500, 0),
         "T3": spatial.rect_ring(-500, 0, 0, 500), "T4": spatial.rect_ring(0, 0, 500, 500)}

_SEG_SQL = """
segs AS (SELECT vec_id AS seg_id, CAST(embedding[3] AS DOUBLE) * 1000 AS x0,
                CAST(embedding[4] AS DOUBLE) * 1000 AS y0, CAST(embedding[5] AS DOUBLE) * 1000 AS x1,
                CAST(embedding[6] AS DOUBLE) * 1000 AS y1, label FROM embeddings)"""


def _segments(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("seg_id"),
                    *[(F.get("embedding", i).cast("double") * 1000).alias(n)
                      for i, n in zip(range(2, 6), ["x0", "y0", "x1", "y1"])], "label")


def _rect_values() -> str:
    rows = []
    for tid, ring in TOWNS.items():
        xs = [p[0] for p in ring]
        ys = [p[1] for p in ring]
        rows.append(f"('{tid}', {float(min(xs))!r}, {float(min(ys))!r}, {float(max(xs))!r}, {float(max(ys))!r})")
    return ", ".join(rows)


@register("n3_clip", f"""
WITH {_SEG_SQL},
r AS (SELECT * FROM (VALUES {_rect_values()}) t(poly_id, xmin, ymin, xmax, ymax)),
p AS (SELECT s.seg_id, r.poly_id, x1 - x0 AS dx, y1 - y0 AS dy, x0, y0, xmin, ymin, xmax, ymax,
             sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS L FROM segs s CROSS JOIN r),
q AS (SELECT seg_id, poly_id, L,
        greatest(0.0,
          CASE WHEN dx > 0 THEN (xmin - x0) / dx WHEN dx < 0 THEN (xmax - x0) / dx
               WHEN x0 >= xmin AND x0 <= xmax THEN 0.0 ELSE 2.0 END,
          CASE WHEN dy > 0 THEN (ymin - y0) / dy WHEN dy < 0 THEN (ymax - y0) / dy
               WHEN y0 >= ymin AND y0 <= ymax THEN 0.0 ELSE 2.0 END) AS t0,
        least(1.0,
          CASE WHEN dx > 0 THEN (xmax - x0) / dx WHEN dx < 0 THEN (xmin - x0) / dx ELSE 1.0 END,
          CASE WHEN dy > 0 THEN (ymax - y0) / dy WHEN dy < 0 THEN (ymin - y0) / dy ELSE 1.0 END) AS t1
      FROM p)
SELECT seg_id, poly_id, round((t1 - t0) * L, 4) AS len_inside FROM q WHERE t1 > t0 AND L > 0""")
def n3_clip(spark, sf):
    """Length of each embedding segment inside each of four quadrant towns."""
    out = spatial.clip_lines(_segments(spark, sf), polygons_df(spark, TOWNS), 100.0)
    return out.select("seg_id", "poly_id", F.round("len_inside", 4).alias("len_inside"))


@register("j14_snap", f"""
WITH {_SEG_SQL},
pts AS (SELECT vec_id AS point_id, CAST(embedding[1] AS DOUBLE) * 1000 AS px,
               CAST(embedding[2] AS DOUBLE) * 1000 AS py FROM embeddings),
c AS (SELECT p.point_id, s.seg_id, p.px, p.py, s.x0, s.y0, x1 - x0 AS dx, y1 - y0 AS dy,
             (x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) AS l2 FROM pts p CROSS JOIN segs s),
t AS (SELECT *, CASE WHEN l2 > 0 THEN least(1.0, greatest(0.0, ((px - x0) * dx + (py - y0) * dy) / l2))
                     ELSE 0.0 END AS t FROM c),
d AS (SELECT point_id, seg_id, t, t * sqrt(l2) AS "offset",
             sqrt((px - (x0 + t * dx)) * (px - (x0 + t * dx)) + (py - (y0 + t * dy)) * (py - (y0 + t * dy))) AS dist
      FROM t),
b AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY dist, seg_id) AS rn FROM d
      WHERE dist <= 10.0)
SELECT point_id, seg_id, round(t, 6) AS t, round("offset", 6) AS "offset", round(dist, 6) AS dist
FROM b WHERE rn = 1""")
def j14_snap(spark, sf):
    """Nearest embedding segment within 10 m of each embedding point."""
    e = table(spark, sf, "embeddings")
    pts = e.select(F.col("vec_id").alias("point_id"),
                   (F.get("embedding", 0).cast("double") * 1000).alias("x"),
                   (F.get("embedding", 1).cast("double") * 1000).alias("y"))
    snapped = spatial.snap_points(pts, _segments(spark, sf).drop("label"), max_m=10.0, cell=50.0)
    return snapped.select("point_id", "seg_id", *[F.round(c, 6).alias(c) for c in ("t", "offset", "dist")])


@register("s7_base_layers", f"""
WITH {_SEG_SQL}
SELECT seg_id, CASE WHEN label < 5 THEN 'A' ELSE 'B' END AS city,
       CASE WHEN label = 0 THEN 'HW' ELSE 'LOCAL' END AS ROADCLASS1
FROM segs WHERE label <> 0""")
def s7_base_layers(spark, sf):
    """Two cities' road layers united, highways dropped."""
    s = _segments(spark, sf).withColumn(
        "ROADCLASS1", F.when(F.col("label") == 0, "HW").otherwise("LOCAL"))
    city_a = s.where(F.col("label") < 5).withColumn("city", F.lit("A"))
    city_b = s.where(F.col("label") >= 5).withColumn("city", F.lit("B"))
    towns = [polygons_df(spark, TOWNS).withColumn("city", F.lit(c)) for c in ("A", "B")]
    roads, _ = io.build_base_layers([city_a, city_b], towns)
    return roads.select("seg_id", "city", "ROADCLASS1")


# --------------------------------------------------------------------------------------
# N10 from raw layers: embedding segments as roads, quadrant towns, embedding points as
# stations with the embedding label as month
# --------------------------------------------------------------------------------------

@register("n10_coverage_layers")
def n10_coverage_layers(spark, sf):
    """The full layer chain (clip, edges, snap, search, bands) on whole tables. No SQL
    oracle: clipping, snapping and the search are checked against hand-computed and brute
    force results in the unit tests."""
    from ..operators import coverage

    e = table(spark, sf, "embeddings")
    seg = _segments(spark, sf)
    roads = seg.select(F.lit("X").alias("city"), F.col("seg_id").alias("road_id"),
                       F.when(F.col("label") == 0, "HW").otherwise("LOCAL").alias("ROADCLASS1"),
                       F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")),
                               F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("path"))
    towns = polygons_df(spark, TOWNS).select(F.lit("X").alias("city"), F.col("poly_id").alias("TOWNID"),
                                             F.col("poly_id").alias("TOWNNAME"), "ring")
    stations = e.select(F.lit("X").alias("city"), F.col("label").cast("string").alias("month"),
                        F.col("vec_id").cast("string").alias("station_id"),
                        (F.get("embedding", 0).cast("double") * 1000).alias("x"),
                        (F.get("embedding", 1).cast("double") * 1000).alias("y"))
    out = coverage.coverage_panel(roads, towns, stations, thresholds=(50, 100, 150), snap_m=20.0,
                                  project=False, cell=100.0, digits_pct=6)
    return out.select("city", "month", "TOWNID", "TOWNNAME", "len_total_m", "n_pieces",
                      "len_0_50_m", "len_50_100_m", "len_100_150_m", "len_gt150_m",
                      "reach50_pct", "reach100_pct", "reach150_pct")


# --------------------------------------------------------------------------------------
# C11 / N10 from raw layers with a closed-form oracle: every supplier has a straight road of its
# nation, 1,000 m apart, whose length comes from its lineitems; three towns side by side (the
# last has no road); a year's stations stand at distances from its returns
# --------------------------------------------------------------------------------------

_CITY_SQL = f"""WITH RECURSIVE {GRAPH_SQL.split("adj AS")[0].rstrip().rstrip(",")},
road AS (SELECT s.s_suppkey AS k, n.n_name AS city, 1000 + sum(l.l_quantity) % 2001 AS len
         FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
         JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY ALL),
place AS (SELECT src.yr, src.node AS k, any_value(ret.q) % 1000 AS x, count(*) % 300 AS dy
          FROM src JOIN ret ON ret.yr = src.yr AND ret.node = src.node
          JOIN lineitem l ON l.l_suppkey = src.node AND year(l.l_shipdate) = src.yr
          GROUP BY src.yr, src.node),
town(t, lo, hi) AS (VALUES ('A', -100.0, 1500.0), ('B', 1500.0, 4000.0), ('C', 6000.0, 7000.0)),
piece AS (SELECT city, k, t, greatest(lo, 0) AS p, least(hi, len) AS q FROM road, town
          WHERE k % 7 <> 0 AND least(hi, len) > greatest(lo, 0)),
seen AS (SELECT DISTINCT city, yr FROM place JOIN road USING (k)),
tot AS (SELECT n.n_name AS city, town.t, coalesce(sum(q - p), 0) AS total, count(q) AS n_pieces
        FROM nation n CROSS JOIN town LEFT JOIN piece ON piece.city = n.n_name AND piece.t = town.t
        GROUP BY n.n_name, town.t),
cov AS (SELECT city, t, yr,
          {', '.join(f"sum(greatest(0, least(q, x + {d}) - greatest(p, x - {d}))) AS c{d}" for d in (500, 1000, 1500))}
        FROM piece JOIN place USING (k) WHERE dy <= 200 GROUP BY ALL),
g AS (SELECT seen.city, seen.yr, tot.t, total, n_pieces, coalesce(c500, 0) AS c500,
             coalesce(c1000, 0) AS c1000, coalesce(c1500, 0) AS c1500
      FROM seen JOIN tot ON tot.city = seen.city
      LEFT JOIN cov ON cov.city = seen.city AND cov.yr = seen.yr AND cov.t = tot.t)
SELECT city, yr AS month, t AS town, round(total, 1) AS len_total_m, n_pieces,
       round(c500, 1) AS len_0_500_m, round(c1000 - c500, 1) AS len_500_1000_m,
       round(c1500 - c1000, 1) AS len_1000_1500_m, round(total - c1500, 1) AS len_gt1500_m,
       round(CASE WHEN total > 0 THEN 100 * c500 / total ELSE 0 END, 6) AS reach500_pct,
       round(CASE WHEN total > 0 THEN 100 * c1000 / total ELSE 0 END, 6) AS reach1k_pct,
       round(CASE WHEN total > 0 THEN 100 * c1500 / total ELSE 0 END, 6) AS reach1500_pct
FROM g"""


@register("c11_city_coverage", _CITY_SQL)
def c11_city_coverage(spark, sf):
    """The whole layer chain (highways dropped, clip, edges, stations inside, snap,
    search, bands) per nation x year x town."""
    from ..operators import coverage

    li = table(spark, sf, "lineitem")
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    city = table(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("k"), "city")
    years = (li.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").cast("int").alias("month"))
             .agg(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).alias("q"),
                  F.sum("l_quantity").alias("all"), F.count(F.lit(1)).alias("n")))
    years = cut_lineage(years)

    def point(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    y = 1000 * F.col("k")
    length = years.groupBy("k").agg((1000 + F.sum("all") % 2001).alias("len"))
    roads = city.join(length, "k").select(
        "city", F.col("k").alias("road_id"), F.when(F.col("k") % 7 == 0, "HW").otherwise("LOCAL").alias("ROADCLASS1"),
        F.array(point(F.lit(0), y), point(F.col("len"), y)).alias("path"))
    top = table(spark, sf, "supplier").agg((1000 * F.max("s_suppkey") + 500).alias("top"))
    spans = [("A", -100.0, 1500.0), ("B", 1500.0, 4000.0), ("C", 6000.0, 7000.0)]
    rects = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for t, lo, hi in spans])
    towns = (nations.crossJoin(F.broadcast(top)).select("city", "top", F.explode(rects).alias("r"))
             .select("city", F.col("r.t").alias("TOWNID"), F.col("r.t").alias("TOWNNAME"),
                     F.array(point(F.col("r.lo"), F.lit(-500)), point(F.col("r.hi"), F.lit(-500)),
                             point(F.col("r.hi"), F.col("top")), point(F.col("r.lo"), F.col("top"))).alias("ring")))
    chosen = station_sets(spark, sf).select(F.col("yr").alias("month"), F.col("node").alias("k"))
    stations = years.join(chosen, ["month", "k"]).join(city, "k").select(
        "city", "month", F.col("k").cast("string").alias("station_id"),
        (F.col("q") % 1000).cast("double").alias("x"), (y + F.col("n") % 300).cast("double").alias("y"))
    out = coverage.coverage_panel(roads, towns, stations, project=False, cell=5000.0, digits_pct=6)
    return out.select("city", "month", F.col("TOWNID").alias("town"), "len_total_m", "n_pieces",
                      "len_0_500_m", "len_500_1000_m", "len_1000_1500_m", "len_gt1500_m",
                      "reach500_pct", "reach1k_pct", "reach1500_pct")

"""Planar geometry as column expressions: N1, N2/J13, N3, J14.

Geometries are ordinary columns: a point is two DOUBLE columns, a ring or path is
``ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>``. Tests run inside the JVM with higher-order
functions (``transform``/``aggregate``); only the search for the nearest segment (J14) runs in
numpy, on bounded groups that Spark deals out. Candidates come from an equi-join or grouping
on grid cells, never from a cross join.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# --------------------------------------------------------------------------------------
# EPSG:4326 -> EPSG:3826 (TWD97 / TM2 zone 121)
# --------------------------------------------------------------------------------------

# Fixed values of the projection (GRS80 ellipsoid, TM2 zone 121).
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
TM2_K0 = 0.9999
TM2_LON0 = 121.0
TM2_FALSE_EASTING = 250000.0
TM2_FALSE_NORTHING = 0.0


def _tm_constants():
    e2 = GRS80_F * (2 - GRS80_F)
    e4, e6 = e2 * e2, e2 * e2 * e2
    ep2 = e2 / (1 - e2)
    m = (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256,
         3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024,
         15 * e4 / 256 + 45 * e6 / 1024,
         35 * e6 / 3072)
    return e2, ep2, m


def project_tm2(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Transverse Mercator series (Snyder) for GRS80, central meridian 121E,
    k0 0.9999, false easting 250 km. Returns (x, y) in metres."""
    e2, ep2, (m0, m2, m4, m6) = _tm_constants()
    a, k0 = GRS80_A, TM2_K0
    phi = F.radians(lat.cast("double"))
    s, c, t = F.sin(phi), F.cos(phi), F.tan(phi)
    n = F.lit(a) / F.sqrt(1 - F.lit(e2) * s * s)
    tt = t * t
    cc = F.lit(ep2) * c * c
    aa = F.radians(lon.cast("double") - F.lit(TM2_LON0)) * c
    mm = F.lit(a) * (F.lit(m0) * phi - F.lit(m2) * F.sin(2 * phi) + F.lit(m4) * F.sin(4 * phi)
                     - F.lit(m6) * F.sin(6 * phi))
    x = F.lit(TM2_FALSE_EASTING) + F.lit(k0) * n * (
        aa + (1 - tt + cc) * aa ** 3 / 6
        + (5 - 18 * tt + tt * tt + 72 * cc - 58 * ep2) * aa ** 5 / 120)
    y = F.lit(TM2_FALSE_NORTHING) + F.lit(k0) * (mm + n * t * (
        aa ** 2 / 2 + (5 - tt + 9 * cc + 4 * cc * cc) * aa ** 4 / 24
        + (61 - 58 * tt + tt * tt + 600 * cc - 330 * ep2) * aa ** 6 / 720))
    return x, y


# --------------------------------------------------------------------------------------
# Grid cells (candidate pairs by equi-join)
# --------------------------------------------------------------------------------------

def cell_of(x: Column, y: Column, cell: float) -> Column:
    return F.struct(F.floor(x / cell).cast("long").alias("cx"),
                    F.floor(y / cell).cast("long").alias("cy"))


def cells_along(x0: Column, y0: Column, x1: Column, y1: Column, reach: float, cell: float) -> Column:
    """All grid cells that hold a point within ``reach`` of a segment, few others: for every column
    of cells, those beside the part of the segment within ``reach`` of the column (array of
    struct(cx, cy)). Their number is linear in the segment's length, whatever its direction."""
    far = reach * (1 + 1e-9) + 1e-6             # over the rounding of the part's ends
    lo, hi = F.least(x0, x1), F.greatest(x0, x1)
    slope = F.try_divide(y1 - y0, x1 - x0)

    def column(cx: Column) -> Column:
        y = [F.coalesce(y0 + slope * (F.greatest(lo, F.least(hi, edge)) - x0), other) for edge, other in
             ((cx * cell - far, y0), (cx * cell + (cell + far), y1))]
        ys = F.sequence(F.floor((F.least(*y) - far) / cell).cast("long"),
                        F.floor((F.greatest(*y) + far) / cell).cast("long"))
        return F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

    return F.flatten(F.transform(F.sequence(F.floor((lo - far) / cell).cast("long"),
                                            F.floor((hi + far) / cell).cast("long")), column))


# --------------------------------------------------------------------------------------
# Point in polygon (crossing number, half-open rule)
# --------------------------------------------------------------------------------------

def point_in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Crossing-number test of (px, py) against a closed ring (last vertex joins the first).

    An edge counts when it straddles the horizontal line through the point (half-open in y)
    and crosses it to the right of the point.
    """
    n = F.size(ring)

    def crossing(i):
        a = F.get(ring, i)
        b = F.get(ring, (i + 1) % n)
        straddles = (a["y"] > py) != (b["y"] > py)
        # try_divide: horizontal edges never straddle, but ANSI mode must not see a 0 divisor
        xcross = F.try_divide((b["x"] - a["x"]) * (py - a["y"]), b["y"] - a["y"]) + a["x"]
        return F.when(straddles & (px < xcross), F.lit(1)).otherwise(F.lit(0))

    hits = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + crossing(i))
    return (hits % 2) == 1


def _columns_in_row(a: Column, b: Column, cy: Column, cell: float) -> tuple[Column, Column]:
    """First and last cell column of the part of edge a-b in row ``cy`` of cells, rounded outwards."""
    far = F.lit(cell * 1e-9) + (F.abs(a["x"]) + F.abs(b["x"]) + F.abs(a["y"]) + F.abs(b["y"])) * 1e-12
    slope = F.try_divide(b["x"] - a["x"], b["y"] - a["y"])
    lo, hi = F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])

    def at(y: Column, flat: Column) -> Column:      # a horizontal edge spans both its ends
        return F.coalesce(a["x"] + slope * (F.greatest(lo, F.least(hi, y)) - a["y"]), flat)

    x0, x1 = at(cy * cell - far, a["x"]), at((cy + 1) * cell + far, b["x"])
    return (F.floor((F.least(x0, x1) - far) / cell).cast("long"),
            F.floor((F.greatest(x0, x1) + far) / cell).cast("long"))


def polygon_cells(polygons: DataFrame, keys: list[str], ring: str, cell: float) -> DataFrame:
    """Index of polygons by grid cell: ``(keys, _cell, _mark, _edges)``, one row per polygon and cell
    that its boundary meets or that lies inside; other cells have no row.

    ``_edges`` are the edges that meet the cell. All edges further right in the same row of cells
    are folded into a parity: an end above the row counts for every point of the cell (``_mark``,
    a running parity along the row), an end below for none, and an end within the row cancels
    against the next edge of the ring, unless that one meets the cell itself; such ends stay with
    the local edge (``ta``, ``tb``). ``in_cell`` then gives exactly ``point_in_ring``.
    """
    n = F.size(ring)

    def vertex(i: Column) -> Column:
        return F.get(F.col(ring), F.pmod(i, n))

    def row(v: Column) -> Column:
        return F.floor(v["y"] / cell).cast("long")

    around = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        vertex(i - 1).alias("p"), vertex(i).alias("a"), vertex(i + 1).alias("b"), vertex(i + 2).alias("q")))
    edges = polygons.where(n > 0).select(*keys, F.explode(around).alias("_e")).select(*keys, "_e.*")
    p, a, b, q = (F.col(c) for c in "pabq")
    edges = edges.withColumn("_cy", F.explode(F.sequence(F.least(row(a), row(b)), F.greatest(row(a), row(b)))))
    cy = F.col("_cy")
    first, last = _columns_in_row(a, b, cy, cell)
    edges = edges.withColumns({
        "_c0": first, "_c1": last,
        "_pc": F.when(row(a) == cy, _columns_in_row(p, a, cy, cell)[0]),
        "_qc": F.when(row(b) == cy, _columns_in_row(b, q, cy, cell)[0])})

    # cells with an odd number of ends above among the edges that begin further right
    starts = edges.groupBy(*keys, "_cy", "_c0").agg(
        F.sum(((row(a) > cy) != (row(b) > cy)).cast("int")).alias("_odd"))
    right = Window.partitionBy(*keys, "_cy").orderBy("_c0")
    starts = starts.select(*keys, "_cy", "_c0", F.lead("_c0").over(right).alias("_next"), F.sum("_odd").over(
        right.rowsBetween(1, Window.unboundedFollowing)).alias("_ends")).where("_ends % 2 = 1")
    marked = starts.select(*keys, "_cy", F.explode(F.sequence(F.col("_c0"), F.col("_next") - 1)).alias("_cx"),
                           F.lit(1).alias("_mark"))
    local = edges.withColumn("_cx", F.explode(F.sequence("_c0", "_c1"))).select(
        *keys, "_cy", "_cx", F.lit(0).alias("_mark"), F.struct(
            a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"),
            F.when(F.col("_pc") > F.col("_cx"), a["y"]).alias("ta"),
            F.when(F.col("_qc") > F.col("_cx"), b["y"]).alias("tb")).alias("_edge"))
    return (local.unionByName(marked, allowMissingColumns=True)
            .groupBy(*keys, F.struct(F.col("_cx").alias("cx"), F.col("_cy").alias("cy")).alias("_cell"))
            .agg(F.max("_mark").alias("_mark"), F.collect_list("_edge").alias("_edges")))


def in_cell(px: Column, py: Column, mark: Column, edges: Column) -> Column:
    """Whether a point of a cell is inside the polygon, by the cell's row of ``polygon_cells``."""

    def hits(e: Column) -> Column:
        straddles = (e["ay"] > py) != (e["by"] > py)
        xcross = F.try_divide((e["bx"] - e["ax"]) * (py - e["ay"]), e["by"] - e["ay"]) + e["ax"]
        return sum((F.when(c, F.lit(1)).otherwise(F.lit(0)) for c in (
            straddles & (px < xcross), e["ta"] > py, e["tb"] > py)), F.lit(0))

    return F.aggregate(edges, mark, lambda n, e: n + hits(e)) % 2 == 1


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, x: str = "x",
                       y: str = "y", ring: str = "ring", poly_keys=("poly_id",),
                       match: tuple = ()) -> DataFrame:
    """Pairs (point, polygon) with the point inside the polygon.

    Points go to their grid cell and meet the polygons' cells there (``polygon_cells``); each is
    tested against the edges in its cell only. A point has one cell, so no pair is produced
    twice, and no ring is carried past the index.
    """
    keys = list(dict.fromkeys([*match, *poly_keys]))
    pts = points.withColumn("_cell", cell_of(F.col(x), F.col(y), cell))
    j = pts.join(polygon_cells(polygons, keys, ring, cell), ["_cell", *match])
    return j.where(in_cell(F.col(x), F.col(y), F.col("_mark"), F.col("_edges"))).drop("_cell", "_mark", "_edges")


def clip_points(points: DataFrame, polygons: DataFrame, cell: float, by=("poly_id",), **kw) -> DataFrame:
    """Points inside the boundary polygons, counted per polygon key."""
    inside = points_in_polygons(points, polygons, cell, poly_keys=tuple(by), **kw)
    return inside.groupBy(*by).agg(F.count(F.lit(1)).alias("n_points"))


# --------------------------------------------------------------------------------------
# Clip segments to polygons
# --------------------------------------------------------------------------------------

def _cross(ax, ay, bx, by):
    return ax * by - ay * bx


def clip_segment(x0: Column, y0: Column, x1: Column, y1: Column, cells: Column, cell: float) -> Column:
    """Parameter intervals ``[a, b]`` (0..1 along the segment) of the pieces inside a polygon, whose
    rows of ``polygon_cells`` along the segment are ``cells`` (in any order, repeats included).

    Cut parameters are the proper crossings with the edges; between consecutive cuts
    the midpoint decides inside/outside. Returns ``ARRAY<STRUCT<a, b>>``.
    """
    dx, dy = x1 - x0, y1 - y0

    def cut(e: Column) -> Column:
        ex, ey = e["bx"] - e["ax"], e["by"] - e["ay"]
        den = _cross(dx, dy, ex, ey)
        wx, wy = e["ax"] - x0, e["ay"] - y0
        t = F.try_divide(_cross(wx, wy, ex, ey), den)
        s = F.try_divide(_cross(wx, wy, dx, dy), den)
        return F.when((den != 0) & (t > 0) & (t < 1) & (s >= 0) & (s <= 1), t)

    def inside(p: Column) -> Column:
        px, py = x0 + dx * (p["a"] + p["b"]) / 2, y0 + dy * (p["a"] + p["b"]) / 2
        at = cell_of(px, py, cell)
        return F.exists(cells, lambda c: (c["_cell"] == at) & in_cell(px, py, c["_mark"], c["_edges"]))

    cuts = F.filter(F.flatten(F.transform(cells, lambda c: F.transform(c["_edges"], cut))),
                    lambda t: t.isNotNull())
    ts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0)), cuts, F.array(F.lit(1.0)))))
    pieces = F.transform(F.sequence(F.lit(0), F.size(ts) - 2),
                         lambda k: F.struct(F.get(ts, k).alias("a"), F.get(ts, k + 1).alias("b")))
    return F.filter(pieces, lambda p: (p["b"] > p["a"]) & inside(p))


def clip_lines(segments: DataFrame, polygons: DataFrame, cell: float,
               seg_keys=("seg_id",), poly_keys=("poly_id",), ring: str = "ring",
               match: tuple = (), keep: tuple = ()) -> DataFrame:
    """Pieces of segments ``(x0, y0, x1, y1)`` inside polygons, with their length.

    Segments go to the cells along them (linear in their length) and meet the polygons' cells
    there; a (segment, polygon) pair collects the edges of those cells only, never a ring. Rows
    that repeat a segment are each clipped.
    """
    polys = polygon_cells(polygons, list(dict.fromkeys([*match, *poly_keys])), ring, cell)
    line = list(dict.fromkeys([*match, *seg_keys, "x0", "y0", "x1", "y1", *keep]))
    ends = [F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]
    segs = (segments.select(*line, F.posexplode(cells_along(*ends, 0.0, cell)).alias("_at", "_cell")))
    near = segs.join(polys, ["_cell", *match]).groupBy(
        *line, *[k for k in poly_keys if k not in line]).agg(
        F.collect_list(F.struct("_at", "_cell", "_mark", "_edges")).alias("_cells"))
    # a segment meets each of its cells once: entries of its first one are rows that repeat it
    first = F.array_min(F.transform("_cells", lambda c: c["_at"]))
    copies = F.size(F.filter("_cells", lambda c: c["_at"] == first))
    seg_len = F.sqrt((F.col("x1") - F.col("x0")) ** 2 + (F.col("y1") - F.col("y0")) ** 2)
    extra = [c for c in (*match, *keep) if c not in seg_keys and c not in poly_keys]
    out = near.select(*seg_keys, *poly_keys, *extra, seg_len.alias("seg_len"),
                      clip_segment(*ends, F.col("_cells"), cell).alias("pieces"), copies.alias("_n"))
    inside_len = F.aggregate("pieces", F.lit(0.0), lambda acc, p: acc + (p["b"] - p["a"]))
    return (out.withColumn("len_inside", inside_len * F.col("seg_len")).where(F.size("pieces") > 0)
            .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n"))


# --------------------------------------------------------------------------------------
# Snap points to the nearest segment within a tolerance
# --------------------------------------------------------------------------------------

SNAP_SHARDS = 4096          # groups that the tiles of a match key are dealt over
SNAP_ROWS = 100_000         # points, and segments, of a group; larger ones are split
SNAP_PAIRS = 1 << 15        # point-segment pairs measured in one array


def _project(px, py, x0, y0, x1, y1):
    """Parameter along the segments of the nearest place to the points, segment length, distance."""
    dx, dy = x1 - x0, y1 - y0
    l2 = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(l2 > 0, np.minimum(1.0, np.maximum(0.0, ((px - x0) * dx + (py - y0) * dy) / l2)), 0.0)
    ex, ey = px - (x0 + t * dx), py - (y0 + t * dy)
    return t, np.sqrt(l2), np.sqrt(ex * ex + ey * ey)


def nearest_segment(points: np.ndarray, segments: np.ndarray, max_m: float) -> np.ndarray:
    """Index of the nearest of ``segments`` (4, n) within ``max_m`` of each of ``points`` (2, m), the
    first of equals; -1 where there is none.

    Points are halved by place. With m the least distance from the middle of a half's box and r
    its half diagonal, all its points have a segment within m + r, and none that is over m + 2r
    from the middle can be nearest to any: a half goes on with the others only.
    """
    best = np.full(points.shape[1], -1)
    slack = 1e-12 * max(np.abs(points).max(initial=0.0), np.abs(segments).max(initial=0.0))
    todo = [(np.arange(points.shape[1]), np.arange(segments.shape[1]))]
    while todo:
        p, s = todo.pop()
        xy, lines = points[:, p], segments[:, s]
        if len(p) > 1 and len(p) * len(s) > SNAP_PAIRS:
            lo, hi = xy.min(axis=1), xy.max(axis=1)
            r = float(np.hypot(*(hi - lo))) / 2
            d = _project(*((lo + hi) / 2), *lines)[2]
            least = d.min()
            s = s[d <= min(least + 2 * r, max_m + r) + slack + 1e-9 * (least + r)]
            half = np.argpartition(xy[int(np.argmax(hi - lo))], len(p) // 2)
            todo += [(p[h], s) for h in (half[:len(p) // 2], half[len(p) // 2:]) if len(s)]
        elif len(p) and len(s):
            d = _project(*xy[:, :, None], *lines[:, None, :])[2]
            at = d.argmin(axis=1)
            best[p] = np.where(d[np.arange(len(p)), at] <= max_m, s[at], -1)
    return best


def _shards(cells: Column) -> Column:
    return F.array_distinct(F.transform(cells, lambda c: F.pmod(F.xxhash64(c["cx"], c["cy"]), F.lit(SNAP_SHARDS))))


def _split_groups(points: DataFrame, segments: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_pp`` and ``_sp``: of a group with over SNAP_ROWS points or segments, every part
    of the points meets every part of the segments."""
    def parts(c: str) -> Column:
        return F.ceil(F.sum(c) / SNAP_ROWS)

    rows = points.select(*group, F.lit(1).alias("p"), F.lit(0).alias("s")).unionByName(
        segments.select(*group, F.lit(0).alias("p"), F.lit(1).alias("s")))
    large = F.broadcast(rows.groupBy(*group).agg(parts("p").alias("_np"), parts("s").alias("_ns"))
                        .where("_np > 0 AND _ns > 0 AND _np + _ns > 2"))     # at most one per SNAP_ROWS rows

    def dealt(df: DataFrame, own: str, n_own: str, other: str, n_other: str, place: list[str]) -> DataFrame:
        return (df.join(large, group, "left")
                .withColumn(own, F.pmod(F.xxhash64(*place), F.coalesce(n_own, F.lit(1))))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(n_other, F.lit(1)) - 1)))
                .drop("_np", "_ns"))

    return (dealt(points, "_pp", "_np", "_sp", "_ns", ["_px", "_py"]),
            dealt(segments, "_sp", "_ns", "_pp", "_np", ["x0", "y0", "x1", "y1"]))


def snap_points(points: DataFrame, segments: DataFrame, max_m: float = 200.0,
                cell: float | None = None, point_keys=("point_id",), seg_keys=("seg_id",),
                x: str = "x", y: str = "y", match: tuple = ()) -> DataFrame:
    """Nearest segment ``(x0, y0, x1, y1)`` within ``max_m`` of each point, with the
    projection parameter ``t`` (0..1), the offset along the segment and the distance.

    Segments go once to every group of tiles along them that hold a point within ``max_m``
    (``cells_along``), places of points to the group of their own tile; a group finds the nearest
    segment of all its places at once (``nearest_segment``), so no point-segment pair is ever a
    row. Ties go to the smaller key. Points with no segment in range are absent.
    """
    tile = max(cell or 1.0, 4 * max_m)
    ends, place = ["x0", "y0", "x1", "y1"], ["_px", "_py"]
    group = [*match, "_shard"]

    def finite(df: DataFrame, cols: list[str]) -> DataFrame:
        return df.where(reduce(Column.__and__, [F.abs(c) < float("inf") for c in cols])).dropna(subset=list(match) or cols)

    # equal segments (the smallest key stands for them) and equal places are measured once
    segs = (finite(segments.select(*dict.fromkeys([*match, *seg_keys]), *[F.col(c).cast("double").alias(c) for c in ends]), ends)
            .groupBy(*match, *ends).agg(F.min(F.struct(*[F.col(k) for k in seg_keys])).alias("_k"))
            .select(*match, *ends, *[F.col("_k")[k].alias(f"_k{i}") for i, k in enumerate(seg_keys)])
            .withColumn("_shard", F.explode(_shards(cells_along(*[F.col(c) for c in ends], max_m, tile)))))
    pts = finite(points.select(*dict.fromkeys([*match, *point_keys]), F.col(x).cast("double").alias("_px"),
                               F.col(y).cast("double").alias("_py")), place)
    places = pts.select(*match, *place).distinct().withColumn(
        "_shard", F.get(_shards(F.array(cell_of(F.col("_px"), F.col("_py"), tile))), 0))
    places, segs = _split_groups(places, segs, group)
    group += ["_pp", "_sp"]
    # names of their own: both sides may have the match columns from one frame
    segs = segs.withColumnsRenamed({c: f"_g{c}" for c in group})
    keys = [f"_k{i}" for i in range(len(seg_keys))]

    def nearest(near: pa.Table, lines: pa.Table) -> pa.Table:
        if near.num_rows and lines.num_rows:
            lines = lines.take(pc.sort_indices(lines, [(k, "ascending") for k in keys], null_placement="at_start"))
        xy, line = (np.array([t[c].to_numpy() for c in cols]).reshape(len(cols), -1)
                    for t, cols in ((near, place), (lines, ends)))
        best = nearest_segment(xy, line, max_m)
        xy, found, line = xy[:, best >= 0], best[best >= 0], line[:, best[best >= 0]]
        t, length, dist = _project(*xy, *line)
        near, lines = near.filter(pa.array(best >= 0)), lines.take(pa.array(found))
        return pa.table({**{c: near[c] for c in (*match, *place)}, **{k: lines[k] for k in keys},
                         "t": t, "offset": t * length, "dist": dist})

    kinds = {f.name: f.dataType.simpleString() for df in (places, segs) for f in df.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*match, *place, *keys)) + ", t double, offset double, dist double"
    snapped = places.groupBy(*group).cogroup(segs.groupBy(*[f"_g{c}" for c in group])).applyInArrow(nearest, schema)
    out = list(dict.fromkeys([*match, *point_keys]))
    best = pts.join(snapped, [*match, *place]).groupBy(*out).agg(F.min_by(
        F.struct(*[F.col(c).alias(k) for c, k in zip(keys, seg_keys)], "t", "offset", "dist"),
        F.struct("dist", *keys)).alias("_b"))
    return best.select(*out, "_b.*")


def rect_ring(x0: float, y0: float, x1: float, y1: float) -> list[tuple[float, float]]:
    """Axis-parallel rectangle as a ring (counter-clockwise)."""
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def ring_literal(points: list[tuple[float, float]]) -> Column:
    return F.array(*[F.struct(F.lit(float(px)).alias("x"), F.lit(float(py)).alias("y"))
                     for px, py in points])


"""Road-network coverage for every city x month from raw layers.

Inputs (planar metres for roads and towns, lon/lat or metres for stations):

* roads    ``(city, road_id, ROADCLASS1, path ARRAY<STRUCT<x, y>>)``
* towns    ``(city, TOWNID, TOWNNAME, ring ARRAY<STRUCT<x, y>>)``, one row per ring
* stations ``(city, month, station_id, lon, lat)`` (or ``x``, ``y`` with ``project=False``)

Steps, all keyed by city (and month for stations), in one Spark job graph:
S7 drop highways -> road segments -> N3 clip to towns -> N4 edges (nodes = piece end points
rounded to ``node_precision``) -> N1 project stations -> N2 keep stations inside the city ->
J14 snap to the nearest edge within ``snap_m`` -> stations enter the search at both ends of
their edge with their offsets -> N5 distances up to the largest threshold -> N6/N7 covered
intervals (stations on an edge also cover around themselves) -> N8 lengths by town -> N9 bands.

Duplicate pieces (same town and end points) are counted in the total but covered once;
the clamp in N9 keeps covered <= total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import network, spatial
from .util import cut_lineage
from .windows import first_wins_dedup

CITY, MONTH = "city", "month"


def road_segments(roads: DataFrame, keys: Sequence[str] = (CITY,), road_id: str = "road_id",
                  path: str = "path") -> DataFrame:
    """Consecutive vertex pairs of every polyline ``(keys, road_id, i, x0, y0, x1, y1)``,
    built from the array in place (no shuffle, no window)."""
    n = F.size(path)
    pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(
        i.alias("i"), F.get(path, i)["x"].alias("x0"), F.get(path, i)["y"].alias("y0"),
        F.get(path, i + 1)["x"].alias("x1"), F.get(path, i + 1)["y"].alias("y1"))))
    return roads.select(*keys, road_id, F.explode(pairs).alias("_s")).select(*keys, road_id, "_s.*")


def town_edges(roads: DataFrame, towns: DataFrame, cell: float = 500.0,
               node_precision: int = 3, drop_classes: Sequence[str] = ("HW",)) -> DataFrame:
    """S7 + N3 + N4: road pieces inside towns as edges
    ``(city, edge_id, u, v, len_m, TOWNID, x0, y0, x1, y1)``."""
    r = roads
    if "ROADCLASS1" in roads.columns:
        r = roads.where(F.col("ROADCLASS1").isNull() | ~F.col("ROADCLASS1").isin(list(drop_classes)))
    segs = road_segments(r)
    parts = spatial.clip_lines(segs, town_parts(towns), cell,
                               seg_keys=(CITY, "road_id", "i"), poly_keys=("TOWNID", "part"),
                               match=(CITY,), keep=("x0", "y0", "x1", "y1"))
    # even-odd over all rings of a town: the cut points in order bound its pieces in turn
    cuts = F.array_sort(F.flatten(F.collect_list(F.flatten(F.transform(
        "pieces", lambda p: F.array(p["a"], p["b"]))))))
    line = [CITY, "road_id", "i", "TOWNID", "x0", "y0", "x1", "y1", "seg_len"]
    clipped = (parts.groupBy(*line).agg(cuts.alias("t"))
               .withColumn("pieces", F.filter(F.transform(
                   F.sequence(F.lit(0), (F.size("t") / 2).cast("int") - 1),
                   lambda k: F.struct(F.get("t", 2 * k).alias("a"), F.get("t", 2 * k + 1).alias("b"))),
                   lambda p: p["b"] > p["a"])))
    pieces = clipped.select(CITY, "road_id", "i", "TOWNID", "x0", "y0", "x1", "y1", "seg_len",
                            F.posexplode("pieces").alias("k", "p"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    ax = F.col("x0") + dx * F.col("p.a")
    ay = F.col("y0") + dy * F.col("p.a")
    bx = F.col("x0") + dx * F.col("p.b")
    by = F.col("y0") + dy * F.col("p.b")

    def node(x, y):
        return F.struct(F.round(x, node_precision).alias("x"), F.round(y, node_precision).alias("y"))

    edges = pieces.select(
        CITY, "TOWNID",
        F.concat_ws(":", F.col("road_id").cast("string"), F.col("i").cast("string"),
                    F.col("TOWNID").cast("string"), F.col("k").cast("string")).alias("edge_id"),
        node(ax, ay).alias("u"), node(bx, by).alias("v"),
        ((F.col("p.b") - F.col("p.a")) * F.col("seg_len")).alias("len_m"),
        ax.alias("x0"), ay.alias("y0"), bx.alias("x1"), by.alias("y1"),
        "road_id", "i", F.col("p.a").alias("t0"))
    return edges.where((F.col("len_m") > 0) & (F.col("u") != F.col("v")))


def town_parts(towns: DataFrame) -> DataFrame:
    """``(city, TOWNID, part, ring)``: a town's boundary is the even-odd union of its rings,
    one row each (separate parts, and holes inside a part)."""
    return towns.select(CITY, "TOWNID", F.xxhash64("ring").alias("part"), "ring").distinct()


def station_points(stations: DataFrame, towns: DataFrame, project: bool = True,
                   cell: float = 500.0) -> DataFrame:
    """N1 + N2: stations in metres, kept when inside some town of their city.

    Places are located once, however many months and stations share them. A station listed
    with two places is at both.
    """
    if project:
        x, y = spatial.project_tm2(F.col("lon"), F.col("lat"))
        pts = stations.select(CITY, MONTH, "station_id", x.alias("x"), y.alias("y"))
    else:
        pts = stations.select(CITY, MONTH, "station_id", "x", "y")
    places = pts.select(CITY, "x", "y").distinct()
    hits = spatial.points_in_polygons(places, town_parts(towns), cell,
                                      poly_keys=("TOWNID", "part"), match=(CITY,))
    inside = (hits.groupBy(CITY, "x", "y", "TOWNID").agg(F.count(F.lit(1)).alias("rings"))
              .where(F.col("rings") % 2 == 1).select(CITY, "x", "y").distinct())
    return pts.distinct().join(inside, [CITY, "x", "y"], "left_semi").select(
        CITY, MONTH, "station_id", "x", "y")


def road_chains(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contract runs of pieces joined at degree-2 vertices into chains.

    Pieces are ordered along their road by (segment, start parameter); a new chain starts at
    the first piece of a road, after a gap (a dropped duplicate), and at any piece whose
    start vertex has degree other than 2 in the whole graph (a junction or a dead end).
    Returns ``(pieces with chain_id and off_u - the distance of their start from the chain
    start -, chains (city, chain_id, start, end, L))``, both materialised. Windows run per road, so their size
    is bounded by the road's vertex count.
    """
    ends = pieces.select(CITY, F.col("u").alias("node")).unionByName(
        pieces.select(CITY, F.col("v").alias("node")))
    deg = ends.groupBy(CITY, "node").agg(F.count(F.lit(1)).alias("_deg"))
    w = Window.partitionBy(CITY, "road_id").orderBy("i", "t0")
    p = pieces.join(deg.withColumnRenamed("node", "u"), [CITY, "u"], "left")
    prev_v = F.lag("v").over(w)
    brk = (prev_v.isNull() | (prev_v != F.col("u")) | (F.col("_deg") != 2)).cast("int")
    p = p.withColumn("_brk", brk).withColumn(
        "_chain", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    wc = Window.partitionBy(CITY, "road_id", "_chain").orderBy("i", "t0")
    p = (p.withColumn("off_u", F.sum("len_m").over(wc.rowsBetween(Window.unboundedPreceding,
                                                                    Window.currentRow)) - F.col("len_m"))
         .withColumn("chain_id", F.concat_ws("#", F.col("road_id").cast("string"),
                                             F.col("_chain").cast("string"))))
    # What follows reads both several times: the windows above run once.
    p = cut_lineage(p.drop("_deg", "_brk", "_chain"))
    order = F.struct("i", "t0")
    chains = p.groupBy(CITY, "chain_id").agg(F.min_by("u", order).alias("start"),
                                             F.max_by("v", order).alias("end"),
                                             F.sum("len_m").alias("L"))
    return p, cut_lineage(chains)


def contracted_ends(pieces: DataFrame, on_edge: DataFrame, max_d: float) -> DataFrame:
    """Exact end distances ``(city, month, edge_id, L, d_u, d_v)`` of every piece, from a
    search over the chain graph only.

    Inside a chain every vertex has degree 2, so a point at chain position x is reached
    either through the chain's start (``d_start + x``), its end (``d_end + L - x``) or from a
    station on the same chain (``|x - s|``, nearest station on either side by a window
    over the chain's positions - no station x piece pairs). The search therefore needs only
    as many rounds as junction hops, not vertex hops.
    """
    p, chains = road_chains(pieces)
    p = p.select(CITY, "edge_id", "chain_id", "off_u", "len_m")
    st = (on_edge.join(p, [CITY, "edge_id"])
          .select(CITY, MONTH, "chain_id", (F.col("off_u") + F.col("offset")).alias("pos"))
          .join(chains, [CITY, "chain_id"]))
    sources = (st.select(CITY, MONTH, F.col("start").alias("node"), F.col("pos").alias("d0"))
               .unionByName(st.select(CITY, MONTH, F.col("end").alias("node"),
                                      (F.col("L") - F.col("pos")).alias("d0"))))
    cedges = chains.select(CITY, F.col("chain_id").alias("edge_id"), F.col("start").alias("u"),
                           F.col("end").alias("v"), F.col("L").alias("len_m"))
    dist = network.network_distance(cedges, sources, [CITY], [MONTH], max_d, d0="d0")
    ds = dist.select(CITY, MONTH, F.col("node").alias("start"), F.col("d").alias("_ds"))
    de = dist.select(CITY, MONTH, F.col("node").alias("end"), F.col("d").alias("_de"))
    cend = (chains.join(ds, [CITY, "start"]).select(CITY, MONTH, "chain_id", "L", "_ds",
                                                    F.lit(None).cast("double").alias("_de"))
            .unionByName(chains.join(de, [CITY, "end"]).select(
                CITY, MONTH, "chain_id", "L", F.lit(None).cast("double").alias("_ds"), "_de"))
            .groupBy(CITY, MONTH, "chain_id").agg(F.first("L").alias("_L"), F.min("_ds").alias("_ds"),
                                                  F.min("_de").alias("_de")))
    via_ends = (p.join(cend, [CITY, "chain_id"])
                .select(CITY, MONTH, "edge_id", "len_m",
                        F.least(F.col("_ds") + F.col("off_u"),
                                F.col("_de") + (F.col("_L") - F.col("off_u"))).alias("d_u"),
                        F.least(F.col("_ds") + F.col("off_u") + F.col("len_m"),
                                F.col("_de") + (F.col("_L") - F.col("off_u") - F.col("len_m"))).alias("d_v")))
    # stations inside a chain reach its pieces directly
    st_chains = st.select(CITY, MONTH, "chain_id").distinct()
    pts = p.join(st_chains, [CITY, "chain_id"])
    elems = (pts.select(CITY, MONTH, "chain_id", "edge_id", F.lit("u").alias("end_"),
                        F.col("off_u").alias("pos"), F.lit(None).cast("double").alias("_s"))
             .unionByName(pts.select(CITY, MONTH, "chain_id", "edge_id", F.lit("v").alias("end_"),
                                     (F.col("off_u") + F.col("len_m")).alias("pos"),
                                     F.lit(None).cast("double").alias("_s")))
             .unionByName(st.select(CITY, MONTH, "chain_id", F.lit(None).cast("string").alias("edge_id"),
                                    F.lit(None).cast("string").alias("end_"), "pos",
                                    F.col("pos").alias("_s"))))
    wpos = Window.partitionBy(CITY, MONTH, "chain_id").orderBy("pos")
    left = F.last("_s", ignorenulls=True).over(wpos.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    right = F.first("_s", ignorenulls=True).over(wpos.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    near = (elems.withColumn("_near", F.least(F.col("pos") - left, right - F.col("pos")))
            .where(F.col("edge_id").isNotNull())
            .groupBy(CITY, MONTH, "edge_id")
            .agg(F.min(F.when(F.col("end_") == "u", F.col("_near"))).alias("d_u"),
                 F.min(F.when(F.col("end_") == "v", F.col("_near"))).alias("d_v")))
    lengths = p.select(CITY, "edge_id", "len_m")
    ends = (via_ends.drop("len_m").unionByName(near)
            .groupBy(CITY, MONTH, "edge_id").agg(F.min("d_u").alias("d_u"), F.min("d_v").alias("d_v"))
            .join(lengths, [CITY, "edge_id"])
            .withColumnRenamed("len_m", "L"))
    return ends.where((F.col("d_u") <= max_d) | (F.col("d_v") <= max_d))


def coverage_panel(roads: DataFrame, towns: DataFrame, stations: DataFrame,
                   thresholds: Sequence[float] = network.THRESHOLDS, snap_m: float = 200.0,
                   project: bool = True, cell: float = 500.0, emit_empty: bool = False,
                   digits_len: int = 1, digits_pct: int = 2, contract: bool = True) -> DataFrame:
    """Coverage by (city, month, town): total and banded road length and reach %.

    Every town of the city, with or without roads, has a row for each city-month with a
    station inside the city, whether or not one is near a road. City-months without such a
    station give no rows unless ``emit_empty``, in which case every town of every city-month in
    ``stations`` appears. A town's boundary may have several rings, one row each.
    """
    # The clipped edges feed the snap, the search, the coverage and the totals: computed once.
    edges = cut_lineage(town_edges(roads, towns, cell))
    # Covered once: one representative per duplicated piece (same town and end points);
    # stations snap to representatives only, totals count every piece.
    # A piece drawn in the other direction is the same piece; the smallest edge id stands for it.
    ends_of = edges.withColumn("_p", F.least("u", "v")).withColumn("_q", F.greatest("u", "v"))
    uniq = cut_lineage(first_wins_dedup(ends_of, [CITY, "TOWNID", "_p", "_q"], ["edge_id"]).drop("_p", "_q"))
    pts = cut_lineage(station_points(stations, towns, project, cell))
    seg = uniq.select(CITY, F.col("edge_id").alias("seg_id"), "x0", "y0", "x1", "y1")
    places = pts.select(CITY, "x", "y").distinct().withColumn("px", F.col("x")).withColumn("py", F.col("y"))
    snapped = spatial.snap_points(places, seg, max_m=snap_m, cell=max(snap_m, 1.0),
                                  point_keys=("px", "py"), seg_keys=("seg_id",), match=(CITY,))
    snapped = snapped.withColumnsRenamed({"px": "x", "py": "y", "seg_id": "edge_id"})
    on_edge = cut_lineage(pts.join(snapped, [CITY, "x", "y"]))
    max_d = float(max(thresholds))
    stations_on = on_edge.select(CITY, MONTH, "edge_id", "offset")
    if contract:
        ends_d = contracted_ends(uniq, stations_on, max_d)
        raw = network.intervals_from_ends(
            ends_d, [CITY, MONTH], thresholds, on_edge=stations_on,
            lengths=uniq.select(CITY, "edge_id", F.col("len_m").alias("L")), graph_keys=[CITY])
        merged = network.merge_intervals(raw, [CITY, MONTH, "edge_id", "D"])
        cov = merged.groupBy(CITY, MONTH, "edge_id", "D").agg(
            F.sum(F.col("to_m") - F.col("from_m")).alias("covered_m"))
    else:
        ends = on_edge.join(uniq.select(CITY, "edge_id", "u", "v", "len_m"), [CITY, "edge_id"])
        sources = (ends.select(CITY, MONTH, F.col("u").alias("node"), F.col("offset").alias("d0"))
                   .unionByName(ends.select(CITY, MONTH, F.col("v").alias("node"),
                                            (F.col("len_m") - F.col("offset")).alias("d0"))))
        dist = network.network_distance(uniq, sources, [CITY], [MONTH], max_d,
                                        d0="d0")
        cov = network.covered_length(uniq, dist, [CITY], [MONTH], thresholds, on_edge=stations_on)
    keys = (stations if emit_empty else pts).select(CITY, MONTH).distinct()
    names = towns.groupBy(CITY, "TOWNID").agg(F.min("TOWNNAME").alias("TOWNNAME"))
    by_town = network.length_by_region(edges, cov, [CITY], [MONTH], keys, town="TOWNID",
                                       thresholds=thresholds, regions=names.select(CITY, "TOWNID"))
    out = network.coverage_bands(by_town, thresholds, digits_len=digits_len, digits_pct=digits_pct)
    return out.join(names, [CITY, "TOWNID"], "left")

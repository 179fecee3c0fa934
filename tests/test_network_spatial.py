import heapq
import math
import random

import numpy as np

import pytest
from pyspark.sql import functions as F

from paneljet.operators import network, spatial


def dijkstra(n_nodes, edges, sources, max_cost):
    adj = {i: [] for i in range(n_nodes)}
    for u, v, w in edges:
        adj[u].append((v, w))
        adj[v].append((u, w))
    dist = {}
    pq = [(0.0, s) for s in sources]
    while pq:
        d, x = heapq.heappop(pq)
        if x in dist or d > max_cost:
            continue
        dist[x] = d
        for y, w in adj[x]:
            if y not in dist and d + w <= max_cost:
                heapq.heappush(pq, (d + w, y))
    return dist


def random_graph(rnd, n=30, m=45):
    edges = set()
    while len(edges) < m:
        u, v = rnd.randrange(n), rnd.randrange(n)
        if u != v:
            edges.add((min(u, v), max(u, v), float(rnd.randint(50, 700))))
    return sorted(edges)


def test_network_distance_equals_dijkstra(spark):
    rnd = random.Random(11)
    for trial in range(2):
        edges = random_graph(rnd)
        e = spark.createDataFrame([("c", u, v, w, f"{u}-{v}") for u, v, w in edges],
                                  "city string, u long, v long, len_m double, edge_id string")
        srcs = {m: rnd.sample(range(30), 2) for m in (1, 2)}
        s = spark.createDataFrame([("c", m, x) for m, xs in srcs.items() for x in xs],
                                  "city string, month int, node long")
        dist = network.network_distance(e, s, ["city"], ["month"], 1500.0)
        got = {(r["month"], r["node"]): r["d"] for r in dist.collect()}
        want = {(m, x): d for m, xs in srcs.items() for x, d in dijkstra(30, edges, xs, 1500.0).items()}
        assert got == pytest.approx(want)


def sampled_cover(L, du, dv, D, stations=(), step=0.01):
    n = int(round(L / step))
    hit = 0
    for i in range(n):
        p = (i + 0.5) * step
        best = min([du + p if du is not None else math.inf, dv + (L - p) if dv is not None else math.inf]
                   + [abs(p - s) for s in stations])
        hit += best <= D
    return hit * step


def test_covered_length_closed_form_vs_sampling(spark):
    rnd = random.Random(5)
    cases = []
    for i in range(25):
        L = float(rnd.randint(100, 1200))
        du = rnd.choice([None, float(rnd.randint(0, 1400))])
        dv = rnd.choice([None, float(rnd.randint(0, 1400))])
        st = [float(rnd.randint(0, int(L)))] if i % 3 == 0 else []
        cases.append((f"e{i}", L, du, dv, st))
    edges = spark.createDataFrame([(c[0], f"u{c[0]}", f"v{c[0]}", c[1]) for c in cases],
                                  "edge_id string, u string, v string, len_m double")
    drows = [(1, f"u{c[0]}", c[2]) for c in cases if c[2] is not None] + \
            [(1, f"v{c[0]}", c[3]) for c in cases if c[3] is not None]
    dist = spark.createDataFrame(drows, "m int, node string, d double")
    on_edge = spark.createDataFrame([(1, c[0], s) for c in cases for s in c[4]],
                                    "m int, edge_id string, offset double")
    cov = network.covered_length(edges, dist, [], ["m"], on_edge=on_edge)
    got = {(r["edge_id"], r["D"]): r["covered_m"] for r in cov.collect()}
    for eid, L, du, dv, st in cases:
        prev = 0.0
        for D in (500.0, 1000.0, 1500.0):
            val = got.get((eid, D), 0.0)
            assert val <= L + 1e-9 and val >= prev - 1e-9           # <= L and monotone in D
            assert val == pytest.approx(sampled_cover(L, du, dv, D, st), abs=0.05)
            prev = val
            if not st:
                a = max(0.0, D - du) if du is not None else 0.0
                b = max(0.0, D - dv) if dv is not None else 0.0
                assert val == pytest.approx(min(L, a + b))


def test_coverage_bands(spark):
    df = spark.createDataFrame([(1000.0, 200.0, 900.0, 1200.0), (0.0, 0.0, 0.0, 0.0)],
                               "len_total_m double, cum_500 double, cum_1000 double, cum_1500 double")
    out = network.coverage_bands(df).collect()
    r = out[0]
    assert (r["len_0_500_m"], r["len_500_1000_m"], r["len_1000_1500_m"], r["len_gt1500_m"]) == (200.0, 700.0, 100.0, 0.0)
    assert (r["reach500_pct"], r["reach1k_pct"], r["reach1500_pct"]) == (20.0, 90.0, 100.0)
    assert out[1]["reach500_pct"] == 0.0


def test_road_edges_shared_vertices(spark):
    lines = spark.createDataFrame(
        [("c", 1, [(0.0, 0.0), (3.0, 4.0), (3.0, 4.0), (6.0, 8.0)]), ("c", 2, [(3.0, 4.0), (3.0, 10.0)])],
        "city string, road_id long, path array<struct<x: double, y: double>>")
    e = network.road_edges(lines, ["city"], "road_id")
    assert e.count() == 3                                         # zero-length piece dropped
    assert sorted(r["len_m"] for r in e.collect()) == [5.0, 5.0, 6.0]
    shared = e.where(F.col("u") == F.struct(F.lit(3.0).alias("x"), F.lit(4.0).alias("y"))).count()
    assert shared == 2


def test_point_in_concave_polygon(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 2), (0, 4)]
    poly = spark.createDataFrame([("P", [(float(x), float(y)) for x, y in ring])],
                                 "poly_id string, ring array<struct<x: double, y: double>>")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 3.0), (3, 3.5, 3.0), (4, 5.0, 1.0)],
                                "id int, x double, y double")
    inside = spatial.points_in_polygons(pts, poly, cell=1.0)
    assert sorted(r["id"] for r in inside.collect()) == [1, 3]


def test_clip_segment_rectangle(spark):
    poly = spark.createDataFrame([("R", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])],
                                 "poly_id string, ring array<struct<x: double, y: double>>")
    segs = spark.createDataFrame([(1, -5.0, 5.0, 15.0, 5.0), (2, 1.0, 1.0, 2.0, 2.0), (3, 20.0, 0.0, 30.0, 0.0),
                                  (4, -5.0, -5.0, 15.0, 15.0)],
                                 "seg_id int, x0 double, y0 double, x1 double, y1 double")
    out = {r["seg_id"]: r["len_inside"] for r in spatial.clip_lines(segs, poly, 4.0).collect()}
    assert out[1] == pytest.approx(10.0)
    assert out[2] == pytest.approx(math.sqrt(2))
    assert 3 not in out
    assert out[4] == pytest.approx(math.sqrt(200))


def test_snap_points(spark):
    segs = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 0.0), (2, 0.0, 10.0, 100.0, 10.0)],
                                 "seg_id int, x0 double, y0 double, x1 double, y1 double")
    pts = spark.createDataFrame([(1, 50.0, 3.0), (2, 50.0, 5.0), (3, 500.0, 0.0), (4, -10.0, 0.0)],
                                "point_id int, x double, y double")
    out = {r["point_id"]: r for r in spatial.snap_points(pts, segs, max_m=20.0).collect()}
    assert out[1]["seg_id"] == 1 and out[1]["offset"] == pytest.approx(50.0) and out[1]["dist"] == pytest.approx(3.0)
    assert out[2]["seg_id"] == 1                                   # tie -> smaller key
    assert 3 not in out
    assert out[4]["t"] == 0.0 and out[4]["dist"] == pytest.approx(10.0)


def test_tm2_projection(spark):
    df = spark.createDataFrame([(121.0, 23.5), (121.0, 0.0), (120.5, 23.5), (121.5, 23.5)], "lon double, lat double")
    x, y = spatial.project_tm2(F.col("lon"), F.col("lat"))
    r = df.select(x.alias("x"), y.alias("y")).collect()
    assert r[0]["x"] == pytest.approx(250000.0) and r[1]["y"] == pytest.approx(0.0, abs=1e-6)
    assert r[2]["y"] == pytest.approx(r[3]["y"]) and r[2]["x"] + r[3]["x"] == pytest.approx(500000.0)
    assert 2.59e6 < r[0]["y"] < 2.61e6                       # 23.5N is about 2,600 km north


def test_two_stations_on_one_edge_and_threshold_at_node(spark):
    edges = spark.createDataFrame([("e1", "a", "b", 1000.0), ("e2", "b", "c", 400.0)],
                                  "edge_id string, u string, v string, len_m double")
    # two stations on e1 at 100 and 300: overlapping reach counted once
    on_edge = spark.createDataFrame([(1, "e1", 100.0), (1, "e1", 300.0)], "m int, edge_id string, offset double")
    src = spark.createDataFrame([(1, "a", 100.0), (1, "b", 900.0), (1, "a", 300.0), (1, "b", 700.0)],
                                "m int, node string, d0 double")
    dist = network.network_distance(edges, src, [], ["m"], 1500.0, d0="d0")
    got_d = {r["node"]: r["d"] for r in dist.collect()}
    assert got_d == {"a": 100.0, "b": 700.0, "c": 1100.0}
    cov = {(r["edge_id"], r["D"]): r["covered_m"]
           for r in network.covered_length(edges, dist, [], ["m"], on_edge=on_edge).collect()}
    assert cov[("e1", 500.0)] == pytest.approx(800.0)        # [0, 800]
    assert cov[("e1", 1000.0)] == pytest.approx(1000.0)
    assert ("e2", 500.0) not in cov                          # b is at 700 > 500
    assert cov[("e2", 1000.0)] == pytest.approx(300.0)
    # threshold equal to a node's distance: c is at exactly 1100, nothing beyond it at D=1100
    cov2 = {(r["edge_id"], r["D"]): r["covered_m"] for r in
            network.covered_length(edges, dist, [], ["m"], thresholds=(1100.0,), on_edge=on_edge).collect()}
    assert cov2[("e2", 1100.0)] == pytest.approx(400.0)


def test_identical_source_sets_share_one_search(spark):
    rnd = random.Random(12)
    edges = random_graph(rnd)
    e = spark.createDataFrame([("c", u, v, w) for u, v, w in edges], "city string, u long, v long, len_m double")
    sets = {1: [3, 7], 2: [7, 3], 3: [5], 4: [3, 7], 5: [5, 6]}
    s = spark.createDataFrame([("c", m, x) for m, xs in sets.items() for x in xs], "city string, month int, node long")
    shared = network.network_distance(e, s, ["city"], ["month"], 1500.0)
    alone = network.network_distance(e, s, ["city"], ["month"], 1500.0, share_identical=False)
    key = lambda r: (r["month"], r["node"])
    assert sorted((key(r), r["d"]) for r in shared.collect()) == sorted((key(r), r["d"]) for r in alone.collect())
    _, key_map = network.share_identical_sources(s.withColumn("d0", F.lit(0.0)), ["city"], ["month"])
    reps = {r["month"]: r["rep_month"] for r in key_map.collect()}
    assert reps[1] == reps[2] == reps[4] == 1 and reps[3] == 3 and reps[5] == 5


def _star_polygon(rnd, cx, cy, n=9):
    """Random star-shaped (generally concave) polygon around (cx, cy)."""
    import math as m

    angles = sorted(rnd.uniform(0, 2 * m.pi) for _ in range(n))
    return [(cx + rnd.uniform(2, 10) * m.cos(a), cy + rnd.uniform(2, 10) * m.sin(a)) for a in angles]


def _inside(px, py, ring):
    hit = False
    for i in range(len(ring)):
        (ax, ay), (bx, by) = ring[i], ring[(i + 1) % len(ring)]
        if (ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def test_random_concave_polygons_points_and_clipping(spark):
    rnd = random.Random(33)
    polys = {f"P{k}": _star_polygon(rnd, rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for k in range(4)}
    pdf = spark.createDataFrame([(k, r) for k, r in polys.items()],
                                "poly_id string, ring array<struct<x: double, y: double>>")
    pts = [(i, rnd.uniform(-15, 15), rnd.uniform(-15, 15)) for i in range(300)]
    got = {(r["id"], r["poly_id"]) for r in spatial.points_in_polygons(
        spark.createDataFrame(pts, "id int, x double, y double"), pdf, cell=3.0).collect()}
    want = {(i, k) for i, x, y in pts for k, ring in polys.items() if _inside(x, y, ring)}
    assert got == want and len(want) > 20
    segs = [(i, rnd.uniform(-15, 15), rnd.uniform(-15, 15), rnd.uniform(-15, 15), rnd.uniform(-15, 15))
            for i in range(40)]
    clip = {(r["seg_id"], r["poly_id"]): r["len_inside"] for r in spatial.clip_lines(
        spark.createDataFrame(segs, "seg_id int, x0 double, y0 double, x1 double, y1 double"), pdf, 4.0).collect()}
    steps = 4000
    for i, x0, y0, x1, y1 in segs:
        L = ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5
        for k, ring in polys.items():
            frac = sum(_inside(x0 + (x1 - x0) * (j + 0.5) / steps, y0 + (y1 - y0) * (j + 0.5) / steps, ring)
                       for j in range(steps)) / steps
            assert clip.get((i, k), 0.0) == pytest.approx(frac * L, abs=L * 2 / steps + 1e-9), (i, k)


def test_cell_index_equals_the_ring_test_on_grid_lines(spark):
    """Rings and points on cell borders, horizontal and repeated vertices, holes, tiny and large cells."""
    rnd = random.Random(7)
    rings = {f"G{k}": [(float(rnd.randint(-6, 6)), float(rnd.randint(-6, 6))) for _ in range(rnd.randint(1, 12))]
             for k in range(12)}                                   # self-crossing rings on whole numbers
    rings["box"] = [(-4.0, -4.0), (4.0, -4.0), (4.0, 4.0), (-4.0, 4.0), (-4.0, -4.0)]
    polys = spark.createDataFrame([*rings.items(), ("none", []), ("null", None)],
                                  "poly_id string, ring array<struct<x: double, y: double>>")
    pts = [(i * 100 + j, (i - 14) / 2, (j - 14) / 2) for i in range(29) for j in range(29)]
    pts += [(10000 + k, rnd.uniform(-7, 7), rnd.uniform(-7, 7)) for k in range(300)]
    pdf = spark.createDataFrame(pts, "id int, x double, y double")
    want = {(i, k) for i, x, y in pts for k, ring in rings.items() if _inside(x, y, ring)}
    for cell in (0.7, 1.0, 2.0, 50.0):
        got = [(r["id"], r["poly_id"]) for r in spatial.points_in_polygons(pdf, polys, cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want, cell
    segs = [(k, *(float(rnd.randint(-7, 7)) for _ in range(4))) for k in range(80)] + [(500, 1.0, 1.0, 2.0, 1.0)] * 2
    sdf = spark.createDataFrame(segs, "seg_id int, x0 double, y0 double, x1 double, y1 double")
    sums = [sorted((r["seg_id"], r["poly_id"], tuple(map(tuple, r["pieces"]))) for r in
                   spatial.clip_lines(sdf, polys, cell).collect()) for cell in (0.7, 2.0, 50.0)]
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) > 100
    assert [p for k, p, _ in sums[0] if k == 500].count("box") == 2       # rows that repeat a segment


def test_large_ring_is_tested_by_the_edges_of_a_cell(spark):
    rnd = random.Random(11)
    n = 5000
    ring = [((100 + rnd.uniform(0, 6)) * math.cos(2 * math.pi * k / n),
             (100 + rnd.uniform(0, 6)) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    poly = spark.createDataFrame([("P", ring)], "poly_id string, ring array<struct<x: double, y: double>>")
    cells = spatial.polygon_cells(poly, ["poly_id"], "ring", 4.0)
    sizes = [r["n"] for r in cells.select(F.size("_edges").alias("n")).collect()]
    assert max(sizes) < 150 and sum(sizes) < 3 * n and sizes.count(0) > len(sizes) / 2
    pts = [(k, rnd.uniform(-110, 110), rnd.uniform(-110, 110)) for k in range(1000)]
    hits = spatial.points_in_polygons(spark.createDataFrame(pts, "id int, x double, y double"), poly, 4.0)
    assert {r["id"] for r in hits.collect()} == {i for i, x, y in pts if _inside(x, y, ring)}
    assert "ring" not in hits.columns


# ---- N5: delta-stepping over a log of improvements ---------------------------------------

@pytest.mark.parametrize("delta", [None, 25.0])
def test_delta_stepping_equals_dijkstra(spark, delta):
    """Lengths of very different size, detours over many short edges, two graphs, two searches."""
    import heapq

    rng = np.random.default_rng(7)
    edges = [(g, int(a), int(b), float(rng.choice([1, 2, 5, 40, 90])) + float(rng.random()))
             for g in (0, 1) for a, b in rng.integers(0, 40, (90, 2))]
    edges += [(0, 100 + i, 101 + i, 1.0) for i in range(8)] + [(0, 100, 108, 55.0), (0, 3, 104, 2.0)]
    sources = [(g, s, int(n), float(d)) for g in (0, 1) for s in (0, 1) for n, d in
               zip(rng.integers(0, 40, 3), rng.random(3) * 30)] + [(0, 0, 100, 0.0), (0, 1, 999, 5.0), (1, 1, 2, 300.0)]
    best = {}
    for g, s in {(g, s) for g, s, _, _ in sources}:
        heap = [(d, n) for a, b, n, d in sources if (a, b) == (g, s) and d <= 120]
        heapq.heapify(heap)
        while heap:
            d, n = heapq.heappop(heap)
            if (g, s, n) in best:
                continue
            best[g, s, n] = d
            for e, a, b, w in edges:
                if e == g and n in (a, b) and d + w <= 120:
                    heapq.heappush(heap, (d + w, b if n == a else a))
    got = network.network_distance(
        spark.createDataFrame(edges, "g int, u long, v long, len_m double"),
        spark.createDataFrame(sources, "g int, s int, node long, d0 double"), ["g"], ["s"], 120.0,
        d0="d0", delta=delta)
    assert got.columns == ["g", "s", "node", "d"]
    got = {(r.g, r.s, r.node): r.d for r in got.collect()}
    assert got.keys() == best.keys() and all(abs(got[k] - best[k]) < 1e-9 for k in best)


def test_no_sources_give_no_distances(spark):
    edges = spark.createDataFrame([(0, 1, 2, 1.0)], "g int, u long, v long, len_m double")
    none = spark.createDataFrame([], "g int, s int, node long")
    out = network.network_distance(edges, none, ["g"], ["s"], 5.0)
    assert out.columns == ["g", "s", "node", "d"] and out.count() == 0


def test_snap_cells_are_linear_in_length_and_miss_no_point(spark):
    rng = np.random.default_rng(5)
    segs = [(i, *map(float, rng.uniform(-3000, 3000, 4))) for i in range(40)]
    segs += [(50, 0.0, 0.0, 0.0, 900.0), (51, -500.0, 20.0, 700.0, 20.0), (52, 5.0, 5.0, 5.0, 5.0), (53, 0.0, 0.0, 20000.0, 20000.0)]
    pts = [(i, *map(float, rng.uniform(-3000, 3000, 2))) for i in range(300)]

    def distance(p, s):
        dx, dy = s[3] - s[1], s[4] - s[2]
        t = ((p[1] - s[1]) * dx + (p[2] - s[2]) * dy) / (dx * dx + dy * dy) if dx or dy else 0.0
        t = min(1.0, max(0.0, t))
        return math.hypot(p[1] - s[1] - t * dx, p[2] - s[2] - t * dy)
    want = {}
    for p in pts:
        d, s = min((distance(p, s), s[0]) for s in segs)
        if d <= 150.0:
            want[p[0]] = (s, d)
    sdf = spark.createDataFrame(segs, "seg_id int, x0 double, y0 double, x1 double, y1 double")
    pdf = spark.createDataFrame(pts, "point_id int, x double, y double")
    for cell in (None, 400.0, 60.0):
        got = {r.point_id: (r.seg_id, r.dist) for r in spatial.snap_points(pdf, sdf, 150.0, cell=cell).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    n = sdf.where("seg_id = 53").select(F.size(spatial.cells_along(
        *[F.col(c) for c in ("x0", "y0", "x1", "y1")], 200.0, 200.0)).alias("n")).first().n
    assert n < 8 * math.hypot(20000, 20000) / 200


def _rows_made(node) -> int:
    """Most rows that any operator of a finished plan put out."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _rows_made(node.executedPlan())
    if name.endswith("QueryStage"):
        return _rows_made(node.plan())
    metric, children = node.metrics().get("numOutputRows"), node.children()
    own = metric.get().value() if metric.isDefined() else 0
    return max([own, *[_rows_made(children.apply(i)) for i in range(children.size())]])


def test_snap_makes_no_row_per_point_and_segment(spark):
    n = 3000
    at = lambda k: F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(80_000)) / 1000
    pts = spark.range(n).select(F.col("id").alias("point_id"), at(1).alias("x"), at(2).alias("y"))
    segs = spark.range(n).select(F.col("id").alias("seg_id"), *[at(k).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"), 3)])
    df = spatial.snap_points(pts, segs, 20.0)
    assert df.count() == n                   # every point is near some segment, and near most of them
    df.collect()
    assert _rows_made(df._jdf.queryExecution().executedPlan()) < 20 * n


def test_snap_in_split_groups_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(spatial, "SNAP_ROWS", 40)
    monkeypatch.setattr(spatial, "SNAP_PAIRS", 64)
    rng = np.random.default_rng(9)
    nan = float("nan")
    # a grid's coordinates, so that many distances are equal; copies under other keys; two cities
    segs = [("AB"[i % 2], f"s{i:03d}", *map(float, rng.integers(0, 12, 4) * 5)) for i in range(300)]
    segs += [(c, "a" + k, *e) for c, k, *e in segs[:30]] + [("A", "nan", nan, 0.0, 1.0, 1.0), (None, "s", 0.0, 0.0, 9.0, 9.0),
                                                            ("A", "null", None, 0.0, 1.0, 1.0), ("B", None, 200.0, 200.0, 200.0, 203.0)]
    pts = [("AB"[i % 2], i, *map(float, rng.integers(0, 24, 2) * 2.5)) for i in range(200)]
    pts += [("A", 500, *pts[0][2:]), ("A", 501, nan, 1.0), ("B", 502, None, 1.0), (None, 503, 1.0, 1.0), ("B", 504, 201.0, 201.0),
            ("A", 505, 900.0, 900.0), ("A", 506, 5.0, 5.0), ("A", 506, 17.5, 22.5), ("B", None, 7.5, 2.5)]

    want = {}
    for c, k, x, y in pts:
        for b, s, *e in segs:
            if c is None or b != c or None in (x, y, *e):
                continue
            t, length, d = (float(v) for v in spatial._project(*(np.float64(v) for v in (x, y, *e))))
            if d <= 4.0:
                want.setdefault((c, k), []).append(((d, s is not None, s or ""), (s, t, t * length, d)))
    sdf = spark.createDataFrame(segs, "city string, seg_id string, x0 double, y0 double, x1 double, y1 double")
    pdf = spark.createDataFrame(pts, "city string, point_id int, x double, y double")
    got = {(r.city, r.point_id): (r.seg_id, r.t, r.offset, r.dist) for r in spatial.snap_points(
        pdf, sdf, 4.0, cell=20.0, match=("city",)).collect()}
    assert got == {k: min(v)[1] for k, v in want.items()}


def test_snap_of_points_and_segments_from_one_frame(spark):
    base = spark.createDataFrame([("A", 1), ("B", 2)], "city string, k int")
    line = [F.col("k").cast("double").alias(c) for c in ("x0", "y0")] + [F.lit(9.0).alias(c) for c in ("x1", "y1")]
    pts = base.select("city", F.col("k").alias("point_id"), F.lit(9.0).alias("x"), F.lit(10.0).alias("y")).checkpoint()
    segs = base.select("city", F.col("k").alias("seg_id"), *line).checkpoint()
    got = spatial.snap_points(pts, segs, 5.0, match=("city",)).collect()
    assert sorted((r.city, r.point_id, r.seg_id, r.t, r.dist) for r in got) == [("A", 1, 1, 1.0, 1.0), ("B", 2, 2, 1.0, 1.0)]

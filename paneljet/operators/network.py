"""Road-network coverage N4-N10 as keyed table operators.

The reference computes one city x month at a time in memory (service areas, then a
geometry dissolve). Here every (city, month) is a key of the same distributed job:

* N5 ``network_distance``: bounded multi-source shortest distances by delta-stepping (the
  nearest pending nodes are joined with the adjacency, ``min`` per (key, node); improvements
  go to an append-only log whose minimum is taken once). Lineage is cut with reliable
  checkpoints; rounds are bounded and the loop fails if not converged.
* N6/N7: the covered part of an edge for threshold D is the union of intervals reached from
  its two ends (and from stations lying on it); no geometry union is needed.
* N8/N9: lengths by town, threshold pivot, bands and reach percentages.

Node ids may be any orderable type (an integer, or a struct of exact coordinates).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.clean import safe_ratio
from .util import cut_lineage, cut_lineage_partitioned

THRESHOLDS = (500, 1000, 1500)
GRID_SLICES = 16        # slices in which a graph's towns meet its search keys


def road_edges(segments: DataFrame, keys: Sequence[str], line_id: str, path: str = "path",
               x: str = "x", y: str = "y", town: str | None = None) -> DataFrame:
    """Polylines ``(keys, line_id, path ARRAY<STRUCT<x,y>>)`` to edges
    ``(keys, line_id, edge_id, u, v, len_m[, town])``. Nodes are vertices with identical
    coordinates (tolerance 0): ``u``/``v`` are ``struct(x, y)``. Zero-length pieces are dropped.

    Consecutive vertex pairs are built inside each row with ``transform`` over the array,
    so no shuffle or window is needed, whatever the length of a line.
    """
    cols = [*keys, line_id] + ([town] if town else [])
    n = F.size(path)

    def vertex(i):
        p = F.get(path, i)
        return F.struct(p[x].alias("x"), p[y].alias("y"))

    pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(
        i.alias("i"), vertex(i).alias("u"), vertex(i + 1).alias("v"))))
    seg = segments.select(*cols, F.explode(pairs).alias("_s")).select(*cols, "_s.i", "_s.u", "_s.v")
    seg = seg.withColumn("len_m", F.sqrt((F.col("v.x") - F.col("u.x")) ** 2
                                         + (F.col("v.y") - F.col("u.y")) ** 2))
    return (seg.where(F.col("len_m") > 0)
            .withColumn("edge_id", F.concat_ws(":", F.col(line_id).cast("string"), F.col("i").cast("string")))
            .drop("i"))


def adjacency(edges: DataFrame, graph_keys: Sequence[str], u: str = "u", v: str = "v",
              length: str = "len_m") -> DataFrame:
    """Both directions of every undirected edge: ``(graph_keys, src, dst, len)``."""
    fwd = edges.select(*graph_keys, F.col(u).alias("src"), F.col(v).alias("dst"), F.col(length).alias("len"))
    bwd = edges.select(*graph_keys, F.col(v).alias("src"), F.col(u).alias("dst"), F.col(length).alias("len"))
    return fwd.unionByName(bwd)


def share_identical_sources(sources: DataFrame, graph_keys: Sequence[str],
                            search_keys: Sequence[str], node: str = "node",
                            d0: str = "d0") -> tuple[DataFrame, DataFrame]:
    """Months (search keys) with the same source set need one search, not one each.

    Returns ``(representative sources, key map (graph_keys, search_keys, rep_*))``. Keys are
    grouped by an order-independent signature (size and two 64-bit hash sums of the
    (node, d0) rows); each key is then verified against its group's representative by an
    exact intersection count, so a hash collision can only cost a shared search, never a
    wrong answer. Work is linear in the sources; no key pairs are formed beyond key ->
    representative.
    """
    keys = [*graph_keys, *search_keys]
    rep_names = [f"rep_{k}" for k in search_keys]
    src = sources.select(*keys, F.col(node).alias("_node"), F.col(d0).cast("double").alias("_d0")).distinct()
    sig = src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        # DECIMAL sums: 64-bit hash sums would overflow a LONG (an error under ANSI)
        F.sum(F.xxhash64("_node", "_d0").cast("decimal(38,0)")).alias("_h1"),
        F.sum(F.hash("_node", "_d0").cast("decimal(38,0)")).alias("_h2"))
    rep = (sig.groupBy(*graph_keys, "_n", "_h1", "_h2")
           .agg(F.min(F.struct(*search_keys)).alias("_rep")))
    cand = sig.join(rep, [*graph_keys, "_n", "_h1", "_h2"]).select(
        *keys, "_n", *[F.col(f"_rep.{k}").alias(r) for k, r in zip(search_keys, rep_names)])
    # exact check: |S_key ∩ S_rep| must equal |S_key| (= |S_rep|, same signature size)
    rep_src = src.select(*graph_keys, *[F.col(k).alias(r) for k, r in zip(search_keys, rep_names)],
                         "_node", "_d0")
    inter = (src.join(cand.select(*keys, *rep_names), keys)
             .join(rep_src, [*graph_keys, *rep_names, "_node", "_d0"])
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("_common")))
    checked = cand.join(inter, keys, "left").withColumn(
        "_ok", F.coalesce(F.col("_common"), F.lit(0)) == F.col("_n"))
    key_map = checked.select(*keys, *[F.when(F.col("_ok"), F.col(r)).otherwise(F.col(k)).alias(r)
                                      for k, r in zip(search_keys, rep_names)])
    reps = key_map.select(*graph_keys, *[F.col(r).alias(k) for k, r in zip(search_keys, rep_names)]).distinct()
    rep_sources = sources.join(reps, keys, "left_semi")
    return rep_sources, key_map


def _signatures(sources: DataFrame, keys: Sequence[str], node: str, d0: str | None) -> DataFrame:
    d = F.col(d0).cast("double") if d0 else F.lit(0.0)
    src = sources.select(*keys, F.col(node).alias("_node"), d.alias("_d0")).distinct()
    return src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        # DECIMAL sums: 64-bit hash sums would overflow a LONG (an error under ANSI)
        F.sum(F.xxhash64("_node", "_d0").cast("decimal(38,0)")).alias("_h1"),
        F.sum(F.hash("_node", "_d0").cast("decimal(38,0)")).alias("_h2"))


def _any_shared_signature(sources, graph_keys, search_keys, node, d0) -> bool:
    """One small job: can any two search keys have the same source set at all?"""
    sig = _signatures(sources, [*graph_keys, *search_keys], node, d0)
    row = sig.agg(F.count(F.lit(1)).alias("k"),
                  F.countDistinct(F.struct(*graph_keys, "_n", "_h1", "_h2")).alias("s")).first()
    return row["s"] < row["k"]


def network_distance(edges: DataFrame, sources: DataFrame, graph_keys: Sequence[str],
                     search_keys: Sequence[str], max_cost: float, u: str = "u", v: str = "v",
                     length: str = "len_m", node: str = "node", d0: str | None = None,
                     max_rounds: int = 10_000, delta: float | None = None,
                     share_identical: bool = True) -> DataFrame:
    """Least network distance ``d`` from any source of the same search key to every node
    reachable within ``max_cost``: ``(graph_keys, search_keys, node, d)``.

    ``graph_keys`` pick the graph (e.g. city); ``search_keys`` (e.g. month) are extra keys of
    the source sets - one search per (graph_keys, search_keys) runs in the same job.
    ``sources`` has ``(graph_keys, search_keys, node[, d0])``; ``d0`` is an initial offset
    (a station snapped mid-edge enters at both ends with its offsets).

    Delta-stepping: a round expands the pending nodes within ``delta`` (default: the longest
    edge) of the nearest one, joined with the adjacency, which stays where it is; the others
    wait. What a round improves is appended to a log, whose minimum per node is taken once at
    the end; no round reads all distances. To tell improvements from detours a round needs
    only the log entries at most one longest edge nearer than its nearest node: a node v
    expanded at d(v) has offered d(v) + len to each neighbour u, so d(u) <= d(v) + len.
    Log tables that lie below are left out altogether. With ``share_identical`` search keys whose source sets are equal share one search
    (``share_identical_sources``) and the distances are copied to each of them.
    """
    keys = [*graph_keys, *search_keys]
    if share_identical and search_keys and _any_shared_signature(
            sources, graph_keys, search_keys, node, d0):
        src = sources if d0 else sources.withColumn("_zero_d0", F.lit(0.0))
        rep_sources, key_map = share_identical_sources(src, graph_keys, search_keys, node,
                                                       d0 or "_zero_d0")
        key_map = cut_lineage(key_map)
        dist = network_distance(edges, rep_sources.drop("_zero_d0") if not d0 else rep_sources,
                                graph_keys, search_keys, max_cost, u, v, length, node, d0,
                                max_rounds, delta, share_identical=False)
        reps = [f"rep_{k}" for k in search_keys]
        renamed = dist.select(*graph_keys, *[F.col(k).alias(r) for k, r in zip(search_keys, reps)],
                              node, "d")
        return key_map.join(renamed, [*graph_keys, *reps]).drop(*reps)
    # Materialised once: every round joins the frontier with it, and recomputing it from
    # its source (e.g. an aggregate over a fact table) each round would rescan that source.
    # Its columns have names of their own: the graph keys may be the very columns of the sources.
    # Edges over max_cost lead nowhere.
    longest = Observation(f"adjacency_{uuid.uuid4().hex}")
    adj = (adjacency(edges, graph_keys, u, v, length).where(F.col("len") <= max_cost).select(
        *[F.col(k).alias(f"_g_{k}") for k in graph_keys], "src", "dst", "len")
        .observe(longest, F.max("len").alias("len")))
    # Kept hash-partitioned on the join key: the rounds shuffle the frontier, not the graph.
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    adj = cut_lineage_partitioned(adj, parts, *[f"_g_{k}" for k in graph_keys], "src")
    reach = float(longest.get["len"] or 0.0)
    delta = reach if delta is None else float(delta)
    start = F.col(d0).cast("double") if d0 else F.lit(0.0)
    found = (sources.select(*keys, F.col(node).alias("node"), start.alias("d"))
             .where(F.col("d") <= max_cost)
             .groupBy(*keys, "node").agg(F.min("d").alias("d"), F.lit(True).alias("new")))
    log: list[tuple[float, DataFrame]] = []          # improvements of a round, and the greatest of them
    for _ in range(max_rounds + 1):
        seen = Observation(f"round_{uuid.uuid4().hex}")
        pending = cut_lineage(found.observe(seen, F.min("d").alias("low"), F.max(F.when(F.col("new"), F.col("d"))).alias("high")))
        low, high = seen.get["low"], seen.get["high"]
        if high is not None:
            log.append((high, pending.where("new").drop("new")))
        if low is None:                              # nothing is pending
            if not log:
                return pending.drop("new").withColumnRenamed("node", node)
            return (reduce(DataFrame.unionByName, [t for _, t in log])
                    .groupBy(*keys, F.col("node").alias(node)).agg(F.min("d").alias("d")))
        near = F.col("d") <= low + delta
        cond = [F.col(k) == F.col(f"_g_{k}") for k in graph_keys] + [F.col("node") == F.col("src")]
        nothing = F.lit(None).cast("double")
        offers = (pending.where(near).join(adj, cond)
                  .select(*keys, F.col("dst").alias("node"), (F.col("d") + F.col("len")).alias("offer"),
                          nothing.alias("known"), nothing.alias("wait"))
                  .where(F.col("offer") <= max_cost))
        # a tolerance far under any length keeps rounding of sums from hiding an entry
        floor = low - reach * (1 + 1e-9) - 1e-9
        band = reduce(DataFrame.unionByName, [t.where(F.col("d") >= floor) for top, t in log if top >= floor])
        band = band.select(*keys, "node", nothing.alias("offer"), F.col("d").alias("known"), nothing.alias("wait"))
        waiting = pending.where(~near).select(*keys, "node", nothing.alias("offer"), nothing.alias("known"),
                                              F.col("d").alias("wait"))
        # one shuffle: a node's best offer against what is known of it and what waits there
        better = F.col("known").isNull() | (F.col("offer") < F.col("known"))
        found = (offers.unionByName(band).unionByName(waiting).groupBy(*keys, "node")
                 .agg(*[F.min(c).alias(c) for c in ("offer", "known", "wait")])
                 .withColumn("new", F.coalesce(F.col("offer").isNotNull() & better, F.lit(False)))
                 .select(*keys, "node", F.when(F.col("new"), F.col("offer")).otherwise(F.col("wait")).alias("d"), "new")
                 .where(F.col("d").isNotNull()))
    raise RuntimeError(f"network_distance did not converge in {max_rounds} rounds")


def edge_intervals(edges: DataFrame, dist: DataFrame, graph_keys: Sequence[str],
                   search_keys: Sequence[str], thresholds: Sequence[float] = THRESHOLDS,
                   on_edge: DataFrame | None = None, edge_id: str = "edge_id", u: str = "u",
                   v: str = "v", length: str = "len_m", node: str = "node") -> DataFrame:
    """Raw covered intervals ``(keys, edge_id, D, from_m, to_m)`` on each edge:
    ``[0, D - d_u]`` from the u end, ``[L - (D - d_v), L]`` from the v end, and
    ``[s - D, s + D]`` around each station at offset ``s`` on the edge (``on_edge`` rows
    ``(graph_keys, search_keys, edge_id, offset)``). Only edges touching a reached node or a
    station appear, so the work follows the covered part of the network.
    """
    keys = [*graph_keys, *search_keys]
    th = F.array(*[F.lit(float(t)) for t in thresholds])
    e = edges.select(*graph_keys, edge_id, u, v, F.col(length).cast("double").alias("L"))
    d = dist.select(*keys, F.col(node).alias("_n"), F.col("d").alias("_dn"))
    from_u = (e.join(d, [*[e[k] == d[k] for k in graph_keys], e[u] == d["_n"]])
              .select(*[d[k] for k in keys], e[edge_id], e["L"], F.explode(th).alias("D"), d["_dn"])
              .where(F.col("D") > F.col("_dn"))
              .select(*keys, edge_id, "D", F.lit(0.0).alias("from_m"),
                      F.least(F.col("L"), F.col("D") - F.col("_dn")).alias("to_m")))
    from_v = (e.join(d, [*[e[k] == d[k] for k in graph_keys], e[v] == d["_n"]])
              .select(*[d[k] for k in keys], e[edge_id], e["L"], F.explode(th).alias("D"), d["_dn"])
              .where(F.col("D") > F.col("_dn"))
              .select(*keys, edge_id, "D",
                      F.greatest(F.lit(0.0), F.col("L") - (F.col("D") - F.col("_dn"))).alias("from_m"),
                      F.col("L").alias("to_m")))
    out = from_u.unionByName(from_v)
    if on_edge is not None:
        st = (on_edge.join(e, [*graph_keys, edge_id])
              .select(*keys, edge_id, "L", F.col("offset").cast("double").alias("s"),
                      F.explode(th).alias("D"))
              .select(*keys, edge_id, "D", F.greatest(F.lit(0.0), F.col("s") - F.col("D")).alias("from_m"),
                      F.least(F.col("L"), F.col("s") + F.col("D")).alias("to_m")))
        out = out.unionByName(st)
    return out


def intervals_from_ends(ends: DataFrame, keys: Sequence[str], thresholds: Sequence[float] = THRESHOLDS,
                        on_edge: DataFrame | None = None, lengths: DataFrame | None = None,
                        graph_keys: Sequence[str] = (), edge_id: str = "edge_id") -> DataFrame:
    """Raw covered intervals from per-edge end distances ``(keys, edge_id, L, d_u, d_v)``
    (either may be NULL) plus stations lying on edges (``on_edge`` with ``offset``, lengths
    from ``lengths`` = ``(graph_keys, edge_id, L)``)."""
    th = F.array(*[F.lit(float(t)) for t in thresholds])
    e = ends.select(*keys, edge_id, F.col("L").cast("double").alias("L"), "d_u", "d_v",
                    F.explode(th).alias("D"))
    from_u = e.where(F.col("d_u") < F.col("D")).select(
        *keys, edge_id, "D", F.lit(0.0).alias("from_m"),
        F.least(F.col("L"), F.col("D") - F.col("d_u")).alias("to_m"))
    from_v = e.where(F.col("d_v") < F.col("D")).select(
        *keys, edge_id, "D", F.greatest(F.lit(0.0), F.col("L") - (F.col("D") - F.col("d_v"))).alias("from_m"),
        F.col("L").alias("to_m"))
    out = from_u.unionByName(from_v)
    if on_edge is not None:
        st = (on_edge.join(lengths, [*graph_keys, edge_id])
              .select(*keys, edge_id, F.col("L").cast("double").alias("L"),
                      F.col("offset").cast("double").alias("s"), F.explode(th).alias("D"))
              .select(*keys, edge_id, "D", F.greatest(F.lit(0.0), F.col("s") - F.col("D")).alias("from_m"),
                      F.least(F.col("L"), F.col("s") + F.col("D")).alias("to_m")))
        out = out.unionByName(st)
    return out


def merge_intervals(intervals: DataFrame, group: Sequence[str], start: str = "from_m",
                    end: str = "to_m") -> DataFrame:
    """N7 core: union of overlapping/touching intervals per group (gaps and islands).

    Each window partition is one edge x key x threshold: a handful of rows.
    """
    w = Window.partitionBy(*group).orderBy(start, end)
    prev_max = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = intervals.withColumn("_new", F.when(prev_max.isNull() | (F.col(start) > prev_max), 1)
                                   .otherwise(0))
    flagged = flagged.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (flagged.groupBy(*group, "_island")
            .agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island"))


def covered_intervals(edges, dist, graph_keys, search_keys, thresholds=THRESHOLDS, on_edge=None,
                      **kw) -> DataFrame:
    """Covered parts as merged rows ``(keys, edge_id, D, from_m, to_m)``."""
    raw = edge_intervals(edges, dist, graph_keys, search_keys, thresholds, on_edge, **kw)
    return merge_intervals(raw, [*graph_keys, *search_keys, kw.get("edge_id", "edge_id"), "D"])


def covered_length(edges, dist, graph_keys, search_keys, thresholds=THRESHOLDS, on_edge=None,
                   **kw) -> DataFrame:
    """Covered length per edge, key and threshold, each point counted once:
    ``min(L, max(0, D - d_u) + max(0, D - d_v))`` when only the ends carry distances."""
    eid = kw.get("edge_id", "edge_id")
    merged = covered_intervals(edges, dist, graph_keys, search_keys, thresholds, on_edge, **kw)
    return (merged.groupBy(*graph_keys, *search_keys, eid, "D")
            .agg(F.sum(F.col("to_m") - F.col("from_m")).alias("covered_m")))


def length_by_region(edges: DataFrame, covered: DataFrame, graph_keys: Sequence[str],
                     search_keys: Sequence[str], keys_table: DataFrame, town: str = "town",
                     thresholds: Sequence[float] = THRESHOLDS, edge_id: str = "edge_id",
                     length: str = "len_m", regions: DataFrame | None = None) -> DataFrame:
    """Total road length and number of pieces per town, and covered length per
    (search key, town, threshold) pivoted to ``cum_<D>`` columns in one aggregation.

    ``keys_table`` lists the search keys to report (e.g. every city x month with stations);
    every town of the graph appears for each, with 0 covered when nothing reaches it.
    ``regions`` lists further towns to report, such as those without roads.
    """
    totals = edges.groupBy(*graph_keys, town).agg(
        F.sum(F.col(length).cast("double")).alias("len_total_m"),
        F.count(F.lit(1)).alias("n_pieces"))
    if regions is not None:
        totals = regions.select(*graph_keys, town).distinct().join(
            totals, [*graph_keys, town], "left").fillna({"len_total_m": 0.0, "n_pieces": 0})
    e_town = edges.select(*graph_keys, edge_id, town)
    cov = (covered.join(e_town, [*graph_keys, edge_id])
           .groupBy(*graph_keys, *search_keys, town)
           .agg(*[F.sum(F.when(F.col("D") == float(t), F.col("covered_m"))).alias(f"cum_{int(t)}")
                  for t in thresholds]))
    report_keys = keys_table.select(*graph_keys, *search_keys).distinct()
    # Every town for every search key is the output. The keys are dealt over slices and the
    # towns copied into each: an equi-join, spread over tasks even if there is only one graph.
    slice_of = F.pmod(F.xxhash64(*search_keys), F.lit(GRID_SLICES)) if search_keys else F.lit(0)
    slices = F.explode(F.array(*[F.lit(i).cast("long") for i in range(GRID_SLICES if search_keys else 1)]))
    grid = (totals.withColumn("_slice", slices)
            .join(report_keys.withColumn("_slice", slice_of.cast("long")), [*graph_keys, "_slice"])
            .drop("_slice"))
    out = grid.join(cov, [*graph_keys, *search_keys, town], "left")
    return out.withColumns({f"cum_{int(t)}": F.coalesce(F.col(f"cum_{int(t)}"), F.lit(0.0))
                            for t in thresholds})


def reach_label(t: int) -> str:
    """Threshold label of the reach columns: whole thousands as ``1k``, ``2k``; else metres."""
    return f"{t // 1000}k" if t >= 1000 and t % 1000 == 0 else str(t)


def coverage_bands(df: DataFrame, thresholds: Sequence[float] = THRESHOLDS,
                   total: str = "len_total_m", digits_len: int = 1, digits_pct: int = 2) -> DataFrame:
    """Clamp cumulative lengths to the total, marginal bands 0-D1, D1-D2, ..., > Dn and
    reach percentages (0 when the total is 0), rounded to 1 and 2 decimals."""
    ts = [int(t) for t in thresholds]
    c = {t: F.least(F.col(f"cum_{t}"), F.col(total)) for t in ts}
    bands = {}
    prev = None
    for t in ts:
        lo = 0 if prev is None else prev
        bands[f"len_{lo}_{t}_m"] = c[t] if prev is None else c[t] - c[prev]
        prev = t
    bands[f"len_gt{ts[-1]}_m"] = F.col(total) - c[ts[-1]]
    out = df.withColumns({k: F.round(v, digits_len) for k, v in bands.items()})
    pct = {f"reach{reach_label(t)}_pct": F.round(safe_ratio(c[t], F.col(total), pct=True, zero="zero"),
                                                digits_pct)
           for t in ts}
    return out.withColumns(pct).withColumn(total, F.round(F.col(total), digits_len))

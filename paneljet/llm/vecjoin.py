"""Cosine near-duplicates by a subspace pigeonhole join.

Vectors are scaled to unit length and rotated by a fixed random orthogonal matrix, so cosine >= c
means a squared distance of at most T = 2 - 2c. The rotated axes form a ring of low-dimensional
blocks. By the pigeonhole principle some block's squared distance is at most its share of T (by
dimensions); by its ring form, some such block also stays within the shares of itself and the
next one together. A pair belongs to the first block that it passes so.

Each block is a range join. Every used axis is cut in two, which deals vectors into cells; two
vectors on different sides of some cuts are at least the sum of their squared offsets from these
cuts apart, so the one with the smaller sum, at most half the budget, finds the other by visiting
its cell. Spark deals vectors over the cells of a few cuts, as many as tables need for cells of
about ``TILE`` rows; a larger cell (near copies) is split into tiles that meet pairwise. Inside a
task the block's other axes are cut in the same way, down to cells of about one vector, and only
a cell's residents and visitors are compared.

Pairs are verified where they are found, exactly, in double precision on the original vectors. A
task returns its vectors' numbers of links and one link of each to its local component: no table
of pairs, so a group of near copies gives rows in proportion to its vectors. Equal vectors are
one node that counts with its copies.

Cuts are medians of a sample of at most ``SAMPLE`` vectors; they decide speed, never results. The
number of cells of a block is at most two to the power of its dimensions.

Defined cases: vectors that are null, empty, all zero, or hold a null or non-finite component
link with nothing; an id of null is a vector like others; rows that repeat an id and its vector
count as copies; an empty table gives no rows; vectors of unequal lengths are compared only with
their own length; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from .common import components, map_arrow, ship_package

BLOCK = 13          # target dimensions of a block
TILE = 1 << 14      # rows of a cell in one comparison task; its guests are up to four times as many
VISITS = 1 << 23    # visits of all rows inside a task beyond which no further axis is cut
CHUNK = 1 << 20     # block distances computed at a time inside a task
CACHED = 1 << 13    # found pairs verified at a time
SAMPLE = 2048       # vectors whose medians are the cuts
SLACK = 1e-5        # allowance on a block's budget for the rounding of rotated vectors to float32


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int) -> list[tuple[int, int]]:
    m = max(1, round(dim / BLOCK))
    edge = [dim * i // m for i in range(m + 1)]
    return list(zip(edge, edge[1:]))


def valid(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def rotate(v: np.ndarray) -> np.ndarray:
    """Unit vectors in rotated axes, float32. Every row is computed by the same sequence of
    operations, so tasks that hold copies of a row agree on it bit by bit."""
    n, dim = v.shape
    q = rotation(dim)
    out = np.empty((n, dim), np.float32)
    for lo in range(0, n, 4096):
        w = v[lo:lo + 4096].astype(np.float64)
        w = w / np.abs(w).max(1, keepdims=True)
        square, turned = np.zeros(len(w)), np.zeros(w.shape)
        for d in range(dim):
            square += w[:, d] * w[:, d]
            turned += w[:, d:d + 1] * q[d]
        out[lo:lo + 4096] = turned / np.sqrt(square)[:, None]
    return out


@dataclass
class Plan:
    """How vectors of one length are dealt: blocks, budgets, and the cut axes of every block."""
    cosine: float
    spans: list[tuple[int, int]]
    one: list[float]                    # budget of a block
    two: list[float]                    # budget of a block and the next one
    axes: list[list[tuple[int, float]]]  # (axis, cut) that deal a block's vectors over cells

    def sides(self, block: int, u: np.ndarray) -> np.ndarray:
        """Offsets of rotated vectors from the block's dealing cuts."""
        return offsets(u, self.axes[block])


def offsets(u: np.ndarray, axes: list[tuple[int, float]]) -> np.ndarray:
    return np.stack([u[:, a].astype(np.float64) - cut for a, cut in axes], 1) if axes \
        else np.zeros((len(u), 0))


def useful_axes(u: np.ndarray, axes: list[int], budget: float, most: int) -> list[tuple[int, float]]:
    """Up to ``most`` of ``axes`` with their medians, those first whose cut the fewest rows can
    cross within half the budget; not those that over nine tenths can."""
    found = []
    for a in axes:
        cut = float(np.median(u[:, a])) if len(u) else 0.0
        near = float(((u[:, a] - cut) ** 2 <= budget / 2).mean()) if len(u) else 1.0
        if near < 0.9:
            found.append((near, a, cut))
    return [(a, cut) for _, a, cut in sorted(found)[:most]]


def make_plan(sample: np.ndarray, rows: int, cosine: float) -> Plan:
    """``sample`` vectors of the ``rows`` to compare."""
    dim = sample.shape[1]
    spans = blocks_of(dim)
    total = max(2.0 - 2.0 * cosine, 0.0)
    one = [total * (hi - lo) / dim + SLACK for lo, hi in spans]
    two = [a + b for a, b in zip(one, one[1:] + one[:1])]
    cuts = max(0, int(np.ceil(np.log2(max(rows, 1) / TILE))))
    u = rotate(sample)
    return Plan(cosine, spans, one, two, [
        useful_axes(u, list(range(lo, hi)), budget, cuts) for (lo, hi), budget in zip(spans, one)])


def visits(x: np.ndarray, limit: np.ndarray, most: float = float("inf")
           ) -> tuple[np.ndarray, np.ndarray, int]:
    """Cells that rows visit: (row, cell, number of cuts used).

    ``x`` holds offsets from the cuts; a row's own cell has a bit for every offset >= 0, and it
    visits those reached by crossing cuts whose squared offsets sum to ``limit`` at most. Cuts
    that would make more than ``most`` visits, and all after them, are left out.
    """
    row = np.arange(len(x), dtype=np.int32)
    cell = np.zeros(len(x), np.int32)
    cost = np.zeros(len(x))
    for j in range(x.shape[1]):
        at = x[row, j]
        crossed = cost + at * at
        go = np.flatnonzero(crossed <= limit[row] + 1e-9)
        if len(row) + len(go) > most:
            return row, cell, j
        bit = (at >= 0).astype(np.int32)
        cell = np.concatenate([cell | (bit << j), cell[go] | ((1 - bit[go]) << j)])
        row = np.concatenate([row, row[go]])
        cost = np.concatenate([cost, crossed[go]])
    return row, cell, x.shape[1]


def cell_of(x: np.ndarray) -> np.ndarray:
    return ((x >= 0).astype(np.int32) << np.arange(x.shape[1], dtype=np.int32)).sum(1, dtype=np.int32)


def _lower(x: np.ndarray, node: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether row q of a pair has the smaller (sum of squared offsets from the cuts between the
    two, node)."""
    a, b = x[p], x[q]
    cut = (a >= 0) != (b >= 0)
    cp, cq = (a * a * cut).sum(1), (b * b * cut).sum(1)
    return (cq < cp) | ((cq == cp) & (node[q] < node[p]))


class Tile:
    """Comparison of a cell's residents with each other (``within``) and with guests, who are
    visitors from other cells or, if ``peers``, residents in another tile of the same cell."""

    def __init__(self, plan: Plan, block: int, cell: int, home: int, vec: np.ndarray,
                 node: np.ndarray, within: bool, peers: bool):
        self.plan, self.block, self.home, self.vec, self.node = plan, block, home, vec, node
        self.within, self.peers, self.compared = within, peers, 0
        self.u = rotate(vec)
        self.dealt = plan.sides(block, self.u)
        lo, hi = plan.spans[block]
        budget = plan.one[block]
        used = {a for a, _ in plan.axes[block]}
        axes = useful_axes(self.u[:home], [a for a in range(lo, hi) if a not in used], budget,
                           int(np.ceil(np.log2(max(home, 1)))))
        limit = np.full(len(vec), budget / 2)
        if peers:
            limit[:] = budget           # one-sided: all visits by the guests
        else:
            bits = (cell >> np.arange(self.dealt.shape[1])) & 1
            away = (self.dealt >= 0) != (bits == 1)
            spent = np.where(away, self.dealt * self.dealt, 0.0).sum(1)
            limit[home:] = budget - 2 * spent[home:]
        x = offsets(self.u, axes)
        # residents visit only if they are compared with each other
        self.first = 0 if within else home
        row, at, k = visits(x[self.first:], limit[self.first:], VISITS)
        self.x = x[:, :k]
        self.own = cell_of(self.x)
        by = np.argsort(at, kind="stable")
        self.visitor, self.at = row[by] + self.first, at[by]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Verified pairs (resident, visitor), each in one block, cell and tile only."""
        lo, hi = self.plan.spans[self.block]
        b = self.u[:, lo:hi]
        square = (b * b).sum(1, keepdims=True)
        left = np.concatenate([-2 * b, square, np.ones_like(square)], 1)
        right = np.concatenate([b, np.ones_like(square), square], 1)
        live = np.argsort(self.own[:self.home], kind="stable")
        cells, start = np.unique(self.own[live], return_index=True)
        stop = np.append(start[1:], self.home)
        vlo, vhi = np.searchsorted(self.at, cells, "left"), np.searchsorted(self.at, cells, "right")
        held, n = [], 0
        for s, e, vs, ve in zip(start.tolist(), stop.tolist(), vlo.tolist(), vhi.tolist()):
            step = max(1, CHUNK // (e - s))
            for v in range(vs, ve, step):
                who = self.visitor[v:min(v + step, ve)]
                near = left[live[s:e]] @ right[who].T <= self.plan.one[self.block] + SLACK
                self.compared += near.size
                i, j = np.divmod(np.flatnonzero(near), len(who))
                held.append((live[s:e][i], who[j]))
                n += len(i)
                if n >= 1 << 17:
                    yield from self._settle(held)
                    held, n = [], 0
        yield from self._settle(held)

    def _settle(self, held: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not held:
            return
        p_all, q_all = (np.concatenate(x) for x in zip(*held))
        for s in range(0, len(p_all), CACHED):
            p, q = p_all[s:s + CACHED], q_all[s:s + CACHED]
            both = q < self.home
            mine = np.where(both, p < q, self.peers)
            ask = np.flatnonzero(both & (self.own[p] != self.own[q]))
            mine[ask] = _lower(self.x, self.node, p[ask], q[ask])
            if not self.peers:
                ask = np.flatnonzero(~both)
                mine[ask] = _lower(self.dealt, self.node, p[ask], q[ask])
            p, q = p[mine], q[mine]
            keep = self._passes(self.block, p, q)
            p, q = p[keep], q[keep]
            for earlier in range(self.block):
                keep = ~self._passes(earlier, p, q)
                p, q = p[keep], q[keep]
            keep = self._cosine(p, q) >= self.plan.cosine
            if keep.any():
                yield p[keep], q[keep]

    def _passes(self, block: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        spans, m = self.plan.spans, len(self.plan.spans)

        def distance(span: tuple[int, int]) -> np.ndarray:
            part = self.u[:, span[0]:span[1]]
            gap = part[p].astype(np.float64) - part[q]
            return (gap * gap).sum(1)

        first = distance(spans[block])
        if m == 1:
            return first <= self.plan.one[block]
        return ((first <= self.plan.one[block])
                & (first + distance(spans[(block + 1) % m]) <= self.plan.two[block]))

    def _cosine(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        a, b = self.vec[p].astype(np.float64), self.vec[q].astype(np.float64)
        return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _unite(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Join the components of p and q; ``label`` names every row's smallest fellow."""
    while True:
        a, b = label[p], label[q]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (label[label] != label).any():
            label = label[label]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _deal(nodes: DataFrame, plan: Plan, dim: int, full: bool) -> DataFrame:
    """(block, cell, guest, node) for every cell that a vector lives in or visits; ``full``: with
    the columns of ``nodes``."""
    names = nodes.columns if full else ["node"]
    at = nodes.columns.index("vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            u = rotate(_matrix(batch.column(at), dim))
            for b in range(len(plan.spans)):
                x = plan.sides(b, u)
                row, cell, _ = visits(x, np.full(len(x), plan.one[b] / 2))
                guest = cell != cell_of(x)[row]
                copied = batch.select(names).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), b, np.int32)), pa.array(cell), pa.array(guest),
                     *copied.columns], names=["block", "cell", "guest", *names])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema if f.name in names)
    return map_arrow(nodes, run, f"block int, cell int, guest boolean, {kept}")


def links(nodes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(node, others, fellow) of the linked ``nodes`` (node, copies, vec), several rows a node.

    ``others`` sum to the copies of the vectors with cosine >= ``cosine``; the pairs of node and
    ``fellow`` connect what links connect.
    """
    sample = nodes.select("vec", F.xxhash64("node").alias("h")).orderBy("h").limit(SAMPLE).collect()
    plan = make_plan(np.array([r["vec"] for r in sample], np.float64).reshape(-1, dim),
                     nodes.count(), cosine)
    sizes: dict = {}
    for r in (_deal(nodes, plan, dim, False).groupBy("block", "cell", "guest")
              .agg(F.count(F.lit(1)).alias("n")).collect()):
        sizes.setdefault((r["block"], r["cell"]), [0, 0])[r["guest"]] = r["n"]
    # cells without residents have nothing to compare
    grid = [(b, c, -(-own // TILE), -(-sent // (4 * TILE))) for (b, c), (own, sent) in sizes.items() if own]
    shape = nodes.sparkSession.createDataFrame(grid, "b int, c int, own int, sent int")
    rows = _deal(nodes, plan, dim, True)
    rows = rows.join(F.broadcast(shape), (F.col("block") == F.col("b")) & (F.col("cell") == F.col("c")))
    h = F.xxhash64("node")
    tile = F.pmod(h, F.when(F.col("guest"), F.greatest("sent", F.lit(1))).otherwise(F.col("own"))).cast("int")
    # task (i, j): tile i of the residents with tile j > i of them, or with tile j - own of the
    # guests; the first of these (or none: j = own) also compares tile i with itself
    as_home = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda j: F.struct(
            F.least(tile, j).alias("i"), F.greatest(tile, j).alias("j"), (tile > j).alias("second"))),
        F.transform(F.sequence(F.lit(0), F.greatest(F.col("sent") - 1, F.lit(0))), lambda j: F.struct(
            tile.alias("i"), (F.col("own") + j).alias("j"), F.lit(False).alias("second"))))
    as_home = F.filter(as_home, lambda t: t["i"] != t["j"])
    as_guest = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: F.struct(
        i.alias("i"), (F.col("own") + tile).alias("j"), F.lit(True).alias("second")))
    tasks = (rows.select("block", "cell", "own", "node", "copies", "vec",
                         F.explode(F.when(F.col("guest"), as_guest).otherwise(as_home)).alias("t"))
             .select("block", "cell", "own", "t.i", "t.j", "t.second", "node", "copies", "vec"))

    def compare(table: pa.Table) -> pa.Table:
        block, cell, own, j = (table.column(c)[0].as_py() for c in ("block", "cell", "own", "j"))
        second = table.column("second").to_numpy()
        by = np.argsort(second, kind="stable")
        node, copies = table.column("node").to_numpy()[by], table.column("copies").to_numpy()[by]
        home = int(len(second) - second.sum())
        others, label = np.zeros(len(node), np.int64), np.arange(len(node))
        if home:
            t = Tile(plan, block, cell, home, _matrix(table.column("vec"), dim)[by], node,
                     within=j == own, peers=j < own)
            for p, q in t.pairs():
                np.add.at(others, p, copies[q])
                np.add.at(others, q, copies[p])
                label = _unite(label, p, q)
        some = others > 0
        return pa.table({"node": node[some], "others": others[some], "fellow": node[label[some]]})

    ship_package(nodes.sparkSession)
    return (tasks.groupBy("block", "cell", "i", "j")
            .applyInArrow(compare, "node long, others long, fellow long"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    cosine: float = 0.95) -> DataFrame:
    """(id, n_links, component) for every row: direct links and the smallest id reachable."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = cut_lineage(rows.withColumn("ok", valid(F.col("vec"))))
    # a node stands for all rows with the same vector; the checkpoint fixes its number
    groups = rows.where("ok").groupBy("vec").agg(F.min("id").alias("low"),
                                                 F.count(F.lit(1)).alias("copies"))
    nodes = cut_lineage(groups.withColumn("node", F.monotonically_increasing_id()))
    dims = [r[0] for r in nodes.select(F.size("vec")).distinct().collect()]
    alone = rows.where(~F.col("ok")).select("id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("id").alias("component"))
    if not dims:
        return alone
    found = cut_lineage(reduce(DataFrame.unionByName, [
        links(nodes.where(F.size("vec") == d).select("node", "copies", "vec"), d, cosine)
        for d in dims]))
    degree = found.groupBy("node").agg(F.sum("others").alias("others"))
    comp = components(found.select(F.col("node").alias("a"), F.col("fellow").alias("b")))
    comp = comp.withColumnRenamed("component", "c")
    told = cut_lineage(nodes.join(degree, "node", "left").join(comp, "node", "left")
                       .select("vec", "low", F.coalesce("c", "node").alias("c"),
                               (F.coalesce("others", F.lit(0)) + F.col("copies") - 1)
                               .alias("n_links")))
    told = told.join(told.groupBy("c").agg(F.min("low").alias("component")), "c")
    return (rows.where("ok").join(told, "vec").select("id", "n_links", "component")
            .unionByName(alone))

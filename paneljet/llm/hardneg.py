"""Hard-negative mining with exact integer scores from a residue-number-system matrix product.

Components are scaled and floored to whole numbers. The scores of a block of anchors against a
block of rows are their inner products: both blocks are reduced modulo several small primes, the
residues multiplied in float32 (every partial sum stays under 2^24, so each is exact), and the
signed scores put together from the remainders by Chinese remaindering (mixed radix). The number
of primes follows from the longest vector: the Cauchy-Schwarz bound of every score lies within
half the primes' product.

Anchors and rows meet in a grid: anchors are dealt into groups and rows into tiles of bounded
size, rows are copied to every anchor group of their length, and one task compares one group
with one tile. The first pass keeps each tile's best rows of the anchor's label, whose best
over all tiles are the positives; the second pass keeps each tile's best rows inside every
positive's window. Only those go on, through a ranking per anchor or per positive; neither
a label nor an anchor is ever gathered whole.

Defined cases: rows whose id, label or vector is null, or with a null or non-finite component,
take no part; vectors are compared with those of their own length only (empty ones score
zero); rows that repeat are rows of their own; of equal scores the smaller id comes first, of
equal ids any; scores that could pass 4 * 10^18 raise an error; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.util import cut_lineage
from .common import ship_package

PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
MOST = 4e18                  # half the product of all primes, about
TILE = 1 << 22               # components of a tile of rows
GROUP = 1 << 20              # components of a group of anchors
CHUNK = 1 << 8               # anchors scored at a time
SPAN = 1 << 10               # components of one float32 product: 1024 * 125^2 < 2^24


def primes_for(bound: float) -> tuple[int, ...]:
    """The fewest primes whose product is over twice ``bound`` (the largest size of a score)."""
    product = 1
    for k, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[:k + 1]
    raise ValueError(f"scores of up to {bound:g} do not fit: scale the vectors down")


def residues(whole: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Remainders of whole numbers (held in double precision), between -p/2 and p/2, as float32."""
    out = []
    for p in primes:
        r = np.fmod(whole, p)
        r -= p * np.rint(r / p)
        out.append(r.astype(np.float32))
    return out


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact inner products (int64) of rows given by their residues."""
    value = radix = None
    for k, (a, b, p) in enumerate(zip(left, right, primes)):
        rest = np.zeros((len(a), len(b)), dtype=np.int64)
        for at in range(0, a.shape[1], SPAN):
            rest += (a[:, at:at + SPAN] @ b[:, at:at + SPAN].T).astype(np.int64)
        if value is None:
            value, radix = rest % p, p
        else:                                   # the next digit in mixed radix
            digit = (rest - value) % p * pow(radix, -1, p) % p
            value += digit * radix
            radix *= p
    value[value > radix // 2] -= radix
    return value


def _grid(rows: DataFrame) -> DataFrame:
    """``rows`` with the grid of their length: ``tiles`` of rows and ``groups`` of anchors."""
    parallel = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = F.greatest(F.col("dim"), F.lit(1))
    shape = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("m"))
    # as many tiles as the bound on their size asks for, and enough of them to go round
    tiles = F.greatest(F.ceil(F.col("n") * n / TILE), F.least(F.lit(parallel), F.ceil(F.col("n") / 256)))
    return shape.where("m > 0").select(F.col("dim").alias("of"), tiles.cast("int").alias("tiles"),
                                       F.ceil(F.col("m") * n / GROUP).cast("int").alias("groups"))


def _compare(rows: DataFrame, anchors: DataFrame, grid: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` on every anchor group with every tile of rows of its length."""
    row = rows.join(grid, rows.dim == grid.of)
    key = F.xxhash64("row")
    none = F.lit(None).cast(anchors.schema["windows"].dataType)
    tile = row.select("dim", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
                      F.pmod(key, F.col("tiles")).cast("int").alias("tile"), F.lit(False).alias("side"),
                      "row", "id", "label", "vec", none.alias("windows"))
    group = (anchors.join(grid, anchors.dim == grid.of)
             .select("dim", F.pmod(key, F.col("groups")).cast("int").alias("group"),
                     F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
                     F.lit(True).alias("side"), "row", "id", "label", "vec", "windows"))
    ship_package(rows.sparkSession)
    # tasks are short of bytes but long of work: a fixed number of partitions is not coalesced
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = tile.unionByName(group).repartition(parts, "dim", "group", "tile")
    return cells.groupBy("dim", "group", "tile").applyInArrow(fn, schema)


def _sides(table: pa.Table, scale: float, primes: tuple[int, ...]):
    """Anchors and rows (the latter by label and id) of a task with their residues."""
    dim = table.column("dim")[0].as_py()
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    whole = np.floor(scale * flat.astype(np.float64)).reshape(len(table), dim)
    side = table.column("side").to_numpy()
    num, ident, label = (table.column(c).to_numpy() for c in ("row", "id", "label"))
    a, b = np.flatnonzero(side), np.flatnonzero(~side)
    b = b[np.lexsort((num[b], ident[b], label[b]))]
    return a, b, num, ident, label, residues(whole[a], primes), residues(whole[b], primes)


def _first(score: np.ndarray, places: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` of ``places`` with the highest scores, ties by smaller id."""
    if len(places) > most:
        value = score[places]
        places = places[value >= np.partition(value, len(value) - most)[len(value) - most]]
    return places[np.lexsort((ident[places], -score[places]))][:most]


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score): hard negatives.

    An anchor (a row where ``is_anchor`` holds) has as positives its ``positives`` other rows of
    the same label with the highest scores; for each, the ``negatives`` rows of another label
    with the highest scores from ``low`` to ``high`` per cent of the positive's are returned.
    """
    vec = F.col(vec_col)
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    size = F.aggregate(vec, F.lit(0.0), lambda s, x: s + F.floor(x.cast("double") * scale).cast("double") ** 2)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           vec.alias("vec"), F.size(vec).alias("dim"),
                           F.coalesce(is_anchor, F.lit(False)).alias("anchor"), size.alias("norm"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & fine))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    primes = primes_for((rows.agg(F.max("norm")).first()[0] or 0.0) * (1 + 1e-9))
    grid = cut_lineage(_grid(rows))
    anchors = rows.where("anchor")

    def nearest(table: pa.Table) -> pa.Table:
        a, b, num, ident, label, left, right = _sides(table, scale, primes)
        out = [[], [], [], []]
        for at in range(0, len(a), CHUNK):
            block = scores([x[at:at + CHUNK] for x in left], right, primes)
            for i, score in zip(a[at:at + CHUNK], block):
                lo, hi = (np.searchsorted(label[b], label[i], s) for s in ("left", "right"))
                same = np.arange(lo, hi)
                best = _first(score, same[num[b[same]] != num[i]], ident[b], positives)
                for col, x in zip(out, (np.full(len(best), num[i]), num[b[best]], ident[b[best]], score[best])):
                    col.append(x)
        return pa.table([np.concatenate(c) if c else np.zeros(0, np.int64) for c in out],
                        names=["row", "other", "id", "score"])

    none = F.lit(None).cast("array<struct<id: long, other: long, score: long>>").alias("windows")
    near = _compare(rows, anchors.select("row", "id", "label", "vec", "dim", none), grid, nearest,
                    "row long, other long, id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "id", "other")
    # at most ``positives`` of an anchor
    found = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    windows = found.groupBy(F.col("row").alias("of_row")).agg(
        F.collect_list(F.struct("id", "other", "score")).alias("windows"))
    ready = cut_lineage(anchors.join(windows, F.col("row") == F.col("of_row"))
                        .select("row", "id", "label", "vec", "dim", "windows"))

    def between(table: pa.Table) -> pa.Table:
        a, b, num, ident, label, left, right = _sides(table, scale, primes)
        asked = table.column("windows")
        out = [[], [], [], [], [], [], []]
        for at in range(0, len(a), CHUNK):
            block = scores([x[at:at + CHUNK] for x in left], right, primes)
            for i, score in zip(a[at:at + CHUNK], block):
                lo, hi = (np.searchsorted(label[b], label[i], s) for s in ("left", "right"))
                wins = asked[int(i)].as_py()
                # 50 p <= 100 s <= 95 p, in whole numbers of any size
                floor = [-(-low * w["score"] // 100) for w in wins]
                top = [high * w["score"] // 100 for w in wins]
                other = np.flatnonzero(score >= min(floor))
                other = other[(other < lo) | (other >= hi)]
                for w, f, t in zip(wins, floor, top):
                    value = score[other]
                    best = _first(score, other[(value >= f) & (value <= t)], ident[b], negatives)
                    one = np.ones(len(best), np.int64)
                    for col, x in zip(out, (one * ident[i], one * num[i], one * w["id"], one * w["other"],
                                            ident[b[best]], score[best], one * w["score"])):
                        col.append(x)
        return pa.table([np.concatenate(c) if c else np.zeros(0, np.int64) for c in out],
                        names=["anchor", "row", "positive", "other", "negative", "negative_score",
                               "positive_score"])

    hard = _compare(rows, ready, grid, between, "anchor long, row long, positive long, other long, "
                                                "negative long, negative_score long, positive_score long")
    order = Window.partitionBy("row", "other").orderBy(F.desc("negative_score"), "negative")
    return (hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor", "positive", "rank", "negative", "positive_score", "negative_score"))

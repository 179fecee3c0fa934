"""Shared helpers of the training-data operators: Arrow text buffers, ranks, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.util import cut_lineage

SLICE_BYTES = 2 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once a context; tasks import them there."""
    sc = spark.sparkContext
    if getattr(sc, "_paneljet_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="paneljet-code-"), "paneljet_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._paneljet_shipped = True


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes (one text at least).

    Yields ``(first row, last row + 1, buffer, starts)``: the UTF-8 bytes of the run's texts,
    each followed by one space, and the start of every text plus the buffer's end. Null texts
    count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = memoryview(data) if data is not None else memoryview(b"")
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        o = offs[lo:hi + 1].tolist()
        buf = b" ".join([raw[a:b] for a, b in zip(o, o[1:])]) + b" "
        starts = offs[lo:hi + 1] - offs[lo] + np.arange(hi - lo + 1)
        yield lo, hi, np.frombuffer(buf, dtype=np.uint8), starts
        lo = hi


def word_bounds(is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-gap bytes; the buffer ends with a gap."""
    word = ~is_gap
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:ends[i]]`` (empty segments give zero), in double precision."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ends] - total[starts]


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(modulus)


def rank_within(df: DataFrame, group: str, order: list[str], out: str, parts: int) -> DataFrame:
    """Gapless rank from 0 inside each ``group`` without one task per group.

    Rows are dealt into ``parts`` slices of a group by a hash of the ordering columns, ranked
    inside (group, slice), and shifted by the counts of the group's earlier slices: a table of
    groups x ``parts`` rows. ``order`` must tell rows apart, or tied rows be equal.
    """
    s, at, n = f"__{out}_slice", f"__{out}_at", f"__{out}_n"
    cut = df.withColumn(s, F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(parts)).cast("int"))
    sizes = (cut.groupBy(group, s).agg(F.count(F.lit(1)).alias(n))
             .withColumn(at, F.sum(n).over(Window.partitionBy(group).orderBy(s)) - F.col(n))
             .select(F.col(group).alias(f"__{out}_g"), F.col(s).alias(f"__{out}_s"), at))
    inner = F.row_number().over(Window.partitionBy(group, s).orderBy(*order)) - 1
    return (cut.withColumn(out, inner)
            .join(sizes, (F.col(group) == F.col(f"__{out}_g")) & (F.col(s) == F.col(f"__{out}_s")))
            .withColumn(out, (F.col(out) + F.col(at)).cast("long"))
            .drop(s, at, f"__{out}_g", f"__{out}_s"))


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long) -> (node, component).

    ``component`` is the smallest node reachable. Alternates large-star and small-star steps:
    every node's neighbours are hung on its smallest neighbour, until the edges form stars.
    Hub nodes are combined map-side (minimum per node) and joined back; rounds are cut by
    checkpoints. Only one checksum a round reaches the driver. Isolated nodes are not listed.
    """
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.join(low, both.a == low.u).where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: neighbours below u, and u itself, hang on the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = (large.join(least, large.a == least.u)
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a").alias("a"), F.col("m").alias("b"))))
                         .alias("p")).select("p.a", "p.b").where("a <> b").distinct())
        obs = Observation()
        e = cut_lineage(small.observe(obs, F.count(F.lit(1)).alias("n"),
                                      F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")))
        now = (obs.get["n"], obs.get["h"])
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
    raise RuntimeError("components did not settle")

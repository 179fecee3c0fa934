"""SimHash near-duplicates with a pigeonring join.

Fingerprint: majority bits of the 64-bit hashes of word shingles. Join: the 64 bits form a ring
of ``distance + 1`` segments. If two fingerprints differ in at most ``distance`` bits, some
segment starts a chain in which the first k segments differ in at most k * distance / segments
bits, for every k. For distance 4 and 5 segments: the first segment is equal, the first two
differ in at most 1 bit, three in 2, four in 3, all in 4. The first two conditions are an equi-join key
(the second segment with one bit flipped on one side), the others filter inside the join before
the full Hamming test, so candidates cost only the pairs that share about 26 bits.

Defined cases: a null or empty text (or one of only spaces) has fingerprint zero and is linked
like any other; texts with fewer words than a shingle hash their whole word sequence; equal
fingerprints are one node of the graph, so copies are never expanded into pairs; an empty table
gives no rows; extra columns are ignored; rows with the same id are each returned, with the
component of their own fingerprint; a null id takes part but can't be a component's name unless
its whole component has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from .common import LOWER, SPACES, components, map_arrow, text_slices, word_bounds

# XXH64 constants (fixed values of the public algorithm)
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161,
    9650029242287828579, 2870177450012600261))
LONG = 160          # longer shingles are hashed one by one
SPREAD = np.array([int.from_bytes(bytes((b >> (7 - i)) & 1 for i in range(8)), "little")
                   for b in range(256)], dtype=np.uint64)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def xxh64_equal_length(words64: np.ndarray, buf: np.ndarray, at: np.ndarray, n: int,
                       seed: int) -> np.ndarray:
    """XXH64 of ``buf[at:at+n]`` for many ``at``; ``words64[i]`` holds the 8 bytes from i."""
    s = np.uint64(seed)
    done = 0
    if n >= 32:
        v = [np.full(len(at), x, dtype=np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
        while done + 32 <= n:
            v = [_round(acc, words64[at + (done + 8 * i)]) for i, acc in enumerate(v)]
            done += 32
        h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for acc in v:
            h = (h ^ _round(np.uint64(0), acc)) * P1 + P4
    else:
        h = np.full(len(at), s + P5, dtype=np.uint64)
    h = h + np.uint64(n)
    while done + 8 <= n:
        h = _rotl(h ^ _round(np.uint64(0), words64[at + done]), 27) * P1 + P4
        done += 8
    if done + 4 <= n:
        h = _rotl(h ^ ((words64[at + done] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        done += 4
    while done < n:
        h = _rotl(h ^ (buf[at + done].astype(np.uint64) * P5), 11) * P1
        done += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of every span of ``buf``, computed length by length."""
    out = np.empty(len(start), dtype=np.uint64)
    padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    words64 = np.ascontiguousarray(
        np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,)))
    size = end - start
    order = np.argsort(np.minimum(size, LONG + 1).astype(np.uint16), kind="stable")
    edges = np.searchsorted(size[order].clip(max=LONG + 1), np.arange(LONG + 3))
    with np.errstate(over="ignore"):
        for n in range(LONG + 1):
            rows = order[edges[n]:edges[n + 1]]
            if len(rows):
                out[rows] = xxh64_equal_length(words64, buf, start[rows], n, seed)
    rest = order[edges[LONG + 1]:]
    view = memoryview(buf)
    out[rest] = [xxhash.xxh64_intdigest(view[a:b], seed)
                 for a, b in zip(start[rest].tolist(), end[rest].tolist())]
    return out


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per group of consecutive hashes (``first``: start of each group, none empty): the bits set
    in over half of them."""
    last = np.append(first[1:], len(hashes))
    lens = last - first
    # blocks of at most 255 hashes, so that one byte holds a block's count of a bit
    per = -(-lens // 255)
    group = np.repeat(np.arange(len(first)), per)
    within = np.arange(len(group)) - np.repeat(np.cumsum(per) - per, per)
    block = first[group] + 255 * within
    spread = SPREAD[hashes.astype(">u8").view(np.uint8).reshape(-1, 8)]
    counts = np.add.reduceat(spread, block, axis=0).view(np.uint8).reshape(-1, 64)
    bits = np.add.reduceat(counts, np.cumsum(per) - per, axis=0, dtype=np.int64)
    return np.packbits(2 * bits > lens[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(column: pa.Array, shingle: int, seed: int = 42) -> np.ndarray:
    """64-bit fingerprints of a string column (A-Z lower-cased, ASCII white space splits words)."""
    out = np.zeros(len(column), dtype=np.uint64)
    for lo, hi, data, starts in text_slices(column):
        low = LOWER[data]
        gap = SPACES[low]
        ws, we = word_bounds(gap)
        if not len(ws):
            continue
        # words joined by single spaces: word bytes plus the gap byte right after a word
        keep = ~gap
        keep[we] = True
        buf = np.where(gap, np.uint8(32), low)[keep]
        size = we - ws
        start = np.cumsum(size + 1) - (size + 1)
        end = start + size
        doc = np.searchsorted(starts, ws, side="right") - 1
        words = np.bincount(doc, minlength=hi - lo)
        first = np.cumsum(words) - words
        count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
        has = np.flatnonzero(count)
        base = np.cumsum(count) - count
        at = np.repeat(first[has], count[has]) + (
            np.arange(count.sum()) - np.repeat(base[has], count[has]))
        until = at + np.repeat(np.minimum(words[has], shingle), count[has]) - 1
        out[lo + has] = majority(hash_spans(buf, start[at], end[until], seed), base[has])
    return out


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int,
                     seed: int = 42) -> DataFrame:
    """(id, fp): the signed 64-bit form of every row's fingerprint."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints(b.column(1), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")
                       ).transform(map_arrow, run, f"id {kind}, fp long")


def _rotate(fp: Column, by: int) -> Column:
    if by == 0:
        return fp
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def similar_pairs(nodes: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (id, fp; distinct fp) at most ``distance`` bits apart, each at
    least once, either way round, by the pigeonring join."""
    m = distance + 1
    width = [64 // m + (1 if i < 64 % m else 0) for i in range(m)]
    ring = []
    at = 0
    for i in range(m):
        w = [width[(i + k) % m] for k in range(m)]
        two = sum(w[:2])
        # prefix masks of 1..m segments and the bits each may differ in
        budget = [(sum(w[:k]), k * distance // m) for k in range(1, m + 1)]
        ring.append((i, at, w[1], two, budget))
        at += width[i]

    def key(r: Column, two: int) -> Column:
        return F.shiftrightunsigned(r, 64 - two)

    def entries(flips: bool) -> DataFrame:
        # A pair that differs in one bit of the second segment has a zero there on one side:
        # that side's flipped entry meets the other's plain one.
        items = []
        for i, off, second, two, _ in ring:
            r = _rotate(F.col("fp"), off)
            k = key(r, two)
            items.append(F.struct(F.lit(i).alias("ring"), k.alias("k"), r.alias("r")))
            if flips:
                for bit in range(second):
                    items.append(F.when(F.shiftrightunsigned(k, bit).bitwiseAND(F.lit(1)) == 0,
                                        F.struct(F.lit(i).alias("ring"),
                                                 k.bitwiseOR(F.lit(1 << bit)).alias("k"),
                                                 r.alias("r"))))
        e = F.filter(F.array(*items), lambda x: x.isNotNull())
        return nodes.select("id", F.explode(e).alias("e")).select("id", "e.ring", "e.k", "e.r")

    plain = entries(False).alias("p")
    flipped = entries(True).alias("q")
    diff = F.col("p.r").bitwiseXOR(F.col("q.r"))
    chain = F.lit(False)
    for i, _, _, _, budget in ring:
        ok = F.col("p.ring") == i
        for bits, most in budget:
            ok = ok & (F.bit_count(F.shiftrightunsigned(diff, 64 - bits)) <= most)
        chain = chain | ok
    on = ((F.col("p.ring") == F.col("q.ring")) & (F.col("p.k") == F.col("q.k"))
          & (F.col("p.id") != F.col("q.id")) & chain)
    return plain.join(flipped, on).select(F.col("p.id").alias("a"), F.col("q.id").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id of its group.

    Rows are in one group when a chain of links (at most ``distance`` differing bits) joins them.
    """
    if not 1 <= distance <= 15:
        raise ValueError("distance must be 1 to 15")
    fps = cut_lineage(with_fingerprint(docs, id_col, text_col, shingle, seed))
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min("id").alias("id")))
    # a fingerprint is its node's number in the graph; ids only name components afterwards
    graph = nodes.select(F.col("fp").alias("id"), "fp")
    comp = components(similar_pairs(graph, distance))
    named = (nodes.join(comp, nodes.fp == comp.node, "left")
             .select("fp", "id", F.coalesce("component", "fp").alias("c")))
    least = named.groupBy("c").agg(F.min("id").alias("component"))
    named = named.select("fp", "c").join(least, "c").select(F.col("fp").alias("__fp"), "component")
    return fps.join(named, fps.fp == named["__fp"]).select("id", "fp", "component")

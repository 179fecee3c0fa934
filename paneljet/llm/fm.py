"""Text quality by a factorisation machine.

Inputs of a score: the text's hashed words (term frequencies, unit length), structure statistics and
optional numeric metadata columns, standardised. The machine adds to a linear score the
interactions <v_i, v_j> x_i x_j of all pairs, in linear time by the sum-of-squares identity:
sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2) / 2. It is fitted with AdaGrad on a bounded
sample of labelled rows (``max_rows``, those with the smallest hash of the id), whose sparse
features alone reach the driver; scoring is a pass over all rows.

Defined cases: null and empty texts have no words and zero statistics, and get a score like any
other; null metadata counts as the sample's mean; ids with several labels take their majority (a tie counts as 1); with no labelled
rows, or only one label, the score is the smoothed share of label 1; repeated rows
are scored each; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from .common import SPACES, map_arrow, text_slices, word_bounds
from .decontam import span_hashes
from .langid import fold_case

BUCKETS = 1 << 13
FACTORS = 8
MAX_ROWS = 6000
_CLASS = np.zeros(256, dtype=np.int8)      # byte classes: 1 digit, 2 capital, 3 punctuation, 4 symbol, 5 high
_CLASS[48:58] = 1
_CLASS[65:91] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 4
_CLASS[128:] = 5
STATS = ("bytes", "words", "word_length", "distinct", "top_word", "digits", "capitals",
         "punctuation", "symbols", "high", "lines", "line_words", "repeated_lines", "sentences")


def slice_features(data: np.ndarray, starts: np.ndarray, buckets: int = BUCKETS
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word features and statistics of a slice: (text, bucket, value) triples by text, and a
    texts x statistics matrix."""
    n = len(starts) - 1
    ws, we = word_bounds(SPACES[data])
    doc = np.searchsorted(starts, ws, side="right") - 1
    h = span_hashes(fold_case(data), ws, we)
    bucket = (h >> np.uint64(40)).astype(np.int64) % buckets
    key, count = np.unique(doc * buckets + bucket, return_counts=True)
    d, b = key // buckets, key % buckets
    norm = np.sqrt(np.bincount(d, weights=count.astype(float) ** 2, minlength=n))
    value = count / norm[d]

    size = np.diff(starts) - 1.0
    words = np.bincount(doc, minlength=n).astype(float)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    kind = _CLASS[data]
    share = []
    for k in range(1, 6):
        at = np.flatnonzero(kind == k)
        share.append(np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=n) / per_byte)
    top = np.zeros(n)
    np.maximum.at(top, d, count)
    ls, le = word_bounds((data == 10) | _ends(len(data), starts))
    line_doc = np.searchsorted(starts, ls, side="right") - 1
    lines = np.bincount(line_doc, minlength=n).astype(float)
    line_key = span_hashes(data, ls, le) ^ (line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(line_key, return_index=True)
    own = np.bincount(line_doc[at], minlength=n)
    per_line = np.maximum(lines, 1)
    stops = np.flatnonzero((data == 46) | (data == 33) | (data == 63))
    stop = np.bincount(np.searchsorted(starts, stops, side="right") - 1, minlength=n)
    stats = np.stack([
        np.log1p(size), np.log1p(words),
        np.bincount(doc, weights=(we - ws).astype(float), minlength=n) / per_word,
        np.bincount(d, minlength=n) / per_word, top / per_word, *share, np.log1p(lines),
        np.log1p(words / per_line), 1 - own / per_line, stop / per_word], axis=1)
    stats[size <= 0] = 0.0
    return d, b, value, stats


def _ends(n: int, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[starts[1:] - 1] = True
    return out


@dataclass
class Machine:
    """Fitted weights; inputs are word buckets, then statistics and metadata."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def score(self, n: int, row: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        """Probability of label 1 for sparse rows (entries sorted by row)."""
        z = np.full(n, self.bias)
        z += np.bincount(row, weights=self.w[idx] * val, minlength=n)
        for f in range(self.v.shape[1]):
            x = self.v[idx, f] * val
            s = np.bincount(row, weights=x, minlength=n)
            z += 0.5 * (s * s - np.bincount(row, weights=x * x, minlength=n))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4)


def _entries(d, b, value, dense, buckets):
    """Sparse entries of word triples plus dense columns."""
    n, k = dense.shape
    row = np.concatenate([d, np.repeat(np.arange(n), k)])
    idx = np.concatenate([b, np.tile(buckets + np.arange(k), n)])
    return row, idx, np.concatenate([value, dense.ravel()])


def fit(words: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, y: np.ndarray,
        buckets: int = BUCKETS, factors: int = FACTORS, epochs: int = 12, batch: int = 128,
        rate: float = 0.08, decay: float = 1e-4, seed: int = 5) -> Machine:
    """AdaGrad on the logistic loss. ``words``: (buckets, values) of every row."""
    known = ~np.isnan(stats)
    mean = np.where(known, stats, 0).sum(0) / np.maximum(known.sum(0), 1)
    stats = np.where(known, stats, mean)
    scale = np.maximum(stats.std(0), 1e-6)
    k = stats.shape[1]
    rng = np.random.default_rng(seed)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(buckets + k),
                rng.normal(0, 0.01, (buckets + k, factors)), mean, scale)
    if len(set(y.tolist())) < 2:
        m.v[:] = 0
        return m
    dense = m.dense(stats)
    gw, gv, gb = np.full(len(m.w), 1e-6), np.full(m.v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            pick = order[lo:lo + batch]
            d = np.repeat(np.arange(len(pick)), [len(words[i][0]) for i in pick])
            b = np.concatenate([words[i][0] for i in pick])
            x = np.concatenate([words[i][1] for i in pick])
            row, idx, val = _entries(d, b, x, dense[pick], buckets)
            g = (m.score(len(pick), row, idx, val) - y[pick]) / len(pick)
            used, at = np.unique(idx, return_inverse=True)
            grow = g[row] * val
            dw = np.bincount(at, weights=grow, minlength=len(used)) + decay * m.w[used]
            dv = np.empty((len(used), m.v.shape[1]))
            for f in range(m.v.shape[1]):
                vx = m.v[idx, f] * val
                s = np.bincount(row, weights=vx, minlength=len(pick))
                dv[:, f] = np.bincount(at, weights=grow * (s[row] - vx), minlength=len(used))
            dv += decay * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            m.w[used] -= rate * dw / np.sqrt(gw[used])
            m.v[used] -= rate * dv / np.sqrt(gv[used])
            db = g.sum()
            gb += db * db
            m.bias -= rate * db / np.sqrt(gb)
    return m


def _metadata(batch: pa.RecordBatch, first: int) -> np.ndarray:
    cols = [c.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            for c in batch.columns[first:]]
    out = np.stack(cols, axis=1) if cols else np.zeros((batch.num_rows, 0))
    return np.sign(out) * np.log1p(np.abs(out))


def train(rows: DataFrame, votes: DataFrame, metadata: list[str], max_rows: int = MAX_ROWS,
          buckets: int = BUCKETS) -> Machine:
    """Fit on the ``max_rows`` ids of ``votes`` (id, label) with the smallest hashes, with the
    texts of ``rows`` (id, text, metadata); of rows that repeat an id, one, that with the smallest
    hash, so no more than ``max_rows`` rows are collected."""
    votes = (votes.where("label IS NOT NULL AND id IS NOT NULL").groupBy(F.col("id").alias("i"))
             .agg(F.avg(F.col("label").cast("double")).alias("y")))
    picked = cut_lineage(votes.orderBy(F.xxhash64(F.col("i").cast("string")), "i").limit(max_rows))
    # picked has at most max_rows rows, so it may be broadcast
    cols = ["t", *[f"m{k}" for k in range(len(metadata))]]
    found = rows.join(F.broadcast(picked), F.col("id") == F.col("i")).select(
        "i", F.col("text").cast("string").alias("t"), (F.col("y") >= 0.5).cast("int").alias("y"),
        *[F.col(c).cast("double").alias(m) for c, m in zip(metadata, cols[1:])])
    found = found.withColumn("h", F.xxhash64(*[x for c in cols for x in (F.col(c), F.isnull(c))]))
    least = cut_lineage(found.groupBy(F.col("i").alias("i0")).agg(F.min("h").alias("h0")))
    sample = found.join(F.broadcast(least), (F.col("i") == F.col("i0")) & (F.col("h") == F.col("h0"))
                        ).select("t", "y", *cols[1:], "i")
    kind = sample.schema["i"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            first = []                    # rows equal in id and hash: one a task
            for r, i in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if i not in seen:
                    seen.add(i)
                    first.append(r)
            if not first:
                continue
            batch = batch.take(pa.array(first, pa.int64()))
            ids = batch.column(batch.num_columns - 1)
            meta = _metadata(batch.select(list(range(batch.num_columns - 1))), 2)
            for lo, hi, data, starts in text_slices(batch.column(0)):
                d, b, x, stats = slice_features(data, starts, buckets)
                stats = np.concatenate([stats, meta[lo:hi]], axis=1)
                cut = pa.array(np.searchsorted(d, np.arange(hi - lo + 1)).astype(np.int32))
                k = stats.shape[1]
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(cut, pa.array(b.astype(np.int32))),
                    pa.ListArray.from_arrays(cut, pa.array(x.astype(np.float64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * k),
                                             pa.array(stats.ravel())),
                    ids.slice(lo, hi - lo)], names=["y", "b", "x", "s", "i"])

    got = (sample.transform(map_arrow, run, f"y int, b array<int>, x array<double>, s array<double>, i {kind}")
           .dropDuplicates(["i"]).drop("i").toPandas())
    # missing metadata as a number: the hash of a NaN differs from object to object
    got["h"] = [hash((y, len(b), tuple(np.nan_to_num(s, nan=-1e9)))) for y, b, s in zip(got.y, got.b, got.s)]
    got = got.sort_values("h", kind="stable")     # the order rows arrive in doesn't matter
    if not len(got):
        k = len(STATS) + len(metadata)
        return Machine(0.0, np.zeros(buckets + k), np.zeros((buckets + k, 1)), np.zeros(k), np.ones(k))
    words = [(np.asarray(b, dtype=np.int64), np.asarray(x)) for b, x in zip(got.b, got.x)]
    return fit(words, np.stack(got.s.to_list()), got.y.to_numpy(dtype=float), buckets)


def score(rows: DataFrame, machine: Machine, metadata: list[str]) -> DataFrame:
    """(id, score) of every row of ``rows`` (id, text, metadata)."""
    kind = rows.schema["id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        buckets = len(m.w) - len(m.mean)
        for batch in batches:
            meta = _metadata(batch, 2)
            out = np.zeros(batch.num_rows)
            for lo, hi, data, starts in text_slices(batch.column(1)):
                d, b, x, stats = slice_features(data, starts, buckets)
                stats = np.concatenate([stats, meta[lo:hi]], axis=1)
                dense = m.dense(np.where(np.isnan(stats), m.mean, stats))
                out[lo:hi] = m.score(hi - lo, *_entries(d, b, x, dense, buckets))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["id", "score"])

    return rows.select("id", F.col("text").cast("string").alias("t"),
                       *[F.col(c).cast("double") for c in metadata]
                       ).transform(map_arrow, run, f"id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, learned: Column, id_col: str = "doc_id",
            text_col: str = "text", label_col: str = "quality", metadata: tuple[str, ...] = (),
            max_rows: int = MAX_ROWS) -> DataFrame:
    """(id, score) of every row of ``docs``; ``learned`` is a condition on ``labels``' id."""
    meta = [f"meta{j}" for j in range(len(metadata))]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(m) for c, m in zip(metadata, meta)])
    votes = labels.where(learned).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    machine = train(rows, votes, meta, max_rows)
    return score(rows, machine, meta)

"""Runs of periodically repeated words, by a descending-LCP Kruskal over suffix classes.

A run is a stretch of consecutive words with smallest period q, at least ``max(min_words, 2 q)``
long, that no neighbouring word extends. If it starts at s, the suffixes at s and s + q share
exactly the length less q words, and no suffix between them shares as many (the run would have a
smaller period). So neighbours in the suffix array are united by decreasing common prefix l with
union-find, every class keeping its positions in order; when a merge makes two positions at a
distance d <= l neighbours, the stretch of d + l words from the first has period d. It is a run
where the word before it breaks the period, and its smallest seed is its period.

Only suffixes that share ``min_words / 2`` words with another of their text can take part, so
texts without such a repeat are passed over, and classes of short prefixes are never formed.
Words (runs of bytes other than ASCII white space) are told apart by 64-bit hashes. Every text
is one document's work: nothing is shuffled, and texts of a batch share the array operations.

Defined cases: a null text has no words; empty texts and texts of white space alone likewise;
repeated rows and null ids are each judged for themselves; of equal stretches the smallest
period counts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, map_arrow, text_slices, word_bounds
from .simhash import hash_spans
from .suffix import common_prefix, name_levels

MIX = np.uint64(0x9E3779B97F4A7C15)


def repeating(words: np.ndarray, doc: np.ndarray, n_docs: int, span: int) -> np.ndarray:
    """Flags of the documents in which some ``span`` consecutive words come twice."""
    flags = np.zeros(n_docs, dtype=bool)
    n = len(words) - span + 1
    if n <= 0:
        return flags
    with np.errstate(over="ignore"):
        gram = doc[:n].astype(np.uint64) * MIX
        for k in range(span):
            gram = (gram ^ words[k:n + k]) * MIX
            gram ^= gram >> np.uint64(29)
    whole = np.flatnonzero(doc[:n] == doc[span - 1:])
    gram = gram[whole]
    order = np.argsort(gram)
    same = np.flatnonzero(gram[order[1:]] == gram[order[:-1]])
    flags[doc[whole[order[same]]]] = True
    return flags


def kruskal_seeds(left: list[int], right: list[int], common: list[int], min_words: int
                  ) -> list[tuple[int, int, int]]:
    """Seeds (start, distance, common prefix) from suffix-array neighbours by descending LCP."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds = []

    def root(x: int) -> int:
        if x not in parent:
            parent[x] = x
            members[x] = [x]
            return x
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b, shared in zip(left, right, common):
        a, b = root(a), root(b)
        few, many = members[a], members[b]
        if len(few) > len(many):
            a, b, few, many = b, a, many, few
        places = [bisect_left(many, x) for x in few]
        for x, k in zip(few, places):
            if k and x - many[k - 1] <= shared and x - many[k - 1] + shared >= min_words:
                seeds.append((many[k - 1], x - many[k - 1], shared))
            if k < len(many) and many[k] - x <= shared and many[k] - x + shared >= min_words:
                seeds.append((x, many[k] - x, shared))
        if 8 * len(few) < len(many):
            for x, k in zip(reversed(few), reversed(places)):
                many.insert(k, x)
        else:
            many += few
            many.sort()
        parent[a] = b
        members[b] = many
        del members[a]
    return seeds


def find_runs(words: np.ndarray, doc: np.ndarray, min_words: int) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period. ``words`` are the word
    numbers of texts that follow one another, ``doc`` the text of each word, starts are places
    in ``words``."""
    if not len(words):
        return np.zeros((0, 3), dtype=np.int64)
    size = np.bincount(doc)
    ends = np.cumsum(size)[doc]
    ids = np.unique(words, return_inverse=True)[1]
    symbols = doc.astype(np.int64) * (ids.max() + 1) + ids
    levels = name_levels(symbols, ends)
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1], order[1:]
    least = (min_words + 1) // 2
    near = np.flatnonzero(doc[a] == doc[b])
    a, b = a[near], b[near]
    shared = common_prefix(levels, ends, a, b)
    near = np.flatnonzero(shared >= least)
    near = near[np.argsort(-shared[near], kind="stable")]
    found = kruskal_seeds(a[near].tolist(), b[near].tolist(), shared[near].tolist(), min_words)
    seeds = np.array(found, dtype=np.int64).reshape(-1, 3)
    start, period, length = seeds[:, 0], seeds[:, 1], seeds[:, 1] + seeds[:, 2]
    before = np.maximum(start - 1, 0)
    breaks = (start == ends[start] - size[doc[start]]) | (symbols[before] != symbols[before + period])
    runs = np.stack([start, length, period], axis=1)[breaks]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):       # one run a stretch: its smallest period
        first = np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))
        runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(data: np.ndarray, gap: np.ndarray, size: np.ndarray, we: np.ndarray,
               doc: np.ndarray, kept: np.ndarray, n_docs: int) -> pa.Array:
    """Texts of the kept words, joined by single spaces."""
    bytes_of = ~gap
    bytes_of[we] = True
    joined = np.where(gap, np.uint8(32), data)[bytes_of]
    last = np.full(n_docs, -1)
    at = np.flatnonzero(kept)
    last[doc[at]] = at                                  # the last kept word has no space after it
    keep = np.repeat(kept, size + 1)
    stop = last[last >= 0]
    keep[np.cumsum(size + 1)[stop] - 1] = False
    lengths = np.bincount(doc[at], weights=size[at] + 1, minlength=n_docs).astype(np.int64)
    lengths -= last >= 0
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.LargeStringArray.from_buffers(
        n_docs, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined[keep].tobytes()))


def slice_runs(data: np.ndarray, starts: np.ndarray, min_words: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of texts in one buffer: words of each, runs of each (row splits), runs, collapsed texts."""
    n_docs = len(starts) - 1
    gap = SPACES[data]
    ws, we = word_bounds(gap)
    doc = np.searchsorted(starts, ws, side="right") - 1
    counts = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(counts) - counts
    words = hash_spans(data, ws, we, 0) if len(ws) else np.zeros(0, np.uint64)
    at = np.flatnonzero(repeating(words, doc, n_docs, (min_words + 1) // 2)[doc]) if len(ws) else ws
    runs = find_runs(words[at], np.unique(doc[at], return_inverse=True)[1], min_words)
    runs[:, 0] = at[runs[:, 0]]
    drop = np.zeros(len(ws) + 1, dtype=np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(drop)[:-1] == 0
    text = _collapsed(data, gap, we - ws, we, doc, kept, n_docs)
    of = doc[runs[:, 0]]
    runs[:, 0] -= first[of]
    return counts, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_docs))]), runs, text


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = 12) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: its runs by start and period, and its words
    without those that a run holds after its first period, joined by single spaces."""
    if min_words < 2:
        raise ValueError("min_words must be 2 at least")
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_words", "runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, starts in text_slices(batch.column(1)):
                counts, splits, runs, text = slice_runs(data, starts, min_words)
                rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)],
                                                  names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(splits.astype(np.int32)), rows),
                     text.cast(pa.string())], names=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")
                       ).transform(map_arrow, run, f"id {kind}, n_words long, runs array<struct<"
                                   "start: long, length: long, period: long>>, collapsed string")

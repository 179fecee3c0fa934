"""Benchmark decontamination: word-pair seeds, then Smith-Waterman alignment.

Texts and items are word sequences (case folded, punctuation and white space separate words). A
passage whose local alignment with an item (match +2, mismatch and gap -1 a word) scores at least
``threshold`` of the item's self-score is a leak.

Seeds miss none of them. Let an item have L words, the alignment M matches and E edits: from
2M - E >= 2 * threshold * L, at most M - threshold * L of the M - 1 steps from one match to the next hold
two edits or more. The other steps, at least ceil(threshold * L) - 1, go one or two words on in the
item and in the text. So a pass over all documents looks up the pairs (p, p + 1) and (p, p + 2) of
every text position among such pairs of the items, and aligns wherever that many positions hit one
item within the (3 - 2 * threshold) * L words that an alignment can span. Pairs that more than
``rare`` of a block's items share are not looked up; the count is lowered by all they could have
added, and they make up half of it at most. The passages aligned depend on the text and the
benchmark only, not on how many documents hold them.

An item of fewer than ``n`` words leaks as a whole only. At least one pair must hit, which matters for
thresholds of up to one word of an item.

The benchmark is taken in blocks of at most about BLOCK_BYTES (a stated query set): each block's grams
and words are broadcast, so the broadcast is bounded whatever the benchmark's size.

Defined cases: null, empty and word-less texts and items match nothing; items equal in words are
each reported; a document with several passages of an item reports its best, the first one in a
tie; repeated rows are reported once per id, an id that is null not at all; texts are read whole;
empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, map_arrow, text_slices, word_bounds
from .langid import fold_case

BLOCK_BYTES = 4 << 20
PASS_BYTES = 512 << 10                      # of text looked up at once: bounds the hits held
MATCH, MISS, GAP = 2, -1, -1
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_MIX = np.uint64(0xD6E8FEB86659FD93)
ALIGN_CELLS = 1 << 16                       # words of the passages that are aligned together
MIN_SHARED = 16                             # a pair that at most so many items share is rare
_NO_TEXT, _NO_ITEM = np.uint64(2 ** 64 - 1), np.uint64(2 ** 64 - 2)       # paddings: equal nothing


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, np.uint64(base), dtype=np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(29))) * _MIX
        return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by prefix sums of a polynomial modulo 2^64, mixed."""
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, dtype=np.uint64),
                                 np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)])
        return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def slice_words(data: np.ndarray, starts: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, ends, hashes, text index) of a slice."""
    low = fold_case(data)
    ws, we = word_bounds(~_WORD[low])
    return ws, we, span_hashes(low, ws, we), np.searchsorted(starts, ws, side="right") - 1


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (none if there are fewer)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = words[:m].copy()
        for k in range(1, n):
            h = h * np.uint64(0x100000001B3) + words[k:k + m]
    return mix(h)


def pair_hashes(words: np.ndarray, step: int) -> np.ndarray:
    """Hash of the words at each position and ``step`` further on, the same for every step."""
    with np.errstate(over="ignore"):
        return mix(words[:-step] * np.uint64(0x100000001B3) + words[step:])


def align_many(items: list[np.ndarray], passages: list[np.ndarray]
               ) -> tuple[np.ndarray, np.ndarray]:
    """(best local scores, their first ends in the passages) of Smith-Waterman over word hashes,
    each item with its passage; pairs of like length are aligned together."""
    best, at = np.zeros(len(items), dtype=np.int64), np.zeros(len(items), dtype=np.int64)
    order = sorted(range(len(items)), key=lambda k: (len(passages[k]), len(items[k])))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * len(passages[order[hi]]) <= ALIGN_CELLS:
            hi += 1
        part = order[lo:hi]
        m = len(passages[part[-1]])
        text = np.full((len(part), m), _NO_TEXT, dtype=np.uint64)
        query = np.full((len(part), max(len(items[k]) for k in part)), _NO_ITEM, dtype=np.uint64)
        for r, k in enumerate(part):
            text[r, :len(passages[k])] = passages[k]
            query[r, :len(items[k])] = items[k]
        steps = GAP * np.arange(m + 1, dtype=np.int32)
        rows = np.arange(len(part))
        score, end = np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
        prev = np.zeros((len(part), m + 1), dtype=np.int32)
        here = np.zeros_like(prev)
        for i in range(query.shape[1]):
            gain = np.where(text == query[:, i:i + 1], np.int32(MATCH), np.int32(MISS))
            here[:, 0] = 0
            np.maximum(prev[:, :-1] + gain, prev[:, 1:] + np.int32(GAP), out=here[:, 1:])
            np.maximum(here, 0, out=here)
            here -= steps
            np.maximum.accumulate(here, axis=1, out=here)         # gaps along the passage
            here += steps
            top = here.argmax(axis=1)
            now = here[rows, top]
            better = (now > score) | (now == score) & (top < end)
            score[better], end[better] = now[better], top[better]
            prev, here = here, prev
        best[part], at[part] = score, end
        lo = hi
    return best, at


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """``align_many`` of one pair."""
    best, at = align_many([item], [passage])
    return int(best[0]), int(at[0])


def _item_words(texts: list[str | None]) -> list[np.ndarray]:
    out = [np.zeros(0, dtype=np.uint64)] * len(texts)
    for lo, hi, data, starts in text_slices(pa.array(texts, pa.string())):
        _, _, h, doc = slice_words(data, starts)
        for i in range(hi - lo):
            out[lo + i] = h[doc == i]
    return out


def _aligned(found: list[tuple[int, int, np.ndarray]], words: list[np.ndarray], threshold: float
             ) -> Iterator[tuple[int, float, int, int]]:
    """(number in ``found``, score, first word, last word + 1) of the (row, item, passage words)
    that reach the threshold. Equal passages are aligned once."""
    keys: dict[tuple[int, bytes], int] = {}
    which = [keys.setdefault((item, passage.tobytes()), len(keys)) for _, item, passage in found]
    items = [words[item] for item, _ in keys]
    passages = [np.frombuffer(p, dtype=np.uint64) for _, p in keys]
    best, end = align_many(items, passages)
    share = best / np.array([MATCH * len(w) for w in items], dtype=np.float64)
    good = np.flatnonzero(share >= threshold).tolist()
    _, back = align_many([items[k][::-1] for k in good],
                         [passages[k][:end[k]][::-1] for k in good])
    spans = {k: (float(share[k]), int(end[k]) - int(r), int(end[k]))
             for k, r in zip(good, back) if end[k]}
    for i, k in enumerate(which):
        if k in spans:
            yield i, *spans[k]


@dataclass
class _Index:
    """Hashes, ascending, and the items of each: ``items[start[k]:start[k + 1]]``."""

    hashes: np.ndarray
    start: np.ndarray
    items: np.ndarray
    mask: int

    @classmethod
    def of(cls, hashes: list[np.ndarray], items: list[int]) -> _Index:
        h = np.concatenate(hashes)
        of = np.repeat(np.array(items, dtype=np.int64), [len(x) for x in hashes])
        order = np.argsort(h, kind="stable")
        keys, first = np.unique(h[order], return_index=True)
        bits = min(24, max(20, len(keys).bit_length() + 4))
        return cls(keys, np.append(first, len(h)), of[order], (1 << bits) - 1)

    def table(self) -> np.ndarray:
        """One lookup by the low bits rules most hashes out."""
        out = np.zeros(self.mask + 1, dtype=bool)
        out[(self.hashes & np.uint64(self.mask)).astype(np.int64)] = True
        return out

    def find(self, h: np.ndarray, same: np.ndarray, table: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h``, items) of all that are found where ``same`` holds."""
        may = np.flatnonzero(table[(h & np.uint64(self.mask)).astype(np.int64)] & same)
        at = np.minimum(np.searchsorted(self.hashes, h[may]), len(self.hashes) - 1)
        good = self.hashes[at] == h[may]
        may, at = may[good], at[good]
        n = self.start[at + 1] - self.start[at]
        begin = np.repeat(self.start[at] - np.cumsum(n) + n, n)
        return np.repeat(may, n), self.items[begin + np.arange(len(begin))]


def _pair_index(words: list[np.ndarray], n: int, rare: float, threshold: float
                ) -> tuple[_Index | None, np.ndarray]:
    """Index of the pairs of the items of at least ``n`` words, and the hits that each needs."""
    pairs = {i: [pair_hashes(w, 1), pair_hashes(w, 2)] for i, w in enumerate(words)
             if len(w) >= max(n, 2)}
    need = np.ones(len(words), dtype=np.int64)
    if not pairs:
        return None, need
    mine = {i: np.unique(np.concatenate(p)) for i, p in pairs.items()}
    keys, shared = np.unique(np.concatenate(list(mine.values())), return_counts=True)
    for i, own in mine.items():
        full = math.ceil(threshold * len(words[i]) - 1e-9) - 1
        fan = shared[np.searchsorted(keys, own)]
        steps: set[int] = set()                  # the item's positions that lose a pair
        drop = []
        for k in np.argsort(-fan, kind="stable").tolist():
            if fan[k] <= max(MIN_SHARED, rare * len(words)):
                break
            lost = steps.union(*(np.flatnonzero(p == own[k]).tolist() for p in pairs[i]))
            if len(lost) <= full // 2:
                steps = lost
                drop.append(k)
        mine[i] = np.delete(own, drop)
        need[i] = max(1, full - len(steps))
    return _Index.of(list(mine.values()), list(mine)), need


def _block(docs: DataFrame, items: list[tuple], n: int, rare: float, threshold: float) -> DataFrame:
    """Leaks of one block of items (id, text) in all documents."""
    spark = docs.sparkSession
    words = _item_words([t for _, t in items])
    pairs, need = _pair_index(words, n, rare, threshold)
    whole = {}                                   # items of fewer than n words, by their number
    for s in sorted({len(w) for w in words if 0 < len(w) < max(n, 2)}):
        own = [i for i, w in enumerate(words) if len(w) == s]
        whole[s] = _Index.of([gram_hashes(words[i], s) for i in own], own)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    # the most words of a text that an alignment over the threshold spans
    spans = np.maximum(lengths, np.floor((3 - 2 * threshold) * lengths + 1e-9).astype(np.int64))
    known = spark.sparkContext.broadcast((words, pairs, need, whole, spans))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, need, whole, spans = known.value
        pair_table = None if pairs is None else pairs.table()
        tables = {s: x.table() for s, x in whole.items()}

        def windows(wh: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
            """(items, first words, last words + 1) that may hold a leak, in order in each text."""
            if pairs is not None:
                codes = []
                for step in (1, 2):
                    p, item = pairs.find(pair_hashes(wh, step), doc[:-step] == doc[step:], pair_table)
                    codes.append(item << 40 | p)
                code = np.unique(np.concatenate(codes))       # a text position hits an item once
                item, p = code >> 40, code & ((1 << 40) - 1)
                j = np.arange(len(code))
                k = j + need[item] - 1
                j, k = j[k < len(code)], k[k < len(code)]
                ok = ((item[j] == item[k]) & (doc[p[j]] == doc[p[k]])
                      & (p[k] - p[j] < spans[item[j]]))
                j, k = j[ok], k[ok]
                yield item[j], p[k] - spans[item[j]] + 1, p[j] + spans[item[j]], p[j]
            for s, index in whole.items():
                m = max(0, len(wh) - s + 1)
                p, item = index.find(gram_hashes(wh, s), doc[:m] == doc[s - 1:s - 1 + m], tables[s])
                order = np.argsort(item, kind="stable")
                p, item = p[order], item[order]
                yield item, p, p + s, p

        for batch in batches:
            for lo, hi, data, starts in text_slices(batch.column(1), PASS_BYTES):
                ws, we, wh, doc = slice_words(data, starts)
                first = np.searchsorted(doc, np.arange(hi - lo))
                last = np.searchsorted(doc, np.arange(hi - lo), side="right")
                found, begin = [], []
                for item, a, b, p in windows(wh, doc):
                    if not len(item):
                        continue
                    d = doc[p]
                    a, b = np.maximum(a, first[d]), np.minimum(b, last[d])
                    # windows that meet are one passage
                    new = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1])
                                                         | (d[1:] != d[:-1]) | (a[1:] > b[:-1])]))
                    ends = b[np.append(new[1:], len(b)) - 1]
                    for i, d0, a0, b0 in zip(item[new].tolist(), d[new].tolist(), a[new].tolist(),
                                             ends.tolist()):
                        found.append((d0, i, wh[a0:b0]))
                        begin.append(a0)
                if not found:
                    continue
                row, cols = [], ([], [], [], [])
                for i, share, a, b in _aligned(found, words, threshold):
                    d, item, _ = found[i]
                    row.append(lo + d)
                    for c, x in zip(cols, (item, share, int(ws[begin[i] + a] - starts[d]),
                                           int(we[begin[i] + b - 1] - starts[d]))):
                        c.append(x)
                if row:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row, pa.int64())),
                         pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()),
                         pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                        names=["id", "item", "score", "start", "end"])

    leaks = docs.transform(map_arrow, run, f"id {kind}, item int, score double, start long, end long")
    best = (leaks.groupBy("id", "item")
            .agg(F.max_by(F.struct("score", "start", "end"),
                          F.struct("score", -F.col("start"), -F.col("end"))).alias("b")))
    # as many rows as the block has items
    names = spark.createDataFrame([(k, x) for k, (x, _) in enumerate(items)],
                                  "item int, item_id long")
    return best.join(F.broadcast(names), "item").select("id", "item_id", "b.score", "b.start", "b.end")


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = 5, rare: float = 0.001,
          threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, score, start, end) of every document that holds a copy of an item.

    ``start`` and ``end`` are UTF-8 byte offsets of the best aligned passage.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")) \
        .where(F.col("id").isNotNull())
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(item_text).cast("string").alias("t"))
    size = items.agg(F.sum(F.octet_length("t") + 16).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)))
    parts = []
    for b in range(blocks):
        got = [(r["item_id"], r["t"]) for r in
               items.where(F.col("block") == b).orderBy("item_id", "t").collect()]
        if got:
            parts.append(_block(rows, got, n, rare, threshold))
    if not parts:
        return rows.sparkSession.createDataFrame(
            [], f"id {docs.schema[id_col].dataType.simpleString()}, item_id long, score double, "
                "start long, end long")
    return reduce(DataFrame.unionByName, parts)

"""Repeated strings across a corpus, by prefix-free parsing and a suffix array of its pieces.

Every window of ``length`` bytes that stands earlier too (smaller id, or same text, earlier
start) is found, overlaps included, and the bytes that such windows cover are cut out.

Parsing. A rolling hash runs over all texts; a window's trigger is its gram of least hash among
the first places, so equal windows have it in the same place. Consecutive starts with the same
trigger form a phrase: the bytes before the trigger are its dictionary entry, those after it the
beginning of the parse suffix. Windows can only be equal if their parse suffixes agree on the
bytes that every window holds after its trigger, the phrase's key.

Order. Phrases are range-partitioned by key; a phrase alone with its key repeats nothing and
goes no further. The others meet in buckets of one key. Of a chunk of buckets, the suffix array
of the dictionary (names by doubling) and the sorted parse suffixes with their common prefixes
are combined: a window's place in corpus order is the rank of its dictionary suffix, then the
rank of its parse suffix, and neighbours with the same dictionary suffix share its length plus
the least common prefix between their parse ranks. Neighbours that share ``length`` bytes or
more are one class, of which the earliest stays.

Scale. Texts are sent once, in compressed blocks of bounded size, and kept partitioned by block;
of equal texts only the earliest is parsed. A key that holds a large share of all phrases (a
passage that stands in a third of all texts) is found in a sample of the blocks, spread over
partitions by salt and split into buckets of bounded size; classes of such keys are settled
between buckets by their earliest members only, in an aggregate over window hashes. Equal phrases
met in one batch of blocks are sent on once. No task holds more than a bucket, a chunk or a batch of
blocks, and only the hot keys of the sample (at most 8 for each partition) reach the driver.

Defined cases: a null text is an empty one; texts shorter than ``length`` lose nothing; null ids
come after all others; texts with equal ids, or none, are ordered as the table holds them; ids are
whole numbers; an empty table gives no rows; extra columns are ignored. Whole texts and windows
of a split key are told apart by 128-bit hashes, all other windows byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage, cut_lineage_partitioned
from .common import map_arrow, text_slices
from .suffix import least_between, name_levels, range_minimum

GRAM = 12               # bytes of a trigger
BUCKET = 1 << 12        # most phrases of a bucket
CHUNK_BYTES = 1 << 22   # phrase bytes ordered at a time
BLOCK_BYTES = 1 << 18   # text bytes of a block (a longer text is one of its own)
BATCH_BYTES = 1 << 24   # text bytes of the blocks whose equal phrases are sent on once
SAMPLE = 64             # one block in so many is looked through for hot keys
FIELD = 12              # bits of a text's place in its block, of a phrase's number of starts,
                        # and of its trigger's offset
PACK = 6                # dictionary bytes in a first name
BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE = np.random.default_rng(11).integers(0, 2 ** 64, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling hash's base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        up = np.full(max(n, 1 << 21), BASE)
        down = np.full(len(up), np.uint64(pow(int(BASE), -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def triggers_of(length: int) -> int:
    """Number of places at a window's start among which its trigger is chosen."""
    return length * 16 // 25


def phrases(data: np.ndarray, starts: np.ndarray, skip: np.ndarray, length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of texts in one buffer (each followed by one byte), without the texts of ``skip``:
    first start, number of starts, offset of the trigger, key."""
    n = len(data)
    none = np.zeros(0, np.int64)
    inside = np.ones(n, dtype=np.int8)              # starts of windows within one text
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        inside[max(s, e - length):e] = 0
    for k in skip.tolist():
        inside[starts[k]:starts[k + 1]] = 0
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none
    choose = triggers_of(length)
    after = length - choose + 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(TABLE[data] * up)])
        gram = _mixed((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    low = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while 2 * span <= choose:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < choose:
        low = np.minimum(low[:span - choose], low[choose - span:])
    trigger = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, trigger[1:] != trigger[:-1]))
    count = np.diff(np.append(first, len(at)))
    place = trigger[first]
    with np.errstate(over="ignore"):
        key = _mixed((total[place + after] - total[place]) * down[place])
    return at[first], count, place - at[first], key.view(np.int64)


def blocks_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, ids, starts, body, copies): blocks of compressed texts, kept partitioned. A text's
    number is its block's with its place there in the lowest bits; ``copies`` are the places of
    texts that an earlier one equals. Written once, so that numbers stay."""
    kind = docs.schema[id_col].dataType.simpleString()
    most = 1 << FIELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row in range(0, batch.num_rows, most):
                part = batch.slice(row, most)
                for lo, hi, data, starts in text_slices(part.column(1), BLOCK_BYTES):
                    raw = memoryview(data)
                    digest = b"".join([xxhash.xxh3_128_digest(raw[a:b - 1])
                                       for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())])
                    both = np.frombuffer(digest, dtype=np.int64).reshape(-1, 2)

                    def listed(values):
                        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), listed(part.column(0).slice(lo, hi - lo)),
                         listed(pa.array(both[:, 0].copy())), listed(pa.array(both[:, 1].copy())),
                         listed(pa.array(starts.astype(np.int64))), pa.array([pack.compress(raw)], pa.binary())],
                        names=["block", "ids", "d1", "d2", "starts", "body"])
                    block += 1 << FIELD

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    rows = map_arrow(rows, run, f"block long, ids array<{kind}>, d1 array<long>, d2 array<long>, "
                                "starts array<long>, body binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage_partitioned(rows, parts, "block")
    each = rows.select("block", F.posexplode(F.arrays_zip("ids", "d1", "d2")).alias("k", "t")).select(
        F.struct(F.isnull("t.ids").alias("none"), F.coalesce(F.col("t.ids").cast("long"), F.lit(0)).alias("doc"),
                 (F.col("block") + F.col("k")).alias("num")).alias("place"), "t.d1", "t.d2")
    first = each.groupBy(F.col("d1").alias("f1"), F.col("d2").alias("f2")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = cut_lineage(first)          # a join of two shuffles, so that a hot text is split
    later = (each.join(first, (F.col("d1") == F.col("f1")) & (F.col("d2") == F.col("f2")))
             .where(F.col("place") != F.col("first"))
             .select((F.col("place.num") - F.col("place.num") % most).alias("block"),
                     (F.col("place.num") % most).cast("int").alias("k"))
             .groupBy("block").agg(F.collect_list("k").alias("copies")))
    return rows.drop("d1", "d2").join(cut_lineage(later), "block", "left")


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """Block, texts, starts and copies of every row (columns block, body, starts, copies)."""
    unpack = zstandard.ZstdDecompressor()
    for i in range(batch.num_rows):
        copies = batch.column(3)[i]
        skip = copies.values.to_numpy() if copies.is_valid else np.zeros(0, np.int32)
        yield (batch.column(0)[i].as_py(), unpack.decompress(batch.column(1)[i].as_py()),
               batch.column(2)[i].values.to_numpy(), skip)


def shared_phrases(texts: DataFrame, length: int) -> DataFrame:
    """(num, at, bucket, open) of the phrases whose key is not theirs alone. ``at`` packs start,
    number of starts and trigger offset; an ``open`` bucket's key stands in others too."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body, starts, skip in _opened(batch):
                s, count, off, key = phrases(np.frombuffer(body, np.uint8), starts, skip, length)
                of = np.searchsorted(starts, s, side="right") - 1
                at = ((s - starts[of]) << 2 * FIELD) | (count << FIELD) | off
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(block + of), pa.array(at)],
                                                 names=["key", "num", "at"])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool)]   # a bucket that may go on
        before = 0                                  # phrases of its key that went out already

        def emit(key, num, at, hot, index):
            cut = np.append(True, (key[1:] != key[:-1]) | (index[1:] % BUCKET == 0))[:len(key)]
            lo = np.flatnonzero(cut)
            size = np.diff(np.append(lo, len(key)))
            number = index[lo] // BUCKET
            with np.errstate(over="ignore"):
                bucket = _mixed((key[lo].view(np.uint64) * BASE) ^ _mixed(
                    number.astype(np.uint64) * BASE + np.uint64(part))).astype(np.uint32).view(np.int32)
            ajar = (number > 0) | (size == BUCKET) | hot[lo]
            keep = np.repeat((size > 1) | ajar, size)
            return pa.RecordBatch.from_arrays(
                [pa.array(num[keep]), pa.array(at[keep]), pa.array(np.repeat(bucket, size)[keep]),
                 pa.array(np.repeat(ajar, size)[keep])], names=["num", "at", "bucket", "open"])

        for batch in batches:
            key, num, at, hot = (np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)])
                                 for i, h in enumerate(held))
            if not len(key):
                continue
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            index = np.arange(len(key)) - np.repeat(head, np.diff(np.append(head, len(key))))
            index[:head[1] if len(head) > 1 else None] += before
            tail = max(len(key) - 1 - int(index[-1] % BUCKET), int(head[-1]))
            if tail:
                yield emit(key[:tail], num[:tail], at[:tail], hot[:tail], index[:tail])
            held, before = [key[tail:], num[tail:], at[tail:], hot[tail:]], int(index[tail])
        if len(held[0]):
            yield emit(*held, before + np.arange(len(held[0])))

    opened = texts.select("block", "body", "starts", "copies")
    found = map_arrow(opened, parse, "key long, num long, at long")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a key is hot with over an eighth of a partition's share of the sample: at most 8 * parts are
    some = map_arrow(opened.where(F.pmod(F.xxhash64("block"), F.lit(SAMPLE)) == 0), parse,
                     "key long, num long, at long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    some = cut_lineage(some)
    total = some.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in some.where(F.col("n") > max(64, total / (8 * parts))).select("key").collect()]
    is_hot = F.col("key").isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64("num"), F.lit(parts))).otherwise(0)
    found = found.withColumn("hot", is_hot)
    return map_arrow(found.repartition(parts, "key", salt).sortWithinPartitions("key"), share,
                     "num long, at long, bucket int, open boolean")


def window_classes(texts: list[bytes], off: np.ndarray, count: np.ndarray, length: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of distinct phrases, in corpus order: their phrase, their start in it, and the
    number of their class (equal windows)."""
    parts = sorted({t[o:] for t, o in zip(texts, off.tolist())})        # the parse's suffixes
    rank = {r: k for k, r in enumerate(parts)}
    size = np.array([len(r) for r in parts])
    wide = np.zeros((len(parts), size.max() + 1), dtype=np.uint8)
    wide[np.arange(wide.shape[1])[None, :] < size[:, None]] = np.frombuffer(b"".join(parts), np.uint8)
    differ = wide[1:] != wide[:-1]
    differ[:, -1] = True
    common = np.minimum(differ.argmax(axis=1), np.minimum(size[1:], size[:-1]))
    heads: dict[bytes, int] = {}                                        # the dictionary
    total = 0
    for t, o in zip(texts, off.tolist()):
        if t[:o] not in heads:
            heads[t[:o]] = total
            total += o + 1
    ends = np.cumsum([len(h) + 1 for h in heads])
    symbol = np.zeros(total + PACK, dtype=np.int64)
    for h, at in heads.items():
        symbol[at:at + len(h)] = np.frombuffer(h, np.uint8)
        symbol[at:at + len(h)] += 1
    ends = np.repeat(ends, np.diff(np.append(0, ends)))
    packed = np.zeros(total, dtype=np.int64)
    for k in range(PACK):
        packed = packed * 300 + np.where(np.arange(total) + k < ends, symbol[k:total + k], 0)
    name = name_levels(packed, ends, int(off.max()) + 1, PACK)[-1]
    phrase = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
    head = np.array([heads[t[:o]] for t, o in zip(texts, off.tolist())])
    suffix = name[head[phrase] + start]
    tail = np.array([rank[t[o:]] for t, o in zip(texts, off.tolist())])[phrase]
    order = np.lexsort((tail, suffix))
    phrase, start, suffix, tail = phrase[order], start[order], suffix[order], tail[order]
    same = suffix[1:] == suffix[:-1]
    check = np.flatnonzero(same & (tail[1:] > tail[:-1]))
    if len(check):
        shared = least_between(range_minimum(common), tail[check], tail[check + 1])
        same[check] = (off[phrase[check]] - start[check]) + shared >= length
    return phrase, start, np.cumsum(np.append(False, ~same))


def _resolve(texts: list[bytes], num, order, at, open_, length):
    """Of a chunk of whole buckets: the starts that repeat, as (row, first start, number), and the
    earliest windows of classes that may stand elsewhere, as (row, start, text)."""
    count, off = (at >> FIELD) & ((1 << FIELD) - 1), at & ((1 << FIELD) - 1)
    place = np.empty(len(texts), dtype=np.int64)
    place[np.lexsort((at, num, *order[::-1]))] = np.arange(len(texts))
    earliest: dict[bytes, int] = {}
    ranked = np.argsort(place)
    for i in ranked.tolist():
        earliest.setdefault(texts[i], i)
    rep = np.fromiter(earliest.values(), dtype=np.int64, count=len(earliest))
    later = np.ones(len(texts), dtype=bool)
    later[rep] = False
    rows, lo, n = [np.flatnonzero(later)], [np.zeros(later.sum(), np.int64)], [count[later]]
    phrase, start, cls = window_classes(list(earliest), off[rep], count[rep], length)
    where = (place[rep][phrase] << FIELD) + start
    lead = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
    least = np.minimum.reduceat(where, lead)[cls]
    again = where > least
    # runs of consecutive starts of a phrase
    hit = np.flatnonzero(again)
    hit = hit[np.argsort(where[hit])]
    cut = np.flatnonzero(np.append(True, np.diff(where[hit]) != 1)) if len(hit) else hit
    rows.append(rep[phrase[hit[cut]]])
    lo.append(start[hit[cut]])
    n.append(np.diff(np.append(cut, len(hit))))
    ajar = np.logical_or.reduceat(open_[rep][phrase], lead)[cls] & ~again
    i = rep[phrase[ajar]]
    return (np.concatenate(rows), np.concatenate(lo), np.concatenate(n)), (i, start[ajar])


def repeated_starts(texts: DataFrame, length: int) -> DataFrame:
    """(block, runs): runs of starts of repeated windows, each packed as start, number of starts
    and the text's place in the block."""
    field, low = F.lit(1 << FIELD), (1 << FIELD) - 1
    num = F.col("num")
    wanted = shared_phrases(texts, length).groupBy((num - num % field).alias("block")).agg(
        F.collect_list(F.struct((num % field).cast("int").alias("k"), "at", "bucket", "open")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(held):
            """Phrases of some blocks in corpus order; equal ones once, the later ones as runs."""
            body = [h[1] for h in held]
            col = [np.concatenate(c) for c in zip(*(h[2:] for h in held))]
            of = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
            none, doc, num, at, base, bucket, ajar = col
            order = np.lexsort((at, num, doc, none))
            s, n = at >> 2 * FIELD, (at >> FIELD) & low
            a = base + s
            seen, keep, texts_, runs = set(), [], [], {}
            for i, b, x, y in zip(order.tolist(), of[order].tolist(), a[order].tolist(),
                                  (a + n - 1 + length)[order].tolist()):
                phrase = body[b][x:y]
                if phrase in seen:
                    runs.setdefault(b, []).append(i)
                else:
                    seen.add(phrase)
                    keep.append(i)
                    texts_.append(phrase)
            i, m = np.array(keep, dtype=np.int64), len(runs)
            packed = (s << 2 * FIELD) | (n << FIELD) | (num & low)
            blocks = [held[b][0] for b in runs]
            nulls = [None] * m
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([bucket[i], np.array([b >> FIELD for b in blocks], np.int64).astype(np.int32)])),
                 pa.array(np.concatenate([num[i], np.array(blocks, np.int64)])),
                 pa.concat_arrays([pa.array(none[i]), pa.array(nulls, pa.bool_())]),
                 pa.concat_arrays([pa.array(doc[i]), pa.array(nulls, pa.int64())]),
                 pa.concat_arrays([pa.array(at[i]), pa.array(nulls, pa.int64())]),
                 pa.concat_arrays([pa.array(ajar[i]), pa.array(nulls, pa.bool_())]),
                 pa.array(texts_ + nulls, pa.binary()),
                 pa.array([None] * len(i) + [packed[r] for r in runs.values()], pa.list_(pa.int64()))],
                names=["bucket", "num", "none", "doc", "at", "open", "x", "runs"])

        held, size = [], 0
        for batch in batches:
            for i, (block, body, starts, _) in enumerate(_opened(batch)):
                ids, w = batch.column(4)[i].values, batch.column(5)[i].values
                k, at, bucket, ajar = (w.field(c).to_numpy(zero_copy_only=False) for c in range(4))
                none = ids.is_null().to_numpy(zero_copy_only=False)
                doc = ids.cast(pa.int64()).fill_null(0).to_numpy()
                held.append((block, body, none[k], doc[k], block + k.astype(np.int64), at, starts[k], bucket, ajar))
                size += len(body)
                if size >= BATCH_BYTES:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["num", "runs", "none", "doc", "start", "c1", "c2"]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.bool_(), *[pa.int64()] * 4]

        def solve(table: pa.Table) -> pa.RecordBatch:
            x = table.column("x").to_pylist()
            num, none, doc, at, ajar = (table.column(c).to_numpy() for c in ("num", "none", "doc", "at", "open"))
            none = none.astype(bool)
            (rows, lo, n), (first, start) = _resolve(x, num, (none, doc), at, ajar.astype(bool), length)
            base = at >> 2 * FIELD
            packed = ((base[rows] + lo) << 2 * FIELD) | (n << FIELD) | (num[rows] & low)
            block = num[rows] & ~low
            by = np.argsort(block, kind="stable")
            owner, head = np.unique(block[by], return_index=True)
            runs = pa.ListArray.from_arrays(pa.array(np.append(head, len(by)).astype(np.int32)), pa.array(packed[by]))
            digest = [xxhash.xxh3_128_digest(x[i][s:s + length]) for i, s in zip(first.tolist(), start.tolist())]
            c = np.frombuffer(b"".join(digest), dtype=np.int64).reshape(-1, 2)
            m, k = len(owner), len(first)
            left = [pa.array(owner), runs, *[pa.nulls(m, t) for t in kinds[2:]]]
            right = [pa.array(num[first]), pa.nulls(k, kinds[1]), pa.array(none[first]), pa.array(doc[first]),
                     pa.array(base[first] + start), pa.array(c[:, 0].copy()), pa.array(c[:, 1].copy())]
            return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(left, right)], names=names)

        held, size = [], 0
        for batch in batches:
            known = batch.filter(pa.compute.is_null(batch.column("x")))
            if known.num_rows:
                nulls = [pa.nulls(known.num_rows, t) for t in kinds[2:]]
                yield pa.RecordBatch.from_arrays([known.column("num"), known.column("runs"), *nulls], names=names)
            batch = batch.filter(pa.compute.is_valid(batch.column("x")))
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("x").nbytes
            if size >= CHUNK_BYTES:
                table = pa.Table.from_batches(held).combine_chunks()
                bucket = table.column("bucket").to_numpy()
                whole = int(np.searchsorted(bucket, bucket[-1]))       # the last bucket may go on
                if whole:
                    yield solve(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
                size = sum(b.column("x").nbytes for b in held)
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = texts.join(wanted, "block").select("block", "body", "starts", "copies", "ids", "wanted")
    found = map_arrow(found, cut, "bucket int, num long, none boolean, doc long, at long, open boolean, "
                                  "x binary, runs array<long>")
    found = cut_lineage(map_arrow(
        found.repartition(parts, "bucket").sortWithinPartitions("bucket"), settle,
        "num long, runs array<long>, none boolean, doc long, start long, c1 long, c2 long"))
    # classes of split keys: all but the earliest of the buckets' earliest windows repeat
    split = found.where("runs IS NULL")
    place = F.struct("none", "doc", "num", "start")
    least = split.groupBy(F.col("c1").alias("k1"), F.col("c2").alias("k2")).agg(F.min(place).alias("least"))
    again = (split.join(least, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")))
             .where(place != F.col("least"))
             .select((num - num % field).alias("block"),
                     F.array(F.shiftleft("start", 2 * FIELD) + field + num % field).alias("runs")))
    return found.where("runs IS NOT NULL").select(num.alias("block"), "runs").unionByName(again)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text"
                   ) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row: the byte spans [start, end) that repeated windows of
    ``length`` bytes cover, and the text's other bytes."""
    if not 2 * GRAM <= length or triggers_of(length) >= 1 << FIELD:
        raise ValueError("length must be 24 to 6000")
    texts = blocks_of(docs, id_col, text_col)
    runs = (repeated_starts(texts, length).groupBy("block")
            .agg(F.flatten(F.collect_list("runs")).alias("runs")))
    kind = docs.schema[id_col].dataType.simpleString()
    low = (1 << FIELD) - 1

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, body, starts, copies) in enumerate(_opened(batch)):
                data, n = np.frombuffer(body, np.uint8), len(starts) - 1
                edge = np.zeros(len(data) + 1, dtype=np.int32)
                size = np.diff(starts) - 1
                whole = copies[size[copies] >= length]
                np.add.at(edge, starts[whole], 1)
                np.add.at(edge, starts[whole + 1] - 1, -1)
                if batch.column(5)[i].is_valid:
                    packed = batch.column(5)[i].values.to_numpy()
                    at = starts[packed & low] + (packed >> 2 * FIELD)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + ((packed >> FIELD) & low) - 1 + length, -1)
                out = np.cumsum(edge)[:-1] > 0
                change = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8))).reshape(-1, 2)
                of = np.searchsorted(starts, change[:, 0], side="right") - 1
                spans = pa.StructArray.from_arrays([pa.array(c - starts[of]) for c in change.T.copy()], names=["start", "end"])
                split = np.append(0, np.cumsum(np.bincount(of, minlength=n)))
                out[starts[1:] - 1] = True                              # the bytes between texts
                left = np.append(0, np.cumsum(~out))[starts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(4)[i].values, pa.array(size.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(split.astype(np.int32)), spans),
                     pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [
                         None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data[~out].tobytes())]).cast(pa.binary())],
                    names=["id", "n_bytes", "spans", "kept"])

    return map_arrow(texts.join(runs, "block", "left").select("block", "body", "starts", "copies", "ids", "runs"),
                     apply, f"id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")

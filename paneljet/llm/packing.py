"""Best-fit packing planned on the histogram of piece lengths.

Documents are tokenised once; a document of over ``capacity`` tokens is cut into full pieces,
the first one taking the rest. The plan packs counts, not documents: lengths from long to short,
each into the fullest open sequences it still fits, groups of equal sequences at a time. Its size depends on
``capacity`` only (lengths x sequence groups), never on the number of documents, so the driver
holds a histogram of at most ``capacity`` rows and a plan of that order. Pieces then take the
planned slots of their length by their rank within the length, a join on (length, rank range).

Defined cases: a null text is an empty one: its only id is the separator; ties between equal
lengths are broken by the id and the piece; repeated rows are packed each; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from .common import map_arrow, rank_within

SPECIAL = "<|endoftext|>"
_LOADED: dict[str, object] = {}


def _encoder(path: str):
    """Tokeniser of ``path``: ids as numpy. The JSON file's ids come from the rank file of the
    same vocabulary beside it, which encodes about four times as fast; texts that spell out the special
    token, or whose runs of white space are too long for the rank file's pattern matcher (it
    gives up with an error), go to the JSON tokeniser itself."""
    if path not in _LOADED:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(path)
        ranks_file = os.path.splitext(path)[0] + ".tiktoken"
        fast = None
        if os.path.exists(ranks_file):
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            if fast is not None and SPECIAL not in text:
                try:
                    return fast.encode_to_numpy(text, disallowed_special=())
                except ValueError:      # the pattern matcher's backtracking limit
                    pass
            return np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4")

        _LOADED[path] = encode
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
                 ) -> DataFrame:
    """(id, piece, start, length, crc[, ids]) of every document's pieces."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "piece", "start", "length", "crc"] + (["ids"] if with_ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        end = np.array([separator], dtype="<u4")
        for batch in batches:
            row, cols = [], ([], [], [], [], [])
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                ids = np.concatenate([encode(text).astype("<u4", copy=False), end]) if text else end
                head = len(ids) % capacity or capacity
                start = 0
                for p, stop in enumerate(range(head, len(ids) + 1, capacity)):
                    raw = ids[start:stop].tobytes()
                    row.append(i)
                    for c, x in zip(cols, (p, start, stop - start, zlib.crc32(raw), raw)):
                        c.append(x)
                    start = stop
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int32()),
                   *[pa.array(c, pa.int64()) for c in cols[1:4]]]
            if with_ids:
                out.append(pa.array(cols[4], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")
                       ).transform(map_arrow, run, f"id {kind}, piece int, start long, length long, crc long"
                                    + (", ids binary" if with_ids else ""))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a length histogram.

    Returns slots ``(length, rank from, rank to, per sequence, first sequence, offset)``: the
    pieces of a length with ranks in [from, to) go ``per`` to a sequence, from ``first sequence``
    on, the first of a sequence at ``offset``.
    """
    slots: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}   # free tokens -> runs (first sequence, how many)
    used = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def place(first: int, n: int, free: int, per: int) -> None:
            nonlocal left, rank
            slots.append((length, rank, rank + n * per, per, first, capacity - free))
            rank += n * per
            left -= n * per
            if free - per * length:
                room.setdefault(free - per * length, []).append((first, n))

        for free in sorted(f for f in room if f >= length):
            runs = room.pop(free)
            while runs and left:
                first, n = runs.pop()
                per = free // length
                take = min(n, left // per)
                if take:
                    place(first, take, free, per)
                if take < n and left:            # fewer than ``per`` remain
                    place(first + take, 1, free, left)
                    take += 1
                if take < n:
                    runs.append((first + take, n - take))
            if runs:
                room.setdefault(free, []).extend(runs)
            if not left:
                break
        if left:
            per = capacity // length
            full = left // per
            if full:
                place(used, full, capacity, per)
                used += full
            if left:
                place(used, 1, capacity, left)
                used += 1
    return slots


def assign(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` should be materialised."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError("piece lengths must be 1 to the capacity")
    slots = best_fit(counts, capacity)
    plan = spark.createDataFrame(
        slots, "slot_length long, lo long, hi long, per long, first long, at long")
    parts = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = rank_within(pieces, "length", ["id", "piece", "crc"], "rank", parts)
    step = F.col("rank") - F.col("lo")
    # the plan's size is bounded by the capacity, whatever the data
    return (ranked.join(F.broadcast(plan), (F.col("length") == F.col("slot_length"))
                        & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .withColumn("sequence_id", F.expr("first + (rank - lo) div per"))
            .withColumn("offset", F.col("at") + F.pmod(step, F.col("per")) * F.col("length"))
            .drop("slot_length", "lo", "hi", "per", "first", "at", "rank"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and place there."""
    return assign(cut_lineage(token_pieces(docs, tokenizer, capacity, separator, id_col, text_col,
                                           with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids (little-endian 32-bit) of whole sequences, from
    ``pack(..., with_ids=True)``. A sequence holds at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p")) \
        .select("sequence_id", "length", F.aggregate(
            "p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))

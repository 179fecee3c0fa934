"""Weighted rendezvous hashing of record keys, in DataFrame functions only.

Shard s of weight w scores -w / ln(u) for a key, u being a hash of (key, s) in (0, 1); the
highest score takes the record. A score depends on the key and its own shard alone, so a new
shard takes records only into itself, and a share of records in proportion to its weight.

Defined cases: a null key is hashed as the empty text, so all null keys share a shard; a null or
empty text has size 1 and CRC zero; repeated rows share a shard and each get a slot; ties of
scores go to the lower shard; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from .common import rank_within


def _scores(key: Column, weights: list[float]) -> list[Column]:
    text = F.coalesce(key.cast("string"), F.lit(""))
    out = []
    for s, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(s)), 11).cast("double") + 0.5) / float(2 ** 53)
        out.append(F.struct((F.lit(-float(w)) / F.log(u)).alias("score"), F.lit(-s).alias("s")))
    return out


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard (0 .. len(weights) - 1) of a key."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, and at least one")
    scores = _scores(key, weights)
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["s"]).cast("int")


def assign_shards(docs: DataFrame, weights: list[float], grown: list[float] | None = None,
                  key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot[, grown_shard]) for every row.

    ``slot`` is gapless from 0 in each shard. ``grown`` are the weights after a change of shards.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cols = [F.col(key_col).alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(F.col(key_col), weights).alias("shard")]
    if grown:
        cols.append(shard_of(F.col(key_col), grown).alias("grown_shard"))
    rows = cut_lineage(docs.select(*cols))      # narrow; the texts are read once
    parts = max(32, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rank_within(rows, "shard", ["key", "size", "text_crc32"], "slot", parts)


def write_shards(docs: DataFrame, weights: list[float], path: str, key_col: str = "doc_id",
                 files_per_shard: int = 8) -> None:
    """Write ``docs`` as Parquet under ``path/shard=N``, every shard in several files."""
    part = F.pmod(F.xxhash64(F.col(key_col).cast("string")), F.lit(files_per_shard))
    (docs.withColumn("shard", shard_of(F.col(key_col), weights))
     .repartition(len(weights) * files_per_shard, "shard", part)
     .write.mode("overwrite").partitionBy("shard").parquet(path))

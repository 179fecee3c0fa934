"""Corpus pipeline: documents -> language -> near-duplicates -> benchmark leaks -> PII -> packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
Empty tables, null texts and repeated rows go through every stage as its operator defines. Rows
whose doc_id is null or repeats are judged each by its own text.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paneljet.llm import decontam, langid, packing, pii, simhash
from paneljet.llm.common import fold
from paneljet.operators.util import cut_lineage
from paneljet.session import ensure_checkpoint_dir

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048


def _key() -> Column:
    """A row's key: its doc_id and text. Ids that are null or repeat are told apart by the text,
    and rows equal in both get the same decisions. The smallest key of a group has an id."""
    return F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("doc"),
                    F.xxhash64("text").alias("text")).alias("key")


def _semi(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose key is (``left_semi``) or is not (``left_anti``) an ``id`` of ``keys``."""
    k = keys.select(F.col("id.doc").alias("__key_doc"), F.col("id.text").alias("__key_text"))
    same = (docs["doc_id"].eqNullSafe(k["__key_doc"])
            & (F.xxhash64(docs["text"]) == k["__key_text"]))
    return docs.join(k, same, how)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is ambiguous."""
    rows = docs.select(_key(), "doc_id", "text", "lang")
    out = langid.identify(rows, fold(F.col("doc_id"), 5) != 0, id_col="key")
    rejected = cut_lineage(out.where((F.col("lang_pred") == "und") | F.col("ambiguous"))
                           .select("id").distinct())
    return _semi(docs, rejected, "left_anti")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest id, of each SimHash group."""
    out = simhash.near_duplicates(docs.select(_key(), "text"), id_col="key", shingle=4, distance=4)
    kept = cut_lineage(out.where(F.col("id") == F.col("component")).groupBy("id")
                       .agg(F.count(F.lit(1)).alias("n")))
    rows = _semi(docs, kept, "left_semi")
    if kept.where("n > 1").isEmpty():
        return rows
    # rows that repeat both id and text: the first by the other columns stays
    w = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*docs.columns)
    rank = f"__rank_{uuid.uuid4().hex}"
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a copy of a benchmark item."""
    found = decontam.leaks(docs.select(_key(), "text"),
                           spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return _semi(docs, cut_lineage(found.select("id").distinct()), "left_anti")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; ``n_chars`` follows the new text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(
        docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all remaining documents: one row per piece."""
    out = packing.pack(docs, public_tokenizers.path(TOKENIZER), CAPACITY)
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length",
                      F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("language_id", language_stage), ("simhash_dedup", dedup_stage),
          ("decontamination", decontamination_stage), ("pii", pii_stage),
          ("packing", packing_stage)]

# Hashing, tokenisation and alignment are not SQL: tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents table, every result written to the shared folder and reread."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

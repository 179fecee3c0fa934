"""Language identification by error-correcting output codes over hashed byte n-grams.

Every language has a codeword of +1/-1 bits. For each bit a binary naive-Bayes classifier over
hashed byte trigrams (A-Z and Latin-1 capitals lower-cased) tells the languages whose bit is +1
from the others; all need the same counts, n-grams by language, which one distributed pass over
all training rows gathers. A text's margin for a bit is its mean log-odds per n-gram, each
bounded by EVIDENCE. Decoding is loss-weighted: bit j of language l counts with the accuracy
classifier j reached on training rows of l, and the codeword with the least weighted logistic
loss wins. The text is ambiguous if the runner-up's loss is within ``ambiguity`` (relative) of
the winner's.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and not ambiguous;
rows with a null language (or null id, in the query) are not learned from; with no language
learned every text is ``und``; with one, every text with a letter gets it with score 1; ties go
to the language that sorts first; texts are read whole, at any length; repeated rows are scored
each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from .common import LOWER, map_arrow, text_slices

GRAMS = 1 << 14        # hashed trigram features
MAX_LANGUAGES = 512    # bound on distinct labels: the count table is languages x GRAMS
SHARPNESS = 4.0        # scale of the margins inside the logistic loss
EVIDENCE = 2.0         # bound of one n-gram's log-odds, so that a foreign passage weighs by its length
AMBIGUITY = 0.02
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z and the capitals U+00C0..U+00DE (but U+00D7) of UTF-8 bytes."""
    low = LOWER[data]
    after = np.flatnonzero(low == 0xC3) + 1
    after = after[after < len(low)]
    x = low[after]
    low[after] = np.where((x >= 0x80) & (x <= 0x9E) & (x != 0x97), x + 0x20, x)
    return low


def gram_index(data: np.ndarray, size: int = GRAMS) -> np.ndarray:
    """Hashed index of the byte trigram at each position (the last two positions have none)."""
    b = fold_case(data).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64)
    h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B)
         ^ b[2:] * np.uint32(0xC2B2AE35))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - size.bit_length() + 1)).astype(np.int64)


def codewords(n: int) -> np.ndarray:
    """n codewords of +1/-1: all splits of up to 6 languages, else random ones far apart."""
    if n < 2:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 6:
        # bit j splits the languages by the binary digits of j; the first is always +1
        return np.array([[1 if i == 0 or (j >> (i - 1)) & 1 else -1
                          for j in range(2 ** (n - 1) - 1)] for i in range(n)], dtype=np.int8)
    bits = 10 * int(np.ceil(np.log2(n)))
    best, far = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), (n, bits))
        code = code[:, (code.min(0) < 0) & (code.max(0) > 0)]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        near = int(apart[~np.eye(n, dtype=bool)].min())
        if near > far:
            best, far = code, near
    return best


def gram_counts(rows: DataFrame, lang_col: str, text_col: str, size: int = GRAMS) -> DataFrame:
    """(lang, gram, n) over all rows with a language: one partial table a task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, hi, data, starts in text_slices(batch.column(1)):
                idx = gram_index(data, size)
                if not len(idx):
                    continue
                names = sorted(set(langs[lo:hi]))
                code = {x: i for i, x in enumerate(names)}
                which = np.array([code[x] for x in langs[lo:hi]], dtype=np.int64)
                # a text's own trigrams: up to its last byte (the separator belongs to none)
                owner = np.repeat(which, np.diff(starts))[:len(idx)]
                inside = np.ones(len(idx) + 2, dtype=bool)
                for back in (1, 2, 3):
                    p = starts[1:] - back
                    inside[p[p >= 0]] = False
                inside = inside[:len(idx)]
                got = np.bincount((owner * size + idx)[inside], minlength=len(names) * size)
                for i, x in enumerate(names):
                    part = got[i * size:(i + 1) * size]
                    counts[x] = counts[x] + part if x in counts else part
        for x, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(c[at].astype(np.int64))], names=["lang", "gram", "n"])

    return (rows.where(F.col(lang_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"),
                    F.col(text_col).cast("string").alias("t"))
            .transform(map_arrow, run, "lang string, gram int, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


@dataclass
class LanguageModel:
    """Languages (sorted), codewords (languages x bits) and gram weights (grams x bits)."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text",
          size: int = GRAMS, smoothing: float = 0.5) -> LanguageModel:
    """Fit the bit classifiers on all ``rows`` that have a language.

    The driver receives languages x ``size`` counts at most; more than MAX_LANGUAGES distinct
    labels are an error.
    """
    counts = cut_lineage(gram_counts(rows, lang_col, text_col, size))
    labels = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1)
                    .collect())
    if len(labels) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages: not a language column?")
    table = np.zeros((len(labels), size))
    at = {x: i for i, x in enumerate(labels)}
    got = counts.toPandas()
    table[got["lang"].map(at).to_numpy(dtype=np.int64, na_value=0),
          got["gram"].to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    share = (table + smoothing) / (table + smoothing).sum(1, keepdims=True)
    code = codewords(len(labels))
    weights = np.zeros((size, code.shape[1]), dtype=np.float32)
    for j in range(code.shape[1]):
        weights[:, j] = (np.log(share[code[:, j] > 0].mean(0))
                         - np.log(share[code[:, j] < 0].mean(0)))
    weights = np.clip(weights, -EVIDENCE, EVIDENCE)
    return LanguageModel(labels, code, weights)


def has_letter(column: pa.Array, lo: int, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each text of a slice holds a letter; only texts without A-Z/a-z are decoded."""
    found = np.add.reduceat(_ASCII_LETTER[data].astype(np.int32), starts[:-1]) > 0
    pattern = regex.compile(r"\p{L}")
    for i in np.flatnonzero(~found):
        text = column[lo + int(i)].as_py()
        found[i] = bool(text and pattern.search(text))
    return found


def margins(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text"
            ) -> DataFrame:
    """``keep`` columns plus ``letters`` and ``margins`` (mean log-odds per bit) of whole texts."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model.weights)
    bits = model.code.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        size = len(w)
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            out = np.zeros((batch.num_rows, bits))
            letters = np.zeros(batch.num_rows, dtype=bool)
            for lo, hi, data, starts in text_slices(text):
                letters[lo:hi] = has_letter(text, lo, data, starts)
                idx = gram_index(data, size)
                first = np.minimum(starts[:-1], len(idx))
                last = np.minimum(np.maximum(starts[1:] - 3, starts[:-1]), len(idx))
                n = np.maximum(last - first, 1)
                # columns one by one bound the memory; sums run from text to text
                for j in range(bits):
                    total = np.concatenate([[0.0], np.cumsum(w[idx, j], dtype=np.float64)])
                    out[lo:hi, j] = (total[last] - total[first]) / n
            flat = pa.array(out.ravel())
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bits), flat)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(letters), lists], names=[*keep, "letters", "margins"])

    return docs.select(*keep, F.col(text_col).cast("string").alias("__t")).transform(map_arrow,
        run, f"{schema}, letters boolean, margins array<double>")


def bit_accuracy(scored: DataFrame, model: LanguageModel, lang_col: str, learned: Column
                 ) -> np.ndarray:
    """Accuracy of each bit's classifier on each language's training rows (languages x bits)."""
    n, bits = model.code.shape
    acc = np.full((n, bits), 0.5)
    if not bits:
        return acc
    rows = (scored.where(learned & F.col("letters") & F.col(lang_col).isNotNull())
            .groupBy(F.col(lang_col).cast("string").alias("l"))
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(F.element_at("margins", j + 1) > 0).alias(f"p{j}")
                   for j in range(bits)]).collect())
    at = {x: i for i, x in enumerate(model.languages)}
    for r in rows:
        plus = np.array([r[f"p{j}"] for j in range(bits)]) / r["n"]
        acc[at[r["l"]]] = np.where(model.code[at[r["l"]]] > 0, plus, 1 - plus)
    return acc


def decode(scored: DataFrame, model: LanguageModel, accuracy: np.ndarray, keep: list[str],
           ambiguity: float = AMBIGUITY) -> DataFrame:
    """``keep`` plus lang_pred, score and ambiguous, by loss-weighted decoding."""
    schema = ", ".join(f"`{c}` {scored.schema[c].dataType.simpleString()}" for c in keep)
    weight = accuracy / np.maximum(accuracy.sum(1, keepdims=True), 1e-12)
    code, names = model.code.astype(float), np.array(model.languages, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_columns
            letters = batch.column(k - 2).to_numpy(zero_copy_only=False).astype(bool)
            n = batch.num_rows
            pred = np.full(n, "und", dtype=object)
            score, amb = np.zeros(n), np.zeros(n, dtype=bool)
            if len(names) == 1:
                pred[letters], score[letters] = names[0], 1.0
            elif len(names) > 1 and n:
                flat = batch.column(k - 1).flatten().to_numpy(zero_copy_only=False)
                m = SHARPNESS * flat.reshape(n, -1)
                loss = np.stack([(np.logaddexp(0.0, -m * code[i]) * weight[i]).sum(1)
                                 for i in range(len(names))], axis=1)
                best = loss.argmin(1)
                two = np.partition(loss, 1, axis=1)[:, :2]
                like = np.exp(-code.shape[1] * (loss - loss.min(1, keepdims=True)))
                pred = np.where(letters, names[best], "und")
                score = np.where(letters, 1.0 / like.sum(1), 0.0)
                amb = letters & (two[:, 1] - two[:, 0] < ambiguity * two[:, 1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(pred, pa.string()), pa.array(score),
                 pa.array(amb)], names=[*keep, "lang_pred", "score", "ambiguous"])

    return scored.select(*keep, "letters", "margins").transform(map_arrow,
        run, f"{schema}, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", ambiguity: float = AMBIGUITY) -> DataFrame:
    """(id, learned, lang_pred, score, ambiguous) for every row; fits on rows where ``learned``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"),
                       F.coalesce(learned, F.lit(False)).alias("learned"))
    model = train(rows.where("learned"), "lang", "text")
    scored = cut_lineage(margins(rows, model, ["id", "lang", "learned"], "text"))
    accuracy = bit_accuracy(scored, model, "lang", F.col("learned"))
    return decode(scored, model, accuracy, ["id", "learned"], ambiguity)

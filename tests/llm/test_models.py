"""The language identifier and the quality classifier against plain Python, from text to score."""

import collections
import itertools
import math
import re

import numpy as np
from pyspark.sql import functions as F

from paneljet.llm import fm, langid

TEXTS = {"aa": "the of and then there with that was over under",
         "bb": "der die und nicht über eine schön groß wird für",
         "cc": "les une avec pour déjà même très où voilà était",
         "dd": "el los una con para sí más año también después"}


def corpus(n=48):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        lang = sorted(TEXTS)[i % 4]
        words = rng.choice(TEXTS[lang].split(), 20 + i).tolist()
        if i % 6 == 0:                  # a foreign passage
            words += rng.choice(TEXTS[sorted(TEXTS)[(i + 1) % 4]].split(), 15 + i).tolist()
        rows.append((i, " ".join(words).title() if i % 5 == 0 else " ".join(words), lang))
    return rows + [(n, None, "aa"), (n + 1, "", "bb"), (n + 2, "12 %", "cc"), (n + 3, "ab", None)]


def brute_grams(text):
    folded = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c
                     for c in text or "").encode()
    word = 0xFFFFFFFF
    out = []
    for a, b, c in zip(folded, folded[1:], folded[2:]):
        h = (a * 0x9E3779B1 & word) ^ (b * 0x85EBCA6B & word) ^ (c * 0xC2B2AE35 & word)
        h ^= h >> 15
        out.append((h * 0x2C1B3C6D & word) >> (32 - langid.GRAMS.bit_length() + 1))
    return out


def brute_language(rows, learned):
    """id -> (language, score, ambiguous)."""
    names = sorted({x for i, _, x in rows if x is not None and learned(i)})
    counts = {x: collections.Counter() for x in names}
    for i, text, lang in rows:
        if lang is not None and learned(i):
            counts[lang].update(brute_grams(text))
    code = langid.codewords(len(names)).tolist()
    bits = range(len(code[0]))

    def share(lang, gram):
        return (counts[lang][gram] + 0.5) / (sum(counts[lang].values()) + 0.5 * langid.GRAMS)

    def weight(gram, j):
        side = {s: [share(x, gram) for x, c in zip(names, code) if c[j] == s] for s in (1, -1)}
        w = math.log(sum(side[1]) / len(side[1])) - math.log(sum(side[-1]) / len(side[-1]))
        return max(-langid.EVIDENCE, min(langid.EVIDENCE, w))

    margin, letters = {}, {}
    for i, text, _ in rows:
        grams = brute_grams(text)
        margin[i] = [sum(weight(g, j) for g in grams) / max(len(grams), 1) for j in bits]
        letters[i] = any(c.isalpha() for c in text or "")
    right = {}
    for x, c in zip(names, code):
        mine = [i for i, _, lang in rows if lang == x and learned(i) and letters[i]]
        acc = [sum((margin[i][j] > 0) == (c[j] > 0) for i in mine) / len(mine) for j in bits]
        right[x] = [a / sum(acc) for a in acc]
    out = {}
    for i, _, _ in rows:
        loss = [sum(right[x][j] * math.log1p(math.exp(-langid.SHARPNESS * margin[i][j] * c[j])) for j in bits)
                for x, c in zip(names, code)]
        best, second = sorted(loss)[:2]
        score = 1 / sum(math.exp(-len(bits) * (v - best)) for v in loss)
        out[i] = ((names[loss.index(best)], score, second - best < langid.AMBIGUITY * second)
                  if letters[i] else ("und", 0.0, False))
    return out


def test_language_margins_and_decoding_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = brute_language(rows, lambda i: i % 3 != 0)
    got = {r.id: r for r in langid.identify(df, F.col("doc_id") % 3 != 0).collect()}
    assert len(got) == len(rows)
    for i, (lang, score, ambiguous) in want.items():
        assert (got[i].lang_pred, got[i].ambiguous) == (lang, ambiguous), i
        assert abs(got[i].score - score) < 1e-4, i
    assert any(a for _, _, a in want.values()) or len({x for x, _, _ in want.values()}) == 5


def brute_quality(m, text, meta):
    """The probability by all pairs of inputs of one text."""
    text = text or ""
    data = text.encode()
    folded = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c
                     for c in text).encode()
    buckets = len(m.w) - len(m.mean)
    words = re.findall(rb"[^\x20\x09-\x0D]+", folded)
    hashed = collections.Counter()
    for w in words:
        h = int(fm.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
        hashed[(h >> 40) % buckets] += 1
    norm = math.sqrt(sum(c * c for c in hashed.values()))
    x = {b: c / norm for b, c in hashed.items()}
    lines = [t for t in data.split(b"\n") if t]
    n, k = max(len(words), 1), max(len(data), 1)

    def part(test):
        return sum(map(test, data)) / k

    stats = [math.log1p(len(data)), math.log1p(len(words)), sum(map(len, words)) / n, len(hashed) / n,
             max(hashed.values(), default=0) / n, part(lambda b: 48 <= b <= 57), part(lambda b: 65 <= b <= 90),
             part(lambda b: chr(b) in ".,;:!?'\"()-"), part(lambda b: chr(b) in "#$%&*+/<=>@[\\]^_`{|}~"),
             part(lambda b: b > 127), math.log1p(len(lines)), math.log1p(len(words) / max(len(lines), 1)),
             1 - len(set(lines)) / max(len(lines), 1), sum(data.count(c) for c in (b".", b"!", b"?")) / n]
    if not data:
        stats = [0.0] * len(stats)
    stats.append(math.nan if meta is None else math.copysign(math.log1p(abs(meta)), meta))
    for j, s in enumerate(stats):
        s = m.mean[j] if math.isnan(s) else s
        x[buckets + j] = max(-4.0, min(4.0, (s - m.mean[j]) / m.scale[j]))
    z = m.bias + sum(m.w[i] * v for i, v in x.items())
    z += sum(m.v[i] @ m.v[j] * x[i] * x[j] for i, j in itertools.combinations(x, 2))
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_quality_features_and_score_match_brute_force(spark):
    rng = np.random.default_rng(6)
    k = len(fm.STATS) + 1
    m = fm.Machine(0.2, rng.normal(0, 0.3, 64 + k), rng.normal(0, 0.2, (64 + k, 4)),
                   rng.normal(size=k), rng.uniform(0.5, 2, k))
    texts = [t for _, t, _ in corpus(16)] + [
        "One line.\nOne line.\n\nAnother, longer line: 12 % of <b>tags</b>!\nÉTÉ déjà", " \t\n", "\n", "a", "9 9 9",
        "same same same same"]
    rows = [(i, t, None if i % 4 == 0 else float(i - 7)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string, meta double").repartition(3)
    got = {r.id: r.score for r in fm.score(df, m, ["meta"]).collect()}
    for i, text, meta in rows:
        assert abs(got[i] - brute_quality(m, text, meta)) < 1e-9, (i, text)

"""Hard negatives, repeated strings and periodic runs against brute force, awkward rows included."""

import collections
import gzip
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from paneljet.llm import common, hardneg, periodic, repeats, suffix  # noqa: E402

DOCS = "doc_id long, text string, num long, none string, runs string, x int, id int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "r", 2, 3) for i, t in rows], DOCS).repartition(3)


# ---- suffixes ---------------------------------------------------------------------------

def test_names_sort_like_suffixes():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("ab"), n)) for n in (1, 9, 40, 0, 17)]
    joined = "".join(texts)
    ends = np.concatenate([[e] * len(t) for t, e in zip(texts, np.cumsum([len(t) for t in texts]))]).astype(int)
    levels = suffix.name_levels(np.frombuffer(joined.encode(), np.uint8).astype(np.int64), ends)
    rest = [joined[i:e] for i, e in enumerate(ends.tolist())]
    distinct = sorted(set(rest))
    assert [distinct.index(r) + 1 for r in rest] == levels[-1].tolist()
    i, j = rng.integers(0, len(joined), 200), rng.integers(0, len(joined), 200)
    i, j = i[i != j], j[i != j]
    want = [next((k for k, (a, b) in enumerate(zip(rest[x], rest[y])) if a != b), min(len(rest[x]), len(rest[y])))
            for x, y in zip(i.tolist(), j.tolist())]
    assert suffix.common_prefix(levels, ends, i, j).tolist() == want


def test_least_between():
    v = np.random.default_rng(1).integers(0, 99, 70)
    table = suffix.range_minimum(v)
    pairs = [(a, b) for a in range(70) for b in range(a + 1, 71)]
    lo, hi = np.array(pairs).T
    assert suffix.least_between(table, lo, hi).tolist() == [v[a:b].min() for a, b in pairs]


# ---- hard negatives ---------------------------------------------------------------------

@pytest.mark.parametrize("size,dim", [(3, 5), (300, 64), (10 ** 6, 33), (10 ** 8, 2500)])
def test_residue_products_are_exact(size, dim):
    rng = np.random.default_rng(dim)
    a = rng.integers(-size, size, (7, dim), endpoint=True)
    b = rng.integers(-size, size, (9, dim), endpoint=True)
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    bound = max(sum(int(x) ** 2 for x in r) for r in (*a, *b))
    if bound > hardneg.MOST:
        with pytest.raises(ValueError):
            hardneg.primes_for(float(bound))
        return
    primes = hardneg.primes_for(float(bound))
    left, right = (hardneg.residues(m.astype(np.float64), primes) for m in (a, b))
    assert hardneg.scores(left, right, primes).tolist() == want


def brute_negatives(rows, anchors):
    ok = [(i, lab, [int(np.floor(256.0 * x)) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (i, lab, v) in enumerate(ok):
        if not anchors(i):
            continue
        score = [(sum(a * b for a, b in zip(v, w)), j, other, m) for m, (j, other, w) in enumerate(ok)
                 if m != k and len(w) == len(v)]
        score.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _, _ in [s for s in score if s[2] == lab][:5]:
            fit = [s for s in score if s[2] != lab and 50 * p <= 100 * s[0] <= 95 * p][:3]
            out += [(i, j, r + 1, s[1], p, s[0]) for r, s in enumerate(fit)]
    return sorted(out)


def test_hard_negatives_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        v = np.abs(rng.standard_normal(6)).round(2 if i % 3 else 0)
        rows.append((i, int(rng.integers(0, 4)) if i % 5 else 0, [float(x) for x in v]))
    rows += [(240, 1, None), (250, None, [1.0] * 6), (260, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (270, 1, [float("nan")] * 6), (280, 1, [float("inf")] + [0.0] * 5), (None, 1, [1.0] * 6),
             (290, 0, [0.0] * 6), (300, 2, [2.0, 1.0]), (301, 2, [2.0, 1.0]), (302, 3, [1.5, 1.0]),
             (310, 0, []), (311, 0, []), (312, 1, [])]
    rows += [rows[7], rows[7], rows[10]]
    schema = "vec_id long, label int, embedding array<float>, windows string, row int, id int"
    df = spark.createDataFrame([(*r, "clash", 0, 0) for r in rows], schema).repartition(5)
    got = hardneg.mine(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor", "positive", "rank", "negative", "positive_score", "negative_score"]
    got = sorted(map(tuple, got.collect()))
    want = brute_negatives([(i, x, None if v is None else [None if c is None else np.float32(c).item() for c in v])
                            for i, x, v in rows], lambda i: i % 10 == 0)
    assert want and got == want
    assert hardneg.mine(df.where("false"), F.lit(True)).count() == 0


def test_hard_negatives_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "GROUP", 40)
    monkeypatch.setattr(hardneg, "TILE", 120)
    rng = np.random.default_rng(5)
    rows = [(i, 0 if i % 3 else int(rng.integers(0, 3)), [float(x) for x in rng.integers(0, 4, 4) / 4]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(map(tuple, hardneg.mine(df, F.col("vec_id") % 4 == 0).collect()))
    assert got == brute_negatives(rows, lambda i: i % 4 == 0)


# ---- repeated strings -------------------------------------------------------------------

def brute_repeats(texts, length):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\1" * length
            seen.add(w)
        out.append((len(b), bytes(x for x, g in zip(b, gone) if not g),
                    [(k, k + len(list(g))) for k, g in _runs(gone)]))
    return out


def _runs(flags):
    k = 0
    while k < len(flags):
        j = k
        while j < len(flags) and flags[j] == flags[k]:
            j += 1
        if flags[k]:
            yield k, range(j - k)
        k = j


def corpus():
    rng = random.Random(4)
    words = ["alpha", "be", "gämma", "δ", "eps", "zzz", "the", "of"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, long = prose(40), prose(400)
    texts = [prose(rng.randint(0, 120)) for _ in range(40)]
    texts += [prose(5) + passage + prose(9) for _ in range(30)]
    texts += [long, long, long[:700] + "!" + long[700:], long[3:], None, "", " ", "x" * 100, "x" * 5000, "x" * 99]
    texts += [("ab" * 300) + ("abc" * 200), "\0" * 300, "a\0b" * 100, ("word " * 3000) + passage, passage[:60]]
    return texts


@pytest.mark.parametrize("bucket", [3, 4096])
def test_repeated_strings(spark, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    if bucket == 3:
        monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
        monkeypatch.setattr(repeats, "BLOCK_BYTES", 4000)
        monkeypatch.setattr(repeats, "BATCH_BYTES", 9000)
        monkeypatch.setattr(repeats, "SAMPLE", 1)
    texts = corpus()
    out = repeats.remove_repeats(documents(spark, list(enumerate(texts))), 100)
    assert out.columns == ["id", "n_bytes", "spans", "kept"]
    got = {r.id: (r.n_bytes, bytes(r.kept), [tuple(s) for s in r.spans]) for r in out.collect()}
    for i, want in enumerate(brute_repeats(texts, 100)):
        assert got[i] == want, texts[i]


def test_repeated_strings_order_of_awkward_ids(spark):
    """Null ids come last, repeated rows count once as the first, empty tables give no rows."""
    a, b = "one text that is long enough to hold a few windows of fifty bytes", "q" * 150
    rows = [(None, a), (None, a), (-3, b), (2, a), (2, a), (9, b + a + "!"), (2, b), (4, a[:30])]
    got = repeats.remove_repeats(documents(spark, rows), 50).collect()
    kept = sorted((r.id is None, r.id or 0, bytes(r.kept)) for r in got)
    order = [(-3, b), (2, a), (2, a), (2, b), (4, a[:30]), (9, b + a + "!"), (None, a), (None, a)]
    want = [(i is None, i or 0, k) for (i, _), (_, k, _) in zip(order, brute_repeats([t for _, t in order], 50))]
    assert kept == sorted(want) and (False, 2, a.encode()) in kept and (True, 0, b"") in kept
    assert repeats.remove_repeats(documents(spark, []), 50).collect() == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(documents(spark, rows), 20)


# ---- periodic runs ----------------------------------------------------------------------

def brute_runs(words, least):
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, 2 * q):
                out.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def period_texts():
    rng = random.Random(9)
    texts = [None, "", " \t\n", "a", "a " * 11, "a " * 12, "a b " * 6, "é x " * 40, "a " * 4000, "a b a " * 2000]
    for _ in range(400):
        letters = "abcdefghij"[:rng.choice([1, 2, 3, 10])]
        w = [rng.choice(letters) for _ in range(rng.randint(0, 50))]
        w += (w[:rng.randint(0, 9)] * rng.randint(0, 6)) + w[:7]
        texts.append(rng.choice(["", " "]) + rng.choice([" ", " \n"]).join(w))
    return texts


@pytest.mark.parametrize("least", [2, 7, 12])
def test_periodic_runs(spark, least):
    texts = period_texts()
    out = periodic.periodic_runs(documents(spark, [*enumerate(texts), (None, "a " * 20)]), min_words=least)
    assert out.columns == ["id", "n_words", "runs", "collapsed"]
    got = {r.id: r for r in out.collect()}
    assert [tuple(x) for x in got.pop(None).runs] == [(0, 20, 1)]
    for i, t in enumerate(texts):
        w = [x for x in "".join(" " if c in "\t\n\v\f\r" else c for c in t or "").split(" ") if x]
        runs = brute_runs(w, least) if len(w) < 1000 else [tuple(r) for r in got[i].runs]
        assert [tuple(r) for r in got[i].runs] == runs and got[i].n_words == len(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        assert got[i].collapsed == " ".join(x for k, x in enumerate(w) if k not in gone)
    assert [tuple(r) for r in got[8].runs] == [(0, 4000, 1)] and len(got[9].runs) == (1 if least > 2 else len(got[9].runs))
    assert periodic.periodic_runs(documents(spark, [])).collect() == []


def test_runs_do_not_depend_on_slices():
    texts = period_texts()
    seen = []
    for limit in (1, 300, 1 << 20):
        got = []
        for _, _, data, starts in common.text_slices(pa.array(texts), limit):
            counts, splits, runs, text = periodic.slice_runs(data, starts, 6)
            got += [(n, runs[a:b].tolist(), t) for n, a, b, t in zip(counts.tolist(), splits, splits[1:], text.to_pylist())]
        seen.append(got)
    assert seen[0] == seen[1] == seen[2]


# ---- packing: texts that the rank file's matcher gives up on ------------------------------

def test_packing_of_very_long_white_space(spark):
    import zlib

    from tokenizers import Tokenizer

    from paneljet.llm import packing

    path = public_tokenizers.path("byte_bpe_50k.json")
    full = Tokenizer.from_file(path)
    texts = [" " * 1_200_000, "\n" * 1_200_000, "word" + " \t\n" * 500_000 + "end", "plain text"]
    out = packing.pack(documents(spark, list(enumerate(texts))), path).collect()
    for i, t in enumerate(texts):
        ids = np.array(full.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        pieces = sorted((r.piece, r.start, r.length, r.crc) for r in out if r.id == i)
        assert sum(p[2] for p in pieces) == len(ids)
        assert all(zlib.crc32(ids[a:a + n].tobytes()) == c for _, a, n, c in pieces)


def test_warc_files_are_cut_by_bytes_and_null_keys_are_responses(spark, tmp_path, monkeypatch):
    from paneljet.llm import warc

    monkeypatch.setattr(warc, "BUNDLE_BYTES", 20_000)
    monkeypatch.setattr(warc, "BATCH_BYTES", 20_000)
    small, large = "<p>s</p>" * 20, "<p>\u00e9\r\n</p>" * 4000
    rows = [(i, "http://a", f"{i}" + (large if 40 <= i < 50 else small)) for i in range(200)]
    rows += [(None, "http://n", rows[3][2]), (None, None, None), (300, "http://b", rows[3][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    bundles = warc.convert_pages(df, "page_id", "url", "html")
    sizes = [len(r.records.encode()) for r in bundles.collect()]
    assert sum(n > 20_000 for n in sizes) == 10 and max(sizes) < 48_000      # a large record alone
    warc.write_warc(bundles, str(tmp_path / "w"))
    plain = [len(gzip.decompress(p.read_bytes())) for p in (tmp_path / "w").glob("*.gz")]
    assert len(plain) == -(-len(sizes) // warc.BUNDLES) > 1
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert collections.Counter((r.key, r.type, r.refers_key) for r in got) == collections.Counter(
        [(str(i), "response", None) for i in range(200)] + [(None, "response", None)] * 2 + [("300", "revisit", "3")])
    assert {r.key: bytes(r.payload) for r in got if r.key == "45"} == {"45": rows[45][2].encode()}
    lean = warc.read_warc(spark, str(tmp_path / "w"), payloads=False)
    assert "payload" not in lean.columns and lean.count() == len(rows)
    data = warc.to_warc(warc.ArcRecord({"URL": "u", "IP-address": "0", "Archive-date": "2020", "Content-type": "t"},
                                       b"x"), "k")
    members = gzip.compress(data) + gzip.compress(data)
    assert [h["X-Record-Key"] for h, _ in warc.parse_warc(members)] == ["k", "k"]
    for bad in (data[:-3], data[:-5] + data[-4:], b"WARC/1.0\r\nA: b"):
        with pytest.raises(ValueError):
            list(warc.parse_warc(bad))


def test_registered_domains_and_strangers_under_one_public_suffix(spark):
    from paneljet.llm import urlrep

    hosts = {"a.b.example.com": ("example.com", "com"), "x.shop.co.uk": ("shop.co.uk", "co.uk"),
             "co.uk": ("co.uk", "co.uk"), "u:p@me.github.io:80": ("me.github.io", "github.io"),
             "10.20.30.40:8080": ("10.20.30.40", ""), "[2001:db8::1]:80": ("[2001:db8::1]", ""),
             "localhost": ("localhost", "localhost"), "": ("", ""), "notco.uk": ("notco.uk", "uk")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = df.select("host", urlrep.domain_of(F.col("host")), urlrep.suffix_of(F.col("host"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == hosts
    # bad pages of one domain tell more of its own new host than of a stranger's under the suffix
    pages = [(f"http://h{i}.bad.co.uk/{j}", 1) for i in range(3) for j in range(200)]
    pages += [(f"http://www.good{i}.co.uk/{j}", 0) for i in range(6) for j in range(100)]
    pages += [(f"http://www.site{i}.com/{j}", int(i == 0)) for i in range(9) for j in range(60)]
    pages += [("http://new.bad.co.uk/", None), ("http://fresh.co.uk/" + "x" * 200_000, None)]
    table = spark.createDataFrame(pages, "url string, bad int")
    rows = {r.host: r for r in urlrep.judge(table, [], "bad").collect()}
    assert rows["h0.bad.co.uk"].verdict == "block" and rows["fresh.co.uk"].verdict == "allow"
    assert rows["new.bad.co.uk"].bad_rate > rows["fresh.co.uk"].bad_rate + 0.2
    # ties between rules of one length: the later in text order
    tied = [urlrep.Rule("uk", "/ab", "allow"), urlrep.Rule("x.uk", "/", "block")]
    one = spark.createDataFrame([("http://x.uk/abc", None)], "url string, bad int")
    assert [r.rule for r in urlrep.judge(one, tied, "bad").collect() + urlrep.judge(one, tied[::-1], "bad").collect()
            ] == ["x.uk/"] * 2

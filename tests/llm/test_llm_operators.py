"""Training-data operators against brute force on small tables with awkward rows."""

import collections
import hashlib
import itertools
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from paneljet.llm import common, decontam, fm, langid, packing, pii, sharding, simhash  # noqa: E402
from paneljet.llm import urlrep, vecjoin, warc  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, t string"
WORDS = {"aa": "the of and then there with that was over under".split(),
         "bb": "der die und nicht über eine schön groß wird für".split(),
         "cc": "les une avec pour déjà même très où voilà était".split()}


def prose(lang, n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS[lang], n).tolist())


@pytest.fixture(scope="module")
def docs(spark):
    """Languages, copies, near copies, nulls, empty and very long texts, repeated rows, extra
    columns whose names clash with the operators' own."""
    rows = []
    for i in range(60):
        lang = "aa bb cc".split()[i % 3]
        rows.append((i, prose(lang, 30 + i, i), lang))
    copy = prose("aa", 300, 999)
    rows += [(100 + i, copy, "aa") for i in range(20)]
    rows += [(130, copy + " tail", "aa"), (131, copy.upper(), None)]
    rows += [(140, None, "aa"), (141, "", "bb"), (142, " \n\t ", None), (143, "12 34 %%", None),
             (144, "Ünïcödé", None), (None, prose("bb", 12, 5), "bb"), (145, "x", "aa")]
    rows += [(150, "word " * 60000, "aa"), (151, "9" * 50000, None)]
    rows += [(5, rows[5][1], rows[5][2])] * 2
    return spark.createDataFrame(
        [(i, t, x, "s", len(t or ""), 7, "clash") for i, t, x in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- shared helpers -------------------------------------------------------------------

def test_text_slices_keep_every_byte():
    texts = ["abc", None, "", "é" * 50, "z" * 500]
    got = []
    for lo, hi, data, starts in common.text_slices(pa.array(texts), 64):
        got += [bytes(data[a:b - 1]).decode() for a, b in zip(starts, starts[1:])]
    assert got == [t or "" for t in texts]
    sliced = pa.array(["q", *texts, "q"]).slice(1, len(texts))
    assert [hi - lo for lo, hi, _, _ in common.text_slices(sliced, 64)] == [3, 1, 1]


def test_rank_within_hot_group(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7).alias("g"))
    out = common.rank_within(df, "g", ["id"], "rank", 16).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.g].append(r["rank"])
    assert len(out) == 3000 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    pairs += [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 530)]
    want = groups(pairs, {x for p in pairs for x in p})
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r.node: r.component for r in common.components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: want[n] for n in touched}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1 language ID --------------------------------------------------------------------

def test_codewords_split_and_stay_apart():
    for n in (2, 3, 4, 6, 9, 40):
        code = langid.codewords(n)
        apart = min((a != b).sum() for a, b in itertools.combinations(code, 2))
        assert apart >= (1 if n < 4 else code.shape[1] // 4)
        assert (code.max(0) > 0).all() and (code.min(0) < 0).all()


def test_language_id(docs, empty):
    out = langid.identify(docs, common.fold(F.col("doc_id"), 5) != 0)
    rows = {(r.id, r.lang_pred, round(r.score, 9)) for r in out.collect()}
    assert out.count() == docs.count()
    pred = {i: (p, s) for i, p, s in rows}
    assert all(pred[i][0] == ["aa", "bb", "cc"][i % 3] for i in range(60))
    for i in (140, 141, 142, 143, 151):
        assert pred[i] == ("und", 0.0)
    assert pred[144][0] != "und" and all(0 <= s <= 1 for _, s in pred.values())
    assert langid.identify(empty, F.lit(True)).count() == 0


def test_language_id_one_or_no_language(docs):
    one = langid.identify(docs, F.col("lang") == "aa").where("lang_pred <> 'und'")
    assert {(r.lang_pred, r.score) for r in one.select("lang_pred", "score").collect()} == {("aa", 1.0)}
    none = langid.identify(docs, F.lit(False))
    assert {r.lang_pred for r in none.collect()} == {"und"}


# ---- 2 SimHash ------------------------------------------------------------------------

def brute_fingerprint(text, n=4):
    low = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_vector_xxh64_all_lengths():
    data = np.random.default_rng(0).integers(0, 256, 1000).astype(np.uint8)
    start = np.arange(0, 300)
    end = start + np.arange(300)
    got = simhash.hash_spans(data, start, end, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(bytes(data[a:b]), 42) for a, b in zip(start, end)]


def test_simhash_matches_brute_force(docs, empty):
    rows = collected(docs)
    fp = collections.Counter((i, brute_fingerprint(t)) for i, t in rows)
    out = simhash.near_duplicates(docs).collect()
    assert collections.Counter((r.id, r.fp % (1 << 64)) for r in out) == fp
    nodes = {f for _, f in fp}
    comp = groups([(a, b) for a, b in itertools.combinations(nodes, 2) if (a ^ b).bit_count() <= 4], nodes)
    low = {}
    for i, f in fp:
        if i is not None:
            low[comp[f]] = min(i, low.get(comp[f], i))
    assert all(r.component == low.get(comp[r.fp % (1 << 64)]) for r in out)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
def test_pigeonring_join_is_complete(spark, distance):
    rng = np.random.default_rng(distance)
    base = [int(x) for x in rng.integers(0, 1 << 62, 40)]
    fps = set(base)
    for b in base:
        for k in range(1, distance + 3):
            for bit in rng.choice(64, k, replace=False):
                b ^= 1 << int(bit)
            fps.add(b)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f, f) for f in signed], "id long, fp long")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.similar_pairs(nodes, distance).collect()}
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2)
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    assert got == want


# ---- 3 packing ------------------------------------------------------------------------

def test_packing_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for capacity in (7, 50, 64):
        for _ in range(30):
            lens = rng.integers(1, capacity + 1, rng.integers(1, 200)).tolist()
            slots = packing.best_fit(collections.Counter(lens), capacity)
            bins = collections.defaultdict(list)
            for length, lo, hi, per, first, at in slots:
                for k in range(hi - lo):
                    bins[first + k // per].append((at + k % per * length, length))
            for b in bins.values():
                b.sort()
                assert [x for x, _ in b] == [0, *itertools.accumulate(n for _, n in b)][:-1]
                assert sum(n for _, n in b) <= capacity
            assert sorted(n for b in bins.values() for _, n in b) == sorted(lens)
            free = []      # one piece at a time, as the textbook has it
            for n in sorted(lens, reverse=True):
                fit = [x for x in free if x >= n]
                if fit:
                    free.remove(min(fit))
                free.append((min(fit) if fit else capacity) - n)
            assert len(bins) == len(free)


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    packed = packing.pack(docs, path, 2048, with_ids=True)
    rows = packed.collect()
    want = collections.Counter()
    for i, t in collected(docs):
        want[i, tuple(tk.encode(t or "", add_special_tokens=False).ids + [0])] += 1
    seqs = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    assert sum(map(len, seqs.values())) == sum(len(k[1]) * n for k, n in want.items())
    assert max(map(len, seqs.values())) <= 2048
    parts = collections.defaultdict(list)
    for r in rows:
        ids = seqs[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(ids.tobytes()) == r.crc
        parts[r.id].append((r.piece, r.start, ids.tolist()))
    single = {k[0]: k[1] for k, n in want.items() if n == 1 and k[0] != 5}
    for i, ids in single.items():
        got = sorted(parts[i])
        assert tuple(itertools.chain(*[x for _, _, x in got])) == ids
        assert all(len(x) == 2048 for _, _, x in got[1:]) and [p for p, _, _ in got] == list(range(len(got)))
    assert packing.pack(empty, path).count() == 0


def test_special_token_text_like_the_json_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tk, enc = Tokenizer.from_file(path), packing._encoder(path)
    for t in ("a <|endoftext|> b", "x\u00a0y  \n\n z", "naïve 日本語 🙂", "don't  stop", "1 000,5"):
        assert enc(t).tolist() == tk.encode(t, add_special_tokens=False).ids


# ---- 4 PII ----------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return [(pii.KINDS[k], a, b) for a, k, b in sorted(out)]


def test_pii_base_equals_the_patterns():
    rng = np.random.default_rng(11)
    alphabet = list("ab1@.+-() 2%_9é:/4")
    for _ in range(4000):
        t = "".join(rng.choice(alphabet, rng.integers(0, 60)))
        assert [s for s in pii.find_spans(t) if s[0] in pii.BASE] == brute_base(t), t
    for t in ("4111 1111 1111 1111 x", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "300.1.1.1.2.3.4.5", "+1 (234) 567-8901"):
        assert [s for s in pii.find_spans(t) if s[0] in pii.BASE] == brute_base(t)


def test_pii_anchors_and_redaction():
    t = ("mail joe.x@mail.example.com, IBAN: DE89 3704 0044 0532 0130 00 and account no. 1234-567890 "
         "at http://10.0.0.1:80/a or ftp://bob:pw@host.example/x; the account was closed in 1999")
    spans = pii.find_spans(t)
    assert [(k, t[a:b]) for k, a, b in spans if k in ("email", "account", "address")] == [
        ("email", "joe.x@mail.example.com"), ("account", "DE89 3704 0044 0532 0130 00"),
        ("account", "1234-567890"), ("address", "http://10.0.0.1:80"),
        ("address", "ftp://bob:pw@host.example"), ("email", "pw@host.example")]
    out = pii.redact_text(t, spans)
    assert "[EMAIL]" in out and "[ACCOUNT]" in out and "DE89" not in out and "1999" in out
    assert pii.find_spans(None) == [] and pii.find_spans("") == []


def test_pii_query_columns(docs, empty):
    rows = {r.id: r for r in pii.personal_data(docs).collect()}
    assert rows[140].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[140].spans == []
    assert len(rows) == len({i for i, _ in collected(docs)})
    assert pii.redact(docs).columns == docs.columns
    assert pii.redact(docs).where("doc_id = 140").first().text is None
    assert pii.personal_data(empty).count() == 0 and pii.redact(empty).count() == 0


# ---- 5 sharding -----------------------------------------------------------------------

def test_sharding(docs, empty, spark):
    out = sharding.assign_shards(docs, [1.0] * 8, [1.0] * 9).collect()
    texts = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                                for i, t in collected(docs))
    assert collections.Counter((r.key, r["size"], r.text_crc32) for r in out) == texts
    slots = collections.defaultdict(list)
    for r in out:
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(empty, [1.0] * 8).count() == 0
    many = spark.range(40000).select(sharding.shard_of(F.col("id"), [1.0, 2.0, 5.0]).alias("s"))
    share = {r.s: r["count"] / 40000 for r in many.groupBy("s").count().collect()}
    assert all(abs(share[s] - w / 8) < 0.01 for s, w in enumerate([1, 2, 5]))


def test_sharding_plan_is_native(docs):
    plan = docs.select(sharding.shard_of(F.col("doc_id"), [1.0] * 8))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 6 URL filters --------------------------------------------------------------------

def test_url_parts_rules_and_reputation(spark):
    rows = [(i, f"http://bad.example.com/{i}", 1) for i in range(40)]
    rows += [(100 + i, f"http://good{i % 5}.example.org/p?q#f", 0) for i in range(60)]
    rows += [(200, "http://New.bad.NET/x", None), (201, "https://a.example.net/en/x?y", None),
             (202, "no scheme", None), (203, None, None), (204, "x://u@H.Org:80/fr/z", None),
             (205, "http://a.org/fr/1", None), (206, "http://k.net", None), (207, "", 1),
             (208, "http://once.example.com/", 1), (208, "http://once.example.com/", 1)]
    rules = [urlrep.Rule("net", "/", "block"), urlrep.Rule("example.net", "/en/", "allow"),
             urlrep.Rule("org", "/fr/", "allow")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, bad int, n int")
    got = {r.page_id: r for r in urlrep.judge(df, rules, "bad").collect()}
    assert got[0].verdict == "block" and got[0].rule is None and got[100].verdict == "allow"
    assert (got[200].host, got[200].path, got[200].rule, got[200].verdict) == ("new.bad.net", "/x", "net/", "block")
    assert (got[201].rule, got[201].verdict) == ("example.net/en/", "allow")
    assert all((got[i].host, got[i].path, got[i].rule, got[i].verdict) == ("", "", None, "allow") for i in (202, 203, 207))
    assert got[204].host == "u@h.org:80" and got[204].rule is None
    assert got[205].rule == "org/fr/" and got[206].rule is None
    assert got[208].verdict in ("allow", "block") and got[208].bad_rate < got[0].bad_rate
    assert urlrep.judge(df.where("false"), rules, "bad").count() == 0
    unlabelled = df.withColumn("bad", F.lit(None).cast("int"))
    assert urlrep.judge(unlabelled, [], "bad").where("verdict = 'block'").count() == 0


# ---- 7 vectors ------------------------------------------------------------------------

@pytest.mark.parametrize("dim,cosine", [(64, 0.95), (20, 0.9), (3, 0.99), (1, 0.5)])
def test_vector_links_match_brute_force(spark, dim, cosine, monkeypatch):
    monkeypatch.setattr(vecjoin, "TILE", 16)      # several cells, tiles of residents and guests
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(25, dim))
    x = np.concatenate([base + s * rng.normal(size=base.shape) * np.abs(base).mean() for s in (0, 0.1, 0.2, 0.3)])
    x = np.concatenate([x, x[:10] * 3, np.repeat(x[:1], 20, axis=0)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * dim), (1003, [float("nan")] * dim),
           (1004, [None] + [1.0] * (dim - 1)), (1005, [float("inf")] * dim)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    got = {r.id: r for r in vecjoin.near_duplicates(df, cosine=cosine).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = (u @ u.T) >= cosine - 1e-12
    np.fill_diagonal(near, False)
    comp = groups(zip(*[a.tolist() for a in np.nonzero(near)]), range(len(x)))
    assert {i: (got[i].n_links, got[i].component) for i in range(len(x))} == {
        i: (int(near[i].sum()), comp[i]) for i in range(len(x))}
    assert all((got[i].n_links, got[i].component) == (0, i) for i, _ in odd)
    assert vecjoin.near_duplicates(df.where("false")).count() == 0


def test_vector_join_compares_few_pairs():
    rng = np.random.default_rng(3)
    shares = []
    for n in (4000, 8000):
        x = rng.normal(size=(n, 64)).astype(np.float32)
        plan = vecjoin.make_plan(x[:vecjoin.SAMPLE], n, 0.95)
        tiles = [vecjoin.Tile(plan, b, 0, n, x, np.arange(n), True, False)
                 for b in range(len(plan.spans))]
        assert not [1 for t in tiles for _ in t.pairs()]
        shares.append(sum(t.compared for t in tiles) / (n * (n - 1) / 2))
    assert max(shares) < 1 / 3 and shares[1] < shares[0]


@pytest.mark.parametrize("tile", [1 << 14, 100])
def test_vector_near_copies_make_no_pair_table(spark, tile, monkeypatch):
    monkeypatch.setattr(vecjoin, "TILE", tile)
    rng = np.random.default_rng(4)
    group = rng.normal(size=64) + 0.02 * rng.normal(size=(600, 64))
    x = np.concatenate([rng.normal(size=(200, 64)), group]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    nodes = df.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"),
                      F.col("embedding").alias("vec"))
    found = vecjoin.links(nodes, 64, 0.95)
    assert found.count() <= 600 * 5 * (1 if tile > 600 else 60)
    got = {r.id: (r.n_links, r.component) for r in vecjoin.near_duplicates(df).collect()}
    assert got == {i: (0, i) if i < 200 else (599, 200) for i in range(800)}


# ---- 8 WARC ---------------------------------------------------------------------------

def test_arc_versions_and_errors():
    recs = [("http://a/ b", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"), (None, b""), ("http://c", b"\n\nfiledesc://\n")]
    for version in (1, 2):
        data = warc.write_arc(recs, version, "199912312359")
        got = list(warc.parse_arc(data))
        assert [r.block for r in got] == [b for _, b in recs]
        assert [r.fields["URL"] for r in got] == ["http://a/%20b", "urn:none", "http://c"]
        with pytest.raises(ValueError):
            list(warc.parse_arc(data[:-4]))
        (h, block), = warc.parse_warc(warc.to_warc(got[0], "k"))
        assert h["WARC-Date"] == "1999-12-31T23:59:00Z" and block == recs[0][1]
        assert h["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(b"body").hexdigest()
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"WARC/1.0\r\n"))
    assert list(warc.parse_arc(b"")) == [] and warc.record_id("a") != warc.record_id("b")


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é</p>" * 30
    rows = [(5, "http://a", big), (3, "http://b", big), (9, None, big), (1, "u", None), (2, "u", ""),
            (4, "x y", "small"), (6, "z", "small"), (7, "w", "WARC/1.0\r\n\r\nHTTP/1.1\r\n\r\n" * 20), (3, "http://b", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(0))
    got = collections.Counter((int(r.key), r.length, r.digest, r.type, r.refers_key)
                              for r in warc.round_trip(df).collect())
    want = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = h == big and i != 3
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", "3" if again else None] += 1
    assert got == want
    assert warc.round_trip(df.where("false")).count() == 0
    (tmp_path / "a.arc").write_bytes(warc.write_arc([("http://a", b"one"), ("http://b", b"two")], 2))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    blocks = [warc.http_parts(b)[1] for r in warc.convert_arc_files(files).collect() for _, b in warc.parse_warc(bytes(r.record))]
    assert sorted(blocks) == [b"one", b"two"]


# ---- 9 quality ------------------------------------------------------------------------

def test_machine_identity_and_learning(spark, docs, empty):
    rng = np.random.default_rng(2)
    m = fm.Machine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)), np.zeros(1), np.ones(1))
    x = rng.normal(size=6)
    z = 0.3 + m.w @ x + sum(m.v[i] @ m.v[j] * x[i] * x[j] for i, j in itertools.combinations(range(6), 2))
    assert np.isclose(m.score(1, np.zeros(6, int), np.arange(6), x)[0], 1 / (1 + np.exp(-z)))
    rows = [(i, prose("aa", 40, i) if i % 2 else "zq" + " %%% zq" * 30, i) for i in range(120)]
    rows += [(500, None, None), (501, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumn("id", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(3, 1), (None, 0), (500, None)],
                                   "doc_id long, quality int")
    got = {r.id: r.score for r in fm.quality(df, labels, F.lit(True), metadata=("n",)).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(80, 120))
    assert 0 <= got[500] <= 1 and 0 <= got[501] <= 1 and len(got) == len(rows)
    same = {r.id: r.score for r in fm.quality(df.repartition(7), labels, F.lit(True), metadata=("n",)).collect()}
    assert all(abs(same[i] - got[i]) < 1e-6 for i in got)
    assert {r.score for r in fm.quality(df, labels.where("false"), F.lit(True)).collect()} == {0.5}
    assert fm.quality(empty, labels, F.lit(True)).count() == 0
    assert fm.quality(docs, labels, F.lit(True)).count() == docs.count()


# ---- 10 decontamination ---------------------------------------------------------------

def brute_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_smith_waterman_matches_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(1, 25)).astype(np.uint64) for _ in range(2))
        assert decontam.align(a, b)[0] == brute_align(a, b)


def test_decontamination(spark, empty, monkeypatch):
    rng = np.random.default_rng(8)
    vocab = np.array([a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnrst"])
    items = [" ".join(rng.choice(vocab, 30)) for _ in range(6)] + ["one two three", "", None]
    noise = [" ".join(rng.choice(vocab, 80)) for _ in range(40)]
    edited = items[1].split()
    edited[7], edited[19] = "xx", "yy"
    del edited[25]
    rows = [(i, t) for i, t in enumerate(noise)]
    rows += [(100, noise[0] + "\n" + items[0].upper().replace(" ", ", ") + ". " + noise[1]), (101, items[1]),
             (102, noise[2] + " " + " ".join(edited) + " " + noise[3]), (103, " ".join(items[2].split()[:8])),
             (104, None), (105, ""), (106, "say one two three now"), (None, items[0]), (107, (items[3] + " ") * 200),
             (108, items[0] + " " + items[1]), (101, items[1])]
    rows += [(200 + i, items[4] + f" {i}") for i in range(60)]        # leaked into most documents
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit(1))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(100, 0), (101, 1), (102, 1), (106, 6), (107, 3), (108, 0), (108, 1)} | {(200 + i, 4) for i in range(60)}
    got = {(r.id, r.item_id): r for r in decontam.leaks(docs, bench).collect()}
    assert set(got) == want
    r = got[100, 0]
    assert rows[40][1].encode()[r.start:r.end].decode().lower() == items[0].replace(" ", ", ")
    assert r.score == 1.0 and 0.7 < got[102, 1].score < 1.0
    assert decontam.leaks(empty, bench).count() == 0
    assert decontam.leaks(docs, bench.where("false")).count() == 0
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)                 # several blocks, same leaks
    assert {(r.id, r.item_id) for r in decontam.leaks(docs, bench).collect()} == want


@pytest.mark.parametrize("others,copies", [(2500, 1), (99, 1), (200, 100)])
def test_decontamination_does_not_depend_on_corpus_or_copies(spark, others, copies):
    rng = np.random.default_rng(21)
    vocab = np.array([a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnrst"])
    item = rng.choice(vocab, 40).tolist()
    edited = item[:5] + [w if i % 4 else "xx" for i, w in enumerate(item[5:])]    # one intact 5-gram
    rows = [(i, " ".join(rng.choice(vocab, 30))) for i in range(others)]
    rows += [(10000 + i, f"{rows[i % others][1]} {' '.join(edited)} {i}") for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.id for r in decontam.leaks(docs, bench).collect()} == {10000 + i for i in range(copies)}


@pytest.mark.parametrize("shared,threshold", [(16, 0.5), (1, 0.5), (1, 0.7)])
def test_decontamination_finds_all_that_align(spark, monkeypatch, shared, threshold):
    rng = np.random.default_rng(22)
    vocab = np.array([a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnrst"])
    items = [rng.choice(vocab, int(n)).tolist() for n in rng.integers(12, 40, 12)]
    items += [items[0][:20] + rng.choice(vocab, 8).tolist(), items[0][5:] + items[1][:9]]   # pairs in common
    texts = [[w if i % 5 else "xx" for i, w in enumerate(items[2])],              # no 5-gram left
             [w if i % 3 else "xx" for i, w in enumerate(items[3])],              # no 3-gram left
             [x for w in items[4] for x in (w, "xx")],                            # no two words in a row
             [w for i, w in enumerate(items[5]) if i % 4]]
    for _ in range(150):
        out = []
        for w in items[rng.integers(len(items))]:
            u = rng.random() * 2
            out += [[rng.choice(vocab)], [w, rng.choice(vocab)], []][int(u * 5)] if u < 0.6 else [w]
        texts.append(rng.choice(vocab, 9).tolist() + out + rng.choice(vocab, 9).tolist())
    want = set()
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            if brute_align(x, t) >= threshold * 2 * len(x):
                want.add((d, i))
    assert 40 < len(want) and (threshold > 0.5 or {(0, 2), (1, 3), (2, 4), (3, 5)} <= want)
    monkeypatch.setattr(decontam, "MIN_SHARED", shared, raising=False)
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = decontam.leaks(docs, bench, threshold=threshold).collect()
    assert {(r.id, r.item_id) for r in got} == want
    for r in got:
        t, x = texts[r.id], items[r.item_id]
        assert r.score == brute_align(x, t) / (2 * len(x))
        assert brute_align(x, " ".join(t)[r.start:r.end].split()) == brute_align(x, t)


def test_warc_keeps_a_page_that_starts_like_an_http_header(spark):
    raw = "HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>page</p>"
    pages = [(1, raw), (2, raw * 5), (3, raw * 5), (4, "HTTP/1.0 without an end"), (5, "HTTP/1.1 204\r\n\r\n")]
    df = spark.createDataFrame([(i, "http://a", h) for i, h in pages], "page_id long, url string, html string")
    got = {int(r.key): r for r in warc.round_trip(df).collect()}
    for i, h in pages:
        assert got[i].length == len(h) and got[i].digest == hashlib.sha256(h.encode()).hexdigest()
        assert (got[i].refers_key == "2" and got[i].payload is None) if i == 3 else bytes(got[i].payload) == h.encode()


def test_pii_identifiers_and_schemes_are_not_cut():
    for gap in (1, 70, 100, 5000):
        for cue in ("Account no", "IBAN", "konto :"):
            ident = "GB82 WEST 1234 5698 7654 32" if cue == "IBAN" else "1234567890123456"
            t = cue + " " * gap + ident
            found = [(a, b) for k, a, b in pii.find_spans(t) if k == "account"]
            assert found == [(len(t) - len(ident), len(t))], (cue, gap)
            assert not any(c.isdigit() for c in pii.redact_text(t, pii.find_spans(t)))
    assert not [s for s in pii.find_spans("account " + "7" * 90) if s[0] == "account"]     # too long: no part of it
    t = "averyveryverylongscheme://me:secret@host/x"
    assert ("address", 0, t.index("/x")) in pii.find_spans(t)
    assert pii.find_spans("account" + " " * 200000) == [] and pii.find_spans("iban x " * 20000 + "a" * 50000 + "://") == []
    assert pii.find_spans("iban 1" + "9a" * 50000) == []


def test_quality_fit_takes_one_row_of_an_id(spark, monkeypatch):
    rows = [(i, prose("aa", 40, i) if i % 2 else "zq" + " %%% zq" * 30, i) for i in range(40)]
    rows += [(3, rows[3][1], 3)] * 200 + [(4, prose("bb", 30, i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, n long")
    votes = spark.createDataFrame([(i, i % 2) for i in range(40)], "id long, label int")
    sizes, fit = [], fm.fit
    monkeypatch.setattr(fm, "fit", lambda words, stats, y, buckets: sizes.append(len(y)) or fit(words, stats, y, buckets))
    a, b = (fm.train(df.repartition(k), votes, ["n"], max_rows=30) for k in (1, 7))
    assert sizes == [30, 30] and np.array_equal(a.w, b.w)

"""Registered training-data queries and the pipeline on the smallest driver tables."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from paneljet.llm import langid, pii, queries, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def test_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    n = {"op6_url_filter": "pages", "op8_warc": "pages", "op7_vector_dedup": "embeddings",
         "op11_hard_negatives": "embeddings"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{n}.parquet").count()
    got = df.count()
    part = name.startswith(("op10", "op11"))        # leaks only, anchors' negatives only
    assert got >= rows if name.startswith("op3") else (got > 0 if part else got == rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("pages", "labels", "embeddings", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name]).fetchall()
    got = queries.QUERIES[name](spark, SF)
    order = [c[0] for c in con.sql(queries.ORACLE[name]).description]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(order).collect())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    out = queries.op1_language_id(spark, SF).join(docs, "doc_id").where("held_out AND lang_pred <> 'und'")
    assert out.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = queries.op9_quality(spark, SF).join(labels, "doc_id").where("held_out")
    assert out.select(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.85


def test_pipeline_against_brute_force(spark):
    """Every stage's decisions recomputed in plain Python on what the stage before kept."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {None: docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        docs = docs.checkpoint()
        seen[name] = docs
    text = {k: {r.doc_id: r.text for r in d.collect()} for k, d in seen.items()}
    out = langid.identify(seen[None], F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    assert set(text["language_id"]) == {r.id for r in out.collect() if r.lang_pred != "und" and not r.ambiguous}
    ids = sorted(text["language_id"])
    fp = [int(simhash.fingerprints(simhash.pa.array([text["language_id"][i]]), 4)[0]) for i in ids]
    first = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for a in range(len(ids)):
            for b in range(a):
                low = min(first[a], first[b])
                if (fp[a] ^ fp[b]).bit_count() <= 4 and (first[a] != low or first[b] != low):
                    first[a] = first[b] = low
                    changed = True
    assert set(text["simhash_dedup"]) == {ids[i] for i in set(first)}
    words = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in t.lower()).split()]
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i, t in text["simhash_dedup"].items() if any(f" {x} " in f" {' '.join(words(t))} " for x in items)}
    assert dirty and set(text["decontamination"]) == set(text["simhash_dedup"]) - dirty
    assert text["pii"] == {i: pii.redact_text(t, pii.find_spans(t)) for i, t in text["decontamination"].items()}
    tk = Tokenizer.from_file(queries.public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: tk.encode(t, add_special_tokens=False).ids + [0] for i, t in text["pii"].items()}
    packed = corpus_pipeline.packing_stage(spark, seen["pii"], SF).collect()
    for r in packed:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))


def test_pipeline_awkward_tables(spark, tmp_path):
    rows = [(1, "the cat sat on the mat", "en"), (1, "the cat sat on the mat", "en"), (2, None, None),
            (3, "", "en"), (None, "the cat sat on the mat", "en"), (4, "1234", "en"), (5, "joe@x.example.com was here now", "en")]
    docs = spark.createDataFrame([(i, t, x, "s", 1, 5) for i, t, x in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, id int")
    bench = spark.createDataFrame([(1, "some other long benchmark sentence")], "item_id long, text string")
    for name, data in (("a", docs), ("b", docs.where("false"))):
        sf = str(tmp_path / name)
        data.write.parquet(f"{sf}/documents.parquet")
        bench.write.parquet(f"{sf}/benchmark.parquet")
        out = corpus_pipeline.run(spark, sf)
        got = sorted((r.doc_id, r.length > 1) for r in out.collect())
        assert got == ([(1, True), (5, True)] if name == "a" else [])


def test_pipeline_judges_null_and_repeated_ids_by_their_text(spark, tmp_path):
    """Rows without an id, or that share one, are dropped or kept each for its own text."""
    other = "a wholly different line about rivers and the boats that sail on them"
    leak = "some other long benchmark sentence that nobody should train on"
    rows = [(None, "the cat sat on the mat"), (None, other), (None, f"before {leak} after"),
            (7, "12345"), (7, "the dog lay down on the rug by the fire"), (8, leak),
            (8, "the bird flew over the house and the old garden"), (9, other), (9, other), (None, "678")]
    sf = str(tmp_path)
    (spark.createDataFrame([(i, t, "en", "s", len(t), "x") for i, t in rows],
                           "doc_id long, text string, lang string, source string, n_chars long, __key_doc string")
     .write.parquet(f"{sf}/documents.parquet"))
    (spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).checkpoint()
    assert sorted(map(repr, docs.select("doc_id", "text").collect())) == sorted(
        f"Row(doc_id={i!r}, text={t!r})" for i, t in [
            (None, rows[0][1]), (7, rows[4][1]), (8, rows[6][1]), (9, other)])

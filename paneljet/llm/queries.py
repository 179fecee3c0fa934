"""Registered queries of the training-data operators (op1 .. op13) and their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, fm, hardneg, langid, packing, periodic, pii, repeats, sharding
from . import simhash, urlrep, vecjoin, warc
from .common import fold

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
SHARDS = 8
RULES = [urlrep.Rule("net", "/", "block"), urlrep.Rule("example.net", "/en/", "allow"),
         urlrep.Rule("example.com", "/de/", "block"), urlrep.Rule("org", "/fr/", "allow")]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_language_id(spark, sf_dir):
    """Language of every document; one in five (by crc32 of the id) is held out of the training."""
    docs = table(spark, sf_dir, "documents")
    learned = fold(F.col("doc_id"), 5) != 0
    out = langid.identify(docs.select("doc_id", "text", "lang"), learned)
    held = F.coalesce(fold(F.col("id"), 5) == 0, F.lit(True))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score",
                      "ambiguous")


@register
def op2_simhash(spark, sf_dir):
    """SimHash groups of all documents: 4-word shingles, links at 4 or fewer bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return out.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


@register
def op3_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens."""
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), CAPACITY)
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length",
                      F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


@register
def op4_pii(spark, sf_dir):
    """Personal data of all documents: counts, digest of the base spans, all spans."""
    out = pii.personal_data(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                      "base_sha256", F.col("joined").alias("spans"))


@register
def op5_sharding(spark, sf_dir):
    """All documents over 8 equal shards by rendezvous hashing of doc_id, and over 9."""
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), [1.0] * SHARDS,
                                 [1.0] * (SHARDS + 1))
    return out.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")


@register
def op6_url_filter(spark, sf_dir):
    """Verdict on every page's url. The last number of a url's path names the document it
    shows; pages of documents labelled toxic or of low quality are bad outcomes."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = (table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("d"))
              .agg(F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0))
                   .alias("bad")))
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)[^/]*$', 1) AS bigint)")
    rows = pages.withColumn("n", number).join(labels, F.col("n") == F.col("d"), "left")
    out = urlrep.judge(rows.select("page_id", "url", "bad"), RULES, "bad")
    return out.select("page_id", "host", "path", "rule", "verdict")


ORACLE["op6_url_filter"] = r"""
WITH u AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
    try_cast(regexp_extract(url, '/([0-9]+)[^/]*$', 1) AS BIGINT) AS n
  FROM pages),
l AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
      FROM labels GROUP BY doc_id),
h0 AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
       FROM (SELECT u.host, l.bad FROM u LEFT JOIN l ON u.n = l.doc_id) GROUP BY host),
h1 AS (SELECT *, regexp_replace(regexp_extract(host, '[^@]*$', 0), ':[0-9]*$', '') AS name FROM h0),
h2 AS (SELECT *, regexp_extract(name, '([^.]*\.)?[^.]*$', 0) AS two,
              regexp_matches(name, '^(\[.*\]|[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)$') AS ip FROM h1),
h AS (SELECT host, n, k, CASE WHEN ip THEN name WHEN two IN (@SUFFIXES)
               THEN regexp_extract(name, '([^.]*\.)?([^.]*\.)?[^.]*$', 0) ELSE two END AS domain,
             CASE WHEN ip THEN '' WHEN two IN (@SUFFIXES) THEN two
               ELSE regexp_extract(name, '[^.]*$', 0) END AS suffix FROM h2),
overall AS (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) AS mu FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT mu FROM overall) AS mu FROM h GROUP BY suffix),
sw AS (SELECT 1.0 / least(greatest(coalesce(
         sum(CASE WHEN n > 0 THEN n * (k / n - mu) * (k / n - mu) - mu * (1 - mu) END)
         / nullif(sum(CASE WHEN n > 0 THEN mu * (1 - mu) * (n - 1) END), 0), 0.5), 0.0005), 0.5)
         - 1.0 AS w FROM s),
sp AS (SELECT suffix, (w * mu + k) / (w + n) AS up FROM s, sw),
d AS (SELECT domain, sum(n) AS n, sum(k) AS k, any_value(up) AS mu
      FROM h JOIN sp USING (suffix) GROUP BY domain),
dw AS (SELECT 1.0 / least(greatest(coalesce(
         sum(CASE WHEN n > 0 THEN n * (k / n - mu) * (k / n - mu) - mu * (1 - mu) END)
         / nullif(sum(CASE WHEN n > 0 THEN mu * (1 - mu) * (n - 1) END), 0), 0.5), 0.0005), 0.5)
         - 1.0 AS w FROM d),
dp AS (SELECT domain, (w * mu + k) / (w + n) AS mu FROM d, dw),
hh AS (SELECT host, n, k, mu FROM h JOIN dp USING (domain)),
hw AS (SELECT 1.0 / least(greatest(coalesce(
         sum(CASE WHEN n > 0 THEN n * (k / n - mu) * (k / n - mu) - mu * (1 - mu) END)
         / nullif(sum(CASE WHEN n > 0 THEN mu * (1 - mu) * (n - 1) END), 0), 0.5), 0.0005), 0.5)
         - 1.0 AS w FROM hh),
hp AS (SELECT host, w * mu + k AS a, w * (1 - mu) + n - k AS b FROM hh, hw),
bound AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lo
          FROM hp),
r(rule, rhost, rpath, v) AS (VALUES ('net/', 'net', '/', 'block'),
  ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (SELECT page_id, rule, v FROM (
  SELECT u.page_id, r.rule, r.v, row_number() OVER (PARTITION BY u.page_id
    ORDER BY length(r.rule) DESC) AS i
  FROM u JOIN r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost))
    AND starts_with(u.path, r.rpath)) WHERE i = 1)
SELECT u.page_id, u.host, u.path, fit.rule,
       coalesce(fit.v, CASE WHEN u.host <> '' AND bound.lo > 0.5 THEN 'block' ELSE 'allow' END)
         AS verdict
FROM u JOIN bound USING (host) LEFT JOIN fit USING (page_id)
""".replace("@SUFFIXES", ", ".join(f"'{s}'" for s in urlrep.SUFFIXES))


@register
def op7_vector_dedup(spark, sf_dir):
    """Links at cosine 0.95 or more among all embeddings, per vector."""
    out = vecjoin.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)
    return out.select(F.col("id").alias("vec_id"), "n_links",
                      F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


@register
def op8_warc(spark, sf_dir):
    """All pages through ARC into WARC archives and back: payload digests and revisits."""
    out = warc.round_trip(table(spark, sf_dir, "pages"), payloads=False)
    return out.select(F.expr("try_cast(key AS bigint)").alias("page_id"),
                      F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                      F.col("type").alias("record_type"),
                      F.expr("try_cast(refers_key AS bigint)").alias("refers_to"))


ORACLE["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100
      GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


@register
def op9_quality(spark, sf_dir):
    """Quality of every document by the factorisation machine; one in three is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = fm.quality(docs, labels, fold(F.col("doc_id"), 3) != 1, metadata=("n_chars",))
    held = F.coalesce(fold(F.col("id"), 3) == 1, F.lit(True))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op10_decontamination(spark, sf_dir):
    """Documents that hold a copy, edited or not, of a benchmark item, with the aligned passage."""
    out = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "item_id", "score", "start", "end")


@register
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector and its five nearest rows of its label."""
    v = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    out = hardneg.mine(v, F.col("vec_id") % 50 == 0, scale=256.0, positives=5, negatives=3, low=50, high=95)
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                      F.col("negative").alias("negative_id"), "positive_score", "negative_score")


ORACLE["op11_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""


@register
def op12_repeated_strings(spark, sf_dir):
    """All documents without the bytes that a 100-byte string standing earlier too covers."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op12_repeated_strings"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(length(h) // 2 - 99)) AS s FROM d),
w AS (SELECT doc_id, s FROM p
      QUALIFY row_number() OVER (PARTITION BY substr(h, 2 * s + 1, 200) ORDER BY doc_id, s) > 1),
i AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100
                         THEN 0 ELSE 1 END AS fresh FROM w)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY doc_id, island),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS e FROM spans),
cut AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS z,
               string_agg(substr(h, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS head
        FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * z + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), where the words of one document in ten, by crc32 of its id, repeat
    with a period from some word on; null ids are left alone."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = (docs.withColumn("g", F.floor(h / 10)).withColumn("words", F.when(h % 10 == 0, words))
            .withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
            .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)")))
    tail = F.expr("slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)), "
                  "int(ceil((n - a) / p)))), 1, int(n - a))")
    text = F.when(F.col("a").isNotNull(), F.array_join(
        F.concat(F.expr("slice(words, 1, int(a))"), tail), " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


@register
def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words in every document (some periods are planted), and their digests."""
    out = periodic.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")
                                                      .select("doc_id", "text")), min_words=12)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return out.withColumn("top", longest).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"), F.expr("1000 * top.length div -top.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

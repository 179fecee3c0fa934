"""Host reputation by empirical Bayes: beta-binomial shrinkage from host to domain to suffix.

Labelled page outcomes (1: bad, 0: good) are counted per host, registered domain and suffix. Each
level's rates are shrunk to the posterior mean of the level above, the top one to the overall
rate. How strongly is estimated from the data, by moments: with a parent mean m and
v = m (1 - m), E[sum n (k/n - m)^2] = sum v (1 + (n - 1) rho), and the prior's weight is
1 / rho - 1 observations. A host is blocked if its posterior mean less ``z`` standard deviations
exceeds ``max_bad``. Fixed rules come first; the longest that fits a url wins.

The counts are partial aggregates (a hot host is combined map-side); three numbers a level reach
the driver; hosts are joined back by an ordinary join, which adaptive execution broadcasts or
splits by measured size.

The registered domain is found with a short list of two-label public suffixes (SUFFIXES); under a
suffix outside it, hosts share the prior of the last two labels.

Defined cases: of rules of one length the later in text order wins; urls are read whole, however
long; a url that is null or has no ``://`` has an empty host and path, fits no rule, and
is allowed; hosts without labelled pages get their domain's, suffix's or the overall prior; null
outcomes are unlabelled; with no labels at all the prior is even and weak, so nothing is blocked; repeated rows
count each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_IP = r"^(\[.*\]|[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)$"
# fixed values: common public suffixes of two labels, registries first, then hosting services
SUFFIXES = tuple((
    "ac.jp ac.nz ac.uk co.id co.il co.in co.jp co.ke co.kr co.nz co.th co.uk co.za com.ar com.au com.br com.cn "
    "com.co com.eg com.hk com.mx com.my com.ng com.ph com.pk com.pl com.sa com.sg com.tr com.tw com.ua com.vn "
    "edu.au edu.cn edu.hk edu.tw go.jp go.kr gov.au gov.br gov.cn gov.in gov.tw gov.uk ltd.uk me.uk ne.jp net.au "
    "net.br net.cn net.in net.nz net.uk nhs.uk or.jp or.kr org.au org.br org.cn org.hk org.in org.nz org.tw org.uk "
    "org.za plc.uk sch.uk "
    "appspot.com azurewebsites.net blogspot.com cloudfront.net github.io gitlab.io herokuapp.com netlify.app "
    "pages.dev vercel.app web.app wordpress.com").split())
RHO_RANGE = (0.0005, 0.5)      # prior weights from 1 to 1,999 observations


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    """Public suffix of the host name (without user info and port): one of SUFFIXES, else the last
    label; empty for IP literals."""
    name, two = _name(host), F.substring_index(_name(host), ".", -2)
    return (F.when(name.rlike(_IP), F.lit("")).when(two.isin(list(SUFFIXES)), two)
            .otherwise(F.substring_index(name, ".", -1)))


def domain_of(host: Column) -> Column:
    """Registered domain: the public suffix and the label before it; an IP literal is its own."""
    name, two = _name(host), F.substring_index(_name(host), ".", -2)
    return (F.when(name.rlike(_IP), name).when(two.isin(list(SUFFIXES)), F.substring_index(name, ".", -3))
            .otherwise(two))


def _name(host: Column) -> Column:
    return F.regexp_replace(F.substring_index(host, "@", -1), r":[0-9]*$", "")


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def _shrunk(level: DataFrame, mean: Column) -> DataFrame:
    """Add a, b (posterior beta) and m (its mean) to rows with counts n, k and a prior mean."""
    d = level.withColumn("mu", mean).withColumn("v", F.col("mu") * (1 - F.col("mu")))
    labelled = F.col("n") > 0
    r = F.try_divide(F.col("k"), F.col("n"))
    s = d.agg(F.sum(F.when(labelled, F.col("n") * (r - F.col("mu")) * (r - F.col("mu")))).alias("s"),
              F.sum(F.when(labelled, F.col("v"))).alias("v"),
              F.sum(F.when(labelled, F.col("v") * (F.col("n") - 1))).alias("w")).first()
    rho = (s["s"] - s["v"]) / s["w"] if s["w"] else RHO_RANGE[1]
    rho = min(max(rho, RHO_RANGE[0]), RHO_RANGE[1])
    weight = F.lit(1.0 / rho - 1.0)
    return (d.withColumn("a", weight * F.col("mu") + F.col("k"))
            .withColumn("b", weight * (1 - F.col("mu")) + F.col("n") - F.col("k"))
            .withColumn("m", F.col("a") / (F.col("a") + F.col("b"))).drop("mu", "v"))


def reputations(pages: DataFrame, host_col: str, bad_col: str) -> DataFrame:
    """(host, n, k, a, b, m) per host: labelled pages, bad ones, posterior beta and its mean."""
    counts = (pages.groupBy(F.col(host_col).alias("host"))
              .agg(F.count(bad_col).alias("n"),
                   F.coalesce(F.sum(F.col(bad_col).cast("long")), F.lit(0)).alias("k"))
              .withColumn("domain", domain_of(F.col("host")))
              .withColumn("suffix", suffix_of(F.col("host"))))
    hosts = cut_lineage(counts)
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)

    def level(*keys):
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    suffixes = _shrunk(level("suffix"), F.lit(overall)).select("suffix", F.col("m").alias("up"))
    domains = level("domain", "suffix").join(suffixes, "suffix")
    domains = _shrunk(domains, F.col("up")).select("domain", F.col("m").alias("up"))
    return _shrunk(hosts.join(domains, "domain"), F.col("up")).select("host", "n", "k", "a", "b", "m")


def judge(pages: DataFrame, rules: list[Rule], bad_col: str, url_col: str = "url",
          z: float = 1.645, max_bad: float = 0.5) -> DataFrame:
    """``pages`` plus host, path, rule, verdict, bad_rate and bound (reserved names)."""
    rows = (pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col))))
    rep = reputations(rows, "host", bad_col)
    sd = F.sqrt(F.col("a") * F.col("b") / ((F.col("a") + F.col("b")) * (F.col("a") + F.col("b"))
                                           * (F.col("a") + F.col("b") + 1)))
    rep = rep.select(F.col("host").alias("__host"), F.col("m").alias("bad_rate"),
                     (F.col("m") - z * sd).alias("bound"))
    fit = best_rule(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("host") != "") & (F.col("bound") > max_bad), "block").otherwise("allow")
    return (rows.join(rep, F.col("host") == F.col("__host"), "left").drop("__host")
            .withColumn("__fit", fit).withColumn("rule", F.col("__fit.rule"))
            .withColumn("verdict", F.coalesce(F.col("__fit.verdict"), own)).drop("__fit"))

"""Panel regression E1-E10: OLS and 2SLS with absorbed fixed effects and clustered errors.

All data-sized work is Spark aggregation: group means for demeaning (E1), one aggregate of
cross products (E2), per-cluster score sums and their outer products (E5). The driver only
receives K x K moment matrices and solves them (K = regressors + instruments, a few dozen).

Conventions (reghdfe-style, documented as assumptions): singleton groups are dropped
iteratively; the small-sample factor is ``G/(G-1) * (N-1)/(N-K)`` with K = regressors plus
the rank of the absorbed effects not nested in the clusters (see ``absorbed_dof``); p-values
use t(G-1) and F(L, G-1); the over-identification statistic is Hansen's J from two-step GMM
with the cluster-robust weight matrix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dist import chi2_upper_p, f_upper_p, stars, t_two_sided_p
from .graph import bipartite_components
from .util import cut_lineage

CONST = "_const"


# --------------------------------------------------------------------------------------
# Sample and demeaning
# --------------------------------------------------------------------------------------

def estimation_sample(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """E10 core: listwise deletion over ``cols`` in order, with a lazy report
    ``(step, col, n_before, n_dropped, n_after)`` computed in one aggregation pass."""
    first = F.lit(None).cast("int")
    for i in reversed(range(len(cols))):
        first = F.when(F.col(cols[i]).isNull(), F.lit(i + 1)).otherwise(first)
    counts = df.select(first.alias("_first")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("_first") == i + 1).alias(f"d{i + 1}") for i in range(len(cols))])
    rows = []
    for i, c in enumerate(cols):
        before = F.col("n") - sum((F.col(f"d{j + 1}") for j in range(i)), F.lit(0))
        rows.append(F.struct(F.lit(i + 1).alias("step"), F.lit(c).alias("col"),
                             before.alias("n_before"), F.col(f"d{i + 1}").alias("n_dropped"),
                             (before - F.col(f"d{i + 1}")).alias("n_after")))
    report = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return df.dropna(subset=list(cols)), report


def prepare_sample(df: DataFrame, numeric: Sequence[str], required: Sequence[str],
                   ids: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """The estimation sample as the regression script builds it.

    Numeric casts (P6, text that is not a number becomes NULL), an existence check of the
    wanted columns (P7: absent ones are reported, not fatal), integer ids for categorical
    keys (P19, ``{source column: id column}``), then listwise deletion over ``required`` in
    order with the rows lost at each step (lazy report).
    """
    from ..functions.clean import encode_ids, keep_columns, to_number

    wanted = list(dict.fromkeys([*numeric, *required, *(ids or {})]))
    kept, report = keep_columns(df, wanted)
    cast = kept.withColumns({c: to_number(c) for c in numeric if c in kept.columns})
    for src, out in (ids or {}).items():
        if src in cast.columns:
            cast = encode_ids(cast, src, out)
    present = [c for c in required if c in cast.columns]
    sample, steps = estimation_sample(cast, present)
    return sample, steps, report


def drop_singletons(df: DataFrame, absorb: Sequence[str], max_iter: int = 100) -> DataFrame:
    """Drop observations alone in a fixed-effect group, repeatedly (dropping can create new
    singletons in another dimension). One small aggregation per dimension and pass."""
    if not absorb:
        return df
    if len(absorb) == 1:
        # one dimension: dropping its singletons cannot create new ones - lazy, no action
        fe = absorb[0]
        keep = df.groupBy(fe).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        return df.join(keep.select(fe), fe, "left_semi").select(*df.columns)
    cur = df
    for _ in range(max_iter):
        # one job tells whether any dimension still has a singleton
        flags = None
        for fe in absorb:
            part = (cur.groupBy(fe).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 1)
                    .select(F.lit(fe).alias("_fe")).limit(1))
            flags = part if flags is None else flags.unionByName(part)
        if flags.isEmpty():
            return cur.select(*df.columns)
        for fe in absorb:
            single = cur.groupBy(fe).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 1)
            cur = cur.join(single.select(fe), fe, "left_anti")
        cur = cut_lineage(cur)
    raise RuntimeError("singleton removal did not converge")


def _stats_of(cols: Sequence[str]) -> list[Column]:
    return [*[F.avg(c).alias(f"a{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]]


def _stats_from(row, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    return {c: (row[f"a{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(cols)}


def _overall(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of every column: one row to the driver."""
    return _stats_from(df.agg(*_stats_of(cols)).first(), cols)


def _subtract_means(df: DataFrame, cols: Sequence[str], fe: str) -> DataFrame:
    means = df.groupBy(fe).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    keep = [c for c in df.columns if c not in cols]
    return df.join(means, fe).select(*keep, *[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in cols])


def absorb_effects(df: DataFrame, cols: Sequence[str], absorb: Sequence[str], tol: float = 1e-8,
                   max_iter: int = 1000, stats: dict | None = None) -> tuple[DataFrame, int]:
    """E1 for two or more effects: ``df`` with the effects removed from ``cols``, and the number of
    conjugate-gradient steps.

    Rows are read twice: once for the cells (rows and sums per combination of levels), once
    to subtract the fitted level coefficients. In between only vectors over levels move: the
    first effect is eliminated exactly (its coefficients are means), the others' normal
    equations are solved by conjugate gradients, preconditioned with the level sizes, for all
    columns at once. Steps grow with the square root of the panel's condition number, those of
    alternating projections with the number itself; a balanced panel takes one step.
    A column is done when the level means left in it are below ``tol`` standard deviations (root
    mean square over rows). Levels are compared as strings, NULL being a level of its own.
    """
    cols, k = list(cols), range(len(cols))
    stats = stats or _overall(df, cols)
    scale = [sd if sd > 0 else 1.0 for _, sd in (stats[c] for c in cols)]
    centred = [F.col(c) - F.lit(float(stats[c][0])) for c in cols]
    level = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    others = range(1, len(absorb))
    lv = [f"l{i}" for i in range(len(absorb))]
    cells = cut_lineage(df.groupBy(*[level(c).alias(v) for c, v in zip(absorb, lv)]).agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(y).alias(f"y{i}") for i, y in zip(k, centred)]))

    def within(frame: DataFrame, values: list[str]) -> DataFrame:
        """``values`` (sums over a cell's rows) less the first effect's means of them."""
        mean = frame.groupBy("l0").agg(*[(F.sum(v) / F.sum("n")).alias(f"_{v}") for v in values])
        return frame.join(mean.withColumnRenamed("l0", "_l0"), F.col("l0") == F.col("_l0")).select(
            *lv, "n", *[(F.col(v) - F.col("n") * F.col(f"_{v}")).alias(v) for v in values])

    def by_level(frame: DataFrame, values: list[str], out: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            frame.groupBy(F.lit(f).alias("f"), F.col(lv[f]).alias("lv")).agg(
                F.sum("n").alias("size"), *[F.sum(v).alias(o) for v, o in zip(values, out)])
            for f in others])

    def spread(vec: DataFrame, names: list[str], also: Sequence[str] = ()) -> DataFrame:
        """Cells with the sums over their rows of the others' coefficients."""
        out = cells
        for f in others:
            part = vec.where(F.col("f") == f).select(F.col("lv").alias("_lv"), *[
                F.col(c).alias(f"_{f}_{c}") for c in names])
            out = out.join(part, F.col(lv[f]) == F.col("_lv")).drop("_lv")
        return out.select(*lv, "n", *also, *[
            (F.col("n") * sum((F.col(f"_{f}_{c}") for f in others), F.lit(0.0))).alias(c) for c in names])

    r, p, w, x = ([f"{t}{i}" for i in k] for t in "rpwx")
    state = by_level(within(cells, [f"y{i}" for i in k]), [f"y{i}" for i in k], r)
    state = cut_lineage(state.select("f", "lv", "size", *r, *[(F.col(a) / F.col("size")).alias(b) for a, b in zip(r, p)],
                                     *[F.lit(0.0).alias(c) for c in x]))

    def dot(frame: DataFrame) -> list[float]:
        row = frame.agg(F.max("f"), *[F.sum(F.col(c) * F.col(c) / F.col("size")) for c in r],
                        F.sum(F.when(F.col("f") == 1, F.col("size")))).first()
        return [float(v or 0.0) for v in row[1:]]

    *rz, rows = dot(state)
    limit = [rows * (tol * s) ** 2 for s in scale]
    steps = 0
    while any(a > b for a, b in zip(rz, limit)):
        if steps == max_iter:
            raise RuntimeError(f"demeaning did not converge in {max_iter} steps")
        steps += 1
        image = by_level(within(spread(state, p), p), p, w).drop("size")
        seen = Observation(f"cg_{uuid.uuid4().hex}")
        both = state.join(image.withColumnRenamed("lv", "_lv").withColumnRenamed("f", "_f"),
                          (F.col("f") == F.col("_f")) & (F.col("lv") == F.col("_lv"))).drop("_f", "_lv")
        both = cut_lineage(both.observe(seen, *[F.sum(F.col(a) * F.col(b)).alias(f"d{i}")
                                                for i, a, b in zip(k, p, w)]))
        pw = [float(seen.get[f"d{i}"] or 0.0) for i in k]
        alpha = [a / b if a > c and b > 0 else 0.0 for a, b, c in zip(rz, pw, limit)]
        moved = both.select("f", "lv", "size",
                            *[(F.col(a) - F.lit(al) * F.col(b)).alias(a) for a, b, al in zip(r, w, alpha)],
                            *[(F.col(a) + F.lit(al) * F.col(b)).alias(a) for a, b, al in zip(x, p, alpha)], *p)
        *now, _ = dot(moved)
        beta = [a / b if b > 0 and al else 0.0 for a, b, al in zip(now, rz, alpha)]
        state = moved.select("f", "lv", "size", *r, *x, *[
            (F.col(a) / F.col("size") + F.lit(be) * F.col(b)).alias(b) for a, b, be in zip(r, p, beta)])
        rz = now
    # the first effect: means of what the others leave
    rest = spread(state, x, [f"y{i}" for i in k])
    first = rest.groupBy(F.col("l0").alias("__l0")).agg(
        *[(F.sum(F.col(f"y{i}") - F.col(f"x{i}")) / F.sum("n")).alias(f"__m{i}") for i in k])
    out = df.withColumns({f"__of{i}": level(c) for i, c in enumerate(absorb)})
    out = out.join(first, F.col("__of0") == F.col("__l0")).drop("__l0")
    fitted_ = [F.col(f"__m{i}") for i in k]
    for f in others:
        part = state.where(F.col("f") == f).select(F.col("lv").alias("__lv"), *[
            F.col(c).alias(f"__{f}_{c}") for c in x])
        out = out.join(part, F.col(f"__of{f}") == F.col("__lv")).drop("__lv")
        fitted_ = [a + F.col(f"__{f}_{c}") for a, c in zip(fitted_, x)]
    keep = [c for c in df.columns if c not in cols]
    return out.select(*keep, *[(y - a).alias(c) for y, a, c in zip(centred, fitted_, cols)]), steps


def demean(df: DataFrame, cols: Sequence[str], absorb: Sequence[str] = (), tol: float = 1e-8,
           max_iter: int = 1000, _stats: dict | None = None) -> DataFrame:
    """Remove fixed effects from ``cols``.

    No fixed effect: subtract the overall mean (the constant). One: subtract group means
    (group means are an aggregate joined back, so a hot group is combined map-side). Several:
    ``absorb_effects``, conjugate gradients over the levels' coefficients.
    """
    cols, absorb = list(cols), list(dict.fromkeys(absorb))
    if len(absorb) == 1:
        return _subtract_means(df, cols, absorb[0])
    if absorb:
        return absorb_effects(df if _stats else cut_lineage(df), cols, absorb, tol, max_iter, _stats)[0]
    stats = _stats or _overall(df, cols)
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[(F.col(c) - F.lit(float(stats[c][0]))).alias(c) for c in cols])


# --------------------------------------------------------------------------------------
# moments
# --------------------------------------------------------------------------------------

def cross_products(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, int]:
    """The K x K matrix of sums of products and N (the corner of a column of ones).

    Rows become vectors whose outer products are summed in the JVM, partition by partition and
    then in a tree (a Gram matrix), so the plan does not grow with K.
    """
    m = _gram(df, [F.lit(1.0), *[F.col(c) for c in cols]])
    return m[1:, 1:], int(round(m[0, 0]))


def _gram(df: DataFrame, cols: Sequence[Column]) -> np.ndarray:
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    rows = df.select(array_to_vector(F.array(*[c.cast("double") for c in cols])).alias("v"))
    # a row of zeros changes no sum; without any row there would be no matrix
    rows = rows.union(df.sparkSession.range(1).select(array_to_vector(F.array(*[F.lit(0.0) for _ in cols]))))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), 0, len(cols)
                     ).computeGramianMatrix().toArray()


def cluster_meat(df: DataFrame, cluster: str | None, scores: Sequence) -> tuple[np.ndarray, int]:
    """E5: ``sum_g s_g s_g'`` with ``s_g`` the per-cluster sums of the score columns.

    Cluster sums are a partial aggregate (one row per cluster), the outer products a Gram
    matrix; without a cluster every observation is its own cluster (robust errors).
    """
    return cluster_meats(df, cluster, [scores])


def cluster_meats(df: DataFrame, cluster: str | None, blocks: Sequence[Sequence]
                  ) -> tuple:
    """``cluster_meat`` of several blocks of scores from one Gram matrix: returns one matrix per
    block, then the number of clusters."""
    return (*_spec_meats(df, cluster, [(F.lit(True), blocks)])[0],)


def _spec_meats(df: DataFrame, cluster: str | None, specs: Sequence[tuple[Column, Sequence[Sequence]]]
                ) -> list[tuple]:
    """``cluster_meats`` of several specifications, each of the rows where its condition holds,
    from one aggregate and one Gram matrix over all of them."""
    cols, shape = [], []
    for s, (mine, blocks) in enumerate(specs):
        flat = [F.when(mine, c).otherwise(0.0) for scores in blocks for c in scores]
        one = F.when(mine, 1.0).otherwise(0.0)
        cols += [one.alias(f"n{s}"), *[c.alias(f"s{s}_{i}") for i, c in enumerate(flat)]]
        shape.append([len(scores) for scores in blocks])
    sums = df.select(*([cluster] if cluster else []), *cols)
    names = [c for c in sums.columns if c != cluster]
    if cluster:
        sums = sums.groupBy(cluster).agg(*[(F.max(c) if c.startswith("n") else F.sum(c)).alias(c) for c in names])
    gram = _gram(sums, [F.col(c) for c in names])
    out, at = [], 0
    for sizes in shape:
        g, at = int(round(gram[at, at])), at + 1
        meats = []
        for k in sizes:
            meats.append(gram[at:at + k, at:at + k])
            at += k
        out.append((*meats, g))
    return out


def _levels_of(df: DataFrame, absorb: Sequence[str], cluster: str | None) -> DataFrame | None:
    """(fe, levels, nested) of every effect: number of levels, and whether each lies in one cluster."""
    parts = []
    for fe in absorb:
        if cluster is None:
            per = df.select(fe).distinct().withColumn("one", F.lit(False))
        else:
            per = df.groupBy(fe).agg((F.min(cluster) == F.max(cluster)).alias("one"))
        parts.append(per.agg(F.count(F.lit(1)).alias("levels"), F.bool_and("one").alias("nested"))
                     .select(F.lit(fe).alias("fe"), "levels", "nested"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def absorbed_dof(df: DataFrame, absorb: Sequence[str], cluster: str | None, _levels: dict | None = None) -> int:
    """Degrees of freedom that the absorbed effects use: the rank of the dummies of all effects
    not nested in the clusters (1, the constant, if there is none).

    Two effects: levels of both less the connected components of the graph that joins levels
    met together, which is the rank exactly. More: each further effect loses as many levels as
    the most components it has with an earlier one, a lower bound of its redundancy.
    """
    absorb = list(dict.fromkeys(absorb))
    if not absorb:
        return 1
    if _levels is None:
        _levels = {r["fe"]: (r["levels"], r["nested"]) for r in _levels_of(df, absorb, cluster).collect()}
    free = [fe for fe in absorb if not _levels[fe][1]]
    if not free:
        return 1
    lost = {fe: 0 for fe in free}
    for a, b in combinations(free, 2):
        lost[b] = max(lost[b], bipartite_components(df, a, b))
    return sum(_levels[fe][0] - lost[fe] for fe in free)


def _independent(xtx: np.ndarray, norms: np.ndarray, rel_tol: float = 1e-9) -> list[int]:
    """Indices of columns kept after dropping absorbed ones (what demeaning left is nothing
    beside ``norms``, the squared deviations before it) and those collinear with earlier ones."""
    kept: list[int] = []
    for j in range(xtx.shape[0]):
        d = xtx[j, j]
        if d <= rel_tol * norms[j] or d <= 0:
            continue
        if kept:
            a = xtx[np.ix_(kept, kept)]
            v = xtx[np.ix_(kept, [j])]
            s = d - float((v.T @ np.linalg.solve(a, v)).item())
        else:
            s = d
        if s > rel_tol * d:
            kept.append(j)
    return kept


# --------------------------------------------------------------------------------------
# Results
# --------------------------------------------------------------------------------------

@dataclass
class Fit:
    model: str
    terms: list[str]
    coef: np.ndarray
    vcov: np.ndarray
    n: int
    g: int
    k: int
    stats: dict = field(default_factory=dict)
    omitted: list[str] = field(default_factory=list)

    @property
    def se(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.vcov), 0.0))

    def table(self) -> list[dict]:
        out = []
        df_t = max(self.g - 1, 1)
        for i, term in enumerate(self.terms):
            se = float(self.se[i])
            t = float(self.coef[i]) / se if se > 0 else float("nan")
            p = t_two_sided_p(t, df_t)
            out.append({"term": term, "coef": float(self.coef[i]), "se": se, "t": t, "p": p,
                        "stars": stars(p)})
        for term in self.omitted:
            out.append({"term": term, "coef": 0.0, "se": float("nan"), "t": float("nan"),
                        "p": float("nan"), "stars": ""})
        return out


def _q(n: int, g: int, k: int, clustered: bool) -> float:
    if clustered:
        return (g / (g - 1)) * ((n - 1) / (n - k)) if g > 1 and n > k else float("nan")
    return n / (n - k) if n > k else float("nan")


@dataclass
class _Prepared:
    """A specification's demeaned sample: the rows of ``dm`` where ``mine`` holds."""

    dm: DataFrame
    mine: Column
    moments: tuple
    dof: int


def _prepare(df, cols, specs, cluster, singletons=True) -> list[_Prepared]:
    """Of every specification (a list of absorbed effects): its sample (complete cases, singletons
    dropped), the demeaned copy, the cross-product moments of ``cols`` with the squared norms the
    columns had before demeaning. The demeaned copies are written as one table, and one
    Gram matrix over it holds the moments and sizes of all of them."""
    cols = list(dict.fromkeys(cols))
    samples, parts, levels = [], [], []
    for s, absorb in enumerate(specs):
        need = [*cols, *absorb] + ([cluster] if cluster else [])
        sample = df.select(*dict.fromkeys(need)).dropna()
        if absorb and singletons:
            sample = drop_singletons(sample, absorb)
        seen = Observation(f"sample_{uuid.uuid4().hex}")
        sample = cut_lineage(sample.observe(seen, *_stats_of(cols)))
        stats = _stats_from(seen.get, cols)
        samples.append((sample, stats))
        keep = [F.col(cluster).alias("_cluster")] if cluster else []
        parts.append(demean(sample.select(*dict.fromkeys(need)), cols, absorb, _stats=stats)
                     .select(F.lit(s).alias("_spec"), *keep, *cols))
        if absorb:
            levels.append(_levels_of(sample, absorb, cluster).withColumn("_spec", F.lit(s)))
    dm = cut_lineage(reduce(DataFrame.unionByName, parts))
    width = len(cols) + 1
    gram = _gram(dm, [F.when(F.col("_spec") == s, c).otherwise(0.0) for s in range(len(specs))
                      for c in (F.lit(1.0), *[F.col(c) for c in cols])])
    found: dict[int, dict] = {}
    for r in (reduce(DataFrame.unionByName, levels).collect() if levels else []):
        found.setdefault(r["_spec"], {})[r["fe"]] = (r["levels"], r["nested"])
    out = []
    for s, (absorb, (sample, stats)) in enumerate(zip(specs, samples)):
        block = gram[s * width:(s + 1) * width, s * width:(s + 1) * width]
        n = int(round(block[0, 0]))
        # squared deviations from the mean; a constant column's are rounding of its size
        norms = np.array([n * (sd * sd + 1e-15 * a * a) for a, sd in (stats[c] for c in cols)])
        out.append(_Prepared(dm, F.col("_spec") == s, (block[1:, 1:], n, cols, norms),
                             absorbed_dof(sample, absorb, cluster, found.get(s))))
    return out


def _sub_moments(moments, want: Sequence[str]) -> tuple[np.ndarray, int, np.ndarray]:
    m, n, cols, norms = moments
    idx = [cols.index(c) for c in want]
    return m[np.ix_(idx, idx)], n, norms[idx]


def ols_fe(df: DataFrame, y: str, x: Sequence[str], absorb: Sequence[str] = (),
           cluster: str | None = None, singletons: bool = True) -> Fit:
    """OLS of ``y`` on ``x`` after absorbing ``absorb``; cluster-robust when ``cluster``
    is given, else heteroskedasticity-robust."""
    x = list(x)
    prepared = _prepare(df, [y, *x], [absorb], cluster, singletons)[0]
    blocks, finish = _ols_solve(prepared, y, x, cluster)
    return finish(*cluster_meats(prepared.dm, "_cluster" if cluster else None, blocks))["ols"]


def _ols_solve(prepared: _Prepared, y: str, x: list[str], cluster: str | None
               ) -> tuple[list[list[Column]], Callable]:
    """Coefficients from the moments: blocks of scores, and what makes the fit of their meats."""
    m, n, norms = _sub_moments(prepared.moments, [*x, y])
    k = len(x)
    keep = _independent(m[:k, :k], norms)
    if not keep:
        raise ValueError("no regressor is left: all are absorbed")
    xs = [x[i] for i in keep]
    xtx = m[np.ix_(keep, keep)]
    xty = m[keep, k]
    b = np.linalg.solve(xtx, xty)
    resid = F.col(y) - sum((F.lit(float(bi)) * F.col(c) for bi, c in zip(b, xs)), F.lit(0.0))

    def finish(meat: np.ndarray, g: int) -> dict[str, Fit]:
        kk = len(xs) + prepared.dof
        inv = np.linalg.inv(xtx)
        v = _q(n, g, kk, cluster is not None) * inv @ meat @ inv
        ssr = m[k, k] - 2 * b @ xty + b @ xtx @ b
        stats = {"N": n, "N_clust": g, "r2_within": 1 - ssr / m[k, k] if m[k, k] > 0 else float("nan"),
                 "df_absorbed": kk - len(xs)}
        return {"ols": Fit("ols", xs, b, v, n, g, kk, stats, [c for c in x if c not in xs])}

    return [[F.col(c) * resid for c in xs]], finish


def iv_2sls(df: DataFrame, y: str, endog: Sequence[str], instruments: Sequence[str],
            exog: Sequence[str] = (), absorb: Sequence[str] = (), cluster: str | None = None,
            singletons: bool = True) -> dict[str, Fit]:
    """E4 + E6 + E7 + E8: 2SLS of ``y`` on ``endog`` (instrumented) and ``exog``.

    Returns ``{"iv": Fit, "first:<endog>": Fit, ...}``. The IV fit's ``stats`` carry the
    first-stage F and p for each endogenous regressor, Hansen's J with its p-value, and the
    R-squared of the second stage on fitted values (E7). Everything after the demeaning is
    computed from one cross-product pass and one cluster pass.
    """
    endog, exog, instruments = list(endog), list(exog), list(instruments)
    prepared = _prepare(df, [*endog, *exog, *instruments, y], [absorb], cluster, singletons)[0]
    blocks, finish = _iv_solve(prepared, y, endog, instruments, exog, cluster)
    return finish(*cluster_meats(prepared.dm, "_cluster" if cluster else None, blocks))


def _iv_solve(prepared: _Prepared, y: str, endog: list[str], instruments: list[str], exog: list[str],
              cluster: str | None) -> tuple[list[list[Column]], Callable]:
    """Coefficients from the moments: blocks of scores (2SLS, then every first stage), and what makes
    the fits of their meats."""
    cols = [*endog, *exog, *instruments, y]
    dof = prepared.dof
    m, n, norms = _sub_moments(prepared.moments, cols)
    ix = {c: i for i, c in enumerate(cols)}

    def left(first, then):
        names = [*first, *then]
        idx = [ix[c] for c in names]
        return [names[i] for i in _independent(m[np.ix_(idx, idx)], norms[idx])]

    # absorbed and collinear columns go: controls first, then instruments and endogenous
    # regressors that the kept controls already span
    asked = [*endog, *instruments, *exog]
    exog = left([], exog)
    instruments = [c for c in left(exog, instruments) if c not in exog]
    endog = [c for c in left(exog, endog) if c not in exog]
    if not endog or len(instruments) < len(endog):
        raise ValueError(f"not identified: {len(instruments)} instruments for {len(endog)} regressors")
    gone = [c for c in asked if c not in {*exog, *instruments, *endog}]
    xi = [ix[c] for c in [*endog, *exog]]
    zi = [ix[c] for c in [*instruments, *exog]]
    yi = ix[y]
    zz, zx, zy = m[np.ix_(zi, zi)], m[np.ix_(zi, xi)], m[zi, yi]
    zz_inv = np.linalg.inv(zz)
    a = zx.T @ zz_inv                              # K x L
    bread = np.linalg.inv(a @ zx)
    b = bread @ (a @ zy)
    pi = zz_inv @ zx                               # first-stage coefficients, L x K
    xnames = [*endog, *exog]
    znames = [*instruments, *exog]
    resid = F.col(y) - sum((F.lit(float(bi)) * F.col(c) for bi, c in zip(b, xnames)), F.lit(0.0))
    v_first = {e: F.col(e) - sum((F.lit(float(pi[l, j])) * F.col(z) for l, z in enumerate(znames)),
                                 F.lit(0.0)) for j, e in enumerate(endog)}
    # One cluster pass: scores z*e for 2SLS and z*v for every first stage.
    blocks = [[F.col(z) * resid for z in znames]]
    blocks += [[F.col(z) * v_first[e] for z in znames] for e in endog]

    def finish(meat_z: np.ndarray, *rest) -> dict[str, Fit]:
        *meats_first, g = rest
        nl = len(znames)
        kk_abs = dof
        clustered = cluster is not None
        v = _q(n, g, len(xnames) + kk_abs, clustered) * bread @ (a @ meat_z @ a.T) @ bread
        stats = {"N": n, "N_clust": g, "df_absorbed": kk_abs}
        # Two-step GMM with the cluster-robust weight, Hansen's J.
        w = np.linalg.pinv(meat_z)
        b_gmm = np.linalg.solve(zx.T @ w @ zx, zx.T @ w @ zy)
        ze = zy - zx @ b_gmm
        j = float(ze @ w @ ze)
        over = len(instruments) - len(endog)
        stats["hansen_j"] = j if over > 0 else 0.0
        stats["hansen_j_df"] = over
        stats["hansen_j_p"] = chi2_upper_p(j, over) if over > 0 else float("nan")
        # Second stage on fitted values, from moments (X_hat = Z pi).
        xhx = pi.T @ zz @ pi
        xhy = pi.T @ zy
        b2 = np.linalg.solve(xhx, xhy)
        ssr2 = m[yi, yi] - 2 * b2 @ xhy + b2 @ xhx @ b2
        stats["r2_fitted_second_stage"] = 1 - ssr2 / m[yi, yi] if m[yi, yi] > 0 else float("nan")
        fits = {"iv": Fit("iv", xnames, b, v, n, g, len(xnames) + kk_abs, stats,
                          [c for c in gone if c not in instruments])}
        # First stages (endog on instruments + exog) with F on the excluded instruments.
        kf = nl + kk_abs
        for j_e, e in enumerate(endog):
            meat_f = meats_first[j_e]
            vf = _q(n, g, kf, clustered) * zz_inv @ meat_f @ zz_inv
            bz = pi[: len(instruments), j_e]
            vzz = vf[: len(instruments), : len(instruments)]
            f_stat = float(bz @ np.linalg.solve(vzz, bz)) / len(instruments)
            df2 = (g - 1) if clustered else (n - kf)
            st = {"N": n, "N_clust": g, "F": f_stat, "F_df1": len(instruments), "F_df2": df2,
                  "F_p": f_upper_p(f_stat, len(instruments), df2)}
            fits["iv"].stats[f"first_F_{e}"] = f_stat
            fits["iv"].stats[f"first_F_p_{e}"] = st["F_p"]
            fits[f"first:{e}"] = Fit("first", znames, pi[:, j_e], vf, n, g, kf, st)
        return fits

    return blocks, finish


def fitted(df: DataFrame, fit: Fit, out: str = "fitted") -> DataFrame:
    """Linear prediction from a fit, as a column dot product."""
    expr = sum((F.lit(float(b)) * F.col(t) for b, t in zip(fit.coef, fit.terms)), F.lit(0.0))
    return df.withColumn(out, expr)


# --------------------------------------------------------------------------------------
# Specification grid
# --------------------------------------------------------------------------------------

def spec_grid(df: DataFrame, y: str, endog: Sequence[str], instruments: Sequence[str],
              exog: Sequence[str], cluster: str, specs: Sequence[tuple[str, Sequence[str]]],
              models: Sequence[str] = ("ols", "iv", "first")) -> tuple[DataFrame, DataFrame]:
    """Every spec (name, absorbed effects) x model (OLS, 2SLS, first stage) as tidy
    tables ``(spec, model, term, coef, se, t, p, stars, fe)`` and ``(spec, model, stat, value)``.
    The input is cut from its lineage once and shared by all fits."""
    spark = df.sparkSession
    endog, instruments, exog = list(endog), list(instruments), list(exog)
    base = cut_lineage(df.select(*dict.fromkeys([y, *endog, *instruments, *exog, cluster,
                                                 *[c for _, a in specs for c in a]])))
    # One sample per spec, complete on every model variable, demeaned once and shared by the
    # OLS, 2SLS and first-stage fits; one Gram matrix for all moments, one for all scores.
    prepared = _prepare(base, [*endog, *exog, *instruments, y], [a for _, a in specs], cluster)
    solved = []
    for p in prepared:
        mine = []
        if "ols" in models:
            mine.append(_ols_solve(p, y, [*endog, *exog], cluster))
        if "iv" in models or "first" in models:
            mine.append(_iv_solve(p, y, endog, instruments, exog, cluster))
        solved.append(mine)
    meats = _spec_meats(prepared[0].dm, "_cluster", [
        (p.mine, [b for blocks, _ in mine for b in blocks]) for p, mine in zip(prepared, solved)])
    coef_rows, stat_rows = [], []
    for (name, absorb), mine, (*all_meats, g) in zip(specs, solved, meats):
        fe = "+".join(absorb) if absorb else "none"
        fits = {}
        for blocks, finish in mine:
            got, all_meats = all_meats[:len(blocks)], all_meats[len(blocks):]
            fits |= {k: f for k, f in finish(*got, g).items() if k.split(":")[0] in models}
        for model, fit in fits.items():
            for r in fit.table():
                coef_rows.append((name, model, r["term"], r["coef"], r["se"], r["t"], r["p"],
                                  r["stars"], fe))
            for s, val in fit.stats.items():
                stat_rows.append((name, model, s, float(val) if val is not None else None))
    coefs = spark.createDataFrame(coef_rows, "spec string, model string, term string, coef double, "
                                             "se double, t double, p double, stars string, fe string")
    stats = spark.createDataFrame(stat_rows, "spec string, model string, stat string, value double")
    return coefs, stats

import numpy as np
import pytest

from paneljet.operators import econ


def make_panel(seed=1, g=14, t=9, n_inst=0):
    rnd = np.random.default_rng(seed)
    rows = []
    month_fe = rnd.normal(size=t)
    for c in range(g):
        ce = rnd.normal()
        for m in range(t):
            zs = rnd.normal(size=max(n_inst, 1))
            u = rnd.normal()
            x = 0.8 * zs.sum() + 0.5 * u + month_fe[m] + ce * 0.3 + rnd.normal()
            w = rnd.normal()
            y = 1.5 * x - 0.7 * w + 2 * month_fe[m] + u + 0.5 * ce * rnd.normal()
            rows.append((f"c{c}", m, float(y), float(x), float(w), *[float(z) for z in zs]))
    return rows


def to_df(spark, rows, n_inst):
    cols = "cl string, month int, y double, x double, w double, " + ", ".join(
        f"z{i} double" for i in range(max(n_inst, 1)))
    return spark.createDataFrame(rows, cols)


def np_cluster_vcov(X, e, cl, bread, k):
    n = len(e)
    groups = sorted(set(cl))
    meat = np.zeros((X.shape[1], X.shape[1]))
    for gname in groups:
        idx = [i for i, c in enumerate(cl) if c == gname]
        s = X[idx].T @ e[idx]
        meat += np.outer(s, s)
    g = len(groups)
    q = g / (g - 1) * (n - 1) / (n - k)
    return q * bread @ meat @ bread


def dummies(months):
    levels = sorted(set(months))
    return np.array([[1.0 if m == lv else 0.0 for lv in levels] for m in months]), len(levels)


def test_ols_fe_equals_dummy_variable_ols(spark):
    rows = make_panel()
    df = to_df(spark, rows, 0)
    fit = econ.ols_fe(df, "y", ["x", "w"], ["month"], "cl")
    y = np.array([r[2] for r in rows])
    D, m = dummies([r[1] for r in rows])
    X = np.column_stack([[r[3] for r in rows], [r[4] for r in rows], D])
    bread = np.linalg.inv(X.T @ X)
    b = bread @ X.T @ y
    e = y - X @ b
    V = np_cluster_vcov(X, e, [r[0] for r in rows], bread, 2 + m)
    assert fit.coef == pytest.approx(b[:2], rel=1e-8)
    assert fit.se == pytest.approx(np.sqrt(np.diag(V))[:2], rel=1e-6)
    assert fit.k == 2 + m and fit.g == 14


def test_iv_with_instrument_equal_to_regressor_is_ols(spark):
    rows = make_panel(seed=2)
    df = to_df(spark, rows, 0).withColumn("x_copy", __import__("pyspark.sql.functions", fromlist=["col"]).col("x"))
    ols = econ.ols_fe(df, "y", ["x", "w"], ["month"], "cl")
    iv = econ.iv_2sls(df, "y", ["x"], ["x_copy"], ["w"], ["month"], "cl")["iv"]
    assert iv.coef == pytest.approx(ols.coef, rel=1e-8)
    assert iv.se == pytest.approx(ols.se, rel=1e-6)


def test_iv_eight_instruments_vs_numpy(spark):
    rows = make_panel(seed=3, g=30, t=8, n_inst=8)
    df = to_df(spark, rows, 8)
    fits = econ.iv_2sls(df, "y", ["x"], [f"z{i}" for i in range(8)], ["w"], ["month"], "cl")
    y = np.array([r[2] for r in rows])
    D, m = dummies([r[1] for r in rows])
    X = np.column_stack([[r[3] for r in rows], [r[4] for r in rows], D])
    Zi = np.array([r[5:13] for r in rows])
    Z = np.column_stack([Zi, [r[4] for r in rows], D])
    Pz = Z @ np.linalg.pinv(Z.T @ Z) @ Z.T
    bread = np.linalg.inv(X.T @ Pz @ X)
    b = bread @ X.T @ Pz @ y
    e = y - X @ b
    Xhat = Pz @ X
    V = np_cluster_vcov(Xhat, e, [r[0] for r in rows], bread, 2 + m)
    iv = fits["iv"]
    assert iv.coef == pytest.approx(b[:2], rel=1e-7)
    assert iv.se == pytest.approx(np.sqrt(np.diag(V))[:2], rel=1e-5)
    assert iv.stats["hansen_j_df"] == 7 and 0 <= iv.stats["hansen_j_p"] <= 1
    assert fits["first:x"].stats["F"] > 10


def test_hansen_j_against_numpy_gmm(spark):
    rows = make_panel(seed=4, g=60, t=3, n_inst=3)
    df = to_df(spark, rows, 3)
    fits = econ.iv_2sls(df, "y", ["x"], ["z0", "z1", "z2"], [], [], "cl")
    A = np.array([[r[2], r[3], r[5], r[6], r[7]] for r in rows])
    A = A - A.mean(axis=0)                                 # constant partialled out
    y, X, Z = A[:, 0], A[:, [1]], A[:, 2:]
    cl = [r[0] for r in rows]
    b2 = np.linalg.solve(X.T @ Z @ np.linalg.inv(Z.T @ Z) @ Z.T @ X, X.T @ Z @ np.linalg.inv(Z.T @ Z) @ Z.T @ y)
    e = y - X @ b2
    S = np.zeros((3, 3))
    for gname in sorted(set(cl)):
        idx = [i for i, c in enumerate(cl) if c == gname]
        s = Z[idx].T @ e[idx]
        S += np.outer(s, s)
    W = np.linalg.inv(S)
    bg = np.linalg.solve(X.T @ Z @ W @ Z.T @ X, X.T @ Z @ W @ Z.T @ y)
    ze = Z.T @ (y - X @ bg)
    assert fits["iv"].stats["hansen_j"] == pytest.approx(float(ze @ W @ ze), rel=1e-6)


def test_collinear_and_singletons(spark):
    rows = make_panel(seed=5)
    df = to_df(spark, rows, 0)
    from pyspark.sql import functions as F

    df2 = df.withColumn("x2", F.col("x") * 2).unionByName(
        spark.createDataFrame([("solo", 99, 1.0, 2.0, 3.0, 0.0, 4.0)],
                              "cl string, month int, y double, x double, w double, z0 double, x2 double"))
    fit = econ.ols_fe(df2, "y", ["x", "x2", "w"], ["month"], "cl")
    assert fit.omitted == ["x2"] and fit.n == len(rows)          # month 99 was a singleton


def test_estimation_sample_report(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (None, None, 1.0), (1.0, 1.0, None), (1.0, 1.0, 1.0)],
                               "a double, b double, c double")
    kept, rep = econ.estimation_sample(df, ["a", "b", "c"])
    assert kept.count() == 1
    got = sorted(tuple(r) for r in rep.collect())
    assert got == [(1, "a", 4, 1, 3), (2, "b", 3, 1, 2), (3, "c", 2, 1, 1)]


def test_two_way_demean_converges(spark):
    rows = make_panel(seed=6, g=8, t=6)
    df = to_df(spark, rows, 0)
    d = econ.demean(df, ["y"], ["month", "cl"])
    from pyspark.sql import functions as F

    worst = max(abs(r[0]) for r in d.groupBy("month").agg(F.avg("y")).select(F.col("avg(y)")).collect())
    worst2 = max(abs(r[0]) for r in d.groupBy("cl").agg(F.avg("y")).select(F.col("avg(y)")).collect())
    assert worst < 1e-8 and worst2 < 1e-8


def test_one_row_cluster(spark):
    rows = make_panel(seed=8)
    rows.append(("lonely", 0, 1.0, 0.5, 0.2, 0.0))
    df = to_df(spark, rows, 0)
    fit = econ.ols_fe(df, "y", ["x", "w"], ["month"], "cl")
    y = np.array([r[2] for r in rows])
    D, m = dummies([r[1] for r in rows])
    X = np.column_stack([[r[3] for r in rows], [r[4] for r in rows], D])
    bread = np.linalg.inv(X.T @ X)
    b = bread @ X.T @ y
    V = np_cluster_vcov(X, y - X @ b, [r[0] for r in rows], bread, 2 + m)
    assert fit.g == 15
    assert fit.se == pytest.approx(np.sqrt(np.diag(V))[:2], rel=1e-6)


def test_prepare_sample(spark):
    df = spark.createDataFrame([("a", "1.5", "2"), ("b", "x", "3"), ("a", "2", None), ("c", "4", "5")],
                               "county string, y string, x string")
    sample, steps, rep = econ.prepare_sample(df, ["y", "x", "z"], ["y", "x", "z"], {"county": "cd_id"})
    assert rep["missing"] == ["z"]
    assert sorted((r["county"], r["cd_id"], r["y"]) for r in sample.collect()) == [("a", 1, 1.5), ("c", 3, 4.0)]
    assert sorted(tuple(r) for r in steps.collect()) == [(1, "y", 4, 1, 3), (2, "x", 3, 1, 2)]


def test_singletons_removed_iteratively_across_dimensions(spark):
    # a-level "x" has one row -> dropped; that leaves b-level "q" with one row -> dropped too
    rows = [("x", "q"), ("y", "q"), ("y", "p"), ("y", "p"), ("z", "p"), ("z", "r"), ("y", "r")]
    df = spark.createDataFrame(rows, "a string, b string")
    out = sorted(tuple(r) for r in econ.drop_singletons(df, ["a", "b"]).collect())
    assert out == sorted([("y", "p"), ("y", "p"), ("z", "p"), ("z", "r"), ("y", "r")])


def _panel(spark, extra):
    rng = np.random.default_rng(12)
    rows = []
    for c in range(12):
        for m in range(20):
            x, w, z = map(float, rng.normal(size=3))
            rows.append((f"c{c}", m, 0.5 * x + 0.3 * z + float(rng.normal()), x + z, w, z, *extra(c, m, w, z)))
    return rows


def test_absorbed_collinear_and_repeated_columns(spark):
    rows = _panel(spark, lambda c, m, w, z: (float(c), 3.0 * w, 2.0 * z, 1e9 * (w + 2)))
    df = spark.createDataFrame(rows, "county string, month int, y double, x double, w double, z double, "
                                     "cc double, w3 double, z2 double, big double")
    fe = ["month", "county"]
    plain = econ.ols_fe(df, "y", ["x", "w"], fe, "county")
    fit = econ.ols_fe(df, "y", ["x", "w", "cc", "w3"], fe, "county")
    assert fit.terms == ["x", "w"] and fit.omitted == ["cc", "w3"]
    assert np.allclose(fit.coef, plain.coef) and np.allclose(fit.se, plain.se)
    base = econ.iv_2sls(df, "y", ["x"], ["z"], ["w"], fe, "county")["iv"]
    iv = econ.iv_2sls(df, "y", ["x"], ["z", "z2"], ["w", "cc", "w3"], fe, "county")["iv"]
    assert iv.stats["hansen_j_df"] == 0 and np.allclose(iv.coef, base.coef) and set(iv.omitted) >= {"cc", "w3"}
    large = econ.ols_fe(df, "y", ["x", "big"], fe, "county")      # converges at any scale
    assert np.isclose(large.coef[1] * 1e9, plain.coef[1]) and np.isclose(large.coef[0], plain.coef[0])
    with pytest.raises(ValueError, match="not identified"):
        econ.iv_2sls(df, "y", ["x"], ["cc"], [], fe, "county")


def test_cross_products_wide_plan(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 28))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(28)))
    m, n = econ.cross_products(df, df.columns)
    assert n == 200 and np.allclose(m, x.T @ x)
    assert econ.cross_products(df.where("false"), df.columns)[1] == 0


def test_demean_without_effects_has_no_cartesian(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "a double, b double")
    out = econ.demean(df, ["a", "b"])
    assert "Cartesian" not in out._jdf.queryExecution().toString()
    assert abs(sum(r.a for r in out.collect())) < 1e-9


# ---- two-way effects: rank of the dummies, accelerated demeaning --------------------------

def dummy_matrix(*columns):
    return np.concatenate([dummies(list(c))[0] for c in columns], axis=1)


def test_components_equal_union_find(spark):
    from paneljet.operators.graph import connected_components

    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (190, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(2000, 2000), (2001, 2000), (2001, 2000), (5, None)] + [(3000, 3001 + i) for i in range(50)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(df.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_absorbed_dof_is_the_rank_of_the_dummies(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for block in range(int(rng.integers(1, 4))):         # blocks of effects that never meet
        rows += [(f"a{block}_{rng.integers(0, 4)}", 100 * block + int(rng.integers(0, 5)), f"g{rng.integers(0, 9)}")
                 for _ in range(int(rng.integers(3, 12)))]
    df = spark.createDataFrame(rows, "a string, b int, g string")
    a, b, _ = zip(*rows)
    assert econ.absorbed_dof(df, ["a", "b"], None) == np.linalg.matrix_rank(dummy_matrix(a, b))


def test_blocks_that_never_meet_lose_one_level_each(spark):
    rows = [(f"a{k}{i}", 10 * k + j, f"c{(i + j) % 3}") for k in range(2) for i in range(2) for j in range(2)] * 2
    df = spark.createDataFrame(rows, "a string, b int, g string")
    assert econ.absorbed_dof(df, ["a", "b"], None) == 6 and econ.absorbed_dof(df, ["a", "b"], "g") == 6


def chain(n, rng):
    """A weakly connected panel: level i of one effect meets levels i and i + 1 of the other."""
    rows = [(i, i + d) for i in range(n) for d in (0, 1) for _ in range(int(rng.integers(1, 4)))]
    return [(a, b, float(rng.normal() + a), float(rng.normal() * 5 + 1e3), f"c{rng.integers(0, 6)}") for a, b in rows]


def test_weakly_connected_panel_converges_quickly(spark):
    rng = np.random.default_rng(8)
    rows = chain(25, rng)
    df = spark.createDataFrame(rows, "a int, b int, y double, x double, g string")
    a, b, y, x, _ = zip(*rows)
    d = dummy_matrix(a, b)
    out, steps = econ.absorb_effects(df, ["y", "x"], ["a", "b"])
    want = {}
    for name, v in (("y", np.array(y)), ("x", np.array(x))):
        want[name] = v - d @ np.linalg.lstsq(d, v, rcond=None)[0]
        got = np.sort([r[0] for r in out.select(name).collect()])
        assert np.allclose(got, np.sort(want[name]), atol=1e-6)
    # the sweeps that plain alternating projections need for the same bound
    r, sweeps = np.array(y) - np.mean(y), 0
    while True:
        for col in (a, b):
            m = dummies(list(col))[0]
            r = r - m @ ((m.T @ r) / m.sum(axis=0))
        sweeps += 1
        m = dummies(list(a))[0]
        if np.abs((m.T @ r) / m.sum(axis=0)).max() < 1e-8 * np.std(y):
            break
    assert steps <= sweeps / 10
    fit = econ.ols_fe(df, "y", ["x"], ["a", "b"], "g", singletons=False)
    assert fit.coef[0] == pytest.approx(want["x"] @ want["y"] / (want["x"] @ want["x"]), rel=1e-6)
    assert fit.k == 1 + np.linalg.matrix_rank(d)


def test_balanced_panel_takes_one_step_and_three_effects_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(f"u{i}", j, (i * j) % 3, float(rng.normal()), 0) for i in range(6) for j in range(5) for _ in range(2)]
    df = spark.createDataFrame(rows, "a string, b int, c int, y double, l0 int")
    assert econ.absorb_effects(df, ["y"], ["a", "b"])[1] == 1
    d = dummy_matrix(*list(zip(*rows))[:3])
    y = np.array([r[3] for r in rows])
    got = econ.demean(df, ["y"], ["a", "b", "c"])
    assert got.columns == ["a", "b", "c", "l0", "y"]
    want = y - d @ np.linalg.lstsq(d, y, rcond=None)[0]
    assert np.allclose(np.sort([r.y for r in got.collect()]), np.sort(want), atol=1e-7)


def test_spec_grid_equals_single_fits_and_jobs_do_not_grow_with_models(spark):
    rows = make_panel(seed=11, g=12, t=6, n_inst=2)
    df = to_df(spark, rows, 2)
    specs = [("none", []), ("month", ["month"]), ("two", ["month", "cl"])]
    coefs, stats = econ.spec_grid(df, "y", ["x"], ["z0", "z1"], ["w"], "cl", specs)
    got = {(r.spec, r.model, r.term): (r.coef, r.se) for r in coefs.collect()}
    n = {(r.spec, r.model, r.stat): r.value for r in stats.collect()}
    for name, absorb in specs:
        ols = econ.ols_fe(df, "y", ["x", "w"], absorb, "cl")
        iv = econ.iv_2sls(df, "y", ["x"], ["z0", "z1"], ["w"], absorb, "cl")
        for model, fit in (("ols", ols), ("iv", iv["iv"]), ("first:x", iv["first:x"])):
            for r in fit.table():
                assert got[name, model, r["term"]] == pytest.approx((r["coef"], r["se"]), rel=1e-9)
            for k, v in fit.stats.items():
                assert n[name, model, k] == pytest.approx(v, rel=1e-9)

"""DuckDB oracles of the regression tables, in closed form: one regressor of interest ``x``
(endogenous), one control ``w``, two instruments ``z1`` and ``z2``.

Small matrices are written out as named scalars (2 x 2 and 3 x 3 inverses by cofactors). DuckDB
lets a select item use the names before it, so each stage is one SELECT of such scalars.
"""

from __future__ import annotations

from itertools import product

Matrix = list[list[str]]


class Scalars:
    """Select items, each named once."""

    def __init__(self, stem: str):
        self.stem, self.items = stem, []

    def let(self, expr: str) -> str:
        name = f"{self.stem}{len(self.items)}"
        self.items.append(f"{expr} AS {name}")
        return name

    def mul(self, a: Matrix, b: Matrix) -> Matrix:
        return [[self.let(" + ".join(f"{a[i][k]} * {b[k][j]}" for k in range(len(b))))
                 for j in range(len(b[0]))] for i in range(len(a))]

    def sub(self, a: Matrix, b: Matrix) -> Matrix:
        return [[self.let(f"{p} - {q}") for p, q in zip(r, s)] for r, s in zip(a, b)]

    def inv(self, a: Matrix) -> Matrix:
        n = len(a)
        if n == 1:
            return [[self.let(f"1.0 / {a[0][0]}")]]

        def minor(i, j):
            m = [[a[r][c] for c in range(n) if c != j] for r in range(n) if r != i]
            return m[0][0] if n == 2 else f"({m[0][0]} * {m[1][1]} - {m[0][1]} * {m[1][0]})"

        sign = lambda i, j: "" if (i + j) % 2 == 0 else "-"
        cof = [[self.let(f"{sign(i, j)}{minor(i, j)}") for j in range(n)] for i in range(n)]
        det = self.let(" + ".join(f"{a[0][j]} * {cof[0][j]}" for j in range(n)))
        return [[self.let(f"{cof[j][i]} / {det}") for j in range(n)] for i in range(n)]

    def text(self) -> str:
        return ",\n  ".join(self.items)


def turn(a: Matrix) -> Matrix:
    return [list(r) for r in zip(*a)]


VARS = ["y", "x", "w", "z1", "z2"]


def _block(rows: list[str], cols: list[str]) -> Matrix:
    return [["m_" + "_".join(sorted((r, c), key=VARS.index)) for c in cols] for r in rows]


def _meat(tag: str, names: list[str]) -> tuple[str, Matrix]:
    items = ", ".join(f"sum({tag}_{a} * {tag}_{b}) AS {tag}_{a}_{b}" for a, b in product(names, names))
    return items, [[f"{tag}_{a}_{b}" for b in names] for a in names]


def regression_ctes(name: str, demeaned: str, dof: str) -> str:
    """CTEs ``{name}_...`` ending in ``{name}`` (one row): coefficients ``b_<model>_<term>``,
    variances ``v_<model>_<term>``, ``f_stat``, ``hansen_j``, n and g. ``demeaned`` has district,
    y, x, w, z1, z2."""
    X, Z = ["x", "w"], ["z1", "z2", "w"]
    moments = ", ".join(f"sum({a} * {b}) AS m_{a}_{b}" for i, a in enumerate(VARS) for b in VARS[i:])
    s = Scalars("a")
    xx, xy = _block(X, X), _block(X, ["y"])
    zz, zx, zy = _block(Z, Z), _block(Z, X), _block(Z, ["y"])
    xxi, zzi = s.inv(xx), s.inv(zz)
    ols = s.mul(xxi, xy)
    pi = s.mul(zzi, zx)
    a = turn(pi)                                  # X'Z (Z'Z)^-1
    bread = s.inv(s.mul(a, zx))
    iv = s.mul(bread, s.mul(a, zy))
    e_ols = f"(y - {ols[0][0]} * x - {ols[1][0]} * w)"
    e_iv = f"(y - {iv[0][0]} * x - {iv[1][0]} * w)"
    v = "(x - " + " - ".join(f"{pi[i][0]} * {z}" for i, z in enumerate(Z)) + ")"
    sums = ", ".join([*[f"sum({c} * {e_ols}) AS o_{c}" for c in X], *[f"sum({c} * {e_iv}) AS i_{c}" for c in Z],
                      *[f"sum({c} * {v}) AS f_{c}" for c in Z]])
    (so, mo), (si, mi), (sf, mf) = _meat("o", X), _meat("i", Z), _meat("f", Z)
    t = Scalars("c")
    q = lambda k: f"(g / (g - 1.0)) * ((n - 1.0) / (n - ({k} + dof)))"
    qx, qf = t.let(q(2)), t.let(q(3))
    vo = t.mul(t.mul(xxi, mo), xxi)
    vi = t.mul(t.mul(bread, t.mul(t.mul(a, mi), pi)), bread)
    vf = t.mul(t.mul(zzi, mf), zzi)
    two = [[t.let(f"{qf} * {vf[i][j]}") for j in range(2)] for i in range(2)]
    bz = [[pi[0][0]], [pi[1][0]]]
    f_stat = t.mul(turn(bz), t.mul(t.inv(two), bz))[0][0]
    weight = t.inv(mi)
    xw = t.mul(turn(zx), weight)
    gmm = t.mul(t.inv(t.mul(xw, zx)), t.mul(xw, zy))
    ze = t.sub(zy, t.mul(zx, gmm))
    j = t.mul(turn(ze), t.mul(weight, ze))[0][0]
    out = [f"{ols[i][0]} AS b_ols_{c}, {qx} * {vo[i][i]} AS v_ols_{c}, {iv[i][0]} AS b_iv_{c}, "
           f"{qx} * {vi[i][i]} AS v_iv_{c}" for i, c in enumerate(X)]
    out += [f"{pi[i][0]} AS b_first_{c}, {qf} * {vf[i][i]} AS v_first_{c}" for i, c in enumerate(Z)]
    return f"""
{name}_m AS (SELECT count(*) AS n, count(DISTINCT district) AS g, {dof} AS dof, {moments} FROM {demeaned}),
{name}_b AS (SELECT *,
  {s.text()} FROM {name}_m),
{name}_s AS (SELECT d.district, {sums} FROM {demeaned} d, {name}_b GROUP BY d.district),
{name}_w AS (SELECT {so}, {si}, {sf} FROM {name}_s),
{name}_c AS (SELECT *,
  {t.text()} FROM {name}_b, {name}_w),
{name} AS (SELECT n, g, {', '.join(out)}, {f_stat} / 2 AS f_stat, {j} AS hansen_j FROM {name}_c)"""


def coefficient_rows(name: str, spec: str, terms: dict[str, str], fe: str = "") -> str:
    """Tidy (spec, model, term, coef, se, t, n_obs, n_clusters, raw t, fe) rows of
    ``regression_ctes``' last row."""
    rows = []
    for model, cols in (("ols", ["x", "w"]), ("iv", ["x", "w"]), ("first", ["z1", "z2", "w"])):
        label = f"first:{terms['x']}" if model == "first" else model
        for c in cols:
            b, v = f"b_{model}_{c}", f"v_{model}_{c}"
            rows.append(f"SELECT '{spec}' AS spec, '{label}' AS model, '{terms[c]}' AS term, "
                        f"round({b}, 6) AS coef, round(sqrt({v}), 6) AS se, "
                        f"round({b} / sqrt({v}), 5) AS t, n AS n_obs, g AS n_clusters, "
                        f"{b} / sqrt({v}) AS raw, '{fe}' AS fe FROM {name}")
    return " UNION ALL ".join(rows)

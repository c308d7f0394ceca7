"""Association tests per marker (T). Linear and count-based tests are sums by marker; iterative fits get one marker's rows as a pandas group."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators.udf import count_equal
from genoframe.operators.windows import global_rank, kept


def armitage() -> tuple[str, str]:
    """(chi-square, P) of the trend test over cells r0..r2, s0..s2, as SQL."""
    r, s = "(r0 + r1 + r2)", "(s0 + s1 + s2)"
    n, n1, n2 = f"({r} + {s})", "(r1 + s1)", "(r2 + s2)"
    top = f"({n} * (r1 + 2e0 * r2) - {r} * ({n1} + 2e0 * {n2}))"
    low = f"({r} * ({n} - {r}) * ({n} * ({n1} + 4e0 * {n2}) - power({n1} + 2e0 * {n2}, 2)))"
    chi = f"(case when {low} > 0 then {n} * power({top}, 2) / {low} end)"
    return chi, S.chi2_sf(chi, 1)


def allelic() -> tuple[str, str]:
    """Chi-square of the 2 x 2 table of alleles."""
    a, b, c, d = "(2e0 * r0 + r1)", "(2e0 * r2 + r1)", "(2e0 * s0 + s1)", "(2e0 * s2 + s1)"
    low = f"(({a} + {b}) * ({c} + {d}) * ({a} + {c}) * ({b} + {d}))"
    chi = f"(case when {low} > 0 then ({a} + {b} + {c} + {d}) * power({a} * {d} - {b} * {c}, 2) / {low} end)"
    return chi, S.chi2_sf(chi, 1)


def genotype_chi2() -> tuple[str, str]:
    """(chi-square, degrees of freedom) of the 2 x 3 table; empty margins are left out."""
    n = "(r0 + r1 + r2 + s0 + s1 + s2)"
    parts = []
    for k in range(3):
        for row, total in (("r", "(r0 + r1 + r2)"), ("s", "(s0 + s1 + s2)")):
            expected = f"({total} * 1e0 * (r{k} + s{k}) / {n})"
            parts.append(f"(case when {expected} > 0 then power({row}{k} - {expected}, 2) / {expected} else 0e0 end)")
    df = "((case when r0 + s0 > 0 then 1 else 0 end) + (case when r1 + s1 > 0 then 1 else 0 end) + (case when r2 + s2 > 0 then 1 else 0 end) - 1)"
    return f"({' + '.join(parts)})", df


def count_tests(tab: DataFrame) -> DataFrame:
    """T1 and T2 on a table of cells."""
    tab = tab.withColumn("chi2_trend", F.expr(armitage()[0])).withColumn("chi2_allelic", F.expr(allelic()[0]))
    return tab.withColumns({"p_trend": F.expr(S.chi2_sf("chi2_trend", 1)), "p_allelic": F.expr(S.chi2_sf("chi2_allelic", 1))})


def genotype_test(tab: DataFrame, min_cell: int = 5, draws: int = 5000, seed: int = 1) -> DataFrame:
    """P by chi-square; where a cell of the table is below ``min_cell``, from random tables with the same margins."""
    chi, df = genotype_chi2()
    rows = tab.withColumn("chi2", F.expr(chi)).withColumn("df", F.expr(df))
    rows = rows.withColumn("p", F.when(F.col("df") == 2, F.expr(S.chi2_sf("chi2", 2))).when(F.col("df") == 1, F.expr(S.chi2_sf("chi2", 1))))
    flagged = rows.where(F.least("r0", "r1", "r2", "s0", "s1", "s2") < min_cell)

    def simulate(batches):
        for pdf in batches:
            p = pdf["p"].to_numpy(float, na_value=np.nan).copy()
            for i, row in enumerate(pdf.itertuples(index=False)):
                random = np.random.default_rng([seed, int(row.marker)])
                cases, columns = int(row.r0 + row.r1 + row.r2), np.array([row.r0 + row.s0, row.r1 + row.s1, row.r2 + row.s2], int)
                n = int(columns.sum())
                if n == 0 or not 0 < cases < n:
                    continue
                drawn = random.multivariate_hypergeometric(columns, cases, size=draws)
                expected = np.outer([cases, n - cases], columns) / n
                used = expected[0] > 0
                stat = ((drawn - expected[0])[:, used] ** 2 / expected[0][used]).sum(1) + ((columns - drawn - expected[1])[:, used] ** 2 / expected[1][used]).sum(1)
                p[i] = (1 + (stat >= row.chi2 - 1e-9).sum()) / (draws + 1)
            yield pdf.assign(p=p)

    exact = flagged.mapInPandas(simulate, rows.schema).withColumn("simulated", F.lit(True))
    return rows.where(F.least("r0", "r1", "r2", "s0", "s1", "s2") >= min_cell).withColumn("simulated", F.lit(False)).unionByName(exact)


# --- linear models from sums -----------------------------------------------------------------------------------


def gram_sums(names: list[str], mask: Column | None = None, prefix: str = "") -> dict[str, Column]:
    """n, sums and sums of products of the columns over the rows that are complete in them (and in ``mask``), as aggregate columns; ``lm_from_sums`` reads them."""
    d = lambda c: F.col(c).cast("double")
    there = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    there = there if mask is None else there & mask
    out = {f"{prefix}n": F.count_if(there)} | {f"{prefix}s{i}": F.sum(F.when(there, d(a))) for i, a in enumerate(names)}
    return out | {f"{prefix}q{i}_{j}": F.sum(F.when(there, d(a) * d(b))) for i, a in enumerate(names) for j, b in enumerate(names) if j >= i}


def _gram(df: DataFrame, key: str, y: str, xs: list[str]) -> DataFrame:
    """Sums of products per key, rows complete in y and xs."""
    return df.dropna(subset=[y, *xs]).groupBy(key).agg(*(c.alias(n) for n, c in gram_sums([*xs, y]).items()))


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + top / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def beta_cdf(x: float, a: float, b: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _betacf(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _betacf(b, a, 1 - x) / b


def f_sf(x: float, d1: float, d2: float) -> float:
    return beta_cdf(d2 / (d2 + d1 * x), d2 / 2, d1 / 2) if x > 0 else 1.0


def chi2_sf(x: float, df: int) -> float:
    if not x > 0:
        return 1.0
    if df % 2 == 0:
        term = total = 1.0
        for k in range(1, df // 2):
            term *= x / 2 / k
            total += term
        return math.exp(-x / 2) * total
    out, term = math.erfc(math.sqrt(x / 2)), math.sqrt(x / 2) / math.gamma(1.5)
    for k in range(1, (df + 1) // 2):
        out += math.exp(-x / 2) * term
        term *= x / 2 / (k + 0.5)
    return out


def _names(prefix: str, xs: list[str]) -> list[str]:
    return [f"{kind}{prefix}.{x}" for x in ["(Intercept)", *xs] for kind in ("beta", "sd")]


def _solve(q: np.ndarray, s: np.ndarray, n: float, k: list[int], y: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Least squares from sums: (coefficients, inverse, residual sum) with an intercept."""
    a = np.empty((len(k) + 1, len(k) + 1))
    a[0, 0], a[0, 1:], a[1:, 0], a[1:, 1:] = n, s[k], s[k], q[np.ix_(k, k)]
    b = np.concatenate(([s[y]], q[k, y]))
    inverse = np.linalg.pinv(a)
    beta = inverse @ b
    return beta, inverse, float(q[y, y] - beta @ b)


def lm_from_sums(row: dict, f1: list[str], f0: list[str], test: str = "F", prefix: str = "") -> dict:
    """The fit of one key from its ``gram_sums`` over [*xs, y], with xs those of f1 and then those of f0 that are not among them: n, P, statistic, coefficients and deviations."""
    xs = [*f1, *(x for x in f0 if x not in f1)]
    n, m = row[f"{prefix}n"], len(xs)
    got = {"n": n, "p": None, "stat": None} | dict.fromkeys([*_names("1", f1), *_names("0", list(f0))])
    if not n:
        return got
    s = np.array([row[f"{prefix}s{i}"] for i in range(m + 1)], float)
    q = np.zeros((m + 1, m + 1))
    for i in range(m + 1):
        for j in range(i, m + 1):
            q[i, j] = q[j, i] = row[f"{prefix}q{i}_{j}"]
    k1, k0 = [xs.index(x) for x in f1], [xs.index(x) for x in f0]
    full = np.empty((len(k1) + 1, len(k1) + 1))
    full[0, 0], full[0, 1:], full[1:, 0], full[1:, 1:] = n, s[k1], s[k1], q[np.ix_(k1, k1)]
    # a variable that does not vary beside the others has no effect to speak of
    if n > len(k1) + 1 and np.linalg.matrix_rank(full / np.sqrt(np.outer(np.diag(full), np.diag(full)) + 1e-300), tol=1e-10) == len(full):
        b1, i1, r1 = _solve(q, s, n, k1, m)
        b0, i0, r0 = _solve(q, s, n, k0, m)
        free, more = n - len(k1) - 1, len(k1) - len(k0)
        if r1 > 1e-9 * max(1.0, q[m, m]):
            got["stat"] = (r0 - r1) / more / (r1 / free) if test == "F" else n * math.log(max(r0, 1e-300) / r1)
            got["p"] = f_sf(got["stat"], more, free) if test == "F" else chi2_sf(got["stat"], more)
        for tag, xs_, b, inv, r, k in (("1", f1, b1, i1, r1, k1), ("0", list(f0), b0, i0, r0, k0)):
            sd = np.sqrt(np.maximum(np.diag(inv) * r / max(n - len(k) - 1, 1), 0))
            got |= dict(zip(_names(tag, xs_), [v for pair in zip(b, sd, strict=True) for v in pair], strict=True))
    return got


def lm_per_marker(df: DataFrame, y: str, f1: list[str], f0: list[str] = (), key: str = "marker", test: str = "F") -> DataFrame:
    """T4, T5: linear regression of y on f1 against f0, on the rows complete for f1; F test, or the Gaussian likelihood ratio (``test="LR"``).

    Genotype rows are only summed; Python sees one row of sums per marker.
    """
    xs = [*f1, *(x for x in f0 if x not in f1)]
    names = [*_names("1", f1), *_names("0", list(f0))]
    schema = f"{key} long, n long, p double, stat double, " + ", ".join(f"`{c}` double" for c in names)

    def fit(batches):
        for pdf in batches:
            out = [{key: row[key]} | lm_from_sums(row, f1, f0, test) for row in pdf.to_dict("records")]
            yield pd.DataFrame(out, columns=[c.strip("`") for c in [key, "n", "p", "stat", *names]])

    return _gram(df, key, y, xs).mapInPandas(fit, schema)


# --- grouped fits ----------------------------------------------------------------------------------------------


def _grouped(df: DataFrame, key: str, cols: list[str], names: list[str], fit: Callable[[pd.DataFrame], dict], weight: str | None = None) -> DataFrame:
    """One fit per key on its complete rows, of which ``weight`` counts the individuals; a fit that fails gives nulls, but n. A key's individuals are in memory at a time."""
    schema = f"{key} long, n long, " + ", ".join(f"`{c}` double" for c in names)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {key: pdf[key].iloc[0], "n": int(pdf[weight].sum()) if weight else len(pdf)} | dict.fromkeys(names, np.nan)
        try:
            out |= fit(pdf)
        except (np.linalg.LinAlgError, ValueError, FloatingPointError, ZeroDivisionError, OverflowError):
            pass
        return pd.DataFrame([out], columns=[key, "n", *names])

    rows = df.select(key, *dict.fromkeys(cols)).dropna(subset=list(dict.fromkeys(cols)))
    # fits cost far more than their few rows tell: partitions are not merged by size
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, key).groupBy(key).applyInPandas(run, schema)


def _design(pdf: pd.DataFrame, xs: list[str]) -> np.ndarray:
    return np.column_stack([np.ones(len(pdf)), *(pdf[x].to_numpy(float) for x in xs)])


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, steps: int = 30) -> tuple[np.ndarray, np.ndarray, float]:
    """(coefficients, covariance, log likelihood) by Newton steps."""
    w0 = np.ones(len(y)) if weight is None else weight
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        info = x.T @ (x * (w0 * p * (1 - p))[:, None])
        change = np.linalg.solve(info, x.T @ (w0 * (y - p)))
        beta += change
        if np.abs(change).max() < 1e-10:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))), 1e-300, 1 - 1e-16)
    return beta, np.linalg.inv(info), float((w0 * (y * np.log(p) + (1 - y) * np.log1p(-p))).sum())


def _lr(names1: list[str], fit1: tuple, names0: list[str], fit0: tuple, more: int, wald: bool = False) -> dict:
    stat = 2 * (fit1[2] - fit0[2])
    out = {"stat": stat, "p": chi2_sf(stat, more)}
    for names, fit in ((names1, fit1), (names0, fit0)):
        out |= dict(zip(names, [v for pair in zip(fit[0], np.sqrt(np.maximum(np.diag(fit[1]), 0)), strict=True) for v in pair], strict=True))
    return out


def logistic_per_marker(df: DataFrame, y: str, f1: list[str], f0: list[str] = (), key: str = "marker") -> DataFrame:
    """Logistic regression, likelihood ratio of f1 against f0, Wald deviations. Equal rows are counted first, so that Python gets each combination of values once."""
    f0 = list(f0)
    cols = list(dict.fromkeys([y, *f1, *f0]))
    counted = df.dropna(subset=cols).groupBy(key, *cols).agg(F.count("*").cast("double").alias("__w"))
    names1, names0 = _names("1", f1), _names("0", f0)

    def fit(pdf: pd.DataFrame) -> dict:
        yy, w = pdf[y].to_numpy(float), pdf["__w"].to_numpy(float)
        return _lr(names1, logistic_fit(_design(pdf, f1), yy, w), names0, logistic_fit(_design(pdf, f0), yy, w), len(f1) - len(f0)) | {"n": int(w.sum())}

    return _grouped(counted, key, [*cols, "__w"], ["stat", "p", *names1, *names0], fit, "__w")


def logistic_table(tab: DataFrame, scores: tuple[float, float, float] = (0.0, 0.5, 1.0)) -> DataFrame:
    """Logistic regression on a 2 x 3 table: six weighted rows per marker."""

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                w = np.array([row.r0, row.r1, row.r2, row.s0, row.s1, row.s2], float)
                x = np.column_stack([np.ones(6), np.tile(scores, 2)])
                y = np.repeat([1.0, 0.0], 3)
                try:
                    b1, c1, l1 = logistic_fit(x, y, w)
                    _, _, l0 = logistic_fit(x[:, :1], y, w)
                    out.append((row.marker, b1[1], math.sqrt(c1[1, 1]), 2 * (l1 - l0), chi2_sf(2 * (l1 - l0), 1)))
                except np.linalg.LinAlgError:
                    out.append((row.marker, None, None, None, None))
            yield pd.DataFrame(out, columns=["marker", "beta", "sd", "stat", "p"])

    return tab.mapInPandas(run, "marker long, beta double, sd double, stat double, p double")


def _newton(objective: Callable[[np.ndarray], float], start: np.ndarray, steps: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Maximum of a smooth log likelihood by Newton steps on numeric derivatives, with halving."""
    at, value = start.astype(float), objective(start)
    n = len(at)
    hess = -np.eye(n)
    for _ in range(steps):
        h = 1e-4 * np.maximum(1, np.abs(at))
        e = np.diag(h)
        up, down = np.array([objective(at + e[i]) for i in range(n)]), np.array([objective(at - e[i]) for i in range(n)])
        grad = (up - down) / (2 * h)
        hess = np.empty((n, n))
        for i in range(n):
            hess[i, i] = (up[i] - 2 * value + down[i]) / h[i] ** 2
            for j in range(i):
                hess[i, j] = hess[j, i] = (objective(at + e[i] + e[j]) - objective(at + e[i] - e[j]) - objective(at - e[i] + e[j]) + objective(at - e[i] - e[j])) / (4 * h[i] * h[j])
        values, vectors = np.linalg.eigh(hess)
        move = vectors @ ((vectors.T @ grad) / np.maximum(-values, 1e-6))
        scale = 1.0
        while scale > 1e-6 and not objective(at + scale * move) >= value - 1e-12:
            scale /= 2
        new = objective(at + scale * move)
        done = new - value < 1e-9
        at, value = at + scale * move, new
        if done:
            break
    return at, np.linalg.pinv(-hess), value


def ordinal_per_marker(df: DataFrame, y: str, f1: list[str], f0: list[str] = (), key: str = "marker") -> DataFrame:
    """Proportional odds, likelihood ratio; equal rows are counted first."""
    f0 = list(f0)
    cols = list(dict.fromkeys([y, *f1, *f0]))
    counted = df.dropna(subset=cols).groupBy(key, *cols).agg(F.count("*").cast("double").alias("__w"))
    names = [f"{k}.{x}" for x in f1 for k in ("beta1", "sd1")]

    def fit(pdf: pd.DataFrame) -> dict:
        levels, code = np.unique(pdf[y].to_numpy(), return_inverse=True)
        w, k = pdf["__w"].to_numpy(float), len(levels) - 1
        share = np.clip(np.cumsum(np.bincount(code, w))[:-1] / w.sum(), 1e-6, 1 - 1e-6)
        cuts = np.log(share / (1 - share))
        first = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))

        def model(xs: list[str]) -> tuple:
            x = pdf[xs].to_numpy(float) if xs else np.zeros((len(pdf), 0))

            def loglik(t: np.ndarray) -> float:
                c = np.concatenate(([-np.inf], t[0] + np.concatenate(([0], np.cumsum(np.exp(np.minimum(t[1:k], 20))))), [np.inf]))
                eta = x @ t[k:]
                cdf = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                return float((w * np.log(np.maximum(cdf(c[code + 1] - eta) - cdf(c[code] - eta), 1e-300))).sum())

            return _newton(loglik, np.concatenate((first, np.zeros(x.shape[1]))))

        one, null = model(f1), model(f0)
        stat = 2 * (one[2] - null[2])
        sds = np.sqrt(np.maximum(np.diag(one[1]), 0))
        return {"n": int(w.sum()), "stat": stat, "p": chi2_sf(stat, len(f1) - len(f0))} | dict(zip(names, [v for i in range(len(f1)) for v in (one[0][k + i], sds[k + i])], strict=True))

    return _grouped(counted, key, [*cols, "__w"], ["stat", "p", *names], fit, "__w")


def _cluster_sums(df: DataFrame, key: str, cluster: str, cols: list[str]) -> DataFrame:
    """By key and cluster: n, sums s0.. and sums of products q0_0.. of the columns, over rows complete in all of them."""
    d = lambda c: F.col(c).cast("double")
    sums = [F.count("*").cast("double").alias("n"), *(F.sum(d(a)).alias(f"s{i}") for i, a in enumerate(cols))]
    sums += [F.sum(d(a) * d(b)).alias(f"q{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    return df.dropna(subset=[*cols, cluster]).groupBy(key, cluster).agg(*sums)


def lmm(df: DataFrame, y: str, f1: list[str], f0: list[str], cluster: str, key: str = "marker") -> DataFrame:
    """Linear mixed model with a random intercept by cluster, maximum likelihood, likelihood ratio.

    Spark sums each cluster's rows; a marker's group holds one row of sums per cluster, and the variance ratio is searched in one dimension.
    """
    xs = list(dict.fromkeys([*f1, *f0]))
    cols = [*xs, y]
    sums = _cluster_sums(df, key, cluster, cols)
    names = [*_names("1", f1)]
    m = len(cols)

    def fit(pdf: pd.DataFrame) -> dict:
        n = pdf["n"].to_numpy(float)
        s = np.column_stack([n, *(pdf[f"s{i}"].to_numpy(float) for i in range(m))])
        q = np.zeros((m + 1, m + 1))
        q[0] = q[:, 0] = s.sum(0)
        for i in range(m):
            for j in range(i, m):
                q[i + 1, j + 1] = q[j + 1, i + 1] = pdf[f"q{i}_{j}"].sum()
        total = n.sum()

        def profile(ratio: float, k: list[int]) -> tuple:
            shrink = ratio / (1 + ratio * n)
            a = q - s.T @ (s * shrink[:, None])
            beta = np.linalg.solve(a[np.ix_(k, k)], a[k, m])
            rss = a[m, m] - beta @ a[k, m]
            value = -0.5 * (total * math.log(2 * math.pi * rss / total) + np.log1p(ratio * n).sum() + total)
            return beta, np.linalg.inv(a[np.ix_(k, k)]) * rss / total, value

        def best(k: list[int]) -> tuple:
            lo, hi = -12.0, 6.0
            golden = (math.sqrt(5) - 1) / 2
            for _ in range(60):
                a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
                if profile(math.exp(a), k)[2] >= profile(math.exp(b), k)[2]:
                    hi = b
                else:
                    lo = a
            found, flat = profile(math.exp((lo + hi) / 2), k), profile(0.0, k)
            return found if found[2] >= flat[2] else flat

        at = lambda names: [0, *(xs.index(x) + 1 for x in names)]
        one, null = best(at(f1)), best(at(f0))
        stat = 2 * (one[2] - null[2])
        sds = np.sqrt(np.diag(one[1]))
        return {"n": int(total), "stat": stat, "p": chi2_sf(stat, len(f1) - len(f0))} | dict(zip(names, [v for pair in zip(one[0], sds, strict=True) for v in pair], strict=True))

    return _grouped(sums, key, [c for c in sums.columns if c != key], ["stat", "p", *names], fit, "n")


def glmm_binary(df: DataFrame, y: str, f1: list[str], f0: list[str], cluster: str, key: str = "marker") -> DataFrame:
    """Logistic regression with a random intercept by cluster (Laplace approximation), likelihood ratio."""
    cols = list(dict.fromkeys([y, *f1, *f0, cluster]))
    counted = df.dropna(subset=cols).groupBy(key, *cols).agg(F.count("*").cast("double").alias("__w"))

    def fit(pdf: pd.DataFrame) -> dict:
        _, code = np.unique(pdf[cluster].to_numpy(), return_inverse=True)
        yy, w, k = pdf[y].to_numpy(float), pdf["__w"].to_numpy(float), code.max() + 1

        def model(xs: list[str]) -> tuple:
            x = _design(pdf, xs)

            def loglik(t: np.ndarray) -> float:
                variance = math.exp(min(t[-1], 10))
                u, eta = np.zeros(k), x @ t[:-1]
                for _ in range(25):
                    p = 1 / (1 + np.exp(-np.clip(eta + u[code], -30, 30)))
                    grad = np.bincount(code, w * (yy - p), k) - u / variance
                    hess = np.bincount(code, w * p * (1 - p), k) + 1 / variance
                    change = grad / hess
                    u += change
                    if np.abs(change).max() < 1e-9:
                        break
                z = np.clip(eta + u[code], -30, 30)
                return float((w * (yy * z - np.log1p(np.exp(z)))).sum() - (u * u).sum() / (2 * variance) - 0.5 * np.log(variance * hess).sum())

            start = np.concatenate((logistic_fit(x, yy, w)[0], [-2.0]))
            return _newton(loglik, start, 25)

        one, null = model(f1), model(f0)
        stat = max(0.0, 2 * (one[2] - null[2]))
        return {"n": int(w.sum()), "stat": stat, "p": chi2_sf(stat, len(f1) - len(f0)), "variance": math.exp(one[0][-1])} | {f"beta1.{x}": one[0][i + 1] for i, x in enumerate(f1)}

    return _grouped(counted, key, [*cols, "__w"], ["stat", "p", "variance", *(f"beta1.{x}" for x in f1)], fit, "__w")


def gee(df: DataFrame, y: str, f1: list[str], f0: list[str], cluster: str, family: str = "gaussian", key: str = "marker") -> DataFrame:
    """Independence working correlation, robust deviations by cluster, Wald P of what f1 adds to f0.

    Python gets one row of sums for each cluster of a marker (gaussian), or one for each combination of values that occurs in it (binomial), not the individuals.
    """
    f1, names = list(f1), _names("1", f1)
    cols = list(dict.fromkeys([y, *f1, *f0]))
    m = len(f1)

    def wald(n: float, beta: np.ndarray, bread: np.ndarray, u: np.ndarray) -> dict:
        cov = bread @ (u.T @ u) @ bread
        at = [1 + f1.index(v) for v in f1 if v not in f0]
        stat = float(beta[at] @ np.linalg.solve(cov[np.ix_(at, at)], beta[at]))
        return {"n": int(n), "stat": stat, "p": chi2_sf(stat, len(at))} | dict(zip(names, [v for pair in zip(beta, np.sqrt(np.diag(cov)), strict=True) for v in pair], strict=True))

    def from_sums(pdf: pd.DataFrame) -> dict:
        gram, right = np.empty((len(pdf), m + 1, m + 1)), np.empty((len(pdf), m + 1))
        gram[:, 0, 0], right[:, 0] = pdf["n"], pdf[f"s{m}"]
        for i in range(m):
            gram[:, 0, i + 1] = gram[:, i + 1, 0] = pdf[f"s{i}"]
            right[:, i + 1] = pdf[f"q{i}_{m}"]
            for j in range(i, m):
                gram[:, i + 1, j + 1] = gram[:, j + 1, i + 1] = pdf[f"q{i}_{j}"]
        bread = np.linalg.inv(gram.sum(axis=0))
        beta = bread @ right.sum(axis=0)
        # a cluster's score is what its sums leave over
        return wald(pdf["n"].sum(), beta, bread, right - gram @ beta)

    def from_counts(pdf: pd.DataFrame) -> dict:
        x, yy, w = _design(pdf, f1), pdf[y].to_numpy(float), pdf["__w"].to_numpy(float)
        beta, bread, _ = logistic_fit(x, yy, w)
        scores = x * (w * (yy - 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))))[:, None]
        _, code = np.unique(pdf[cluster].to_numpy(), return_inverse=True)
        return wald(w.sum(), beta, bread, np.column_stack([np.bincount(code, scores[:, i]) for i in range(m + 1)]))

    if family == "binomial":
        counted = df.dropna(subset=[*cols, cluster]).groupBy(key, cluster, *cols).agg(F.count("*").cast("double").alias("__w"))
        return _grouped(counted, key, [cluster, *cols, "__w"], ["stat", "p", *names], from_counts, "__w")
    complete = df.dropna(subset=[*cols, cluster])
    sums = _cluster_sums(complete, key, cluster, [*f1, y])
    return _grouped(sums, key, [c for c in sums.columns if c != key], ["stat", "p", *names], from_sums, "n")


# --- imputed genotypes -----------------------------------------------------------------------------------------


def imputed_score(prob: DataFrame, y: str, scores: tuple[float, float, float] = (0.0, 1.0, 2.0)) -> DataFrame:
    """Score test of a phenotype on expected scores, with the information lost to uncertain calls; all as sums by marker. ``uncertainty`` is the sum of the variances of the calls."""
    called = prob.where(F.col(y).isNotNull() & (F.col("p_aa") + F.col("p_ab") + F.col("p_bb") > 0))
    a, b, c = (F.lit(float(s)) for s in scores)
    mean = F.col("p_aa") * a + F.col("p_ab") * b + F.col("p_bb") * c
    square = F.col("p_aa") * a * a + F.col("p_ab") * b * b + F.col("p_bb") * c * c
    rows = called.select("marker", F.col(y).cast("double").alias("y"), mean.alias("x"), (square - mean * mean).alias("v"))
    s = rows.groupBy("marker").agg(*(F.sum(e).alias(k) for k, e in {"n": F.lit(1.0), "sy": F.col("y"), "sx": F.col("x"), "sxx": F.col("x") * F.col("x"), "sxy": F.col("x") * F.col("y"), "sv": F.col("v"), "svy": F.col("v") * F.col("y"), "svyy": F.col("v") * F.col("y") * F.col("y"), "syy": F.col("y") * F.col("y")}.items()))
    m = F.col("sy") / F.col("n")
    score = F.col("sxy") - m * F.col("sx")
    var_y = F.col("syy") / F.col("n") - m * m
    info = var_y * (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n") + F.col("sv"))
    lost = F.col("svyy") - 2 * m * F.col("svy") + m * m * F.col("sv")
    out = s.select("marker", score.alias("score"), info.alias("information"), lost.alias("missing_information"), F.col("sv").alias("uncertainty"))
    out = out.withColumn("stat", F.when(F.col("information") > F.col("missing_information"), F.col("score") * F.col("score") / (F.col("information") - F.col("missing_information"))))
    return out.withColumns({"p": F.expr(S.chi2_sf("stat", 1)), "r2": 1 - F.col("missing_information") / F.nullif(F.col("information"), F.lit(0.0))})


def imputed_score_gt(prob: DataFrame, y: str) -> DataFrame:
    """The same with two degrees of freedom (indicators of two genotypes); the 2 x 2 inverse in closed form."""
    called = prob.where(F.col(y).isNotNull() & (F.col("p_aa") + F.col("p_ab") + F.col("p_bb") > 0)).select("marker", F.col(y).cast("double").alias("y"), F.col("p_ab").alias("a"), F.col("p_bb").alias("b"))
    mean = called.groupBy("marker").agg(F.avg("y").alias("my"), F.avg("a").alias("ma"), F.avg("b").alias("mb"))
    e = called.join(mean, "marker").withColumn("e", F.col("y") - F.col("my"))
    s = e.groupBy("marker").agg(F.sum(F.col("e") * F.col("a")).alias("ua"), F.sum(F.col("e") * F.col("b")).alias("ub"), F.sum(F.col("e") * F.col("e")).alias("ss"), F.count("*").alias("n"), F.first("ma").alias("ma"), F.first("mb").alias("mb"), F.sum(F.col("e") * F.col("e") * F.col("a") * (1 - F.col("a"))).alias("la"), F.sum(F.col("e") * F.col("e") * F.col("b") * (1 - F.col("b"))).alias("lb"), F.sum(-F.col("e") * F.col("e") * F.col("a") * F.col("b")).alias("lab"))
    v11 = F.col("ss") * F.col("ma") * (1 - F.col("ma")) - F.col("la")
    v22 = F.col("ss") * F.col("mb") * (1 - F.col("mb")) - F.col("lb")
    v12 = -F.col("ss") * F.col("ma") * F.col("mb") - F.col("lab")
    det = v11 * v22 - v12 * v12
    stat = F.when(det > 0, (F.col("ua") * F.col("ua") * v22 - 2 * F.col("ua") * F.col("ub") * v12 + F.col("ub") * F.col("ub") * v11) / det)
    return s.select("marker", stat.alias("stat")).withColumn("p", F.expr(S.chi2_sf("stat", 2)))


def r2_max_post(prob: DataFrame) -> DataFrame:
    """Squared correlation of the dosage with the most likely genotype."""
    best = F.when((F.col("p_bb") > F.col("p_ab")) & (F.col("p_bb") > F.col("p_aa")), 2.0).when(F.col("p_ab") > F.col("p_aa"), 1.0).otherwise(0.0)
    rows = prob.where("p_aa + p_ab + p_bb > 0").withColumns({"best": best, "dose": F.col("p_ab") + 2 * F.col("p_bb")})
    return rows.groupBy("marker").agg(F.pow(S.corr("best", "dose"), F.lit(2)).alias("r2"))


def imputed_lr(prob: DataFrame, y: str, scores: tuple[float, float, float] = (0.0, 0.5, 1.0)) -> DataFrame:
    """Likelihood ratio of a binary phenotype whose genotype is known by probabilities; the likelihood mixes over the three genotypes."""
    rows = prob.where("p_aa + p_ab + p_bb > 0").groupBy("marker", y, "p_aa", "p_ab", "p_bb").agg(F.count("*").cast("double").alias("__w"))

    def fit(pdf: pd.DataFrame) -> dict:
        p, yy, w = pdf[["p_aa", "p_ab", "p_bb"]].to_numpy(float), pdf[y].to_numpy(float), pdf["__w"].to_numpy(float)
        x = np.array(scores)

        def loglik(t: np.ndarray) -> float:
            q = 1 / (1 + np.exp(-np.clip(t[0] + t[1] * x, -30, 30)))
            return float((w * np.log(np.maximum((p * np.where(yy[:, None] == 1, q, 1 - q)).sum(1), 1e-300))).sum())

        share = np.clip((w * yy).sum() / w.sum(), 1e-6, 1 - 1e-6)
        start = math.log(share / (1 - share))
        at, cov, one = _newton(loglik, np.array([start, 0.0]))
        stat = max(0.0, 2 * (one - loglik(np.array([start, 0.0]))))
        return {"n": int(w.sum()), "beta": at[1], "sd": math.sqrt(max(cov[1, 1], 0)), "stat": stat, "p": chi2_sf(stat, 1)}

    return _grouped(rows, "marker", [y, "p_aa", "p_ab", "p_bb", "__w"], ["beta", "sd", "stat", "p"], fit, "__w")


def lh_test_lr(df: DataFrame, cols: list[str], loglik: Callable[[np.ndarray, pd.DataFrame], float], start1: list[float], start0: list[float], expand0: Callable[[np.ndarray], np.ndarray], key: str = "marker", counted: str | None = None) -> DataFrame:
    """Likelihood ratio of a user's log likelihood; ``expand0`` maps null parameters to full ones.

    With ``counted`` equal rows are counted first, where they lie: the likelihood gets each combination of ``cols`` once and its number of rows in a column of that
    name, by which it weights the terms; ``n`` counts rows as before. So a marker's frame is bounded by combinations of values, not by individuals."""

    def fit(pdf: pd.DataFrame) -> dict:
        one = _newton(lambda t: loglik(t, pdf), np.array(start1))
        null = _newton(lambda t: loglik(expand0(t), pdf), np.array(start0)) if start0 else (None, None, loglik(expand0(np.array([])), pdf))
        stat = max(0.0, 2 * (one[2] - null[2]))
        n = {} if counted is None else {"n": int(pdf[counted].sum())}
        return n | {"stat": stat, "p": chi2_sf(stat, len(start1) - len(start0))} | {f"t{i}": v for i, v in enumerate(one[0])}

    if counted is not None:
        cols = list(dict.fromkeys(cols))
        df, cols = count_equal(df.select(key, *cols).dropna(subset=cols), counted), [*cols, counted]
    return _grouped(df, key, cols, ["stat", "p", *(f"t{i}" for i in range(len(start1)))], fit, counted)


# --- permutations ----------------------------------------------------------------------------------------------

_MIX1, _MIX2, _GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _uniform(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) by hash, one for each row key (64 bits) and column number."""
    x = rows[:, None] + (columns[None, :] + np.uint64(1)) * _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _keys(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _dealt_cases(sample: DataFrame, y: str, reps: int, seed: int) -> DataFrame:
    """(iid, key, cases): bit 0 of ``cases`` is the individual's own status, bit r whether it is a case in replicate r.

    In each replicate the cases are the ``n1`` individuals of least hash, so that their number stays. The hash up to which they go lies near n1 / n: a first
    pass counts what lies surely below and sends on the few values near it (some square root of n a replicate), of which the right one is taken.
    """
    known = sample.where(F.col(y).isNotNull()).select("iid", F.col(y).cast("int").alias("y"), F.xxhash64(F.lit(seed), "iid").alias("key"))
    n, n1 = known.agg(F.count("*"), F.sum("y")).first()
    if not n:
        return known.select("iid", "key", F.lit(None).cast("binary").alias("cases"))
    share, columns = n1 / n, np.arange(reps, dtype=np.uint64)
    around = 8 * math.sqrt(share * (1 - share) / n) + 2 / n
    lo, hi = share - around, share + around

    def near(batches):
        below = np.zeros(reps, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                u = _uniform(_keys(batch.column(2))[at : at + 256], columns)
                below += (u < lo).sum(0)
                row, rep = np.nonzero((u >= lo) & (u <= hi))
                yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int32()), pa.array(u[row, rep]), pa.nulls(len(rep), pa.int64())], names=["rep", "u", "below"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(reps), pa.int32()), pa.nulls(reps, pa.float64()), pa.array(below)], names=["rep", "u", "below"])

    counted = kept(known.mapInArrow(near, "rep int, u double, below long"))
    below = counted.where("u is null").groupBy("rep").agg(F.sum("below").alias("below"))
    placed = counted.where("u is not null").withColumn("k", F.row_number().over(Window.partitionBy("rep").orderBy("u"))).drop("below").join(below, "rep")
    found = {r["rep"]: r["u"] for r in placed.where(F.col("k") + F.col("below") == n1).select("rep", "u").collect()}  # one number a replicate
    if 0 < n1 < n and len(found) < reps:
        raise ValueError("the number of cases of a replicate is not kept: its hashes are spread too unevenly; take another seed")
    least = np.array([found[r] if 0 < n1 < n else (-1.0 if n1 == 0 else 2.0) for r in range(reps)])

    def deal(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cases = np.empty((part.num_rows, reps + 1), bool)
                cases[:, 0] = part.column(1).to_numpy() > 0
                cases[:, 1:] = _uniform(_keys(part.column(2)), columns) <= least
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([x.tobytes() for x in np.packbits(cases, axis=1)], pa.binary())], names=["iid", "key", "cases"])

    return known.mapInArrow(deal, "iid long, key long, cases binary")


def _erfc(x: np.ndarray) -> np.ndarray:
    """For x of 0 or more, by the approximation that the scalar functions use."""
    y = np.maximum(x, 4.0)
    inverse = 1 / (y * y)
    large = np.exp(-y * y) / y * (1 / math.sqrt(math.pi) - inverse * np.polyval(S._ERF_P, inverse) / np.polyval(S._ERF_Q, inverse))
    z = np.minimum(x, 4.0)
    return np.where(x > 4, large, np.exp(-z * z) * np.polyval(S._ERF_C, z) / np.polyval(S._ERF_D, z))


def _trend(cases: np.ndarray, totals: np.ndarray, all_cases: np.ndarray) -> np.ndarray:
    """Trend chi-square by replicate from ``cases`` (3, replicates) and ``totals`` (3, replicates); 0 where it is not defined."""
    n, r = totals.sum(0), all_cases
    x, xx = totals[1] + 2.0 * totals[2], totals[1] + 4.0 * totals[2]
    low = r * (n - r) * (n * xx - x * x)
    top = n * (cases[1] + 2.0 * cases[2]) - r * x
    return np.where(low > 0, n * top * top / np.where(low > 0, low, 1), 0.0)


def _minus_log_p(chi2: np.ndarray) -> np.ndarray:
    return -np.log(np.maximum(_erfc(np.sqrt(chi2 / 2)), 1e-300))


def _by_replicate(rows: DataFrame, reps: int, seed: int) -> DataFrame:
    """(rep, value): sum of -log P over all markers of ``rows`` (marker, key, cases, p_aa, p_ab), with genotypes drawn in each replicate: replicates are
    summed side by side as arrays, marker by marker, in one pass."""
    columns = np.arange(reps + 1, dtype=np.uint64)

    def run(batches):
        total = np.zeros(reps + 1)
        marker, cases, totals = None, np.zeros((3, reps + 1)), np.zeros((3, reps + 1))
        for batch in batches:
            names = batch.column(0).to_numpy()
            for at in range(0, len(names), 512):
                part = batch.slice(at, 512)
                dealt = np.unpackbits(np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, -1), axis=1)[:, : reps + 1].astype(bool)
                u = _uniform(_keys(part.column(1)) ^ (names[at : at + 512].view(np.uint64) + np.uint64(seed)) * _MIX1, columns)
                first = part.column(3).to_numpy()[:, None]
                g = (u >= first).astype(np.int8) + (u >= first + part.column(4).to_numpy()[:, None])
                own = names[at : at + 512]
                for a in np.flatnonzero(np.diff(own, prepend=own[0] - 1)).tolist():
                    b = a + int(np.searchsorted(own[a:], own[a], "right"))
                    if marker is not None and own[a] != marker:
                        total += _minus_log_p(_trend(cases, totals, cases.sum(0)))
                        cases[:], totals[:] = 0, 0
                    marker = own[a]
                    for k in range(3):
                        here = g[a:b] == k
                        totals[k] += here.sum(0)
                        cases[k] += (here & dealt[a:b]).sum(0)
        if marker is not None:
            total += _minus_log_p(_trend(cases, totals, cases.sum(0)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(reps + 1), pa.int32()), pa.array(total)], names=["rep", "value"])

    dealt = rows.repartition("marker").sortWithinPartitions("marker")
    return dealt.mapInArrow(run, "rep int, value double").groupBy("rep").agg(F.sum("value").alias("value"))


def global_emp(gt: DataFrame, sample: DataFrame, y: str, reps: int = 5000, seed: int = 1, how: str = "min") -> DataFrame:
    """P of an aggregate over markers (least trend P, or the mean of -log P with ``how="tail"``) from permuted cases, ``#{better than observed} / M``.

    Replicates are vectors: a call is shuffled with a few bytes for each thousand of them, and markers are gone through side by side.
    """
    from genoframe.operators import permute

    rows = gt.where("gt is not null").select("iid", "marker", "gt").join(sample.select("iid", F.col(y).cast("int").alias("__y")), "iid")
    logs = lambda *sums: _minus_log_p(permute.trend_chi2(*sums))
    per = permute.replicate_totals(rows, "iid", "__y", ["gt"], permute.trend_chi2 if how == "min" else logs, reps, "max" if how == "min" else "sum", seed, "marker")
    first = per.where("rep = 0").select(F.col("value").alias("v0"))
    # equal up to rounding is not better
    better = F.col("value") > F.col("v0") * (1 + permute.ROUNDING)
    out = per.where("rep > 0").join(F.broadcast(first)).agg(F.first("v0").alias("v0"), (F.count_if(better) / reps).alias("p"))
    markers = gt.where("gt is not null").agg(F.count_distinct("marker").alias("m"))
    observed = F.expr(S.chi2_sf("v0", 1)) if how == "min" else F.col("v0") / F.col("m")
    return out.join(F.broadcast(markers)).select(observed.alias("observed"), "p")


def set_permutation(prob: DataFrame, sample: DataFrame, y: str, reps: int = 5000, seed: int = 1) -> DataFrame:
    """In each replicate cases are permuted and genotypes drawn anew from the probabilities by a hash; sum of -log P over the markers, ``(1 + #{T >= T0}) / (M + 1)``."""
    dealt = _dealt_cases(sample, y, reps, seed)
    rows = prob.where("p_aa + p_ab + p_bb > 0").join(dealt, "iid").select("marker", "key", "cases", "p_aa", "p_ab")
    per = _by_replicate(rows, reps, seed)
    first = per.where("rep = 0").select(F.col("value").alias("t0"))
    return per.where("rep > 0").join(F.broadcast(first)).agg(F.first("t0").alias("observed"), ((1 + F.count_if(F.col("value") >= F.col("t0"))) / (reps + 1)).alias("p"))


def _permuted(sample: DataFrame, y: str, reps: int, seed: int, cluster: str | None = None) -> DataFrame:
    """(rep, iid, y): for each replicate the phenotypes dealt anew. With ``cluster`` whole clusters change places with clusters of their size, members by the order of their ids.

    Units are ordered by replicate, size and a seeded hash, once as givers and once as takers; equal places meet. The order is made over range partitions, so
    that no task holds a replicate.
    """
    ids = sample.where(F.col(y).isNotNull()).select("iid", F.col(y).alias("y"), (F.col(cluster) if cluster else F.col("iid")).alias("unit"))
    if cluster:
        ids = kept(ids.withColumn("member", F.row_number().over(Window.partitionBy("unit").orderBy("iid"))))
        units = ids.groupBy("unit").agg(F.count("*").alias("size"))
    else:
        ids = ids.withColumn("member", F.lit(1))
        units = ids.select("unit", F.lit(1).alias("size"))
    every = units.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(reps))))

    def ordered(tag: str) -> DataFrame:
        hashed = every.withColumn("h", F.xxhash64(F.lit(seed), F.lit(tag), F.col("rep"), F.col("unit"))).select("rep", "size", "h", "unit")
        return global_rank(hashed, ["rep", "size", "h", "unit"], "k").select("k", "rep", F.col("unit").alias(tag))

    # a replicate's places are the same numbers in both orders
    met = ordered("giver").join(ordered("taker").drop("rep"), "k")
    given = met.join(ids.select(F.col("unit").alias("giver"), "member", "y"), "giver")
    return given.join(ids.select(F.col("unit").alias("taker"), "member", "iid"), ["taker", "member"]).select("rep", "iid", F.col("y").alias(y))


def permute_p(df: DataFrame, key: str, y: str, stat: Column, n: int = 5000, side: str = "upper", seed: int = 1, by: list[str] | None = None, cluster: str | None = None) -> DataFrame:
    """T27 for any aggregate column, which need not be a function of sums: rows are joined with every replicate, so use ``permute.permutation_p`` where sums will do. P lower, upper or two-tailed; divided by n.

    With ``by`` (markers) there is a row for each group; a replicate deals the individuals' phenotypes once for all groups. An individual has one y.
    """
    by = by or []
    renamed = df.withColumnRenamed(key, "iid")
    people = renamed.select("iid", y, *([cluster] if cluster else [])).dropDuplicates(["iid"])
    per = _permuted(people, y, n, seed, cluster).join(renamed.drop(y), "iid").groupBy(*by, "rep").agg(stat.alias("s"))
    first = df.groupBy(*by).agg(stat.alias("s0"))
    test = {"upper": F.col("s") >= F.col("s0"), "lower": F.col("s") <= F.col("s0"), "two": F.abs("s") >= F.abs("s0")}[side]
    joined = per.join(first, by) if by else per.join(F.broadcast(first))
    return joined.groupBy(*by).agg(F.first("s0").alias("observed"), (F.count_if(test) / n).alias("p"))


def assoc_multi(df: DataFrame, phenotypes: list[str], f1: list[str], f0: list[str] = ()) -> DataFrame:
    """Quantitative association of all phenotypes that exist: unpivoted, one job, key (phenotype, marker)."""
    known = [p for p in phenotypes if p in df.columns]
    keep = [c for c in df.columns if c not in phenotypes]
    long = df.select(*keep, *(F.col(p).cast("double").alias(p) for p in known)).unpivot(keep, known, "phenotype", "y")
    number = {p: k for k, p in enumerate(known)}
    place = F.create_map(*(F.lit(x) for pair in number.items() for x in pair))
    out = lm_per_marker(long.withColumn("key", F.col("marker") * len(known) + place[F.col("phenotype")]), "y", f1, f0, key="key")
    names = F.array(*map(F.lit, known))
    return out.withColumns({"marker": F.floor(F.col("key") / len(known)).cast("long"), "phenotype": F.get(names, (F.col("key") % len(known)).cast("int"))}).drop("key")

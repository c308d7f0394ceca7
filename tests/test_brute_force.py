"""Operators that SQL can't express, against plain brute force on small data."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators import assoc as T
from genoframe.operators import cox as C
from genoframe.operators import ld as LD
from genoframe.operators import permute as P
from genoframe.operators import qc as Q
from genoframe.operators import scaling as M
from genoframe.operators import reshape as A
from genoframe.operators import windows as W
from genoframe.plans import fixtures as X

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def people(spark):
    """Genotypes with phenotypes of marker 3, and of all markers."""
    rows = X.gt(spark, DATA).join(X.sample(spark, DATA), "iid").where("gt is not null").toPandas()
    return rows.sort_values(["marker", "iid"]).reset_index(drop=True)


def _best(f, lo, hi, steps=80):
    """Maximum of a function with one peak, by golden section."""
    g = (math.sqrt(5) - 1) / 2
    for _ in range(steps):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if f(a) >= f(b) else (a, hi)
    return (lo + hi) / 2


# --- order, quantiles, distances


def test_clumps_over_cell_borders(spark, monkeypatch):
    random = np.random.default_rng(3)
    step = np.where(random.random(600) < 0.04, 900_000, random.integers(0, 700, 600))
    rows = [(k, 1 + k % 2, int(p), float(random.random())) for k, p in enumerate(np.cumsum(step))]
    df = spark.createDataFrame(rows, "marker long, chr int, pos long, p double")
    for d in (300, 1000, 400_000):
        expected = []
        for c in (1, 2):
            here, groups = sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[0])), []
            for r in here:
                if not groups or r[2] - groups[-1][-1][2] > d:
                    groups.append([])
                groups[-1].append(r)
            expected += [min(g, key=lambda r: (r[3], r[0]))[0] for g in groups]
        assert sorted(r.marker for r in W.prune_distance(df, d).collect()) == sorted(expected)


def test_top_hits_with_a_limit_returns_all(spark):
    random = np.random.default_rng(4)
    rows = [(k, 1 + k % 3, int(random.integers(0, 60_000)), float(random.random())) for k in range(400)]
    df = spark.createDataFrame(rows, "marker long, chr int, pos long, p double")
    left, expected = sorted((r for r in rows if r[3] <= 0.6), key=lambda r: (r[3], r[0])), []
    while left:
        best = left.pop(0)
        expected.append(best[0])
        left = [r for r in left if r[1] != best[1] or r[2] == best[2] or abs(r[2] - best[2]) >= 1500]
    assert [r.marker for r in W.top_hits(df, 3, 1500, p_limit=0.6).collect()] == expected


def test_quantiles_by_ranges(spark):
    random = np.random.default_rng(5)
    values = random.normal(size=237).round(2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    levels = [0.0, 0.1, 0.25, 0.5, 0.73, 1.0]
    for few in (1000, 10):
        assert W.exact_quantiles(df, F.col("x"), levels, few) == pytest.approx(np.quantile(values, levels).tolist())
    assert W.exact_quantiles(df.where("x > 99"), F.col("x"), [0.5]) == [None]


def test_ids_without_distances_go_one_by_one(spark):
    random = np.random.default_rng(6)
    pairs = [(a, b, None if random.random() < (0.5 if a % 7 == 0 else 0.04) else 1.0) for a in range(40) for b in range(a + 1, 40)]
    bad, gone = {(a, b) for a, b, v in pairs if v is None}, set()
    while bad:
        count = {}
        for pair in bad:
            for i in pair:
                count[i] = count.get(i, 0) + 1
        worst = min(count, key=lambda i: (-count[i], i))
        gone.add(worst)
        bad = {p for p in bad if worst not in p}
    got = Q.drop_nan_ids(spark.createDataFrame(pairs, "id1 long, id2 long, value double")).collect()
    assert {(r.id1, r.id2) for r in got} == {(a, b) for a, b, _ in pairs if a not in gone and b not in gone}


def test_lumped_levels(spark):
    counts = {"a": 1, "b": 2, "c": 2, "d": 5, "e": 9, "f": 4}
    df = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "x string")
    groups = [([k], n) for k, n in counts.items()]
    while min(n for _, n in groups) < 6 and len(groups) > 1:
        groups.sort(key=lambda g: (g[1], sorted(g[0])))
        groups = [(groups[0][0] + groups[1][0], groups[0][1] + groups[1][1]), *groups[2:]]
    expected = {x: "+".join(sorted(g)) for g, _ in groups for x in g}
    assert {r.x: r.x_lumped for r in A.lump_factor(df, "x", 6).collect()} == expected


# --- quality control


def test_ld_prune(spark):
    random = np.random.default_rng(7)
    base = random.integers(0, 3, (80, 12))
    calls = np.concatenate([base, np.where(random.random((80, 12)) < 0.15, random.integers(0, 3, (80, 12)), base)], 1)
    calls = calls[:, random.permutation(24)]
    rows = [(i, m, 1, m * 10, int(calls[i, m])) for i in range(80) for m in range(24)] + [(0, 99, 23, 5, 1)]
    got = {r.marker: r.pruned for r in LD.ld_prune(spark.createDataFrame(rows, "iid long, marker long, chr int, pos long, gt int"), 8, 3, 2.0).collect()}
    alive, corr = [True] * 24, np.corrcoef(calls.T)
    for lo in range(0, 24 - 8 + 1 + 3, 3):
        while True:
            at = [k for k in range(lo, min(lo + 8, 24)) if alive[k]]
            if len(at) < 2:
                break
            factors = np.diag(np.linalg.pinv(corr[np.ix_(at, at)]))
            if factors.max() <= 2.0:
                break
            alive[at[int(factors.argmax())]] = False
    assert got == {k: not alive[k] for k in range(24)} | {99: True}
    assert 0 < sum(got.values()) < 25


def test_ld_prune_in_segments(spark):
    """Whatever the segments, the result is that of one sweep; correlations reach over the borders, and copies of a marker go."""
    random = np.random.default_rng(11)
    calls = np.zeros((60, 90), int)
    calls[:, 0] = random.integers(0, 3, 60)
    for k in range(1, 90):
        calls[:, k] = np.where(random.random(60) < (0.25 if k % 30 else 1.0), random.integers(0, 3, 60), calls[:, k - 1])
    calls[:, 40] = calls[:, 39]
    calls[:, 70] = 1
    rows = [(i, m, 1 + m // 60, m * 10, int(calls[i, m])) for i in range(60) for m in range(90)]
    gt = spark.createDataFrame(rows, "iid long, marker long, chr int, pos long, gt int")
    expected = {}
    for own in (range(60), range(60, 90)):
        with np.errstate(all="ignore"):
            corr, alive = np.nan_to_num(np.corrcoef(calls[:, list(own)].T)), np.ones(len(own), bool)
        np.fill_diagonal(corr, 1)
        band = np.array([[corr[k, k + d] if k + d < len(own) else 0 for d in range(8)] for k in range(len(own))])
        LD.sweep(band, alive, range(0, max(1, len(own) - 8 + 1 + 3), 3), 8, 2.0)
        expected |= {m: not a for m, a in zip(own, alive, strict=True)}
    assert expected[39] or expected[40]
    for segment in (9, 12, 2000):
        assert {r.marker: r.pruned for r in LD.ld_prune(gt, 8, 3, 2.0, segment).collect()} == expected
    assert LD.ld_prune(gt.where("false")).count() == 0


def test_scaling_of_more_ids_than_a_block(spark, monkeypatch):
    """Eigenvectors of a matrix without gaps to speak of, to 1e-6, over several blocks; dimensions that the distances have not got are 0."""
    monkeypatch.setattr(M, "BLOCK", 16)
    random = np.random.default_rng(3)
    far = random.uniform(0.2, 0.6, (70, 70))
    d2 = np.triu(far, 1) ** 2 + (np.triu(far, 1) ** 2).T
    centre = np.eye(70) - 1 / 70
    value, vector = np.linalg.eigh(-0.5 * centre @ d2 @ centre)
    pairs = spark.createDataFrame([(100 + a, 100 + b, float(1 - far[a, b])) for a in range(70) for b in range(a + 1, 70)], "id1 long, id2 long, distance double")
    got = M.mds(pairs, 3, rule="c1 > mean1 + 2 * sd1").toPandas().sort_values("id")
    for k in range(3):
        expected = vector[:, -1 - k] * np.sqrt(value[-1 - k])
        expected *= np.sign(expected[np.abs(expected).argmax()])
        assert np.allclose(got[f"c{k + 1}"], expected, atol=1e-6)
    assert got.outlier.tolist() == (got.c1 > got.c1.mean() + 2 * got.c1.std()).tolist()
    line = spark.createDataFrame([(a, b, 1 - abs(a - b) / 10) for a in range(5) for b in range(a + 1, 5)], "id1 long, id2 long, distance double")
    flat = M.mds(line, 2).toPandas()
    assert np.allclose(sorted(flat.c1), [-0.2, -0.1, 0.0, 0.1, 0.2]) and np.allclose(flat.c2, 0, atol=1e-6)
    assert M.mds(pairs.where("false"), 2).count() == 0


def test_scaling_of_distances(spark):
    random = np.random.default_rng(8)
    place = random.normal(size=(30, 2)) * [3, 1] * 0.05
    far = np.sqrt(((place[:, None] - place[None]) ** 2).sum(-1))
    pairs = spark.createDataFrame([(a, b, float(1 - far[a, b])) for a in range(30) for b in range(a + 1, 30)], "id1 long, id2 long, distance double")
    got = M.mds(pairs, 2).toPandas().sort_values("id")[["c1", "c2"]].to_numpy()
    again = np.sqrt(((got[:, None] - got[None]) ** 2).sum(-1))
    assert np.allclose(again, far, atol=1e-6)


# --- fits


def test_cox_against_the_likelihood_written_out(spark, people):
    one = people[people.marker == 3]
    t, d, g = one.age.to_numpy(float), one.cc.to_numpy(), one["gt"].to_numpy(float)

    def loglik(b):
        total = 0.0
        for time in sorted(set(t[d == 1])):
            dead, risk = np.flatnonzero((t == time) & (d == 1)), t >= time
            total += b * g[dead].sum()
            for j in range(len(dead)):
                total -= math.log(np.exp(b * g[risk]).sum() - j / len(dead) * np.exp(b * g[dead]).sum())
        return total

    beta = _best(loglik, -5, 5)
    information = -(loglik(beta + 1e-3) - 2 * loglik(beta) + loglik(beta - 1e-3)) / 1e-6
    df = X.gt(spark, DATA).where("marker = 3").join(X.sample(spark, DATA).select("iid", "age", "cc"), "iid")
    got = C.cox_per_marker(df, "age", "cc", ["gt"]).first()
    assert got["beta1.gt"] == pytest.approx(beta, abs=1e-5)
    assert got["sd1.gt"] == pytest.approx(information**-0.5, rel=1e-3)
    assert got.p == pytest.approx(math.erfc(abs(beta) * information**0.5 / math.sqrt(2)), rel=1e-2)


def test_cox_with_clusters_by_hand(spark, people):
    """Two covariates: every individual's score residual step by step of each tie, summed by cluster; and nulls, a marker that does not vary and an empty table."""
    df = X.gt(spark, DATA).where("marker in (3, 5)").join(X.sample(spark, DATA), "iid").withColumn("z", F.col("y") / 1000)
    got = C.cox_per_marker(df, "age", "cc", ["gt", "z"], cluster="fid").toPandas().set_index("marker")
    plain = C.cox_per_marker(df, "age", "cc", ["gt", "z"], ["z"]).toPandas().set_index("marker")
    for marker, g in df.where("gt is not null").toPandas().groupby("marker"):
        t, d, x = g.age.to_numpy(float), g.cc.to_numpy(), g[["gt", "z"]].to_numpy(float)
        beta = got.loc[marker, ["beta1.gt", "beta1.z"]].to_numpy(float)
        assert np.allclose(beta, plain.loc[marker, ["beta1.gt", "beta1.z"]].to_numpy(float))
        risk, u, information = np.exp(x @ beta), np.zeros(x.shape), np.zeros((2, 2))
        for time in sorted(set(t[d == 1])):
            dead, there = (t == time) & (d == 1), t >= time
            for j in range(dead.sum()):
                share = there - dead * j / dead.sum()
                total = (share * risk).sum()
                mean = (share * risk) @ x / total
                information += (x * (share * risk)[:, None]).T @ x / total - np.outer(mean, mean)
                u += dead[:, None] / dead.sum() * (x - mean) - (share * risk / total)[:, None] * (x - mean)
        assert np.allclose(u.sum(0), 0, atol=1e-6)
        by = np.array([u[g.fid.to_numpy() == f].sum(0) for f in set(g.fid)])
        cov = np.linalg.inv(information) @ by.T @ by @ np.linalg.inv(information)
        assert np.allclose(got.loc[marker, ["sd1.gt", "sd1.z"]].to_numpy(float), np.sqrt(np.diag(cov)), rtol=1e-6)
        assert got.stat[marker] == pytest.approx(beta @ np.linalg.solve(cov, beta), rel=1e-6)
    flat = C.cox_per_marker(df.withColumn("gt", F.lit(1)), "age", "cc", ["gt"]).toPandas()
    assert len(flat) == 2 and flat.p.isna().all() and (flat.n > 0).all()
    assert C.cox_per_marker(df.where("false"), "age", "cc", ["gt"]).count() == 0
    assert C.cox_per_marker(df.withColumn("z", F.lit(None).cast("double")), "age", "cc", ["gt", "z"]).count() == 0


def test_mixed_model_against_dense_matrices(spark, people):
    one = people[people.marker == 3]
    y, x = one.y.to_numpy(float), np.column_stack([np.ones(len(one)), one["gt"]])
    same = (one.fid.to_numpy()[:, None] == one.fid.to_numpy()).astype(float)

    def loglik(ratio, x):
        v = np.eye(len(y)) + ratio * same
        inverse = np.linalg.inv(v)
        beta = np.linalg.solve(x.T @ inverse @ x, x.T @ inverse @ y)
        rest = y - x @ beta
        s2 = rest @ inverse @ rest / len(y)
        return -0.5 * (len(y) * math.log(2 * math.pi * s2) + np.linalg.slogdet(v)[1] + len(y)), beta

    def best(x):
        ratio = math.exp(_best(lambda r: loglik(math.exp(r), x)[0], -12, 6))
        return max(loglik(ratio, x), loglik(0.0, x), key=lambda r: r[0])

    (l1, beta), (l0, _) = best(x), best(x[:, :1])
    df = X.gt(spark, DATA).where("marker = 3").join(X.sample(spark, DATA).select("iid", "y", "fid"), "iid")
    got = T.lmm(df, "y", ["gt"], [], "fid").first()
    assert got.stat == pytest.approx(2 * (l1 - l0), abs=1e-4)
    assert got["beta1.gt"] == pytest.approx(beta[1], rel=1e-4)


def test_robust_deviations_written_out(spark, people):
    one = people[people.marker == 3]
    y, x = one.y.to_numpy(float), np.column_stack([np.ones(len(one)), one["gt"]])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    rest, middle = y - x @ beta, np.zeros((2, 2))
    for f in set(one.fid):
        own = (one.fid == f).to_numpy()
        u = x[own].T @ rest[own]
        middle += np.outer(u, u)
    bread = np.linalg.inv(x.T @ x)
    sd = np.sqrt(np.diag(bread @ middle @ bread))
    df = X.gt(spark, DATA).where("marker = 3").join(X.sample(spark, DATA).select("iid", "y", "fid"), "iid")
    got = T.gee(df, "y", ["gt"], [], "fid").first()
    assert (got["beta1.gt"], got["sd1.gt"]) == pytest.approx((beta[1], sd[1]), rel=1e-8)
    assert got.p == pytest.approx(math.erfc(abs(beta[1] / sd[1]) / math.sqrt(2)), rel=1e-8)


def test_robust_logistic_deviations_written_out(spark, people):
    """Binomial with a covariate: scores of single individuals, summed by cluster."""
    one = people[people.marker == 5]
    y, x = one.cc.to_numpy(float), np.column_stack([np.ones(len(one)), one["gt"], one.age])
    df = X.gt(spark, DATA).where("marker = 5").join(X.sample(spark, DATA), "iid")
    got = T.gee(df, "cc", ["gt", "age"], ["age"], "fid", "binomial").first()
    beta = np.array([got[f"beta1.{v}"] for v in ("(Intercept)", "gt", "age")])
    p = 1 / (1 + np.exp(-x @ beta))
    assert np.allclose(x.T @ (y - p), 0, atol=1e-6)
    u = np.array([x[own].T @ (y - p)[own] for own in ((one.fid == f).to_numpy() for f in set(one.fid))])
    bread = np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None]))
    sd = np.sqrt(np.diag(bread @ u.T @ u @ bread))
    assert got["sd1.gt"] == pytest.approx(sd[1], rel=1e-6) and got.stat == pytest.approx((beta[1] / sd[1]) ** 2, rel=1e-6) and got.n == len(one)


def test_random_intercepts_of_a_logistic_model(spark):
    """The Laplace likelihood written out person by person, its greatest value found coordinate by coordinate."""
    random = np.random.default_rng(4)
    family = np.repeat(np.arange(12), 20)
    g = random.integers(0, 3, 240).astype(float)
    y = (random.uniform(size=240) < 1 / (1 + np.exp(-(-0.5 + 0.6 * g + random.normal(size=12)[family] * 1.2)))).astype(int)
    df = spark.createDataFrame([(i, 1, float(g[i]), int(y[i]), int(family[i])) for i in range(240)], "iid long, marker long, gt double, cc int, fid long")

    def loglik(a, b, s):
        total = 0.0
        for f in range(12):
            own = family == f
            eta = a + b * g[own]
            inner = lambda u: (y[own] * (eta + u) - np.log1p(np.exp(eta + u))).sum() - u * u / (2 * s)
            u = _best(inner, -8, 8, 60)
            p = 1 / (1 + np.exp(-(eta + u)))
            total += inner(u) - 0.5 * math.log(s * ((p * (1 - p)).sum() + 1 / s))
        return total

    def best(b):
        a, s = 0.0, 1.0
        for _ in range(12):
            a = _best(lambda v: loglik(v, b, s), -4, 4, 25)
            s = math.exp(_best(lambda v: loglik(a, b, math.exp(v)), -5, 3, 25))
        return loglik(a, b, s), s

    got = T.glmm_binary(df, "cc", ["gt"], [], "fid").first()
    at, variance = best(got["beta1.gt"])
    assert got.variance == pytest.approx(variance, rel=2e-2)
    assert got.stat == pytest.approx(2 * (at - best(0.0)[0]), abs=1e-2)
    assert at >= max(best(got["beta1.gt"] - 0.05)[0], best(got["beta1.gt"] + 0.05)[0]) - 1e-4


def test_imputed_likelihood_written_out(spark):
    prob = X.prob(spark, DATA).where("marker = 3").join(X.sample(spark, DATA).select("iid", "cc"), "iid")
    rows = prob.where("p_aa + p_ab + p_bb > 0").toPandas()
    p, y = rows[["p_aa", "p_ab", "p_bb"]].to_numpy(), rows.cc.to_numpy()

    def loglik(a, b):
        q = 1 / (1 + np.exp(-(a + b * np.array([0.0, 0.5, 1.0]))))
        return np.log((p * np.where(y[:, None] == 1, q, 1 - q)).sum(1)).sum()

    profile = lambda b: max((loglik(a, b) for a in [_best(lambda a: loglik(a, b), -6, 6, 50)]))
    beta = _best(profile, -8, 8, 50)
    got = T.imputed_lr(prob.select("marker", "cc", "p_aa", "p_ab", "p_bb"), "cc").first()
    assert got.beta == pytest.approx(beta, abs=2e-3)
    assert got.stat == pytest.approx(2 * (profile(beta) - profile(0.0)), abs=1e-5)


def test_ordinal_fit_is_a_maximum(spark, people):
    one = people[people.marker == 3]
    grade, g = np.clip(np.floor(one.y.to_numpy() / 3500), 0, 2).astype(int), one["gt"].to_numpy(float)

    def loglik(c0, c1, b):
        cut = np.array([-np.inf, c0, c1, np.inf])
        cdf = lambda z: 1 / (1 + np.exp(-z))
        with np.errstate(over="ignore"):
            return np.log(cdf(cut[grade + 1] - b * g) - cdf(cut[grade] - b * g)).sum()

    def profile(b):
        c0, c1 = -1.0, 1.0
        for _ in range(25):
            c0 = _best(lambda c: loglik(c, c1, b), -8, c1 - 1e-6, 40)
            c1 = _best(lambda c: loglik(c0, c, b), c0 + 1e-6, 8, 40)
        return loglik(c0, c1, b)

    assert set(grade) == {0, 1, 2}
    df = X.gt(spark, DATA).where("marker = 3").join(X.sample(spark, DATA).select("iid", "y"), "iid").withColumn("grade", F.greatest(F.least(F.floor(F.col("y") / 3500), F.lit(2)), F.lit(0)))
    got = T.ordinal_per_marker(df, "grade", ["gt"]).first()
    b = got["beta1.gt"]
    assert profile(b) >= max(profile(b - 0.05), profile(b + 0.05))
    assert got.stat == pytest.approx(2 * (profile(b) - profile(0.0)), abs=1e-3)


# --- permutations


def test_replicates_are_permutations_and_trend_tests(spark):
    sample, reps = X.sample(spark, DATA), 60
    dealt = T._dealt_cases(sample, "cc", reps, 1)
    rows = dealt.toPandas()
    bits = np.unpackbits(np.frombuffer(b"".join(rows.cases), np.uint8).reshape(len(rows), -1), axis=1)[:, : reps + 1]
    status = sample.toPandas().set_index("iid").cc
    assert (bits[:, 0] == status.loc[rows.iid].to_numpy()).all()
    assert set(bits.sum(0)) == {status.sum()} and len({b.tobytes() for b in bits.T}) == reps + 1
    calls = X.gt(spark, DATA).where("gt is not null")
    # probabilities of 0 and 1 draw the calls themselves
    sure = calls.select("iid", "marker", *(F.when(F.col("gt") == k, 1.0).otherwise(0.0).alias(n) for k, n in enumerate(("p_aa", "p_ab"))))
    got = T._by_replicate(sure.join(dealt, "iid").select("marker", "key", "cases", "p_aa", "p_ab"), reps, 1).toPandas().set_index("rep").value.sort_index()
    of, total = dict(zip(rows.iid, bits, strict=True)), np.zeros(reps + 1)
    for _, g in calls.toPandas().groupby("marker"):
        total += T._minus_log_p(_chi2(g["gt"].to_numpy(float), np.stack([of[i] for i in g.iid]).astype(float)))
    assert np.allclose(got, total)


def _chi2(x, y):
    x, y = x - x.mean(), y - y.mean(0)
    with np.errstate(all="ignore"):
        return len(x) * np.nan_to_num((x @ y) ** 2 / ((x**2).sum() * (y**2).sum(0)))


def test_global_permutation_by_hand(spark, monkeypatch):
    """The least P and the mean of -log P over markers, replicate by replicate, over several blocks and chunks."""
    monkeypatch.setattr(P, "BLOCK", 64)
    monkeypatch.setattr(P, "CHUNK", 25)
    sample, calls, reps = X.sample(spark, DATA), X.gt(spark, DATA).where("gt is not null"), 75
    known = calls.join(sample, "iid").select("iid", "cc")
    people = P.ordered_people(known, "cc", 1).toPandas().sort_values("place")
    to = P.dealt(*(people[c].to_numpy() for c in ("place", "first", "units", "size")), 1, np.arange(reps + 1))
    y = np.empty(to.shape)
    for r in range(reps + 1):
        y[to[:, r], r] = people.y.to_numpy()
    place, best, total, markers = dict(zip(people.iid, people.place, strict=True)), np.zeros(reps + 1), np.zeros(reps + 1), 0
    for _, g in calls.toPandas().groupby("marker"):
        chi2 = _chi2(g["gt"].to_numpy(float), y[[place[i] for i in g.iid]])
        best, total, markers = np.maximum(best, chi2), total + (T._minus_log_p(chi2) if g["gt"].nunique() > 1 else 0), markers + 1
    least = T.global_emp(calls, sample, "cc", reps).first()
    assert least.p == (best[1:] > best[0] * (1 + 1e-9)).mean() and least.observed == pytest.approx(math.erfc(math.sqrt(best[0] / 2)), rel=1e-6)
    tail = T.global_emp(calls, sample, "cc", reps, how="tail").first()
    assert tail.p == (total[1:] > total[0] * (1 + 1e-9)).mean() and tail.observed == pytest.approx(total[0] / markers, rel=1e-9)


def test_strong_association_beats_all_replicates(spark):
    rows = [(i, m, (2 if i % 2 else 0) if m == 5 else (i * (m + 3)) % 3) for i in range(200) for m in range(8)]
    gt = spark.createDataFrame(rows, "iid long, marker long, gt int")
    sample = spark.createDataFrame([(i, i % 2, i // 4) for i in range(200)], "iid long, cc int, family int")
    assert T.global_emp(gt, sample, "cc", 300).first().p == 0.0
    prob = gt.select("iid", "marker", *(F.when(F.col("gt") == k, 0.9).otherwise(0.05).alias(n) for k, n in enumerate(("p_aa", "p_ab", "p_bb"))))
    assert T.set_permutation(prob, sample, "cc", 300).first().p == pytest.approx(1 / 301)
    joined = gt.join(sample, "iid")
    got = {r.marker: r.p for r in T.permute_p(joined, "iid", "cc", F.abs(S.corr("cc", "gt")), 50, by=["marker"]).collect()}
    assert got[5] == 0.0 and max(got.values()) > 0.2


def test_clusters_change_places_as_a_whole(spark):
    rows = [(i, f, float(10 * f + i)) for i, f in enumerate([1, 1, 2, 2, 3, 3, 4, 5, 5, 5, 6, 6, 6])]
    sample = spark.createDataFrame(rows, "iid long, family int, y double")
    got = T._permuted(sample, "y", 20, 1, "family").toPandas()
    value = {i: y for i, _, y in rows}
    family = {i: f for i, f, _ in rows}
    members = {f: [y for _, g, y in rows if g == f] for f in family.values()}
    for _, rep in got.groupby("rep"):
        assert sorted(rep.y) == sorted(value.values())
        for f, own in rep.assign(f=rep.iid.map(family)).sort_values("iid").groupby("f"):
            assert own.y.tolist() in [m for m in members.values() if len(m) == len(members[f])]
    assert len({tuple(rep.sort_values("iid").y) for _, rep in got.groupby("rep")}) > 1

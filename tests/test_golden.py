"""Golden cases on the embedded table, closed-form distribution checks and properties."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators import assoc as T
from genoframe.operators import cox as C
from genoframe.operators import genotypes as G
from genoframe.operators import joins as J
from genoframe.operators import reshape as A
from genoframe.operators import tables as P
from genoframe.operators import windows as W


@pytest.fixture(scope="module")
def small(spark):
    rows = [("a", "c", 1.0, "X", 3), ("b", "d", 2.0, "X", 4), ("aa", "g", 3.0, "X", 1), ("a", "a", 3.0, "X", 2), ("b", "a", 3.0, "Y", 3), ("c", "d", 4.0, "Y", 4), ("b", "a", 1.5, "Z", 5)]
    return spark.createDataFrame([(k + 1, *r) for k, r in enumerate(rows)], "line int, a string, b string, c double, d string, c1 int")


def test_group_max_row(small):
    got = [tuple(r)[1:] for r in A.group_max_row(small, ["a"], "c", "line").orderBy("line").collect()]
    assert got == [("aa", "g", 3.0, "X", 1), ("a", "a", 3.0, "X", 2), ("b", "a", 3.0, "Y", 3), ("c", "d", 4.0, "Y", 4)]


def test_filter_expression(small):
    assert [r.line for r in P.filter_expr(small, "c > 1.2 and d = 'Y'").orderBy("line").collect()] == [5, 6]


def test_dedup_counted(small):
    assert [r.a for r in W.dedup_labels(small, "a", ["line"], ":", counted=True).orderBy("line").collect()] == ["a", "b", "aa", "a:2", "b:2", "c", "b:3"]


def test_map_values(small):
    assert [r.b for r in J.map_values(small, "b", {"c": "v1", "g": "0"}).orderBy("line").collect()] == ["v1", "d", "0", "a", "a", "d", "a"]


def test_distribution_functions(spark):
    x = [0.01, 0.5, 1.0, 3.84, 10.0, 40.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = df.select(*(F.expr(S.chi2_sf("x", k)).alias(f"c{k}") for k in (1, 2, 3, 4, 5)), F.expr(S.erfc("x")).alias("e")).collect()
    for v, r in zip(x, got, strict=True):
        assert r.c1 == pytest.approx(math.erfc(math.sqrt(v / 2)), rel=1e-6)
        assert r.c2 == pytest.approx(math.exp(-v / 2), rel=1e-9)
        for k in (3, 4, 5):
            assert r[f"c{k}"] == pytest.approx(T.chi2_sf(v, k), rel=1e-5)
        assert r.e == pytest.approx(math.erfc(v), rel=1e-6)
    p = spark.createDataFrame([(v,) for v in (1e-8, 0.01, 0.3, 0.5, 0.99)], "p double")
    for r in p.select("p", F.expr(S.norm_quantile("p")).alias("z")).collect():
        assert 0.5 * math.erfc(-r.z / math.sqrt(2)) == pytest.approx(r.p, rel=1e-6)


def test_f_tail():
    assert T.f_sf(4.0, 1, 1e7) == pytest.approx(math.erfc(math.sqrt(2.0)), rel=1e-4)
    assert T.f_sf(3.0, 2, 10) == pytest.approx((1 + 2 * 3 / 10) ** -5, rel=1e-9)


def test_gram_equals_least_squares(spark):
    random = np.random.default_rng(3)
    rows = [(m, float(random.integers(0, 3)), float(random.normal()), float(random.normal())) for m in (1, 2) for _ in range(60)]
    df = spark.createDataFrame(rows, "marker long, gt double, age double, y double")
    for r in T.lm_per_marker(df, "y", ["gt", "age"], ["age"]).collect():
        own = np.array([x[1:] for x in rows if x[0] == r.marker])
        beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(60), own[:, 0], own[:, 1]]), own[:, 2], rcond=None)
        assert r["beta1.gt"] == pytest.approx(beta[1], abs=1e-9)
        assert 0 <= r.p <= 1


def test_flip_symmetry(spark):
    gt = spark.createDataFrame([(i, 1, (i * 7) % 3 if i % 5 else None) for i in range(50)], "iid long, marker long, gt int")
    af = G.allele_freq(gt).first().af
    assert G.allele_freq(gt.withColumn("gt", 2 - F.col("gt"))).first().af == pytest.approx(1 - af)


def test_scores_of_missing_calls(spark):
    gt = spark.createDataFrame([(None,), (0,), (1,), (2,)], "gt int")
    assert [r[0] for r in gt.select(G.score(F.col("gt"), "additive")).collect()] == [None, 0.0, 0.5, 1.0]


def test_global_rank_is_a_permutation(spark):
    df = spark.range(1000).withColumn("x", (F.col("id") * 7919) % 1009)
    got = W.global_rank(df, ["x"], "k").orderBy("k").collect()
    assert [r.k for r in got] == list(range(1, 1001))
    assert [r.x for r in got] == sorted(r.x for r in got)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (9, 3), (10, 11), (11, 12), (12, 13)], "a long, b long")
    assert {r.node: r.root for r in A.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, 10: 10, 11: 10, 12: 10, 13: 10}


def test_clumping_with_equal_positions(spark):
    df = spark.createDataFrame([(1, 1, 100, 0.2), (2, 1, 100, 0.1), (3, 1, 700, 0.3), (4, 2, 100, 0.4)], "marker long, chr int, pos long, p double")
    assert sorted(r.marker for r in W.prune_distance(df, 500).collect()) == [2, 3, 4]
    assert [r.marker for r in W.top_hits(df, 10, 1000).collect()] == [2, 1, 4]


def test_cox_and_logistic_agree_with_direction(spark):
    random = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        g = int(random.integers(0, 3))
        rows.append((1, float(g), float(round(random.exponential(1 / np.exp(0.7 * g)), 2)), 1, int(random.random() < 1 / (1 + np.exp(-g + 1)))))
    df = spark.createDataFrame(rows, "marker long, gt double, t double, event int, y int")
    cox = C.cox_per_marker(df, "t", "event", ["gt"]).first()
    assert cox["beta1.gt"] == pytest.approx(0.7, abs=0.2)
    logistic = T.logistic_per_marker(df, "y", ["gt"]).first()
    assert logistic["beta1.gt"] == pytest.approx(1.0, abs=0.35)
    assert logistic.p < 1e-6


def test_skipped_lines_of_split_files(spark, tmp_path):
    """Head lines are passed over once for each file, also where a file is read in several splits."""
    from genoframe.sources import tables as SC

    for name, n in (("a", 4000), ("b", 3)):
        (tmp_path / f"{name}.txt").write_text("note one\nnote two\nk\tx\n" + "".join(f"{k}\t{name}{k}\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = SC.read_table(spark, str(tmp_path / "*.txt"), skip=2, schema="k long, x string")
        assert got.rdd.getNumPartitions() > 3
        assert sorted((r.x, r.k) for r in got.collect()) == sorted([(f"a{k}", k) for k in range(4000)] + [(f"b{k}", k) for k in range(3)])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_simulated_p_of_small_tables(spark):
    """P from random tables against the exact sum over all tables with the same margins."""
    cells = (4, 3, 1, 2, 6, 5)
    r, columns = sum(cells[:3]), [cells[k] + cells[k + 3] for k in range(3)]
    n = sum(columns)

    def chi2(row):
        return sum((row[k] - r * columns[k] / n) ** 2 / (r * columns[k] / n) + (columns[k] - row[k] - (n - r) * columns[k] / n) ** 2 / ((n - r) * columns[k] / n) for k in range(3))

    exact = 0.0
    for a in range(columns[0] + 1):
        for b in range(columns[1] + 1):
            c = r - a - b
            if 0 <= c <= columns[2] and chi2((a, b, c)) >= chi2(cells[:3]) - 1e-9:
                exact += math.comb(columns[0], a) * math.comb(columns[1], b) * math.comb(columns[2], c) / math.comb(n, r)
    tab = spark.createDataFrame([(1, *cells)], "marker long, r0 int, r1 int, r2 int, s0 int, s1 int, s2 int")
    got = T.genotype_test(tab, draws=20_000).first()
    assert got.simulated and got.p == pytest.approx(exact, abs=0.012)


def test_tails_of_the_normal():
    """The tail formula against the C library, down to the smallest doubles."""
    import duckdb

    for x in [0.0, 0.01, 0.3, 0.47, 1.0, 2.5, 3.99, 4.01, 8.0, 15.0, 26.0]:
        got = duckdb.sql(f"select {S.erfc(f'({x}e0)')}").fetchall()[0][0]
        assert got == pytest.approx(math.erfc(x), rel=1e-11)
    assert duckdb.sql(f"select {S.chi2_sf('1370e0', 1)}").fetchall()[0][0] == pytest.approx(math.erfc(math.sqrt(685)), rel=1e-10)


def test_line_numbers_of_split_files(spark, tmp_path):
    from genoframe.sources import tables as SC

    (tmp_path / "a.txt").write_text("".join(f"line {k}\n" for k in range(1, 3001)))
    (tmp_path / "b.txt").write_text("line 1\nline 2\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = SC._lines(spark, str(tmp_path / "*.txt")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 3002 and all(r.value == f"line {r.line}" for r in rows)

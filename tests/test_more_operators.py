"""Sources, models, folds, imputation and fits of scores against plain code, and their odd cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators import assoc as T
from genoframe.operators import models as M
from genoframe.operators import results as R
from genoframe.plans import fixtures as X
from genoframe.sources import tables as SC

DATA = "/root/testdata/sf0.001"


# --- sources


def _file(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_prefixed_table_with_repeated_keys(spark, tmp_path):
    head, table = SC.read_prefixed(spark, _file(tmp_path, "a.txt", "source: a\nsource: b\nversion: 2\n\nid\tname\n1\tx\n\n2\ty: z\n"))
    assert head == {"source": "b", "version": "2"} and sorted(map(tuple, table.collect())) == [("1", "x"), ("2", "y: z")]
    head, table = SC.read_prefixed(spark, _file(tmp_path, "none.txt", "\nid\n5\n"))
    assert head == {} and [tuple(r) for r in table.collect()] == [("5",)]
    with pytest.raises(ValueError):
        SC.read_prefixed(spark, _file(tmp_path, "bad.txt", "a: b\nc: d\n"))


def test_prefixed_tables_of_a_folder(spark, tmp_path):
    """Heads of differing lengths; a file with other columns is an error."""
    folder = tmp_path / "many"
    folder.mkdir()
    _file(folder, "1.txt", "k: 1\n\nid\tname\n1\tx\n")
    _file(folder, "2.txt", "k: 2\nk: 3\nl: 4\n\nid\tname\n2\ty\n3\tz\n")
    head, table = SC.read_prefixed(spark, str(folder))
    assert head == {"k": "1"} and sorted(r.id for r in table.collect()) == ["1", "2", "3"]
    _file(folder, "3.txt", "k: 2\n\nid\tother\n2\ty\n")
    with pytest.raises(PySparkException):
        SC.read_prefixed(spark, str(folder))[1].collect()


def test_file_numbers_follow_the_list(spark, tmp_path):
    line = "snp_id rs_id position a0 a1 exp_freq_a1 info certainty type info_type0 concord_type0 r2_type0\n--- rs{k} 1 A G 0.5 0.9 1 0 NA NA NA\n"
    (tmp_path / "info1").mkdir()
    paths = [_file(tmp_path / "info1", "x.txt", line.format(k=0)), _file(tmp_path, "b.txt", line.format(k=1)), str(tmp_path / "info10")]
    (tmp_path / "info10").mkdir()
    _file(tmp_path / "info10", "x.txt", line.format(k=2))
    got = {r.rs_id: (r.file, r.file_no) for r in SC.read_gens_info(spark, paths).collect()}
    assert got == {"rs0": ("x.txt", 0), "rs1": ("b.txt", 1), "rs2": ("x.txt", 2)}
    assert {r.file_no for r in SC.read_gens_info(spark, ["file://" + str(tmp_path / "info1"), str(tmp_path / "info10")]).collect()} == {0, 1}


def test_packed_file_by_marker_list(spark, tmp_path, monkeypatch):
    """Only the wanted records and small gaps are read; calls count the rarer allele."""
    random = np.random.default_rng(1)
    calls = random.choice([0, 1, 2, -1], (40, 9), p=[0.1, 0.2, 0.6, 0.1])
    code = {2: 0, -1: 1, 1: 2, 0: 3}
    records = [bytes(sum(code[int(c)] << 2 * k for k, c in enumerate(row[a : a + 4])) for a in range(0, 9, 4)) for row in calls]
    path = str(tmp_path / "x.bed")
    with open(path, "wb") as out:
        out.write(b"\x6c\x1b\x01" + b"".join(records))
    bim = spark.createDataFrame([(k,) for k in range(40)], "marker_no long")
    fam = spark.createDataFrame([(k,) for k in range(9)], "person_no long")
    wanted = [3, 4, 4, 20, 39]
    got = SC.read_bed(spark, path, bim, fam, 10, spark.createDataFrame([(k,) for k in [*wanted, None]], "marker_no long"), flip=True).collect()
    assert len(got) == 4 * 9
    for r in got:
        row = calls[r.marker_no]
        turned = row[row >= 0].sum() > (row >= 0).sum()
        call = int(row[r.person_no])
        assert r.flipped == turned and r.gt == (None if call < 0 else 2 - call if turned else call)
    assert SC.read_bed(spark, path, bim, fam).count() == 360
    assert SC.read_bed(spark, path, bim, fam, only=bim.where("false")).count() == 0
    with pytest.raises(PySparkException):
        SC.read_bed(spark, path, bim, fam, only=spark.createDataFrame([(40,)], "marker_no long")).collect()
    assert SC.spans([3, 4, 20, 21, 39], 1) == [(3, 2), (20, 2), (39, 1)] and SC.spans([1, 5, 9], 4) == [(1, 9)] and SC.spans([], 3) == []
    text = _file(tmp_path, "x.bim", "1\trs1\t0\t100\tA\tG\n2\trs2\t0\t200\tC\tT\n")
    assert [(r.marker_no, r.marker, r.pos) for r in SC.bed_markers(spark, text).orderBy("marker_no").collect()] == [(0, "rs1", 100), (1, "rs2", 200)]


# --- models


def test_linear_models_share_one_reading(spark):
    """P of each model as fitted alone; the genotype rows are read once whatever the number of models."""
    df = X.gt(spark, DATA).join(X.sample(spark, DATA), "iid")
    models = M.expand_models([M.Model("y", ("gt",), responses=("y", "cc"), subsets={"all": None, "old": "age > 40", "odd": "if(age > 60, null, iid % 2 = 1)"}), M.Model("y", ("gt", "age"), ("age",), kind="gaussian", tag="lr")])
    got = M.association(df, models, maf=0.01, counts=2)
    scans = got._jdf.queryExecution().optimizedPlan().toString().count("lineitem") + got._jdf.queryExecution().optimizedPlan().toString().count("l_suppkey#")
    single = M.association(df, models[:1], maf=0.01, counts=2)
    assert scans == single._jdf.queryExecution().optimizedPlan().toString().count("lineitem") + single._jdf.queryExecution().optimizedPlan().toString().count("l_suppkey#")
    found = {(r.tag, r.marker): r for r in got.collect()}
    for m in models:
        rows = df.where(m.subset) if m.subset else df
        alone = {r.marker: r.p for r in T.lm_per_marker(rows, m.response, list(m.f1), list(m.f0), test="LR" if m.kind == "gaussian" else "F").collect()}
        af = {r.marker: r.af for r in M.testable(rows, 0.01, 2).collect()}
        assert {k for t, k in found if t == (m.tag or m.response)} == set(af)
        for marker, share in af.items():
            r = found[m.tag or m.response, marker]
            assert (r.af is None) == (share is None) and (share is None or r.af == pytest.approx(share))
            if r.status == "ok":
                assert r.p == pytest.approx(alone[marker], rel=1e-9)
            else:
                assert r.p is None and (share is None) == (r.status == "excluded")
    assert sum(r.status == "ok" for r in found.values()) > 10


# --- folds, scores, imputation


def test_folds_by_class(spark):
    rows = [(i, "abc"[0 if i < 20 else 1 if i < 27 else 2]) for i in range(60)]
    df = spark.createDataFrame([*rows, (99, None)], "id long, y string")
    got = R.class_folds(df, "id", "y", 4, 5).collect()
    assert sorted((r.id, r.y) for r in got) == sorted(rows)
    size = lambda keep: [sum(keep(r) and r.fold == f for r in got) for f in range(4)]
    assert max(size(lambda r: True)) - min(size(lambda r: True)) == 0
    for c in "abc":
        assert max(size(lambda r: r.y == c)) - min(size(lambda r: r.y == c)) <= 1  # noqa: B023
        assert all(sum(r.y == c and r.fold != f for r in got) >= 5 for f in range(4))
    with pytest.raises(ValueError, match="b"):
        R.class_folds(df, "id", "y", 4, 6)
    assert R.class_folds(df.where("false"), "id", "y").count() == 0


def test_cross_validation_by_hand(spark):
    """Each fold's predictions are those of least squares, or of a logistic fit, on the other folds."""
    random = np.random.default_rng(5)
    x = random.normal(size=(90, 2))
    y = 1 + x @ [2.0, -1.0] + random.normal(size=90) * 0.3
    z = (random.uniform(size=90) < 1 / (1 + np.exp(-x @ [1.5, 0.0]))).astype(int)
    df = spark.createDataFrame([(i, float(x[i, 0]), float(x[i, 1]), float(y[i]), int(z[i])) for i in range(90)], "id long, a double, b double, y double, z int")
    for label, binary, least in (("y", False, None), ("z", True, 3)):
        got = R.cross_validate(df, "id", label, ["a", "b"], 3, binary=binary, least=least).toPandas()
        assert sorted(got.id) == list(range(90)) and set(got.fold) == {0, 1, 2}
        for f in range(3):
            test, train = got[got.fold == f], got[got.fold != f]
            design = lambda d: np.column_stack([np.ones(len(d)), d[["a", "b"]]])
            if binary:
                beta = T.logistic_fit(design(train), train.z.to_numpy(float))[0]
                expected = 1 / (1 + np.exp(-design(test) @ beta))
            else:
                expected = design(test) @ np.linalg.lstsq(design(train), train.y, rcond=None)[0]
            assert np.allclose(test.predicted, expected, atol=1e-4)


def test_penalties_choose_and_refits_do_not_shrink(spark):
    random = np.random.default_rng(6)
    x = random.normal(size=(200, 3))
    y = 3 * x[:, 0] + 0.02 * x[:, 1] + random.normal(size=200) * 0.1
    df = spark.createDataFrame([(*map(float, x[i]), float(y[i])) for i in range(200)], "a double, b double, c double, y double")
    model, out = R.prs_fit(df, df, "y", ["a", "b", "c"], 0.5, binary=False)
    assert model.coefficients[0] > 2 and list(model.coefficients[1:]) == [0, 0] and out.count() == 200
    rows = [r.asDict() for r in R.refit(df, "y", ["a", "b", "c"], [0.5, 1e-6], binary=False).collect()]
    by = {}
    for r in rows:
        by.setdefault(r["penalty"], {})[r["variable"]] = r["coefficient"]
    alone = np.linalg.lstsq(np.column_stack([np.ones(200), x[:, 0]]), y, rcond=None)[0]
    assert by[0.5]["a"] == pytest.approx(alone[1], rel=1e-6) and set(by[0.5]) <= {"a", "(Intercept)"}
    full = np.linalg.lstsq(np.column_stack([np.ones(200), x]), y, rcond=None)[0]
    assert by[1e-6]["c"] == pytest.approx(full[3], abs=1e-6)


def test_cross_imputation(spark):
    """Every draw is a donor's value, with the donors' frequencies; observed values and columns without donors stay."""
    df = spark.createDataFrame([(i, None if i % 2 else 7.5, None if i % 3 else "q", None) for i in range(3000)], "id long, x double, s string, e int")
    donors = spark.createDataFrame([(1.25, "a", None)] * 600 + [(2.5, None, None)] * 200 + [(None, "b", None)], "x double, s string, e int")
    got = R.impute_cross(df, donors, ["x", "s", "e"], "id").toPandas().sort_values("id")
    assert len(got) == 3000 and got.e.isna().all()
    assert (got.x[got.id % 2 == 0] == 7.5).all() and (got.s[got.id % 3 == 0] == "q").all()
    drawn = got.x[got.id % 2 == 1]
    assert set(drawn) == {1.25, 2.5} and abs((drawn == 1.25).mean() - 0.75) < 0.04
    assert set(got.s[got.id % 3 != 0]) <= {"a", "b"} and (got.s[got.id % 3 != 0] == "a").mean() > 0.99
    again = R.impute_cross(df.repartition(7), donors.repartition(5), ["x", "s", "e"], "id").toPandas().sort_values("id")
    assert again.x.tolist() == got.x.tolist() and again.s.tolist() == got.s.tolist()
    other = R.impute_cross(df, donors, ["x"], "id", seed=2).toPandas().sort_values("id")
    assert other.x.tolist() != got.x.tolist()


def test_drawn_imputation(spark):
    """Each copy has its own draws from the observed values."""
    df = spark.createDataFrame([(i, None if i % 2 else float(i % 10)) for i in range(1000)], "id long, x double")
    got = R.impute_draw(df, "x", "id", 2).toPandas()
    assert len(got) == 2000 and set(got.x) == {0.0, 2.0, 4.0, 6.0, 8.0}
    one, two = (got[got["copy"] == k].sort_values("id").x.to_numpy() for k in (1, 2))
    assert (one[::2] == two[::2]).all() and (one[1::2] != two[1::2]).mean() > 0.6
    assert R.impute_draw(df.withColumn("x", F.lit(None).cast("double")), "x", "id").toPandas().x.isna().all()


def test_where_studies_place_a_marker(spark):
    a = spark.createDataFrame([(1, 1, 10, "A"), (2, 2, 20, None), (4, None, None, "T")], "id long, chr int, pos long, allele string")
    b = spark.createDataFrame([(1, 2, 10, "C"), (2, 2, 21, "G"), (3, 3, 30, "G")], "id long, chr int, pos long, allele string")
    c = spark.createDataFrame([(1, 3), (4, 5)], "id long, chr int")
    got = {r.id: tuple(r)[1:] for r in R.meta_origin({"a": a, "b": b, "c": c}).collect()}
    assert got == {1: ("1", 10, "A:C:NA", "C: 1:2:3"), 2: ("2", 20, "NA:G:NA", "P: 20:21"), 3: ("3", 30, "NA:G:NA", None), 4: ("5", None, "T:NA:NA", None)}


def test_running_sums_do_not_depend_on_partitions(spark):
    random = np.random.default_rng(7)
    p = random.uniform(size=400).round(2)
    df = spark.createDataFrame([(k, float(v), int(random.uniform() < v)) for k, v in enumerate(p)], "marker long, p double, y int")
    rows = df.toPandas()
    pos, neg = rows.p[rows.y == 1].to_numpy(), rows.p[rows.y == 0].to_numpy()
    expected = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert R.auc(df, "p", "y").first().auc == pytest.approx(expected, rel=1e-12)
            q = R.q_value(df).toPandas().sort_values(["p", "marker"])
            pi0 = min((p > 0.5).mean() / 0.5, 1)
            raw = pi0 * 400 * np.sort(p) / np.arange(1, 401)
            assert np.allclose(q.q, np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert math.isfinite(expected)


# --- intervals


def test_p_of_intervals_as_a_column(spark):
    """The staged form gives what the whole expression and the normal distribution give, also beside a column of the helper's name."""
    rows = [(1, -0.2, 0.6), (2, 0.1, 0.3), (3, -0.5, 0.5), (4, None, 1.0)]
    df = spark.createDataFrame(rows, "__z long, lo double, up double")
    got = {r["__z"]: r for r in S.with_ci_p(df, "lo", "up").withColumn("whole", F.expr(S.ci_to_p("lo", "up"))).collect()}
    for k, lo, up in rows[:3]:
        z = (lo + up) / 2 / ((up - lo) / (2 * 1.959963984540054))
        assert got[k].p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-8) and got[k].p == pytest.approx(got[k].whole, abs=1e-12)
    assert got[4].p is None and len(got) == 4

"""User functions on markers: by counted rows and by parts against the whole frame; blocks of dosages against a plain matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from genoframe.operators import assoc as T
from genoframe.operators import genotypes as G
from genoframe.operators import udf as D


@pytest.fixture(scope="module")
def frame(spark):
    random = np.random.default_rng(3)
    pdf = pd.DataFrame({"marker": np.repeat([1, 2, 3, 4], 500), "dosage": random.integers(0, 3, 2000).astype(float), "y": random.integers(0, 5, 2000).astype(float)})
    pdf.loc[pdf["marker"] == 3, "dosage"] = 1.0  # no information: left out
    return pdf


@pytest.fixture(scope="module")
def product_sum():
    def total(p):
        return pd.DataFrame({"marker": p["marker"].iloc[:1], "total": [float((p["dosage"] * p["y"] * (p["w"] if "w" in p else 1)).sum())]})

    return total


def test_counted_rows_give_the_whole_result(spark, frame, product_sum):
    df = spark.createDataFrame(frame).repartition(5)
    plain = {r.marker: r.total for r in D.per_marker(df, product_sum, "marker long, total double").collect()}

    def small(p):
        return pd.DataFrame({"marker": p["marker"].iloc[:1], "total": [float(len(p))]})

    counted = {r.marker: r.total for r in D.per_marker(df, product_sum, "marker long, total double", counted="w").collect()}
    sizes = [r.total for r in D.per_marker(df, small, "marker long, total double", counted="w").collect()]
    assert plain == counted and sorted(plain) == [1, 2, 4] and max(sizes) <= 15
    with pytest.raises(ValueError, match="already"):
        D.count_equal(df, "Y")


@pytest.mark.parametrize("rows", [1, 7, 100_000])
def test_parts_are_put_together(spark, frame, product_sum, rows):
    df = spark.createDataFrame(frame).repartition(5)

    def finish(p):
        return p.groupby("marker", as_index=False)["total"].sum()

    got = {r.marker: r.total for r in D.per_marker_pieces(df, product_sum, finish, "marker long, total double", "marker long, total double", rows=rows).collect()}
    assert got == {k: float((p["dosage"] * p["y"]).sum()) for k, p in frame.groupby("marker") if k != 3}


def test_parts_that_fail_or_change_shape(spark, frame, product_sum):
    df = spark.createDataFrame(frame).repartition(3)

    def raising(p):
        if p["marker"].iloc[0] == 2:
            raise KeyError("no")
        return product_sum(p)

    schema = "marker long, total double"
    got = {r.marker: r.total for r in D.per_marker_pieces(df, raising, lambda p: p.groupby("marker", as_index=False)["total"].sum(), schema, schema).collect()}
    assert got[2] is None and got[1] is not None and sorted(got) == [1, 2, 4]
    odd = D.per_marker_pieces(df, product_sum, lambda p: p.rename(columns={"total": "other"}), schema, schema)
    assert odd.count() == 0
    assert D.per_marker_pieces(df.where("false"), product_sum, lambda p: p, schema, schema).count() == 0


def test_likelihood_on_counted_rows(spark, frame):
    """Weighted terms of each combination give the fit of all rows; rows with nulls are no rows."""
    df = spark.createDataFrame(frame).withColumn("y", F.when(F.col("y") > 0, F.col("y"))).repartition(4)

    def loglik(t, rows):
        w = rows["w"].to_numpy(float) if "w" in rows else 1.0
        return float((-0.5 * w * (rows["y"].to_numpy(float) - t[0] - t[1] * rows["dosage"].to_numpy(float)) ** 2).sum())

    args = (["y", "dosage"], loglik, [0.0, 0.0], [0.0], lambda t: np.array([t[0], 0.0]))
    plain = {r.marker: r for r in T.lh_test_lr(df, *args).collect()}
    counted = {r.marker: r for r in T.lh_test_lr(df, *args, counted="w").collect()}
    assert plain.keys() == counted.keys() and len(plain) == 4
    for k, r in plain.items():
        assert counted[k].n == r.n
        for name in ("stat", "t0", "t1") if k != 3 else ("stat",):
            assert counted[k][name] == pytest.approx(r[name], abs=1e-5)


def test_blocks_of_dosages(spark):
    random = np.random.default_rng(5)
    cells = {(i, m): random.dirichlet([1, 1, 1]) for i in range(1, 9) for m in (2, 3, 5, 8, 13, 21, 34) if random.random() < 0.6}
    rows = [(i, m, *map(float, p)) for (i, m), p in cells.items()]
    df = spark.createDataFrame([*rows, rows[0], (1, None, 0.1, 0.2, 0.7), (9, 40, None, None, None)], "iid long, marker long, p_aa double, p_ab double, p_bb double").repartition(4)
    got = {(r.iid, r.block): r.dosages for r in G.genotype_blocks(df, 3).collect()}
    markers, expected = [2, 3, 5, 8, 13, 21, 34, 40], {}
    for (i, m), p in cells.items():
        k = markers.index(m)
        expected.setdefault((i, k // 3), [None] * 3)[k % 3] = p[1] + 2 * p[2]
    assert got.keys() == expected.keys()
    for k, row in expected.items():
        assert [x is None for x in got[k]] == [x is None for x in row]
        assert [x for x in got[k] if x is not None] == pytest.approx([x for x in row if x is not None])
    assert G.genotype_blocks(df.where("false")).count() == 0

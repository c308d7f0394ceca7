"""Cases of the findings of round 4."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from genoframe.operators import assoc as T
from genoframe.operators import joins as J
from genoframe.operators import qc as Q
from genoframe.plans.q_genetics import QUERIES
from genoframe.sources import tables as SC


def test_fits_that_fail_count_individuals(spark):
    """a marker whose calls are all alike has no fit, but all its individuals."""
    calls = spark.createDataFrame([(k, i, i % 2, (i // 2) % 3 if k else 0) for k in range(2) for i in range(60)], "marker long, iid long, cc int, gt int")
    got = {r.marker: r for r in T.logistic_per_marker(calls, "cc", ["gt"]).collect()}
    assert (got[0].n, got[0].stat, got[0]["beta1.gt"]) == (60, None, None) and got[1].n == 60 and got[1].p is not None
    clusters = calls.withColumns({"fid": calls.iid % 5, "y": calls.iid * 1.5})
    assert {r.marker: r.n for r in T.gee(clusters, "y", ["gt"], [], "fid").collect()} == {0: 60, 1: 60}


@pytest.mark.parametrize("listed", [0, 1 << 23])
def test_pairs_of_blocks(spark, monkeypatch, listed):
    """Blocks of few individuals and chunks of few markers, counted by lists of meetings or by matrices; an individual without calls and one whose calls meet none."""
    monkeypatch.setattr(Q, "PEOPLE", 7)
    monkeypatch.setattr(Q, "MARKERS", 5)
    monkeypatch.setattr(Q, "CELLS", 0)
    monkeypatch.setattr(Q, "LISTED", listed)
    random = np.random.default_rng(3)
    calls = {(f"i{i:02}", m): int(random.integers(0, 3)) for i in range(20) for m in range(13) if random.random() < 0.6} | {("j", 99): 1}
    gt = spark.createDataFrame([(*k, v) for k, v in calls.items()] + [("k", 1, None)], "iid string, marker long, gt int")
    ids = sorted({i for i, _ in calls} | {"k"})
    expected = {}
    for a, b in itertools.combinations(ids, 2):
        shared = [2 - abs(g - calls[b, m]) for (i, m), g in calls.items() if i == a and (b, m) in calls]
        expected[a, b] = (*(shared.count(k) for k in range(3)), (shared.count(1) * 0.5 + shared.count(2)) / len(shared) if shared else None)
    got = Q.ibs_pairs(gt)
    assert {(r.id1, r.id2): (r.ibs0, r.ibs1, r.ibs2, r.distance) for r in got.collect()} == expected
    plan = got._jdf.queryExecution().toString()
    # nothing is joined by pair, and no function of higher order walks over an individual's words
    assert "zip_with" not in plan and "Join" not in plan


def test_labels_that_repeat(spark):
    """a pathway with thousands of labels meets its genes once."""
    genes = spark.range(20_000).selectExpr("concat('g', id) as subject", "'in_pathway' as predicate", "concat('w', id % 2) as object")
    labels = spark.range(20_000).selectExpr("concat('w', id % 2)", "'label'", "concat('Brand', id % 2)")
    found = J.pathway_genes(genes.union(labels), "1$")
    assert found.count() == 10_000 and "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    causes = spark.range(10).selectExpr("concat('v', id)", "'causes'", "'d1'").union(spark.range(10).selectExpr("concat('v', id)", "'in_gene'", "'g1'")).union(spark.range(9).selectExpr("'d1'", "'name'", "concat('x', id)"))
    assert [r.gene for r in J.disease_genes(causes.toDF("subject", "predicate", "object"), "x").collect()] == ["g1"]


def test_packed_calls_in_proportion(spark, tmp_path):
    """a marker with calls of 30,000 of 120,000 individuals is packed and read back without a search for each of them; missing calls are left out where asked."""
    calls = spark.range(30_000).selectExpr("0L as marker_no", "id * 4 as person_no", "cast(if(id % 5 = 0, null, id % 3) as int) as gt")
    data = SC.bed_records(calls, 119_998).collect()
    assert len(data) == 1 and len(data[0].data) == 30_000
    path = tmp_path / "x.bed"
    path.write_bytes(b"\x6c\x1b\x01" + bytes(data[0].data))
    people, markers = spark.range(119_998), spark.range(1)
    read = SC.read_bed(spark, str(path), markers, people, called=True)
    assert sorted((r.person_no, r.gt) for r in read.collect()) == sorted((r.person_no, r.gt) for r in calls.where("gt is not null").collect())
    assert SC.read_bed(spark, str(path), markers, people).count() == 119_998
    with pytest.raises(Exception, match="different numbers"):
        SC.bed_records(calls, 100).collect()


def test_score_reads_calls_once(spark):
    """the sum of variances comes with the score, so that the genotypes are made once."""
    plan = QUERIES["t17_imputed_score"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 4


@pytest.mark.parametrize("cells", [0, 1 << 40])
def test_counts_of_two_blocks(monkeypatch, cells):
    """Both ways of counting, in this process, where the settings hold."""
    monkeypatch.setattr(Q, "CELLS", cells)
    random = np.random.default_rng(8)
    blocks = [np.where(random.random((n, 30)) < 0.3, random.integers(0, 3, (n, 30)), -1) for n in (9, 6)]
    packed = []
    for block in blocks:
        marker, at = np.nonzero(block.T >= 0)
        packed.append((at, marker, block[at, marker]))
    total = np.zeros((3, 9, 6), np.int32)
    Q._counts(*packed, total)
    one, two = blocks[0][:, None], blocks[1][None]
    both = (one >= 0) & (two >= 0)
    expected = [(both & (np.abs(one - two) == 2)).sum(2), (both & (one == two)).sum(2), both.sum(2)]
    assert (total == np.array(expected)).all()

"""The vector operators against brute force, SQL and planted cases, and on nulls, odd entries, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from genoframe.llm import metric_trees, queries, sign_hashing, whitening

DATA = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas().sort_values("vec_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def odd(spark):
    """Vectors of 16 entries: nulls, null and non-finite entries, other lengths, zeros, copies, repeated and null ids, and columns with helpers' names."""
    random = np.random.default_rng(5)
    base = random.normal(size=(40, 16)).round(3)
    rows = [(k, base[k].tolist(), k % 3) for k in range(40)]
    rows += [(40, None, 1), (41, [], 1), (42, [None] + [0.5] * 15, 1), (43, [math.nan] + [0.5] * 15, 1), (44, [math.inf] + [0.5] * 15, None), (45, [1.0, 2.0], None), (46, [0.0] * 16, None)]
    rows += [(7, base[7].tolist(), None), (7, base[8].tolist(), None), (None, base[9].tolist(), None), (None, (2 * base[10]).tolist(), 2), (50, (-base[11]).tolist(), 2)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("x")).withColumn("node", F.lit(1)).withColumn("H1", F.lit(2)).withColumn("code", F.lit(3)).withColumn("n", F.lit(4))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 11


def _whitened(x):
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    covariance = np.cov(fit.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    return n, ((n * x - total) ** 2).sum(axis=1), (x - total / n) @ vectors / np.sqrt(values), values / np.trace(covariance)


def test_whitening_against_a_library(spark, table):
    got = whitening.op11(spark, DATA).toPandas().sort_values(["vec_id", "component"])
    x = np.floor(64 * np.stack(table.embedding).astype(float)).astype(np.int64) + 1_000_000
    n, deviation, whitened, explained = _whitened(x)
    assert len(got) == 16 * len(table) and set(got.n) == {n} and set(got.component) == set(range(1, 17))
    assert got.deviation.to_numpy()[::16].tolist() == deviation.tolist()
    assert np.allclose(np.abs(got.whitened.to_numpy().reshape(-1, 16)), np.abs(whitened), atol=1e-9)
    assert np.allclose(got.explained.to_numpy()[:16], explained, rtol=1e-12)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_whitening_identity(spark, table):
    """The whitened distinct vectors have the identity as covariance."""
    got = whitening.op11(spark, DATA).toPandas().sort_values(["vec_id", "component"])
    z = got.whitened.to_numpy().reshape(-1, 16)
    assert np.allclose(np.cov(z.T, bias=True), np.eye(16), atol=1e-10) and np.allclose(z.mean(axis=0), 0, atol=1e-10)


@pytest.mark.parametrize("kind", ["random", "ties", "blocks", "low", "one", "tiny", "zero", "large"])
def test_eigenpairs(kind):
    random = np.random.default_rng(1)
    a = {
        "random": np.cov(random.normal(size=(300, 40)).T), "ties": np.diag([3.0, 3, 3, 1, 1, 0]), "blocks": np.kron(np.eye(4), [[2.0, 1], [1, 2]]), "low": np.outer(range(1, 30), range(1, 30)).astype(float),
        "one": np.array([[2.0]]), "tiny": np.array([[2.0, 1], [1, 2]]) * 1e-200, "zero": np.zeros((3, 3)), "large": np.cov(random.normal(size=(150, 150)).T) * 1e30,
    }[kind]
    values, vectors = whitening.leading(a, 16)
    expected = np.sort(np.linalg.eigvalsh(a))[::-1]
    if kind == "zero":
        assert len(values) == 0
        return
    positive = expected[expected > 1e-11 * expected[0]]
    assert len(values) == min(16, len(positive))
    assert np.allclose(values, expected[: len(values)], rtol=0, atol=1e-14 * len(a) * expected[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * values, rtol=0, atol=1e-13 * len(a) * expected[0])


def test_whitening_sums_are_exact():
    random = np.random.default_rng(3)
    y = random.integers(-1000, 1000, (500, 5))
    y[3] = [1 << 39, -(1 << 40), 5, 6, 7]
    wide = y.astype(object)
    assert (whitening.products(y) == wide.T @ wide).all()
    rest = [1, -2, 3, 0, 4]
    exact = [sum((7 * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y.tolist()]
    assert whitening.deviations(y, 7, rest) == [e if e < 1 << 63 else None for e in exact]
    assert whitening.deviations(np.array([[1 << 31]]), 1, [0]) == [1 << 62]


def test_whitening_odd(odd, nothing, spark):
    out, error = whitening.whiten(odd)
    got = out.toPandas()
    kept = odd.toPandas().iloc[[*range(40), *range(46, 52)]]
    x = np.floor(64 * np.stack(kept.embedding).astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, deviation, whitened, _ = _whitened(x)
    assert len(got) == 16 * len(kept) and set(got.n) == {n} and error < 1e-9
    assert sorted(got[got.component == 1].deviation) == sorted(deviation.tolist())
    assert np.allclose(sorted(np.abs(got[got.component == 2].whitened)), sorted(np.abs(whitened[:, 1])), atol=1e-9)
    assert got[got.vec_id.isna()].shape[0] == 32 and got[got.vec_id == 7].shape[0] == 48
    assert whitening.whiten(nothing)[0].count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA))[0].count() == 0
    flat, error = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0], 0) for k in range(5)], SCHEMA))
    assert flat.count() == 5 and error < 1e-9


# --- 12


def _codes(numbers, entries=16, rounds=6):
    """Codes, errors and codebooks by comparing every part with every entry; ``numbers`` by ascending id."""
    width, codes, error, books = numbers.shape[1], [], 0, []
    for p in range(8):
        part = numbers[:, p * width // 8 : (p + 1) * width // 8]
        book = part[:entries].copy()
        for k in range(rounds + 1):
            away = ((part[:, None] - book[None]) ** 2).sum(axis=2)
            own = away.argmin(axis=1)
            if k < rounds:
                for e in range(len(book)):
                    if (own == e).any():
                        book[e] = part[own == e].sum(axis=0) // (own == e).sum()
        codes.append(own)
        error = error + away.min(axis=1)
        books.append(book)
    return ["".join(f"{c:02x}" for c in row) for row in np.array(codes).T], error.tolist(), books


def _digest(books):
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def test_codes_against_brute_force(spark, table):
    got = metric_trees.op12(spark, DATA).toPandas().sort_values("vec_id")
    codes, error, books = _codes(np.floor(4096 * np.stack(table.embedding).astype(float)).astype(np.int64))
    assert got.code.tolist() == codes and got.error.tolist() == error and set(got.codebooks_sha256) == {_digest(books)}
    by = table.assign(error=error).groupby("label").error.transform("sum")
    assert got.label_error.tolist() == by.tolist()


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "grid", "one"])
def test_trees_own_what_distances_say(kind):
    """Whatever the points, ties and bounds included, trees give the codes and sums of plain comparison."""
    random = np.random.default_rng(8)
    points = {
        "spread": random.integers(-3000, 3000, (3000, 8)), "clusters": (random.integers(-9000, 9000, (20, 1, 8)) + random.integers(-40, 40, (20, 100, 8))).reshape(-1, 8),
        "copies": np.repeat(random.integers(-5, 5, (3, 8)), 700, axis=0), "grid": random.integers(0, 3, (2000, 4)), "one": np.array([[1 << 27, -(1 << 27)]]),
    }[kind]
    distinct, of, counts = np.unique(points, axis=0, return_inverse=True, return_counts=True)
    tree = metric_trees.Tree.from_bytes(metric_trees.build(distinct, counts).to_bytes())
    for entries in (points[:16], random.integers(0, 3, (16, points.shape[1])), np.repeat(points[:1], 5, axis=0)):
        own = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (metric_trees.codes_of(tree, entries)[of.ravel()] == own).all()
        sums = metric_trees.gathered(tree, entries)
        for e in range(len(entries)):
            assert sums[e].tolist() == [(own == e).sum(), *points[own == e].sum(axis=0).tolist()]


def test_balls_are_owned_whole():
    """In clustered data most points are never compared themselves, and every ball holds its points."""
    random = np.random.default_rng(9)
    points = np.unique((random.integers(-9000, 9000, (16, 1, 8)) + random.integers(-40, 40, (16, 200, 8))).reshape(-1, 8), axis=0)
    tree = metric_trees.build(points, np.ones(len(points), np.int64))
    single = sum(len(rows) for _, _, rows in metric_trees.owners(tree, points[::200][:16]) if rows is not None)
    assert single < len(points) / 2
    for b in range(len(tree.begin)):
        own = tree.points[tree.begin[b] : tree.end[b]]
        assert (np.sqrt(((own - tree.centre[b]) ** 2).sum(axis=1)) <= tree.radius[b]).all() and own.sum(axis=0).tolist() == tree.sums[b].tolist()


def test_codes_odd(odd, nothing, spark):
    out, books = metric_trees.compress(odd)
    rows = odd.toPandas()
    kept = rows.iloc[[*range(40), *range(46, 52)]].copy()
    kept["x"] = [np.floor(4096 * np.asarray(e, np.float32).astype(float)).astype(np.int64).tolist() for e in kept.embedding]
    kept = sorted(zip(kept.vec_id.isna(), kept.vec_id.fillna(0), kept.x, strict=True))
    codes, error, expected = _codes(np.array([k[2] for k in kept]))
    assert _digest(books) == _digest(expected)
    got = out.toPandas()
    assert sorted(zip(got.code, got.error, strict=True)) == sorted(zip(codes, error, strict=True))
    assert metric_trees.compress(nothing)[0].count() == 0
    # fewer rows than entries, and a length that 8 doesn't divide
    few, books = metric_trees.compress(spark.createDataFrame([(k, [float(k), 1.0, 2.0], None) for k in range(3)], SCHEMA))
    assert [len(b) for b in books] == [3] * 8 and sorted(few.toPandas().error) == [0, 0, 0]


# --- 13


def _near(ids, vectors):
    """Links and components by comparing all pairs; vectors of None link with nothing."""
    u = [None if v is None else np.asarray(v, float) / np.sqrt((np.asarray(v, float) ** 2).sum()) for v in vectors]
    linked = [[i != j and u[i] is not None and u[j] is not None and float(u[i] @ u[j]) >= 0.9 for j in range(len(u))] for i in range(len(u))]
    root = list(range(len(u)))
    while True:
        new = [min([root[i], *(root[j] for j in range(len(u)) if linked[i][j])]) for i in range(len(u))]
        if new == root:
            break
        root = new
    least = {r: min((ids[i] for i in range(len(u)) if root[i] == r and ids[i] is not None), default=None) for r in set(root)}
    return [(ids[i], sum(linked[i]), least[root[i]], ids[i] == least[root[i]]) for i in range(len(u))]


def _families(count, seed):
    """Vectors with near copies at angles around the limit, and one dense group."""
    random = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        base = random.normal(size=24)
        out += [base + random.normal(size=24) * random.uniform(0.0, 0.45) for _ in range(int(random.integers(1, 6)))]
    dense = random.normal(size=24)
    return np.array(out + [dense + random.normal(size=24) * 0.05 for _ in range(count)])


@pytest.mark.parametrize("bucket", [2048, 16])
def test_near_vectors_against_brute_force(spark, bucket):
    """No link below the limit and at least 99 of 100 at or above it, also where buckets are cut and balls are counted."""
    vectors = _families(90, 4).astype(np.float32)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(vectors)]
    got = sign_hashing.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), bucket=bucket).toPandas().sort_values("vec_id")
    expected = _near(list(range(len(rows))), vectors)
    links = np.array([e[1] for e in expected])
    assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.99 * links.sum() > 5000
    assert (got.component_id.to_numpy() == [e[2] for e in expected]).mean() > 0.98


def test_dense_groups_are_counted_not_compared(spark):
    """In a hot bucket the nodes of a ball are in no pair of blocks with each other."""
    random = np.random.default_rng(6)
    vectors = (np.ones(24) + random.normal(size=(400, 24)) * 0.02).astype(np.float32)
    rows = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(vectors)], SCHEMA)
    got = sign_hashing.near_vectors(rows, bucket=20).toPandas()
    assert set(got.n_links) == {399} and set(got.component_id) == {0} and got.kept.sum() == 1
    codes = sign_hashing.sign_codes(sign_hashing.units(_arrow(vectors), 24), 4, 3)
    placed = spark.createDataFrame([(k, 1, v.tolist(), c.tolist(), 5 if k < 390 else None) for k, (v, c) in enumerate(zip(vectors, codes, strict=True))], "node long, weight long, embedding array<float>, codes array<long>, ball long")
    placed = placed.select("*", F.posexplode("codes").alias("turn", "code"))
    blocked = sign_hashing._blocked(placed, 20)
    assert blocked.groupBy("turn", "code", "lo", "hi").count().agg(F.max("count")).first()[0] <= 80
    # 10 nodes outside of the ball: members of the ball meet those only
    assert blocked.count() <= 3 * (390 * 2 + 10 * 60)


def _arrow(x):
    import pyarrow as pa

    return pa.array(x.tolist(), pa.list_(pa.float32()))


def test_tables_for_the_miss_rate():
    for nodes in (0, 1, 5000, 10**6, 10**9):
        planes, tables = sign_hashing.tables_for(nodes)
        same = (1 - math.acos(0.9) / math.pi) ** planes
        assert (1 - same) ** tables <= sign_hashing.MISS and nodes / 2**planes <= sign_hashing.BUCKET


def test_near_vectors_odd(odd, nothing):
    got = sign_hashing.near_vectors(odd).collect()
    rows = odd.toPandas()
    ids = [None if np.isnan(i) else int(i) for i in rows.vec_id]
    usable = [e is not None and len(e) == 16 and all(c is not None and math.isfinite(c) for c in e) and any(e) for e in rows.embedding]
    expected = _near(ids, [np.asarray(e, np.float32) if u else None for e, u in zip(rows.embedding, usable, strict=True)])
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, expected))
    assert sign_hashing.near_vectors(nothing).count() == 0


def test_near_vectors_of_extreme_size(spark):
    rows = [(1, [3e38, 3e38, 0.0]), (2, [1e-44, 1e-44, 0.0]), (3, [1.0, 1.0, 0.0]), (4, [-1.0, -1.0, 0.0])]
    got = sign_hashing.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas().set_index("vec_id")
    assert got.n_links.to_dict() == {1: 2, 2: 2, 3: 2, 4: 0} and got.component_id.to_dict() == {1: 1, 2: 1, 3: 1, 4: 4}


@pytest.mark.parametrize("name", ["op12_metric_tree_codes", "op13_sign_hash_duplicates"])
def test_vector_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{DATA}/embeddings.parquet'")
    expected = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    got = queries.queries()[name](spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall())

"""Operator 13: near-duplicate vectors by random-hyperplane sign hashing, exact cosines and connected components.

1. Equal vectors are one node with a count (by a 128-bit digest).
2. In each of several tables a node's bucket is the signs of its products with random hyperplanes. There are so many planes that a bucket holds about
   ``BUCKET`` nodes, and so many tables that two vectors at a cosine of just 0.9 share no bucket with a chance of ``MISS`` at most (nearer ones: far less).
3. Within a bucket all pairs are compared by their cosine in double precision. A pair that already met in an earlier table is left to that one, so that counts add up
   without any list of pairs: a bucket gives one row for each node, with its number of links and the root of its links in that bucket.
4. A bucket over ``2 * BUCKET`` nodes is cut into blocks, and pairs of blocks are compared in tasks of their own. So that a dense group doesn't cost its square, such buckets
   name leaders; nodes within half of the link angle of a leader form a ball, and by the triangle inequality any two
   of a ball are linked. Pairs of one ball are counted, not compared, and large balls are blocks of their own.
5. Links give connected components (large and small stars); the smallest id names each.

No partner and no bucket is capped. Links below 0.9 are never made; the share of pairs found follows from ``MISS`` whatever the data are.

Defined results: vectors that are null, empty, zero or hold null or non-finite entries, or have another number of entries than most vectors have, link with
nothing and form a component of their own. Rows that repeat an id are rows of their own; null ids never name a component unless there is no other, and then ``kept`` is true. An empty table
gives an empty result. Only the columns vec_id and embedding are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoframe.llm.common import settle
from genoframe.llm.jaccard_join import components
from genoframe.llm.vectors import matrix, sound, usual_length

COSINE = 0.9
MISS = 0.003
BUCKET = 2048
LEAST_PLANES = 4
SEED = 13
#: Nodes of a task that computes codes or components.
TASK_NODES = 200_000
#: Rows of a block that are compared at a time.
TILE = 512


def tables_for(nodes: int, bucket: int = BUCKET, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Planes and tables: planes so that buckets hold about ``bucket`` nodes, tables so that a pair at ``cosine`` is missed with a chance of ``miss``."""
    planes = max(LEAST_PLANES, math.ceil(math.log2(max(nodes, 1) / bucket)))
    same = (1 - math.acos(cosine) / math.pi) ** planes
    return planes, math.ceil(math.log(miss) / math.log1p(-same))


def units(column: pa.Array, width: int) -> np.ndarray:
    """Rows of unit length, in double precision (scaled first, so that squares neither overflow nor vanish)."""
    x = matrix(column, width).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sign_codes(u: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """For each row and table the signs of the products with the table's planes, as a number."""
    normals = np.random.default_rng(SEED).standard_normal((tables * planes, u.shape[1]))
    signs = (u @ normals.T >= 0).reshape(len(u), tables, planes)
    return signs @ (1 << np.arange(planes, dtype=np.int64))


def _nodes(rows: DataFrame, width: int, planes: int, tables: int) -> DataFrame:
    """node, weight, id (the smallest), the digest, embedding and codes of each distinct vector, written."""

    def run(batches):
        for batch in batches:
            codes = sign_codes(units(batch.column("embedding"), width), planes, tables)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, tables), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=[*batch.schema.names, "codes"])

    kind = rows.schema["embedding"].dataType.simpleString()
    one = rows.groupBy("h1", "h2").agg(F.count("*").alias("weight"), F.min("vec_id").alias("id"), F.first("embedding").alias("embedding"))
    named = one.withColumn("node", F.monotonically_increasing_id())
    return settle(named.mapInArrow(run, f"h1 long, h2 long, weight long, id long, embedding {kind}, node long, codes array<long>"), "hash-nodes")


def _balls(placed: DataFrame, nodes: DataFrame, width: int, bucket: int, cosine: float) -> DataFrame:
    """(node, ball) of the nodes of large balls; each hot bucket names its node of smallest hash as a leader, and a node takes the leader of smallest hash among those near enough."""
    half = math.cos(math.acos(cosine) / 2) + 1e-9

    def near(batches):
        for batch in batches:
            if batch.num_rows:
                close = (units(batch.column("embedding"), width) * units(batch.column("leading"), width)).sum(axis=1) >= half
                yield batch.select(["node", "rank", "leader"]).filter(pa.array(close))

    rank = F.xxhash64("node").alias("rank")
    hot = placed.groupBy("turn", "code").agg(F.count("*").alias("size"), F.min(F.struct(rank, "node")).alias("first")).where(F.col("size") > 2 * bucket)
    leaders = hot.select("turn", "code", F.col("first.rank").alias("rank"), F.col("first.node").alias("leader"))
    leaders = leaders.join(nodes.select(F.col("node").alias("leader"), F.col("embedding").alias("leading")), "leader")
    met = placed.join(leaders, ["turn", "code"]).select("node", "rank", "leader", "embedding", "leading")
    chosen = met.mapInArrow(near, "node long, rank long, leader long").groupBy("node").agg(F.min(F.struct("rank", "leader")).alias("first")).select("node", F.col("first.leader").alias("ball"))
    chosen = settle(chosen, "hash-chosen")
    large = chosen.groupBy("ball").agg(F.count("*").alias("k")).where(F.col("k") >= bucket).select("ball")
    return settle(chosen.join(large, "ball").select("node", "ball"), "hash-balls")


def _blocked(placed: DataFrame, bucket: int) -> DataFrame:
    """Each row once for each pair of blocks (lo, hi) that it is compared in, with its own block; rows of a ball are not compared with each other."""
    sizes = placed.groupBy("turn", "code", "ball").agg(F.ceil(F.count("*") / F.lit(bucket)).alias("blocks"), F.count("*").alias("size"))
    whole = Window.partitionBy("turn", "code")
    before = whole.orderBy(F.asc_nulls_first("ball")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("offset", F.coalesce(F.sum("blocks").over(before), F.lit(0))).withColumn("all", F.sum("blocks").over(whole)).withColumn("total", F.sum("size").over(whole))
    # other buckets are one block, and pairs of one ball are passed over as they are compared
    hot = sizes.where(F.col("total") > 2 * bucket).select(F.col("turn").alias("t"), F.col("code").alias("c"), F.col("ball").alias("b"), "blocks", "offset", "all")
    # written first: it is small where few buckets are hot, and then no row of the others has to move for it
    hot = settle(hot, "hash-hot")
    cut = placed.join(hot, (F.col("turn") == F.col("t")) & (F.col("code") == F.col("c")) & F.col("ball").eqNullSafe(F.col("b")), "left")
    cut = cut.withColumn("own", F.expr("coalesce(offset + pmod(xxhash64(node, 7), blocks), 0)"))
    others = F.expr("case when all is null then array(0L) else filter(sequence(0L, all - 1), v -> ball is null or v < offset or v >= offset + blocks) end")
    paired = cut.withColumn("other", F.explode(others))
    return paired.select("turn", "code", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "weight", "ball", "embedding", "codes")


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row that it is connected with."""
    root = np.full(len(linked), -1)
    for k in range(len(linked)):
        if root[k] < 0:
            root[k], front = k, np.array([k])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
                root[front] = k
    return root


def compared(rows: pa.Table, width: int, cosine: float) -> pa.Table:
    """node, links (with the counts of partners) and root of the nodes of one pair of blocks that have a link there."""
    rows = rows.combine_chunks()
    turn, lo, hi = (rows.column(c)[0].as_py() for c in ("turn", "lo", "hi"))
    node, weight, own = (rows.column(c).to_numpy() for c in ("node", "weight", "own"))
    ball = rows.column("ball").fill_null(-1).to_numpy()
    u, codes = units(rows.column("embedding"), width), matrix(rows.column("codes"), rows.schema.field("codes").type and len(rows.column("codes")[0]))
    linked = np.zeros((len(node),) * 2, bool)
    for a in range(0, len(node), TILE):
        some = slice(a, a + TILE)
        found = u[some] @ u.T >= cosine
        found &= (ball[some, None] < 0) | (ball[some, None] != ball[None])
        if lo != hi:
            found &= own[some, None] != own[None]
        for t in range(turn):
            found &= codes[some, None, t] != codes[None, :, t]
        linked[some] = found
    np.fill_diagonal(linked, False)
    linked |= linked.T  # products may round differently in the two halves
    with_links = np.flatnonzero(linked.any(axis=0))
    linked = linked[np.ix_(with_links, with_links)]
    node, weight = node[with_links], weight[with_links]
    return pa.table({"node": node, "links": (linked * weight[None]).sum(axis=1).astype(np.int64), "root": node[_roots(linked)]})


def near_vectors(rows: DataFrame, cosine: float = COSINE, bucket: int = BUCKET, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``rows`` (vec_id, embedding)."""
    usable = f"{sound(float('inf'))} and exists(embedding, c -> c <> 0)"
    named = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"case when {usable} then embedding end").alias("embedding"))
    width = usual_length(named.where("embedding is not null"))
    named = named.withColumn("embedding", F.when(F.size("embedding") == width, F.col("embedding")))
    named = named.withColumn("h1", F.when(F.col("embedding").isNotNull(), F.xxhash64(F.lit(1), "embedding"))).withColumn("h2", F.when(F.col("embedding").isNotNull(), F.xxhash64(F.lit(2), "embedding")))
    vectors = named.where("embedding is not null")
    count = vectors.agg(F.approx_count_distinct("h1")).first()[0]
    planes, tables = tables_for(count, bucket, cosine, miss)
    nodes = _nodes(vectors, width, planes, tables)
    tasks = max(8, -(-count // TASK_NODES))
    placed = nodes.select("node", "weight", "embedding", "codes", F.posexplode("codes").alias("turn", "code"))
    balls = _balls(placed, nodes, width, bucket, cosine)
    # the ball is joined to nodes, of which there is one row, before tables multiply them
    placed = nodes.join(balls, "node", "left").select("node", "weight", "ball", "embedding", "codes", F.posexplode("codes").alias("turn", "code"))
    groups = _blocked(placed, bucket).groupBy("turn", "code", "lo", "hi")
    found = settle(groups.applyInArrow(lambda table: compared(table, width, cosine), "node long, links long, root long"), "hash-links")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(balls.select(F.col("node").alias("a"), F.col("ball").alias("b")))
    roots = components(edges.where("a <> b"), tasks)
    # links: compared ones, those of the ball, and copies
    inside = balls.join(nodes.select("node", "weight"), "node")
    totals = inside.join(inside.groupBy("ball").agg(F.sum("weight").alias("total")), "ball").select("node", (F.col("total") - F.col("weight")).alias("links"))
    links = found.select("node", "links").unionByName(totals).groupBy("node").agg(F.sum("links").alias("links"))
    told = nodes.select("node", "weight", "id", "h1", "h2").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    told = told.join(told.groupBy("root").agg(F.min("id").alias("component")), "root")
    told = told.select("h1", "h2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component")
    out = named.select("vec_id", "h1", "h2").join(told, ["h1", "h2"], "left")
    name = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), name.alias("component_id"), F.col("vec_id").eqNullSafe(name).alias("kept"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

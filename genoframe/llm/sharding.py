"""Operator 2: shards by a k-d tree over document metadata, split at weighted medians.

The tree splits a node in its widest dimension (the spread of the node's values over the spread of all values) at
the weighted median, level by level: as often as a number of shards asks for, or each leaf by itself until it holds the target bytes.
Values are whole numbers (ids by their place between the least and the greatest one); each is followed by 31 bits of a hash of the row, so that a value which very many rows share (a hot source, a
group of copies) is cut within. The medians of all nodes are found at once by narrowing: the weights of ``BINS`` equal intervals of each node
are summed, the interval that holds the median is cut again, until it is one value wide. Nodes, intervals and cuts are tables that rows are joined with;
nothing that grows with the number of leaves comes to the driver.

Defined results: a null text has size 1; null dimensions count as -1; equal rows with an equal id
can't be told apart and stay together, also in a leaf over the target; an empty table gives an empty result; slots count from 0 in each shard, in an order
that a hash of the id gives. ``law`` is ``bytes``: shard sizes are near equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoframe.llm.common import release, settle

BINS = 4096
HASH_BITS = 31
VALUE_BITS = 31
#: Rows of one slot bucket, about.
SLOT_ROWS = 20_000


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the dimensions d0.. as whole numbers below 2**62."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    low = F.lit((1 << VALUE_BITS) - 2)
    ends = docs.agg(F.min(F.col("doc_id").cast("double")).alias("a"), F.max(F.col("doc_id").cast("double")).alias("b")).first()
    first, width = ends["a"] or 0.0, max((ends["b"] or 0.0) - (ends["a"] or 0.0), 1.0)
    # ids close together keep their distances, others are scaled to the bits there are
    scale = min(1.0, ((1 << VALUE_BITS) - 3) / width)
    spread = F.xxhash64(F.lit("spread"), F.col("doc_id"), F.col("text")).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    named = lambda c: F.when(F.col(c).isNull(), F.lit(-1)).otherwise(F.crc32(F.col(c).cast("string").cast("binary")).cast("long") % (1 << 20))
    values = [
        F.coalesce(F.least(F.floor((F.col("doc_id").cast("double") - F.lit(first)) * F.lit(scale)).cast("long"), low), F.lit(-1)),
        F.least((F.log2(size) * (1 << 20)).cast("long"), low),
        named("lang"),
        named("source"),
    ]
    dims = [(F.greatest(v.cast("long"), F.lit(-1)) + 1) * (1 << HASH_BITS) + spread for v in values]
    return docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *(d.alias(f"d{k}") for k, d in enumerate(dims)))


def _plan(rows: DataFrame, dims: list[str], spread: dict, target_bytes: int | None) -> DataFrame:
    """(node, dim, lo, hi, half): the nodes that are split, each in its widest dimension, with the range of values there and half of its bytes."""
    stats = rows.groupBy("node").agg(F.sum("size").alias("s"), *(F.min(d).alias(f"{d}_lo") for d in dims), *(F.max(d).alias(f"{d}_hi") for d in dims))
    wide = [(F.col(f"{d}_hi") - F.col(f"{d}_lo")) / F.lit(float(max(1, spread[f"{d}_hi"] - spread[f"{d}_lo"]))) for d in dims]
    best = F.greatest(*(F.struct(w.alias("w"), F.lit(-k).alias("k"), F.col(f"{d}_lo").alias("lo"), F.col(f"{d}_hi").alias("hi")) for k, (w, d) in enumerate(zip(wide, dims, strict=True))))
    split = stats.withColumn("best", best)
    if target_bytes is not None:
        split = split.where((F.col("s") > target_bytes) & (F.col("best.hi") > F.col("best.lo")))
    return split.select("node", (-F.col("best.k")).alias("dim"), F.col("best.lo").alias("lo"), F.col("best.hi").alias("hi"), (F.col("s") / 2).alias("half"))


def _median_cuts(values: DataFrame, plan: DataFrame) -> DataFrame:
    """(node, cut): for each node of the plan the value up to which half of its weight lies, from the rows' values (node, size, v)."""
    state, done = plan.select("node", "lo", "hi", "half", F.lit(0).cast("long").alias("below")), None
    while True:
        stepped = state.withColumn("width", F.greatest(F.lit(1).cast("long"), F.ceil((F.col("hi") - F.col("lo") + 1) / BINS).cast("long")))
        inside = values.join(stepped, "node").where("v >= lo and v <= hi")
        sums = inside.groupBy("node", F.expr("(v - lo) div width").alias("bin")).agg(F.sum("size").alias("s"))
        order = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        reached = sums.withColumn("before", F.coalesce(F.sum("s").over(order), F.lit(0))).join(stepped, "node")
        # the first interval with which half is reached, or the last one
        enough = F.col("below") + F.col("before") + F.col("s") >= F.col("half")
        pick = reached.groupBy("node").agg(F.coalesce(F.min(F.when(enough, F.struct("bin", "before", "s"))), F.max(F.struct("bin", "before", "s"))).alias("p"))
        found = settle(pick.select("node", "p.*").join(stepped, "node").withColumn("below", F.col("below") + F.col("before")).withColumn("lo", F.col("lo") + F.col("bin") * F.col("width")), "shard-medians")
        # the cut goes before or after this value, whichever is nearer to half
        after = F.col("below") + F.col("s") - F.col("half") <= F.col("half") - F.col("below")
        cut = found.where("width = 1").select("node", F.when(after, F.col("lo")).otherwise(F.col("lo") - 1).alias("cut"))
        done = cut if done is None else done.unionByName(cut)
        state = found.where("width > 1").select("node", "lo", F.least(F.col("hi"), F.col("lo") + F.col("width") - 1).alias("hi"), "half", "below")
        if state.isEmpty():
            return done


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for each row; give a power-of-two number of shards, or the bytes that leaves shall not pass. Shards are numbered from 0 in the order of the tree's leaves."""
    if (shards is None) == (target_bytes is None) or (shards is not None and (shards < 1 or shards & (shards - 1))):
        raise ValueError("give either a number of shards that is a power of two, or the target bytes")
    rows = settle(metadata(docs), "shard-metadata")
    dims = [c for c in rows.columns if c.startswith("d") and c[1:].isdigit()]
    spread = rows.agg(F.count("*").alias("n"), *(F.min(d).alias(f"{d}_lo") for d in dims), *(F.max(d).alias(f"{d}_hi") for d in dims)).first().asDict()
    at, level, older = rows.withColumn("node", F.lit(1).cast("long")), 0, rows
    while spread["n"] and (shards is None or 1 << level < shards):
        plan = settle(_plan(at, dims, spread, target_bytes), "shard-plan")
        if plan.isEmpty():
            break
        value = F.element_at(F.array(*dims), F.col("dim") + 1)
        values = settle(at.join(plan.select("node", "dim"), "node").select("node", "size", value.alias("v")), "shard-values")
        cuts = settle(plan.select("node", "dim").join(_median_cuts(values, plan), "node"), "shard-cuts")
        # nodes without a cut are leaves and stay
        side = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + (value > F.col("cut")).cast("long"))
        at = settle(at.join(cuts, "node", "left").withColumn("node", side).select(*rows.columns, "node"), "shard-level")
        release(older, values)
        older, level = at, level + 1
    # a leaf's path from the root, as text, orders it (one row a leaf)
    leaves = at.select("node").distinct().withColumn("shard", F.row_number().over(Window.orderBy(F.bin("node").substr(F.lit(2), F.lit(64)), "node")) - 1)
    return slotted(at.join(settle(leaves, "shard-leaves"), "node").select("doc_id", "size", "text_crc32", "shard"), spread["n"])


def slotted(placed: DataFrame, count: int) -> DataFrame:
    """Gapless slots in each shard, without sorting a shard in one task: rows go to hash buckets, buckets get offsets."""
    buckets = max(1, -(-count // SLOT_ROWS)) * 8
    keyed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("shard", "bucket").agg(F.count("*").alias("k"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    ranked = keyed.withColumn("place", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    out = kd_shards(docs, shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))

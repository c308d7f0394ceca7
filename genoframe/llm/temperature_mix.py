"""Operator 9: temperature mixing of sources, realised as budgeted block permutations.

Every source has a share of all tokens. Raised to an exponent and normalised, the shares become weights; exponent 1 keeps the shares, 0 makes
sources equal. The exponent is bisected: the largest one whose weights reach the target entropy (a part of the highest possible one), or the
smallest that keeps every source within ``most_repeats`` passes over its documents, whichever is larger. Each step weighs a grid of exponents in one
aggregation over the table of sources, so that sources never come to the driver.

The budget is the fewest tokens at which no document is left out (``budget=None``), or given. Source s owes ``weight * budget`` tokens. It pays them
in blocks: block b is a permutation of its documents, by a hash of (b, document); whole blocks first, then the begin of the next permutation
up to the first document that would pass the amount. The begin is found from sums of hash buckets, and only in the one
bucket where it ends are documents put in order.

Defined results: the tokens of a text are its words (at least 1 a document, null texts too); a null source is a source of its own; equal ids and repeated
rows are documents of their own (rows that are equal in id and text stand or fall together in the last block); an empty table gives an empty result;
with one source its weight is 1. Documents that are equal in id and text are next to each other in a block. Columns of the input are kept; those that are added must not clash, else an error names them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoframe.llm.common import free_names, settle

#: Part of the entropy of equal weights that the mix shall reach, and passes over a source at most.
TARGET, MOST_REPEATS = 0.97, 4.0
GRID, ROUNDS = 32, 4
#: Documents of a bucket, about.
BUCKET_DOCS = 2_000


def _tokens(text: str):
    return F.greatest(F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(r"\S++")), F.lit(1)).cast("long")


def weights(sources: DataFrame, target: float = TARGET, most_repeats: float = MOST_REPEATS, budget: float | None = None) -> DataFrame:
    """``sources`` (source, tokens, ...) with share, weight and owed (tokens)."""
    head = sources.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("top"), F.count("*").alias("n")).first()
    if not head["n"]:
        return sources.withColumns({c: F.lit(0.0) for c in ("share", "weight", "owed")})
    shared = sources.withColumn("share", F.col("tokens") / F.lit(float(head["all"])))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        # entropy = ln Z - a * sum(share^a * ln share) / Z; passes of a source = weight * budget / tokens
        parts = []
        for k, a in enumerate(grid):
            power = F.pow("share", F.lit(a))
            parts += [F.sum(power).alias(f"z{k}"), F.sum(power * F.log("share")).alias(f"l{k}"), F.min(F.pow("share", F.lit(a - 1))).alias(f"f{k}"), F.max(F.pow("share", F.lit(a - 1))).alias(f"g{k}")]
        row = shared.agg(*parts).first()
        def entropy(k: int) -> float:
            return math.log(row[f"z{k}"]) - grid[k] * row[f"l{k}"] / row[f"z{k}"]

        def passes(k: int) -> float:
            whole = row[f"g{k}"] / row[f"f{k}"]  # at the budget where the rarest pass is 1
            return whole if budget is None else row[f"g{k}"] / row[f"z{k}"] * budget / head["all"]

        wanted = target * math.log(head["n"]) - 1e-12
        # both conditions: entropy falls and passes fall as the exponent grows
        enough = [k for k in range(GRID + 1) if entropy(k) >= wanted]
        few = [k for k in range(GRID + 1) if passes(k) <= most_repeats + 1e-12]
        top = max(enough, default=0)
        least = min(few, default=GRID)
        at = max(top, least)
        low, high = (grid[at], grid[min(at + 1, GRID)]) if at == top else (grid[max(at - 1, 0)], grid[at])
    exponent = low if at == top else high
    raised = shared.withColumn("weight", F.pow("share", F.lit(exponent)))
    sums = raised.agg(F.sum("weight").alias("z"), F.max(F.col("tokens") / F.col("weight")).alias("whole")).first()
    amount = float(budget) if budget is not None else sums["whole"] * sums["z"]
    return raised.withColumn("weight", F.col("weight") / F.lit(sums["z"])).withColumn("owed", F.col("weight") * F.lit(amount))


def _taken(of) -> Column:
    """Passes that take a document, from its key and the plan of its source: all whole blocks, and the last one if it comes before the end of that in the block's order."""
    turn = F.xxhash64(of("full"), of("key"))
    bucket = _bucket(turn, of("buckets"))
    ended = F.when(of("bucket").isNull(), of("rest") > 0.5).otherwise((bucket < of("bucket")) | ((bucket == of("bucket")) & (turn <= of("last_turn"))))
    return of("full") + F.coalesce(ended, F.lit(False)).cast("int")


def _bucket(turn: Column, buckets: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(turn, 20), buckets)


def _offsets(slim: DataFrame, ends: DataFrame) -> DataFrame:
    """(source, block, bucket, offset): the places of a block that the buckets before take; null sources as ``_named`` has them."""
    met = slim.join(ends.withColumnRenamed("s", "ps"), F.col("s").eqNullSafe(F.col("ps")))
    rows = met.withColumn("taken", _taken(F.col)).where("taken > 0").select(_named(F.col("s")).alias("source"), "key", "buckets", F.explode(F.sequence(F.lit(0), F.col("taken") - 1)).alias("block"))
    sizes = rows.groupBy("source", "block", _bucket(F.xxhash64("block", "key"), F.col("buckets")).alias("bucket")).agg(F.count("*").alias("k"))
    before = Window.partitionBy("source", "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for some 2,000 documents
    return settle(sizes.select("source", "block", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset")), "mix-offsets")


def _named(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", target: float = TARGET, most_repeats: float = MOST_REPEATS, budget: float | None = None, place: bool = False) -> DataFrame:
    """``docs`` once for each pass that takes the document, with mix_tokens, mix_weight and mix_block (0, 1, ...); with ``place`` also mix_place, the document's place (0, 1, ..., without gaps) in its source's permutation of that block."""
    clash = {"mix_tokens", "mix_weight", "mix_block", "mix_place"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns there already: {sorted(clash)}")
    own = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(*(F.col(f"`{c}`") for c in ("doc_id", text)))
    narrow = docs.select(F.col(f"`{source}`").cast("string").alias("s"), key.alias("key"), _tokens(text).alias("tokens"))
    # what the plan needs of the documents, without their texts
    slim = settle(narrow, "mix-documents")
    per_source = slim.groupBy("s").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    plan = weights(settle(per_source, "mix-sources"), target, most_repeats, budget)
    # rounding must not cost a document where a source owes whole passes
    plan = plan.withColumn("full", F.floor(F.col("owed") / F.col("tokens") + 1e-9).cast("int")).withColumn("rest", F.greatest(F.col("owed") - F.col("full") * F.col("tokens"), F.lit(0.0)))
    plan = plan.withColumn("buckets", F.ceil(F.col("docs") / BUCKET_DOCS).cast("long"))
    plan = settle(plan.select("s", "weight", "full", "rest", "buckets"), "mix-plan")
    dealt = slim.join(plan.withColumnRenamed("s", "ps"), F.col("s").eqNullSafe(F.col("ps"))).drop("ps")
    turn = F.xxhash64(F.col("full"), F.col("key"))
    dealt = dealt.select("s", "key", "tokens", "rest", turn.alias("turn"), _bucket(turn, F.col("buckets")).alias("bucket"))
    sums = dealt.groupBy("s", "bucket").agg(F.sum("tokens").alias("in_bucket"), F.first("rest").alias("rest"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0))).where("before < rest and before + in_bucket > rest").select("s", "bucket", "before")
    edge = settle(edge, "mix-edge")
    # the documents of the one bucket per source in which the last block ends
    inside = dealt.join(edge.select(F.col("s").alias("es"), F.col("bucket").alias("eb"), "before"), F.col("s").eqNullSafe(F.col("es")) & (F.col("bucket") == F.col("eb")))
    ordered = Window.partitionBy("s").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(ordered)).where("upto <= rest").groupBy("s").agg(F.max("turn").alias("last_turn"))
    ends = plan.join(edge.select(F.col("s").alias("es"), "bucket"), F.col("s").eqNullSafe(F.col("es")), "left").drop("es").join(last.withColumnRenamed("s", "ls"), F.col("s").eqNullSafe(F.col("ls")), "left").drop("ls")
    ends = settle(ends, "mix-ends")
    # one pass over the documents: the plan of a source is one small row
    names = dict(zip(("key", "source", "taken", *ends.columns), free_names(docs, "__key", "__source", "__taken", *(f"__{c}" for c in ends.columns)), strict=True))
    of = lambda c: F.col(names[c])
    renamed = ends.select(*(F.col(c).alias(names[c]) for c in ends.columns))
    spread = docs.withColumns({"mix_tokens": _tokens(text), names["key"]: key, names["source"]: F.col(f"`{source}`").cast("string")})
    joined = spread.join(renamed, of("source").eqNullSafe(of("s")))
    rows = joined.withColumn(names["taken"], _taken(of)).where(of("taken") > 0)
    block = F.explode(F.sequence(F.lit(0), of("taken") - 1)).alias("mix_block")
    weight = of("weight").alias("mix_weight")
    if not place:
        return rows.select(*own, "mix_tokens", weight, block)
    # a place is the number of documents in earlier buckets of the block, and of earlier ones in its own
    offsets = _offsets(slim, ends).select(*(F.col(c).alias(names[n]) for c, n in (("source", "source"), ("block", "full"), ("bucket", "bucket"), ("offset", "rest"))))
    rows = rows.select(*own, "mix_tokens", weight, block, of("key"), of("buckets"), _named(of("source")).alias(names["source"]))
    rows = rows.withColumn(names["last_turn"], F.xxhash64("mix_block", of("key"))).withColumn(names["bucket"], _bucket(of("last_turn"), of("buckets"))).withColumn(names["full"], F.col("mix_block"))
    order = Window.partitionBy(names["source"], names["full"], names["bucket"]).orderBy(names["last_turn"])
    ranked = rows.withColumn("mix_place", F.row_number().over(order) - 1)
    return ranked.join(offsets, [names["source"], names["full"], names["bucket"]]).select(*own, "mix_tokens", "mix_weight", "mix_block", (of("rest") + F.col("mix_place")).alias("mix_place"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = mixed(docs, place=True)
    return out.select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.round("mix_weight", 9).alias("weight"), F.col("mix_block").alias("block"), F.col("mix_place").alias("place"))

"""Set operations (U) and exclusion sets."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CATEGORIES = {"baseline": ("missing", "sex"), "marginal": ("missing", "sex", "inbreeding", "maf", "hwe"), "pruned": ("pruned",), "external": ("external",)}


def union_sets(*frames: DataFrame) -> DataFrame:
    """U1"""
    return functools.reduce(DataFrame.unionByName, frames).distinct()


def union_ordered(frames: list[DataFrame], key: str, line: str) -> DataFrame:
    """U1 with the place of first appearance (set number, line)."""
    tagged = [f.select(key, F.lit(k).alias("set"), F.col(line).alias("at")) for k, f in enumerate(frames)]
    return functools.reduce(DataFrame.unionByName, tagged).groupBy(key).agg(F.min(F.struct("set", "at")).alias("first")).select(key, "first.set", "first.at")


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """U2"""
    return a.intersect(b)


def minus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` without those of ``b``; repeated rows stay repeated."""
    return a.join(b.select(key).distinct(), key, "left_anti")


def compare_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: sizes of both differences, and whether the sets are identical."""
    both = a.distinct().withColumn("__a", F.lit(1)).join(b.distinct().withColumn("__b", F.lit(1)), a.columns, "full")
    return both.agg(F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b")).withColumn("identical", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def df_diff(d1: DataFrame, d2: DataFrame) -> DataFrame:
    """U5"""
    return d1.subtract(d2)


def change_set(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """State (new, deleted, updated) of each id from ``a`` to ``b``."""
    values = [c for c in a.columns if c != key]
    text = lambda: F.struct(*values)
    j = a.select(key, text().alias("va"), F.lit(1).alias("ina")).join(b.select(key, text().alias("vb"), F.lit(1).alias("inb")), key, "full")
    state = F.when(F.col("ina").isNull(), "new").when(F.col("inb").isNull(), "deleted").when(~F.col("va").eqNullSafe(F.col("vb")), "updated")
    return j.select(key, state.alias("state"), "vb").where("state is not null")


def apply_changes(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """U7"""
    kept = df.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.where("state <> 'deleted'").select(key, "vb.*"))


def sync_sets(leaf: DataFrame, reference: DataFrame, key: str, ts: str) -> DataFrame:
    """U8: new or deleted on the leaf, or newer on one side."""
    j = leaf.select(key, F.col(ts).alias("tl"), F.lit(1).alias("l")).join(reference.select(key, F.col(ts).alias("tr"), F.lit(1).alias("r")), key, "full")
    state = F.when(F.col("r").isNull(), "new").when(F.col("l").isNull(), "deleted").when(F.col("tl") > F.col("tr"), "newer_leaf").when(F.col("tl") < F.col("tr"), "newer_reference").otherwise("same")
    return j.select(key, state.alias("state"))


def exclusions(excl: DataFrame, kind: str, category: str) -> DataFrame:
    """Distinct ids of a kind whose reason is in the category (``all``: any)."""
    rows = excl.where(F.col("kind") == kind)
    return (rows if category == "all" else rows.where(F.col("reason").isin(*CATEGORIES[category]))).select("id").distinct()


def exclusion_summary(excl: DataFrame, order: list[str], n: int) -> DataFrame:
    """Per reason the excluded number, its percentage, and the number of the union so far."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("reason"))
    ids = excl.select("reason", "id").distinct().withColumn("place", place).where("place > 0")
    per = ids.groupBy("reason", "place").agg(F.count("*").alias("ne"))
    fresh = ids.groupBy("id").agg(F.min("place").alias("place")).groupBy("place").agg(F.count("*").alias("fresh"))
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)  # one row per reason
    joined = per.join(fresh, "place", "left").withColumn("cumulative", F.sum(F.coalesce("fresh", F.lit(0))).over(upto))
    return joined.select("reason", "ne", (100.0 * F.col("ne") / n).alias("percent"), "cumulative")


def external_exclusions(flagged: DataFrame, listed: list[DataFrame], previous: DataFrame | None, ungenotyped: DataFrame) -> DataFrame:
    """U11"""
    return union_sets(*(f.select("id") for f in [flagged, *listed, ungenotyped, *([previous] if previous is not None else [])]))

"""LD pruning (Q9) in segments of a chromosome that are swept side by side.

The sweep goes from window to window, and a window starts from what the ones before it left. So each segment is first swept as if nothing before it had gone; then
those whose first markers were hit by the segment before are swept again from there, until no segment's start changes. What a segment does late seldom depends on how it began, so that
a few rounds do, and the result is that of one sweep along the whole chromosome whatever their number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators.windows import global_rank, released, stored

#: Markers of a segment, about.
SEGMENT = 2000
#: Eigenvalues of a correlation matrix below it count as this, so that markers in full correlation have a large inflation.
LEAST = 1e-8


def inflation(r: np.ndarray) -> np.ndarray:
    """Variance inflation factors from correlations."""
    value, turn = np.linalg.eigh(r)
    return (turn * turn / np.maximum(value, LEAST)).sum(axis=1)


def sweep(band: np.ndarray, alive: np.ndarray, starts: range, window: int, vif: float) -> None:
    """Takes markers out of ``alive`` window by window; row k of ``band`` holds the correlations of marker k with itself and the next ones. Of equal factors the first goes."""
    for lo in starts:
        at = np.arange(lo, min(lo + window, len(alive)))
        while len(at := at[alive[at]]) > 1:
            first, second = np.minimum(at[:, None], at), np.maximum(at[:, None], at)
            factors = inflation(band[first, second - first])
            if factors.max() <= vif:
                break
            alive[at[int(np.flatnonzero(factors >= factors.max() * (1 - 1e-9))[0])]] = False


def ld_prune(gt: DataFrame, window: int = 50, step: int = 5, vif: float = 2.0, segment: int = SEGMENT) -> DataFrame:
    """Q9: (marker, pruned): windows of markers along a chromosome; while some marker's variance inflation passes ``vif`` the worst goes.

    Correlations of markers within a window of each other come from a banded join and native sums; a marker's are one row of ``window`` numbers. Chromosomes above 22 are pruned whole. Markers without calls, or
    that do not vary, have no correlations and stay.
    """
    size = max(step, segment // step * step, -(-window // step) * step)
    order = global_rank(gt.where("chr <= 22").select("chr", "pos", "marker").distinct(), ["chr", "pos", "marker"], "place")
    ends = order.groupBy("chr").agg(F.min("place").alias("first"), F.count("*").alias("n"))  # one row a chromosome
    markers = stored(order.join(F.broadcast(ends), "chr").select("chr", "marker", (F.col("place") - F.col("first")).alias("k"), "n"))
    ranked = gt.where("gt is not null").select("iid", "marker", "gt").join(markers.select("marker", "chr", "k"), "marker")
    cell = F.floor(F.col("k") / window).cast("int")
    left = ranked.select("iid", "chr", F.col("k").alias("ka"), F.col("gt").alias("ga"), F.explode(F.array(cell, cell + 1)).alias("cell"))
    right = ranked.select("iid", "chr", F.col("k").alias("kb"), F.col("gt").alias("gb"), cell.alias("cell"))
    near = left.join(right, ["chr", "iid", "cell"]).where(f"kb > ka and kb - ka < {window}")
    pairs = near.groupBy("chr", "ka", "kb").agg(S.corr("ga", "gb").alias("r")).where("r is not null and not isnan(r)")
    rows = pairs.groupBy("chr", "ka").agg(F.collect_list(F.struct((F.col("kb") - F.col("ka")).cast("int").alias("d"), "r")).alias("next"))  # at most ``window`` numbers
    # a segment holds the windows that start in it, so the markers of the next one that these reach as well
    both = F.array(F.floor(F.col("k") / size).cast("int"), F.when((F.col("k") >= size) & (F.col("k") % size < window), F.floor(F.col("k") / size).cast("int") - 1))
    held = markers.join(rows.select("chr", F.col("ka").alias("k"), "next"), ["chr", "k"], "left").withColumn("segment", F.explode(F.array_compact(both)))
    held = stored(held.select("chr", "segment", "k", "n", "next"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        base, count, number = int(pdf["segment"].iloc[0]) * size, int(pdf["n"].iloc[0]), len(pdf)
        band = np.zeros((number, window))
        band[:, 0] = 1
        for i, pairs in enumerate(pdf["next"]):
            for d, r in [] if pairs is None else [(p["d"], p["r"]) for p in pairs]:
                if i + d < number:
                    band[i, d] = r
        alive = np.ones(number, bool)
        gone = pdf["gone"].iloc[0]
        before = np.array([] if gone is None else gone, np.int64) - base
        alive[before] = False
        last = max(1, count - window + 1 + step)
        sweep(band, alive, range(0, min(size, last - base), step), window, vif)
        alive[before] = True
        mine = np.flatnonzero(~alive) + base
        return pd.DataFrame({"chr": [pdf["chr"].iloc[0]], "segment": [pdf["segment"].iloc[0]], "dead": [mine.tolist()], "over": [sorted(int(k) for k in mine if k >= base + size)]})

    starts = held.select("chr", "segment").distinct().withColumn("gone", F.array().cast("array<long>"))
    state, gone = None, None
    while True:
        swept = held.join(starts, ["chr", "segment"]).groupBy("chr", "segment").applyInPandas(run, "chr int, segment int, dead array<long>, over array<long>")
        if state is not None:
            kept = state.join(starts.select("chr", "segment"), ["chr", "segment"], "left_anti")
            swept = kept.unionByName(swept)
        older, state = state, stored(swept)
        # what reached over into the next segment is what that one must start from
        now = state.select("chr", (F.col("segment") + 1).alias("segment"), F.col("over").alias("gone"))
        known = gone if gone is not None else now.select("chr", "segment", F.array().cast("array<long>").alias("gone"))
        changed = now.join(known.withColumnRenamed("gone", "was"), ["chr", "segment"], "left").where(F.coalesce("was", F.array().cast("array<long>")) != F.col("gone"))
        starts = stored(changed.select("chr", "segment", "gone").join(held.select("chr", "segment").distinct(), ["chr", "segment"], "left_semi"))
        gone = stored(now)
        released(older)
        if starts.isEmpty():
            break
    pruned = state.select("chr", F.explode("dead").alias("k")).distinct().withColumn("pruned", F.lit(True))
    result = markers.join(pruned, ["chr", "k"], "left").select("marker", F.coalesce("pruned", F.lit(False)).alias("pruned"))
    above = gt.where("chr > 22").select("marker").distinct().withColumn("pruned", F.lit(True))
    return result.unionByName(above)

"""Cox regression for all markers at once (T9): every Newton step is one aggregation, and Python sees one row of sums a marker.

Equal rows are counted first. A step sums risks by marker and time, runs these totals from the last time to the first (a window that streams a marker's distinct times, spilling where they are many), and adds
up log likelihood, score and information with Efron's ties. Robust deviations come from score residuals, summed by cluster, which need one more running total from the first time to the last.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.operators.assoc import chi2_sf
from genoframe.operators.windows import stored

STEPS = 30
CLOSE = 1e-9


def _counted(df: DataFrame, key: str, time: str, event: str, xs: list[str], cluster: str | None) -> DataFrame:
    """(k, t, d, x0.., c, w): complete rows, counted; each x less its mean over the marker, which changes no coefficient."""
    names = [f"x{i}" for i in range(len(xs))]
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(time).cast("double").alias("t"), (F.col(event).cast("double") > 0).cast("int").alias("d"), *(F.col(x).cast("double").alias(n) for x, n in zip(xs, names, strict=True)), (F.col(cluster) if cluster else F.lit(0)).alias("c"))
    rows = rows.dropna().groupBy("k", "t", "d", *names, "c").agg(F.count("*").cast("double").alias("w"))
    means = rows.groupBy("k").agg(*((F.sum(F.col("w") * F.col(n)) / F.sum("w")).alias(f"m_{n}") for n in names))
    return stored(rows.join(means, "k").select("k", "t", "d", "c", "w", *((F.col(n) - F.col(f"m_{n}")).alias(n) for n in names)))


def _pairs(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i, size)]


def _risks(rows: DataFrame, beta: DataFrame, at: list[int]) -> DataFrame:
    """The rows with their marker's coefficients: linear predictor ``eta`` and weighted risk ``r``."""
    eta = sum((F.get("b", F.lit(i)) * F.col(f"x{x}") for i, x in enumerate(at)), F.lit(0.0))
    return rows.join(beta, "k").withColumn("eta", F.greatest(F.lit(-50.0), F.least(F.lit(50.0), eta))).withColumn("r", F.col("w") * F.exp("eta"))


def _times(risks: DataFrame, at: list[int]) -> DataFrame:
    """By marker and time: risk sums s over all that are still there, the same e over those that die at this time, their number m, and Efron's sums over the steps j of a tie.

    With a_j = s0 - j/m e0: r1, r2 are the sums of 1/a_j and (j/m)/a_j; q0, q1, q2 those of 1, j/m and (j/m)^2 over a_j^2; l that of log a_j.
    """
    x, r, d, size = [F.col(f"x{i}") for i in at], F.col("r"), F.col("d"), range(len(at))
    one = {"s0": r, "e0": r * d, "m": F.col("w") * d, "de": F.col("w") * d * F.col("eta")}
    one |= {f"s1_{i}": r * x[i] for i in size} | {f"e1_{i}": r * d * x[i] for i in size} | {f"dx_{i}": F.col("w") * d * x[i] for i in size}
    one |= {f"s2_{i}_{j}": r * x[i] * x[j] for i, j in _pairs(len(at))} | {f"e2_{i}_{j}": r * d * x[i] * x[j] for i, j in _pairs(len(at))}
    by_time = risks.groupBy("k", "t").agg(*(F.sum(v).alias(n) for n, v in one.items()))
    later = Window.partitionBy("k").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    running = by_time.withColumns({n: F.sum(n).over(later) for n in one if n[0] == "s"})
    sums = ("r1", "r2", "q0", "q1", "q2", "l")

    def step(z: Column, j: Column) -> Column:
        f = j / F.col("m")
        a = F.col("s0") - f * F.col("e0")
        more = {"r1": 1 / a, "r2": f / a, "q0": 1 / (a * a), "q1": f / (a * a), "q2": f * f / (a * a), "l": F.log(a)}
        return F.struct(*((z[n] + more[n]).alias(n) for n in sums))

    steps = F.when(F.col("m") > 0, F.sequence(F.lit(0).cast("long"), F.col("m").cast("long") - 1)).otherwise(F.array().cast("array<long>"))
    ties = F.aggregate(steps, F.struct(*(F.lit(0.0).alias(n) for n in sums)), step)
    return running.withColumn("tie", ties).select("*", "tie.*").drop("tie")


def _scores(times: DataFrame, size: int) -> DataFrame:
    """By marker: log likelihood, score g and information h."""
    c = F.col
    out = {"ll": c("de") - c("l")} | {f"g{i}": c(f"dx_{i}") - (c(f"s1_{i}") * c("r1") - c(f"e1_{i}") * c("r2")) for i in range(size)}
    for i, j in _pairs(size):
        square = c(f"s1_{i}") * c(f"s1_{j}") * c("q0") - (c(f"s1_{i}") * c(f"e1_{j}") + c(f"e1_{i}") * c(f"s1_{j}")) * c("q1") + c(f"e1_{i}") * c(f"e1_{j}") * c("q2")
        out[f"h{i}_{j}"] = c(f"s2_{i}_{j}") * c("r1") - c(f"e2_{i}_{j}") * c("r2") - square
    return times.where("m > 0").groupBy("k").agg(*(F.sum(v).alias(n) for n, v in out.items()))


def _symmetric(row: dict, name: str, size: int) -> np.ndarray:
    out = np.empty((size, size))
    for i, j in _pairs(size):
        out[i, j] = out[j, i] = row[f"{name}{i}_{j}"]
    return out


def _fitted(rows: DataFrame, at: list[int]) -> DataFrame:
    """(k, b, ll, h): coefficients, log likelihood and information of each marker; those whose information can't be inverted, or that don't settle, are missing."""
    size = len(at)

    def update(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    change = np.linalg.solve(_symmetric(row, "h", size), [row[f"g{i}"] for i in range(size)])
                except np.linalg.LinAlgError:
                    continue
                if np.isfinite(change).all() and np.isfinite(row["ll"]):
                    out.append((row["k"], (np.asarray(row["b"]) + change).tolist(), row["ll"], _symmetric(row, "h", size).ravel().tolist(), float(np.abs(change).max())))
            yield pd.DataFrame(out, columns=["k", "b", "ll", "h", "change"])

    beta = rows.select("k").distinct().withColumn("b", F.array(*(F.lit(0.0) for _ in at)))
    done = None
    for _ in range(STEPS):
        sums = _scores(_times(_risks(rows, beta, at), at), size).join(beta, "k")
        state = stored(sums.mapInPandas(update, "k long, b array<double>, ll double, h array<double>, change double"))
        settled = state.where(F.col("change") < CLOSE).drop("change")
        done = settled if done is None else done.unionByName(settled)
        beta = state.where(F.col("change") >= CLOSE).select("k", "b")
        if beta.isEmpty():
            break
    return stored(done)


def _residual_sums(rows: DataFrame, beta: DataFrame, at: list[int]) -> DataFrame:
    """(k, v): sums over clusters of products of their score residuals."""
    size, c = len(at), F.col
    risks = _risks(rows, beta.select("k", "b"), at)
    times = _times(risks, at)
    # hazard steps at a time, for those who live on (a, b) and for those who die, who take part in a share of them only (a_own, b_own)
    steps = {"a": c("r1"), "a_own": c("r1") - c("r2")}
    for i in range(size):
        all_ = c(f"s1_{i}") * c("q0") - c(f"e1_{i}") * c("q1")
        steps |= {f"b{i}": all_, f"b_own{i}": all_ - (c(f"s1_{i}") * c("q1") - c(f"e1_{i}") * c("q2")), f"mean{i}": F.when(c("m") > 0, (c(f"s1_{i}") * c("r1") - c(f"e1_{i}") * c("r2")) / c("m")).otherwise(0.0)}
    so_far = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    hazard = times.select("k", "t", *(v.alias(n) for n, v in steps.items()))
    hazard = hazard.select("*", *(F.sum(n).over(so_far).alias(f"all_{n}") for n in ("a", *(f"b{i}" for i in range(size)))))
    met = risks.join(hazard, ["k", "t"])
    dead, parts = c("d") > 0, []
    for i, x in enumerate(at):
        passed = c(f"x{x}") * c("all_a") - c(f"all_b{i}")
        own = (c(f"x{x}") * c("a") - c(f"b{i}")) - (c(f"x{x}") * c("a_own") - c(f"b_own{i}"))
        hazard_part = F.exp("eta") * (passed - F.when(dead, own).otherwise(0.0))
        parts.append((c("w") * (F.when(dead, c(f"x{x}") - c(f"mean{i}")).otherwise(0.0) - hazard_part)).alias(f"u{i}"))
    by_cluster = met.select("k", "c", *parts).groupBy("k", "c").agg(*(F.sum(f"u{i}").alias(f"u{i}") for i in range(size)))
    products = [F.sum(c(f"u{i}") * c(f"u{j}")) for i in range(size) for j in range(size)]
    return by_cluster.groupBy("k").agg(F.array(*products).alias("v"))


def cox_per_marker(df: DataFrame, time: str, event: str, f1: list[str], f0: list[str] = (), key: str = "marker", cluster: str | None = None) -> DataFrame:
    """Cox regression with Efron ties, on the rows complete for the variables; Wald P for one added variable or an empty null model, else the likelihood ratio.

    With ``cluster`` deviations are robust against dependence within clusters, and P is the robust Wald test of what f1 adds. A marker whose fit fails has nulls.
    """
    f1, f0 = list(f1), list(f0)
    xs, names = list(dict.fromkeys([*f1, *f0])), [f"{k}.{x}" for x in f1 for k in ("beta1", "sd1")]
    added = [f1.index(x) for x in f1 if x not in f0]
    rows = _counted(df, key, time, event, xs, cluster)
    one = _fitted(rows, [xs.index(x) for x in f1])
    wald = cluster is not None or len(added) == 1 or not f0
    if cluster is not None:
        one = one.join(_residual_sums(rows, one, [xs.index(x) for x in f1]), "k")
    if not wald:
        one = one.join(_fitted(rows, [xs.index(x) for x in f0]).select("k", F.col("ll").alias("ll0")), "k")

    def finish(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                b = np.asarray(row["b"])
                cov = np.linalg.inv(np.asarray(row["h"]).reshape(len(b), -1))
                if cluster is not None:
                    cov = cov @ np.asarray(row["v"]).reshape(cov.shape) @ cov
                try:
                    stat = float(b[added] @ np.linalg.solve(cov[np.ix_(added, added)], b[added])) if wald else 2 * (row["ll"] - row["ll0"])
                    sds = np.sqrt(np.diag(cov))
                except np.linalg.LinAlgError:
                    continue
                out.append([row["k"], stat, chi2_sf(stat, len(added)), *(v for pair in zip(b, sds, strict=True) for v in pair)])
            yield pd.DataFrame(out, columns=["k", "stat", "p", *names])

    fitted = one.mapInPandas(finish, "k long, stat double, p double, " + ", ".join(f"`{n}` double" for n in names))
    counts = rows.groupBy("k").agg(F.sum("w").cast("long").alias("n"))
    return counts.join(fitted, "k", "left").select(F.col("k").alias(key), "n", "stat", "p", *(F.col(f"`{n}`") for n in names))

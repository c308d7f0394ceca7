"""Operator 4: quality by a sparse rule ensemble.

Statistics of a text are Spark columns. Shallow trees are grown over the statistics of a bounded sample of labelled rows; each path from a root to a
node is a conjunctive rule. Lasso logistic regression over the rules (and nothing else) keeps few of them, and these become one Spark
column: the logistic function of a weighted sum of comparisons. Scoring all rows is one pass without Python.

The sample: labelled rows outside the held-out fold, each kept if a hash of its id falls under ``fit_rows`` over their number, so that about ``fit_rows``
ids (documented bound, default 20,000) reach the driver at any size of the table, each with at most ``ROWS_PER_ID`` rows. Trees and weights are fitted there with numpy.

Statistics see the text only; labels, lang, source and doc_id are never inputs of a score. Defined results: a null or empty text has all
statistics 0 and gets a score like any other; documents without a label are scored and not learnt from; an id with both labels counts with each, labels that repeat count once; of
an id that repeats, the ``ROWS_PER_ID`` rows of least hash are learnt from; with no labelled
row, or one class only, the score is that class's share (0.5 without rows), the same for all; an empty table gives an empty result. ``scored`` raises an error where its
new column is there already; columns of other names, also those of the helpers, come back as they were.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoframe.llm.common import crc32_of_id, free_names

FIT_ROWS = 20_000
ROWS_PER_ID = 8
FOLDS, HELD = 4, 2
THRESHOLD = 0.7
TREES, DEPTH, BINS = 16, 3, 32
LASSO = 0.002
STEPS = 600


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    length = F.greatest(F.length(t), F.lit(1))
    words = F.greatest(F.regexp_count(t, F.lit(r"\S++")), F.lit(1))
    lines = F.split(t, "\n")
    share = lambda pattern, of=length: F.regexp_count(t, F.lit(pattern)) / of
    return {
        "log_chars": F.log1p(F.length(t).cast("double")),
        "word_length": F.length(t) / words,
        "symbols": share(r"[#$%&*+=<>{}\[\]\\^~_@]"),
        "bars": share(r"\|", words),
        "shouts": share(r"!", words),
        "upper": share(r"\p{Lu}"),
        "digits": share(r"[0-9]"),
        "stops": share(r"[.?;:]", words),
        "commas": share(r",", words),
        "repeats": share(r"(?<!\S)(\S++)\s(?=\1(?!\S))", words),
        "lines": F.size(lines) / words,
        "same_lines": 1 - F.size(F.array_distinct(lines)) / F.size(lines),
    }


NAMES = ["log_chars", "word_length", "symbols", "bars", "shouts", "upper", "digits", "stops", "commas", "repeats", "lines", "same_lines"]


@dataclass(frozen=True)
class Rule:
    """Holds where each (statistic, is it above, bound) holds."""

    parts: tuple[tuple[int, bool, float], ...]

    def column(self, values: list[Column]) -> Column:
        out = F.lit(True)
        for k, above, bound in self.parts:
            out = out & ((values[k] > bound) if above else (values[k] <= bound))
        return out

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, bound in self.parts:
            out &= (x[:, k] > bound) if above else (x[:, k] <= bound)
        return out


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, values: list[Column]) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(values), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, columns: np.ndarray, path: tuple, out: dict[Rule, None]) -> None:
    """Adds the rules of a tree below ``path``."""
    if len(path) == DEPTH or len(y) < 40 or y.min() == y.max():
        return
    best = (1e-9, None, None)
    all_w, all_y = weight.sum(), (weight * y).sum()
    purity = lambda s, n: s * (n - s) / np.maximum(n, 1e-12)
    for k in columns:
        bounds = np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[:-1]))
        place = np.searchsorted(bounds, x[:, k], side="left")
        n = np.cumsum(np.bincount(place, weight, len(bounds) + 1))[:-1]
        s = np.cumsum(np.bincount(place, weight * y, len(bounds) + 1))[:-1]
        gain = purity(all_y, all_w) - purity(s, n) - purity(all_y - s, all_w - n)
        gain[(n < 1e-12) | (all_w - n < 1e-12)] = 0
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], k, float(bounds[at]))
    _, k, bound = best
    if k is None:
        return
    for above in (False, True):
        rows = (x[:, k] > bound) if above else (x[:, k] <= bound)
        if rows.any():
            here = (*path, (int(k), above, bound))
            out[Rule(here)] = None
            _grow(x[rows], y[rows], weight[rows], columns, here, out)


def _lasso(z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal steps; the bias is not penalised."""
    n, d = z.shape
    mean, scale = z.mean(0), np.maximum(z.std(0), 0.02)
    u = (z - mean) / scale
    step = 4 * n / (np.linalg.norm(u, 2) ** 2 + n)
    w = v = np.zeros(d)
    b = c = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    t = 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(u @ v + c))) - y
        w_new = v - step * (u.T @ error) / n
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * LASSO, 0)
        b_new = c - step * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return b - float((w * mean / scale).sum()), w / scale


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
    """The model of statistics ``x`` (rows by NAMES) and labels ``y`` (0 or 1)."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 0.01), 0.99)
        return Model(float(np.log(share / (1 - share))), ())
    random = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    for k in range(TREES):
        columns = np.arange(x.shape[1]) if k == 0 else random.choice(x.shape[1], max(1, x.shape[1] * 2 // 3), replace=False)
        weight = np.ones(len(y)) if k == 0 else random.poisson(1.0, len(y)).astype(float)
        used = weight > 0
        _grow(x[used], y[used], weight[used], columns, (), rules)
    names = list(rules)
    if not names:
        return Model(float(np.log(y.mean() / (1 - y.mean()))), ())
    bias, weights = _lasso(np.stack([r.of(x) for r in names], 1).astype(float), y)
    return Model(bias, tuple((r, float(w)) for r, w in zip(names, weights, strict=True) if abs(w) > 1e-3))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), without the held-out fold."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.where(crc32_of_id("doc_id") % FOLDS != HELD).distinct()
    count = known.count()
    if count > fit_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / count))
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "quality", F.xxhash64("text").alias("hash"), *(c.cast("double").alias(n) for n, c in statistics(F.col("text")).items()))
    turn = Window.partitionBy("doc_id", "quality").orderBy("hash")
    rows = rows.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= ROWS_PER_ID).drop("hash", "turn")
    sample = rows.toPandas().sort_values(["doc_id", *NAMES, "quality"], kind="stable")
    return fit_rules(sample[NAMES].to_numpy(float), sample["quality"].to_numpy(float))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's score in a new column."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {out} already")
    own = dict(zip(NAMES, free_names(docs, *(f"__stat_{n}" for n in NAMES)), strict=True))
    values = docs.select("*", *(c.cast("double").alias(own[n]) for n, c in statistics(F.col(f"`{text}`")).items()))
    return values.withColumn(out, model.score([F.col(own[n]) for n in NAMES])).drop(*own.values())


def accepted(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """``docs`` whose score reaches ``least``.

    Statistics come from a projection that also holds a row number: a filter is not pushed through it, which would write the statistics out in every rule.
    """
    *names, row, score = free_names(docs, *(f"__stat_{n}" for n in NAMES), "__row", "__score")
    own = dict(zip(NAMES, names, strict=True))
    values = docs.select("*", *(c.cast("double").alias(own[n]) for n, c in statistics(F.col(f"`{text}`")).items()), F.monotonically_increasing_id().alias(row))
    scored_rows = values.withColumn(score, model.score([F.col(own[n]) for n in NAMES]))
    return scored_rows.where((F.col(score) >= least) & (F.col(row) >= 0)).select(*(F.col(f"`{c}`") for c in docs.columns))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scored(docs, model)
    return out.select("doc_id", (crc32_of_id("doc_id") % FOLDS == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

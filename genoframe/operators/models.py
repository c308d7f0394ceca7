"""Model specifications: expansion and runs over all markers."""

from __future__ import annotations

import functools
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.operators import assoc as T
from genoframe.operators import genotypes as G
from genoframe.operators.cox import cox_per_marker
from genoframe.operators.windows import kept


@dataclass(frozen=True)
class Model:
    """A test of response ~ f1 against response ~ f0 on the rows of ``subset`` (an SQL condition)."""

    response: str
    f1: tuple[str, ...]
    f0: tuple[str, ...] = ()
    kind: str = "linear"
    subset: str | None = None
    tag: str = ""
    options: dict = field(default_factory=dict, hash=False)
    #: For ``expand_models``: responses, named subsets and scaling components.
    responses: tuple[str, ...] = ()
    subsets: dict = field(default_factory=dict, hash=False)
    components: tuple[int, ...] = ()


FITS = {
    "linear": lambda df, m: T.lm_per_marker(df, m.response, list(m.f1), list(m.f0)),
    "gaussian": lambda df, m: T.lm_per_marker(df, m.response, list(m.f1), list(m.f0), test="LR"),
    "logistic": lambda df, m: T.logistic_per_marker(df, m.response, list(m.f1), list(m.f0)),
    "ordinal": lambda df, m: T.ordinal_per_marker(df, m.response, list(m.f1), list(m.f0)),
    "cox": lambda df, m: cox_per_marker(df, m.options["time"], m.response, list(m.f1), list(m.f0), cluster=m.options.get("cluster")),
    "mixed": lambda df, m: T.lmm(df, m.response, list(m.f1), list(m.f0), m.options["cluster"]),
}


def expand_models(models: list[Model]) -> list[Model]:
    """One model for each response and subset that a model names, in this order. The scaling components it names (by number) are covariates
    ``c1``, ``c2``, ... of both formulas. The tag is made of response, subset and components."""
    out = []
    for model in models:
        extra = tuple(f"c{i}" for i in model.components)
        for response in model.responses or (model.response,):
            for name, condition in (model.subsets or {"all": model.subset}).items():
                parts = [model.tag, response, name, *(["mds" + "-".join(map(str, model.components))] if extra else [])]
                out.append(replace(model, response=response, responses=(), subset=condition, subsets={}, components=(), f1=model.f1 + extra, f0=model.f0 + extra, tag="_".join(p for p in parts if p)))
    return out


def testable(df: DataFrame, maf: float = 0.01, counts: int = 5) -> DataFrame:
    """(marker, af) of all markers; ``af`` is null for those that are not tested: too few minor alleles, or more than one genotype with fewer than ``counts`` carriers."""
    n = F.nullif(F.col("n0") + F.col("n1") + F.col("n2"), F.lit(0))
    af = (F.col("n1") + 2 * F.col("n2")) / (2 * n)
    few = sum((F.col(f"n{k}") < counts).cast("int") for k in range(3))
    return G.gt_counts(df).select("marker", F.when((F.least(af, 1 - af) >= maf) & (few < 2), af).alias("af"))


#: Models whose fits come from sums, so that any number of them needs one reading of the genotypes.
FROM_SUMS = {"linear": "F", "gaussian": "LR"}


def _chosen(model: Model):
    return F.coalesce(F.expr(model.subset), F.lit(False)) if model.subset else F.lit(True)


def _status(af, p):
    return F.when(af.isNull(), "excluded").when(p.isNull() | F.isnan(p), "failed").otherwise("ok")


def _from_sums(df: DataFrame, models: list[Model], maf: float, counts: int) -> DataFrame:
    """All models at once: each row is read once and adds to the sums of the models whose subset it is in; Python then gets one row of sums a marker."""
    sums = {}
    for i, m in enumerate(models):
        xs = [*m.f1, *(x for x in m.f0 if x not in m.f1)]
        sums |= {f"m{i}_g{k}": F.count_if(_chosen(m) & (F.col("gt") == k)) for k in range(3)} | {f"m{i}_all": F.count_if(_chosen(m))}
        sums |= T.gram_sums([*xs, m.response], _chosen(m), f"m{i}_")
    summed = df.groupBy("marker").agg(*(c.alias(n) for n, c in sums.items()))
    tags = [m.tag or m.response for m in models]

    def fit(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                for i, m in enumerate(models):
                    g = [row[f"m{i}_g{k}"] for k in range(3)]
                    af = (g[1] + 2 * g[2]) / (2 * sum(g)) if sum(g) else None
                    good = af is not None and min(af, 1 - af) >= maf and sum(k < counts for k in g) < 2
                    if row[f"m{i}_all"]:
                        p = T.lm_from_sums(row, list(m.f1), list(m.f0), FROM_SUMS[m.kind], f"m{i}_")["p"] if good else None
                        out.append((tags[i], row["marker"], af if good else None, p))
            yield pd.DataFrame(out, columns=["tag", "marker", "af", "p"]).astype({"af": float, "p": float})

    found = summed.mapInPandas(fit, "tag string, marker long, af double, p double")
    known = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return found.select("tag", "marker", known("af"), known("p")).withColumn("status", _status(F.col("af"), F.col("p")))


def association(df: DataFrame, models: list[Model], maf: float = 0.01, counts: int = 5) -> DataFrame:
    """(tag, marker, af, p, status) of all models: ``ok``, ``failed`` (no P) or ``excluded``. A marker has a row for each model in whose subset it has rows.

    Linear and Gaussian models share one reading of the genotypes, whatever their number.
    """
    together = [m for m in models if m.kind in FROM_SUMS]
    parts = [_from_sums(df, together, maf, counts)] if together else []
    for m in (m for m in models if m.kind not in FROM_SUMS):
        rows = df.where(m.subset) if m.subset else df
        # one row a marker, written, so that the genotypes are read once to count and once to fit
        every = kept(testable(rows, maf, counts))
        fitted = FITS[m.kind](rows.join(every.where("af is not null").select("marker"), "marker", "left_semi"), m).select("marker", "p")
        every = every.join(fitted, "marker", "left")
        parts.append(every.select(F.lit(m.tag or m.response).alias("tag"), "marker", "af", "p", _status(F.col("af"), F.col("p")).alias("status")))
    return functools.reduce(DataFrame.unionByName, parts)


def status_counts(results: DataFrame) -> DataFrame:
    """T14"""
    return results.groupBy("tag").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "failed", "excluded")))


def test_snp(df: DataFrame, model: Model, marker: int) -> DataFrame:
    """One marker again, with all coefficients."""
    rows = df.where(F.col("marker") == marker)
    return FITS[model.kind](rows.where(model.subset) if model.subset else rows, model)


def test_marginal(df: DataFrame, model: Model, markers: DataFrame) -> DataFrame:
    """The markers of a list."""
    return FITS[model.kind](df.join(markers.select("marker").distinct(), "marker", "left_semi"), model)


test_snp.__test__ = test_marginal.__test__ = False

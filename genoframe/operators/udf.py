"""User functions (D)."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Markers whose dosage entropy is not above this are skipped.
LEAST_ENTROPY = 0.02


def informative(df: DataFrame, dosage: str = "dosage", key: str = "marker", least: float = LEAST_ENTROPY) -> DataFrame:
    """Markers whose dosages spread over [0, .5), [.5, 1.5), [1.5, 2] enough; native, before any Python."""
    cell = F.when(F.col(dosage) < 0.5, 0).when(F.col(dosage) < 1.5, 1).otherwise(2)
    counts = df.where(F.col(dosage).isNotNull()).groupBy(key).agg(*(F.count_if(cell == k).alias(f"k{k}") for k in range(3)))
    n = F.col("k0") + F.col("k1") + F.col("k2")
    part = lambda k: F.when(F.col(f"k{k}") > 0, -F.col(f"k{k}") / n * F.log(F.col(f"k{k}") / n)).otherwise(0.0)
    return counts.where(part(0) + part(1) + part(2) > least).select(key)


def _guarded(fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The user's function of a marker's frame: where it raises, a row of nulls; a result of another shape is left out."""
    names = [f.split()[0] for f in schema.split(",")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            out = fn(pdf)
        except Exception:  # a user's function may raise anything; the marker then has no result
            out = pd.DataFrame([dict.fromkeys(names, None) | {key: pdf[key].iloc[0]}])
        return out if list(out.columns) == names else pd.DataFrame(columns=names)

    return run


def per_marker(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, dosage: str = "dosage", key: str = "marker", counted: str | None = None) -> DataFrame:
    """A function per informative marker; one that raises gives a row of nulls, one of another shape is left out.

    With ``counted`` equal rows are counted first: the function gets each combination of values once, and how often it occurs in a column of that name."""
    rows = df.join(informative(df, dosage, key), key, "left_semi")
    if counted is not None:
        rows = count_equal(rows, counted)
    return rows.groupBy(key).applyInPandas(_guarded(fn, schema, key), schema)


def count_equal(df: DataFrame, name: str) -> DataFrame:
    """Each distinct row once, with its number in a new column (as a double, ready to be a weight)."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {name} already")
    return df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count("*").cast("double").alias(name))


def per_marker_pieces(
    df: DataFrame,
    piece: Callable[[pd.DataFrame], pd.DataFrame],
    finish: Callable[[pd.DataFrame], pd.DataFrame],
    state: str,
    schema: str,
    dosage: str = "dosage",
    key: str = "marker",
    rows: int = 100_000,
) -> DataFrame:
    """D1 for functions that can be put together from parts: no task holds all individuals of a marker.

    ``piece`` turns some ``rows`` rows of a marker (fewer at the end of a task's rows) into a small frame of columns ``state`` (which hold the key); it works where
    the rows lie, sorted within their task. ``finish`` turns a marker's parts, in any order and of any sizes, into its result. Errors and odd shapes are as in ``per_marker``; a marker of which a
    part raises is as if ``finish`` had raised.
    """
    names, failed = [f.split()[0] for f in state.split(",")], "__failed"

    def part(held: list[pd.DataFrame]) -> pd.DataFrame:
        group = pd.concat(held, ignore_index=True)
        try:
            return piece(group)[names].assign(**{failed: False})
        except Exception:  # as above: the user's function may raise anything
            return pd.DataFrame([dict.fromkeys(names, None) | {key: group[key].iloc[0], failed: True}])

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, own = [], 0, None
        for pdf in batches:
            for marker, group in pdf.groupby(key, sort=False):
                if held and (marker != own or size >= rows):
                    yield part(held)
                    held, size = [], 0
                own = marker
                held.append(group)
                size += len(group)
        if held:
            yield part(held)

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf[failed].any():
            raise ValueError("a part of the marker has no result")
        return finish(pdf.drop(columns=failed))

    some = df.join(informative(df, dosage, key), key, "left_semi").sortWithinPartitions(key).mapInPandas(parts, f"{state}, {failed} boolean")
    return some.groupBy(key).applyInPandas(_guarded(together, schema, key), schema)


def n_to_one(frames: Iterable[DataFrame], fn: Callable[..., DataFrame]) -> DataFrame:
    """D2"""
    return fn(*frames)


def row_apply(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """D3"""
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([fn(r) for r in pdf.to_dict("records")], columns=names)

    return df.mapInPandas(run, schema)


def cl_apply(params: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """One row of parameters each; rows are spread over the cluster first."""
    return row_apply(params.repartition(max(1, int(params.sparkSession.conf.get("spark.sql.shuffle.partitions")))), fn, schema)


def iterate_models(grid: list[DataFrame], fn: Callable[[dict], dict], schema: str, constraint: str | None = None, chosen: Iterable[int] | None = None) -> DataFrame:
    """A function over a parameter grid; ``chosen`` picks grid numbers (from 1, in grid order)."""
    from genoframe.operators.joins import product
    from genoframe.operators.windows import global_rank

    cells = product(grid, constraint)
    cells = global_rank(cells, cells.columns, "model")
    return cl_apply(cells.where(F.col("model").isin(list(chosen))) if chosen is not None else cells, fn, schema)


def sow(kind: str, reason: str, ids: DataFrame) -> DataFrame:
    """A side result as rows (kind, reason, id)."""
    return ids.select(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"), F.col(ids.columns[0]).cast("long").alias("id"))


def reap(sown: Iterable[DataFrame], kind: str | None = None) -> DataFrame:
    every = functools.reduce(DataFrame.unionByName, sown)
    return every.where(F.col("kind") == kind) if kind else every



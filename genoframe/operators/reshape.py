"""Aggregation and reshaping (A)."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators.windows import exact_quantiles, kept



def group_max_row(df: DataFrame, key: list[str], value: str, line: str) -> DataFrame:
    """A1: the row of the maximum (first on ties) of each group."""
    best = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(value).desc_nulls_last(), line))
    return df.withColumn("__k", best).where("__k = 1").drop("__k")


def by_apply(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """A2"""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def table_n(df: DataFrame, col: str, categories: list, keys: list[str] = ()) -> DataFrame:
    """A3: counts over fixed categories, zeros kept."""
    return df.groupBy(*keys).agg(*(F.count_if(F.col(col) == c).alias(f"n_{c}") for c in categories))


def table_freq(df: DataFrame, col: str) -> DataFrame:
    """A4"""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__t"))
    return counts.join(F.broadcast(total)).withColumn("freq", F.col("n") / F.col("__t")).drop("__t")


def truth(df: DataFrame, sql: str, distinct: str) -> DataFrame:
    """A5: number and share of rows for which a condition holds, and the cardinality of a column."""
    return df.agg(F.count_if(F.expr(sql)).alias("n_true"), F.avg(F.expr(sql).cast("double")).alias("fraction"), F.count_distinct(distinct).alias("cardinality"))


def entropy(df: DataFrame, col: str) -> DataFrame:
    """A6"""
    return table_freq(df, col).agg((-F.sum(F.col("freq") * F.log("freq"))).alias("entropy"))


def summary_num(df: DataFrame, cols: list[str]) -> DataFrame:
    """Quantiles, mean, sd and missing share, one row per column."""
    long = df.select(*(F.col(c).cast("double").alias(c) for c in cols)).unpivot([], cols, "variable", "x")
    # one row a column
    levels = df.sparkSession.createDataFrame([(c, exact_quantiles(df, F.col(c), [0.0, 0.25, 0.5, 0.75, 1.0])) for c in cols], "variable string, q array<double>")
    out = long.groupBy("variable").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.avg(F.col("x").isNull().cast("double")).alias("missing")).join(F.broadcast(levels), "variable")
    return out.select("variable", *(F.get("q", F.lit(k)).alias(n) for k, n in enumerate(("min", "q25", "median", "q75", "max"))), "mean", "sd", "missing")


def sample_description(df: DataFrame, col: str, levels: list[float] | None = None) -> DataFrame:
    """Mean, median, sd and quantiles of one sample, as one row; quantiles are an array."""
    q = exact_quantiles(df, F.col(col), [0.5, *(levels or [0.25, 0.75])])
    values = F.array(*(F.lit(v).cast("double") for v in q[1:]))
    x = F.col(col).cast("double")
    return df.agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")).select("mean", F.lit(q[0]).cast("double").alias("median"), "sd", values.alias("quantiles"))


def descriptives(df: DataFrame, col: str) -> DataFrame:
    """With outliers beyond 1.5 hinge spreads; hinges are medians of the lower and upper halves (the middle value in both)."""
    x = df.select(F.col(col).cast("double").alias("x"))
    known = x.where("x is not null")
    n = known.count()
    # the hinges stand at depth (floor((n + 1) / 2) + 1) / 2 from either end
    depth = ((n + 1) // 2 + 1) / 2
    level = (depth - 1) / max(n - 1, 1) if n else 0.5
    lo, median, hi = (F.lit(q).cast("double") for q in exact_quantiles(known, F.col("x"), [level, 0.5, 1 - level]))
    spread = hi - lo
    outside = (F.col("x") < lo - 1.5 * spread) | (F.col("x") > hi + 1.5 * spread)
    return x.agg(F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("n_na"), (100.0 * F.avg(F.col("x").isNull().cast("double"))).alias("na_percent"), F.avg("x").alias("mean"), F.max(median).alias("median"), (F.stddev_samp("x") / F.sqrt(F.count("x"))).alias("se"), F.count_if(outside).alias("outliers"))


def skewness(df: DataFrame, col: str) -> DataFrame:
    """A10"""
    return df.agg((F.skewness(col) * F.pow(1 - F.lit(1.0) / F.count(col), F.lit(1.5))).alias("skewness"))


def set_overlaps(sets: DataFrame) -> DataFrame:
    """(set, id) to sizes of intersection, union and difference for each pair of sets."""
    s = sets.select("set", "id").distinct()
    size = s.groupBy("set").agg(F.count("*").alias("n"))
    # sets are few, ids many: ids are gathered into the list of their sets before pairs are made
    lists = s.groupBy("id").agg(F.array_sort(F.collect_set("set")).alias("sets")).groupBy("sets").agg(F.count("*").alias("k"))
    pairs = lists.select("sets", "k", F.explode("sets").alias("s1")).select("s1", F.explode("sets").alias("s2"), "k").groupBy("s1", "s2").agg(F.sum("k").alias("common"))
    grid = size.select(F.col("set").alias("s1"), F.col("n").alias("n1")).crossJoin(size.select(F.col("set").alias("s2"), F.col("n").alias("n2")))
    full = grid.join(pairs, ["s1", "s2"], "left").withColumn("common", F.coalesce("common", F.lit(0)))
    return full.select("s1", "s2", "common", (F.col("n1") + F.col("n2") - F.col("common")).alias("either"), (F.col("n1") - F.col("common")).alias("only1"))


def union_cum(sets: DataFrame) -> DataFrame:
    """(set number, id) to the size of the union up to each set."""
    fresh = sets.groupBy("id").agg(F.min("set").alias("set")).groupBy("set").agg(F.count("*").alias("k"))
    every = sets.select("set").distinct().join(fresh, "set", "left")
    return every.select("set", F.sum(F.coalesce("k", F.lit(0))).over(Window.orderBy("set").rowsBetween(Window.unboundedPreceding, 0)).alias("size"))


def reshape_wide(df: DataFrame, ids: list[str], var: str, levels: list, values: list[str]) -> DataFrame:
    """Columns ``value.level``; where not exactly one row matches, null."""
    only = [F.when(F.count(F.lit(1)) == 1, F.first(v)).alias(v) for v in values]
    wide = df.groupBy(*ids).pivot(var, levels).agg(*only)
    return wide.toDF(*ids, *(f"{v}.{level}" for level in levels for v in values))


def reshape_long(df: DataFrame, variables: list[str], factor: str, value: str) -> DataFrame:
    """A15"""
    keep = [c for c in df.columns if c not in variables]
    return df.unpivot(keep, variables, factor, value)


def reshape_long_re(df: DataFrame, families: list[str], factor: str = "k") -> DataFrame:
    """Columns ``name1 name.2 name_3`` of several families to one row per number."""
    found: dict[int, dict[str, str]] = {}
    for c in df.columns:
        for f in families:
            if m := re.fullmatch(rf"{re.escape(f)}[._]?(\d+)", c):
                found.setdefault(int(m[1]), {})[f] = c
    used = {c for names in found.values() for c in names.values()}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used]
    types = dict(df.dtypes)
    kind = {f: next(types[names[f]] for names in found.values() if f in names) for f in families}
    rows = F.array(*(F.struct(F.lit(k).alias(factor), *((F.col(f"`{names[f]}`") if f in names else F.lit(None)).cast(kind[f]).alias(f) for f in families)) for k, names in sorted(found.items())))
    return df.select(*rest, F.explode(rows).alias("__r")).select(*rest, "__r.*")


def transpose(df: DataFrame, line: str, cols: list[str], by: int = 1) -> DataFrame:
    """One row per (block of ``by``) column, its cells in line order."""
    long = df.select(F.col(line).alias("__l"), F.posexplode(F.array(*(F.col(c).cast("string") for c in cols))).alias("__c", "__v"))
    grouped = long.groupBy((F.floor(F.col("__c") / by)).cast("int").alias("column")).agg(F.array_sort(F.collect_list(F.struct("__l", "__c", "__v"))).alias("cells"))
    return grouped.select("column", F.transform("cells", lambda c: c["__v"]).alias("cells"))


def cbind(frames: list[DataFrame], line: str) -> DataFrame:
    """Frames side by side by line; clashing names get the number of their frame."""
    seen: set[str] = {line}
    named = []
    for k, f in enumerate(frames):
        fresh = {c: f"{c}.{k}" for c in f.columns if c in seen and c != line}
        named.append(f.withColumnsRenamed(fresh))
        seen |= set(named[-1].columns)
    return functools.reduce(lambda a, b: a.join(b, line, "full"), named)


def rbind_all(frames: dict[str, DataFrame], id_col: str = "id") -> DataFrame:
    """A19"""
    parts = [f.withColumn(id_col, F.lit(name)) for name, f in frames.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def expand_weights(df: DataFrame, weight: str) -> DataFrame:
    """A22"""
    return df.where(F.col(weight) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(weight).cast("int"))))


def factor_levels(df: DataFrame, col: str, most: int = 10_000) -> list:
    """Sorted levels of a factor (an error beyond ``most``)."""
    levels = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(levels) > most:
        raise ValueError(f"{col} has more than {most} levels")
    return sorted(levels)


def expand_factors(df: DataFrame, cols: list[str]) -> DataFrame:
    """Indicator columns ``col.level``, without the first level; null stays null."""
    out = {}
    for c in cols:
        for level in factor_levels(df, c)[1:]:
            out[f"{c}.{level}"] = F.when(F.col(c).isNotNull(), (F.col(c) == level).cast("int"))
    return df.withColumns(out).drop(*cols)


def recode_levels(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Levels through a map, others null."""
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return df.withColumn(col, table[F.col(col)])


def factor_from(df: DataFrame, cols: list[str], out: str = "factor", sep: str = ";") -> DataFrame:
    """One label of several factors; null unless all are known."""
    whole = functools.reduce(Column.__and__, (F.col(c).isNotNull() for c in cols))
    return df.withColumn(out, F.when(whole, F.concat_ws(sep, *cols)))


def value_combinations(df: DataFrame, cols: list[str]) -> DataFrame:
    """All combinations of the columns' distinct values."""
    return functools.reduce(DataFrame.crossJoin, (df.select(c).distinct() for c in cols))


def lump_factor(df: DataFrame, col: str, min_n: int) -> DataFrame:
    """The two rarest levels are merged until all have ``min_n`` rows; the table of levels (10,000 at most) is worked on the driver."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).limit(10_001).collect()
    if len(counts) > 10_000:
        raise ValueError(f"{col} has more than 10000 levels")
    groups = [([str(r[col])], r["n"]) for r in counts]
    while len(groups) > 1:
        groups.sort(key=lambda g: (g[1], sorted(g[0])))
        if groups[0][1] >= min_n:
            break
        (a, n), (b, m) = groups[:2]
        groups = [(a + b, n + m), *groups[2:]]
    names = {x: "+".join(sorted(g)) for g, _ in groups for x in g}
    return df.withColumn(f"{col}_lumped", F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col(col).cast("string")] if names else F.lit(None).cast("string"))


def corr_clusters(df: DataFrame, cols: list[str], eps: float) -> DataFrame:
    """(column, cluster) of columns tied by |r| > 1 - eps; the cluster's first column names it."""
    pairs = [(a, b) for k, a in enumerate(cols) for b in cols[k + 1 :]]
    row = df.agg(*(S.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs))).first() if pairs else []
    root = {c: c for c in cols}
    for (a, b), r in zip(pairs, row, strict=True):
        if r is not None and abs(r) > 1 - eps:
            old, new = sorted((root[a], root[b]), key=cols.index, reverse=True)
            root = {c: new if x == old else x for c, x in root.items()}
    return df.sparkSession.createDataFrame(list(root.items()), "column string, cluster string")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the smallest connected node, by min-label steps; labels are checkpointed so that plans stay short."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    links = kept(both)
    labels = kept(links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).select(F.col("a").alias("node"), "root"))
    while True:
        near = links.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.least("root", "near").alias("next"), "root")
        # a label points to the label of its own root
        jump = step.join(step.select(F.col("node").alias("at"), F.col("next").alias("over")), F.col("next") == F.col("at"), "left").select("node", F.least("next", F.coalesce("over", "next")).alias("root"), F.col("root").alias("was"))
        after = kept(jump)
        if after.where("root <> was").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")


def center(df: DataFrame, cols: list[str], scale: bool = False, keep_mean: bool = False) -> DataFrame:
    """A30, A31"""
    stats = df.agg(*(F.avg(c).alias(f"__m_{c}") for c in cols), *(F.stddev_samp(c).alias(f"__s_{c}") for c in cols))
    value = lambda c: (F.col(c) - F.col(f"__m_{c}")) / (F.col(f"__s_{c}") if scale else F.lit(1.0)) + (F.col(f"__m_{c}") if keep_mean else F.lit(0.0))
    return df.join(F.broadcast(stats)).withColumns({c: value(c) for c in cols}).select(*df.columns)


def minimax(c: Column, lo: float, hi: float) -> Column:
    """A32"""
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def design_matrix(df: DataFrame, formula: str, line: str, intercept: bool = True, offset: str | None = None) -> DataFrame:
    """``y ~ a + b + (1|g)``: complete rows, factors as indicators, random terms as plain columns, names matched as regular expressions. ``offset`` is an expression, taken along as column ``offset`` for
    the rows that are complete in the formula's variables; it may be null itself."""
    response, _, right = (p.strip() for p in formula.partition("~"))
    names: list[str] = []
    random: list[str] = []
    for term in (t.strip() for t in right.split("+")):
        if m := re.fullmatch(r"\(1\s*\|\s*(\w+)\)", term):
            random.append(m[1])
        elif term != "1":
            found = [term] if term in df.columns else [c for c in df.columns if re.fullmatch(term, c)]
            if not found:
                raise ValueError(f"no column matches {term!r}")
            names += found
    cols = list(dict.fromkeys([line, *([response] if response else []), *names, *random]))
    rows = df.select(*cols, *([F.expr(offset).cast("double").alias("offset")] if offset else [])).dropna(subset=cols)
    types = dict(rows.dtypes)
    rows = expand_factors(rows, [c for c in names if types[c] == "string"])
    return rows.withColumn("intercept", F.lit(1.0)) if intercept else rows


def records_to_frame(df: DataFrame, column: str, id_col: str, most: int = 1000) -> DataFrame:
    """A column of maps with differing keys to columns; absent keys are null. A frame has at most ``most`` such columns, more keys are an error."""
    keys = sorted(r[0] for r in df.select(F.explode(F.map_keys(column))).distinct().limit(most + 1).collect())
    if len(keys) > most:
        raise ValueError(f"more than {most} different keys in {column}")
    return df.select(id_col, *(F.col(column)[k].alias(k) for k in keys))



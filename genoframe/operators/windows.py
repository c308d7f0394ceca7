"""Order, ranks and thinning (W). Global ranks go through range partitions and a table of offsets, not one task."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Values that one task may hold for an exact percentile; more are ranked by range.
FEW = 1_000_000


def shared_base(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Without that setting a temporary one on a single machine (master ``local``); on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="genoframe-")
    return base.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: for steps that join what an earlier step has made.

    Unlike a checkpoint, a table brings its own size. The size of a checkpoint is the planner's estimate for the plan before it, which for a join is a product,
    so that some ten joined steps later the estimates alone take minutes.
    """
    path = f"{shared_base(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.options(compression="zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_in = path
    return table


def released(*tables: DataFrame | None) -> None:
    """Removes stored tables that nothing reads any more."""
    for table in tables:
        if table is not None:
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(table.stored_in)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def global_rank(df: DataFrame, order: list, name: str = "rank", partitions: int | None = None, part: str | None = None) -> DataFrame:
    """Row numbers from 1 by ``order`` (names or sort columns; give a full tie-break): rows are range-partitioned, numbered by partition, and shifted by the
    counts of the partitions before. ``part`` names a column for the number of the range, of which there are as many as partitions whatever the rows."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # ids ascend by partition in the upper 31 bits and count rows in the lower 33
    placed = ranged.withColumn("__id", F.monotonically_increasing_id()).withColumns({"__part": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND((1 << 33) - 1)})
    # range bounds come from a sample that may differ when a lost task is run again: numbers are fixed before they are used
    placed = kept(placed)
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__k"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__k").over(before), F.lit(0)).alias("__before"))  # one row per partition
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + F.col("__row") + 1).withColumnsRenamed({"__part": part} if part else {}).drop("__id", "__part", "__row", "__before")


def exact_quantiles(df: DataFrame, value: Column, levels: list[float], few: int | None = None) -> list[float | None]:
    """Exact quantiles of the non-null values, linear between neighbours; nulls without values.

    Up to ``few`` values go through one aggregation; more are ranked by range partitions, and two values for each level come to the driver.
    """
    x = df.select(value.cast("double").alias("x")).where("x is not null")
    n = x.count()
    if n <= (FEW if few is None else few):
        return list(x.agg(F.percentile("x", F.array(*map(F.lit, levels))).alias("q")).first()["q"] or [None] * len(levels))
    places = [level * (n - 1) for level in levels]
    wanted = sorted({k for p in places for k in (int(p) + 1, min(int(p) + 2, n))})
    at = {r["rank"]: r["x"] for r in global_rank(x, ["x"]).where(F.col("rank").isin(wanted)).collect()}
    return [at[int(p) + 1] * (1 - (p - int(p))) + at[min(int(p) + 2, n)] * (p - int(p)) for p in places]


def lag_diff(df: DataFrame, value: str, by: list[str], order: list[str], out: str = "diff") -> DataFrame:
    """W1"""
    return df.withColumn(out, F.col(value) - F.lag(value).over(Window.partitionBy(*by).orderBy(*order)))


def cum_sum(df: DataFrame, value: str, by: list[str], order: list[str], out: str = "cum") -> DataFrame:
    """W1"""
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def prune_distance(df: DataFrame, d: int, chr: str = "chr", pos: str = "pos", p: str = "p", marker: str = "marker") -> DataFrame:
    """Along a chromosome a gap of more than ``d`` begins a group; the best P of each group stays (the least marker on ties)."""
    best = F.min_by(F.struct(*(F.col(c) for c in df.columns)), F.struct(p, marker)).alias("best")
    return _clumped(df, d, chr, pos).groupBy(chr, "__begin").agg(best).select("best.*")


def _clumped(df: DataFrame, d: int, chr: str, pos: str) -> DataFrame:
    """``df`` with ``__begin``, the position at which its group begins: groups are cut at gaps of more than ``d``.

    Chromosomes are cut into cells, so that no task sorts a chromosome; a table of cells (one row each: first and last
    position, last begin) carries groups over the borders.
    """
    cell = F.floor(F.col(pos) / max(d, 1 << 18))
    inside = Window.partitionBy(chr, "__cell").orderBy(pos)
    before = F.lag(pos).over(inside)
    rows = df.withColumn("__cell", cell)
    # a row's begin if its group begins in the cell; rows before the first gap wait for the cell's border
    rows = rows.withColumn("__new", F.when(F.col(pos) - before > d, F.col(pos)))
    rows = rows.withColumn("__own", F.max("__new").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    cells = rows.groupBy(chr, "__cell").agg(F.min(pos).alias("lo"), F.max(pos).alias("hi"), F.max("__new").alias("last"))
    along = Window.partitionBy(chr).orderBy("__cell")
    gap = F.col("lo") - F.lag("hi").over(along)
    cells = cells.withColumn("first", F.when(gap.isNull() | (gap > d), F.col("lo")))
    reach = F.last(F.coalesce("last", "first"), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    borders = cells.withColumn("__border", F.coalesce("first", reach)).select(F.col(chr).alias("__chr"), F.col("__cell").alias("__at"), "__border")
    joined = rows.join(borders, F.col(chr).eqNullSafe(F.col("__chr")) & F.col("__cell").eqNullSafe(F.col("__at")))
    return joined.withColumn("__begin", F.coalesce("__own", "__border")).drop("__cell", "__new", "__own", "__chr", "__at", "__border")


def prune_distance_iter(df: DataFrame, d: int, rounds: int = 15, **names: str) -> DataFrame:
    """W2 over distances from d/100 to d, evenly spaced in logs; ends when a round at full distance changes nothing."""
    count = None
    for k in range(rounds):
        step = d if rounds == 1 else round(d / 100 * 100 ** (k / (rounds - 1)))
        df = kept(prune_distance(df, step, **names))
        if k % 5 == 4:
            now = df.count()
            if now == count and step == d:
                break
            count = now
    return df


def top_hits(df: DataFrame, n: int, region: int, p_limit: float | None = None, overshoot: int = 30, chr: str = "chr", pos: str = "pos", p: str = "p", marker: str = "marker") -> DataFrame:
    """Greedily the best P, without others closer than ``region`` on the chromosome (equal positions stay).

    With a P limit the candidates are all rows up to it, and every hit is returned; else they are the ``overshoot * n`` best rows, and ``n`` hits at most are
    returned (fewer, where these candidates lie in fewer regions). Candidates are cut at gaps of ``region`` or more, over which no hit reaches; each part is worked through alone.
    """
    narrow = df.select(F.col(chr).cast("int").alias("chr"), F.col(pos).cast("long").alias("pos"), F.col(p).alias("p"), F.col(marker).cast("long").alias("marker")).where("p is not null")
    candidates = narrow.where(F.col("p") <= p_limit) if p_limit is not None else narrow.orderBy("p", "marker").limit(overshoot * n)

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["p", "marker"]).reset_index(drop=True)
        place, kept, gone = rows["pos"].to_numpy(), [], np.zeros(len(rows), bool)
        for k in range(len(rows)):
            if gone[k]:
                continue
            kept.append(k)
            distance = abs(place - place[k])
            gone |= (distance > 0) & (distance < region)
        return rows.loc[kept]

    parts = _clumped(candidates, region - 1, "chr", "pos")
    names = candidates.columns
    hits = parts.groupBy("chr", "__begin").applyInPandas(lambda rows: greedy(rows[names]), candidates.schema)
    return hits.orderBy("p", "marker") if p_limit is not None else hits.orderBy("p", "marker").limit(n)


def genome_positions(df: DataFrame, chr: str = "chr", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """Rows with an absolute position, and (chr, start, end, mid) of each chromosome."""
    ends = df.groupBy(chr).agg(F.max(pos).alias("length"))
    before = Window.orderBy(chr).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))
    axis = starts.select(chr, "start", (F.col("start") + F.col("length")).alias("end"), (F.col("start") + F.col("length") / 2).alias("mid"))
    return df.join(F.broadcast(axis.select(chr, F.col("start").alias("__s"))), chr).withColumn("genome_pos", F.col("__s") + F.col(pos)).drop("__s"), axis


def qq_points(df: DataFrame, p: str = "p", tie: str = "marker", bottom: float = 1e-30) -> DataFrame:
    """Expected and observed -log10 P by rank; null P go, P outside [0, 1] raise."""
    clean = df.where(F.col(p).isNotNull()).withColumn("__p", F.when((F.col(p) < 0) | (F.col(p) > 1), F.raise_error(F.lit("P outside [0, 1]")).cast("double")).otherwise(F.greatest(F.col(p), F.lit(bottom))))
    n = clean.agg(F.count("*").alias("__n"))
    ranked = global_rank(clean.select("__p", tie), ["__p", tie], "rank")
    return ranked.join(F.broadcast(n)).select("rank", tie, (-F.log10(F.col("rank") / F.col("__n"))).alias("expected"), (-F.log10("__p")).alias("observed"))


def qq_points_by(df: DataFrame, group: str, p: str = "p", tie: str = "marker") -> DataFrame:
    """W6 within groups."""
    ranked = global_rank(df.where(F.col(p).isNotNull()).select(group, tie, p), [group, p, tie], "__rank")
    sizes = ranked.groupBy(F.col(group).alias("__g")).agg(F.min("__rank").alias("__first"), F.count("*").alias("__n"))
    rows = ranked.join(sizes, F.col(group).eqNullSafe(F.col("__g"))).withColumn("rank", F.col("__rank") - F.col("__first") + 1)
    return rows.select(group, "rank", tie, (-F.log10(F.col("rank") / F.col("__n"))).alias("expected"), (-F.log10(p)).alias("observed"))


def dedup_labels(df: DataFrame, col: str, order: list[str], sep: str = "-", counted: bool = False) -> DataFrame:
    """The k-th repeat of a label gets ``sep`` and k (first stays); ``counted`` numbers by occurrences (b, b:2, b:3)."""
    k = F.row_number().over(Window.partitionBy(col).orderBy(*order))
    number = k if counted else k - 1
    return df.withColumn(col, F.when(k == 1, F.col(col)).otherwise(F.concat(F.col(col), F.lit(sep), number.cast("string"))))


def bin_thin(df: DataFrame, x: str, y: str, bins: int, n: int, key: str, seed: int = 1) -> DataFrame:
    """At most n rows of each cell of a bins x bins grid, chosen by a seeded hash of the key."""
    ends = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    cell = lambda c, lo, hi: F.least(F.floor((F.col(c) - F.col(lo)) / F.nullif(F.col(hi) - F.col(lo), F.lit(0)) * bins), F.lit(bins - 1))
    placed = df.join(F.broadcast(ends)).withColumns({"cell_x": F.coalesce(cell(x, "x0", "x1"), F.lit(0)), "cell_y": F.coalesce(cell(y, "y0", "y1"), F.lit(0))})
    turn = F.row_number().over(Window.partitionBy("cell_x", "cell_y").orderBy(F.xxhash64(F.lit(seed), F.col(key)), key))
    return placed.withColumn("__k", turn).where(F.col("__k") <= n).drop("x0", "x1", "y0", "y1", "__k")


def order_rows(df: DataFrame, cols: list[str], na_last: bool = True, dictionary: dict[str, list] | None = None) -> DataFrame:
    """Order by columns; a dictionary column goes by its list, other values after it."""
    keys: list[Column] = []
    for c in cols:
        key = F.col(c)
        if dictionary and c in dictionary:
            place = F.array_position(F.array(*map(F.lit, dictionary[c])), F.col(c))
            key = F.when(place > 0, place).when(F.col(c).isNotNull(), F.lit(len(dictionary[c]) + 1))
        keys.append(key.asc_nulls_last() if na_last else key.asc_nulls_first())
    return df.orderBy(*keys)


def insert_order(df: DataFrame, col: str, reference: DataFrame, key: str, number: str, width: int = 6) -> DataFrame:
    """A zero-padded order column from an external list."""
    listed = reference.select(F.col(key).alias(col), F.lpad(F.col(number).cast("string"), width, "0").alias("order"))
    return df.join(listed, col, "left")


def order_align(reference: DataFrame, df: DataFrame, key: str, number: str) -> DataFrame:
    """Rows of ``df`` in the order in which the reference lists their keys."""
    return df.join(reference.select(key, F.col(number).alias("__at")), key).orderBy("__at").drop("__at")


def top_n(df: DataFrame, col: str, n: int, ascending: bool = True, tie: list[str] | None = None) -> DataFrame:
    """W12"""
    return df.orderBy(F.col(col).asc() if ascending else F.col(col).desc(), *(tie or [])).limit(n)


def which_max(df: DataFrame, col: str, index: str, last: bool = False) -> DataFrame:
    """Index of the maximum, first or last on ties."""
    order = F.struct(F.col(col), F.col(index) if last else -F.col(index))
    return df.agg(F.max_by(index, order).alias("at"))


def unique_by(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """The first row for each combination of values."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*cols).orderBy(*order))).where("__k = 1").drop("__k")


def quantile_bins(df: DataFrame, x: str, n: int, out: str = "bin") -> DataFrame:
    """Quantile bins 1..n, closed on the right; the least value is in the first."""
    cuts = exact_quantiles(df, F.col(x), [k / n for k in range(1, n)])
    place = sum(((F.col(x) > q).cast("int") for q in cuts if q is not None), F.lit(1))
    return df.withColumn(out, F.when(F.col(x).isNotNull(), place))


def quantile_normalize(reference: DataFrame, df: DataFrame, cols: list[str], key: str, points: int = 1001) -> DataFrame:
    """Each column takes the reference's quantile at its rank (ties: mean rank); nulls become the row's median. ``reference`` is one column."""
    levels = [k / (points - 1) for k in range(points)]
    grid = df.sparkSession.createDataFrame([(exact_quantiles(reference, F.col(reference.columns[0]), levels),)], "__g array<double>")  # one row
    filled = df.withColumn("__m", F.element_at(F.array_sort(F.filter(F.array(*cols), lambda x: x.isNotNull())), F.greatest(F.ceil(F.size(F.filter(F.array(*cols), lambda x: x.isNotNull())) / 2).cast("int"), F.lit(1))))
    long = filled.select(key, *(F.coalesce(c, "__m").alias(c) for c in cols)).unpivot([key], cols, "col", "x")
    # ranks over range partitions; a column's ranks follow those of the columns before it
    ranked = global_rank(long, ["col", "x", key], "__rank")
    ties = ranked.groupBy(F.col("col").alias("__c"), F.col("x").alias("__x")).agg(F.min("__rank").alias("__lo"), F.count("*").alias("__k"))
    ends = ranked.groupBy(F.col("col").alias("__e")).agg(F.min("__rank").alias("__first"), F.count("*").alias("__n"))  # one row a column
    met = ranked.join(ties, (F.col("col") == F.col("__c")) & F.col("x").eqNullSafe(F.col("__x"))).join(F.broadcast(ends), F.col("col") == F.col("__e"))
    place = F.col("__lo") - F.col("__first") + (F.col("__k") - 1) / 2
    placed = met.select(key, "col", (place / F.greatest(F.col("__n") - 1, F.lit(1))).alias("__u"))
    at = F.floor(F.col("__u") * (points - 1)).cast("int")
    part = F.col("__u") * (points - 1) - at
    value = F.get("__g", at) * (1 - part) + F.coalesce(F.get("__g", at + 1), F.get("__g", at)) * part
    out = placed.join(F.broadcast(grid)).withColumn("x", value)
    return out.groupBy(key).pivot("col", cols).agg(F.first("x"))


def quantile_normalize_medians(df: DataFrame, cols: list[str], key: str, around: int = 1) -> DataFrame:
    """The reference is made of the ``around`` columns on either side of the median of the column medians."""
    medians = {c: exact_quantiles(df, F.col(c), [0.5])[0] for c in cols}
    ordered = sorted(cols, key=lambda c: (medians[c], c))
    middle = len(ordered) // 2
    chosen = ordered[max(0, middle - around) : middle + around + 1]
    reference = df.select(F.explode(F.array(*chosen)).alias("x")).where("x is not null")
    return quantile_normalize(reference, df, cols, key)


def split_ranges(n: int, k: int) -> list[tuple[int, int]]:
    """K integer ranges (from 0, end exclusive) of nearly equal size."""
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


def split_seats(weights: list[float], seats: int) -> list[int]:
    """Seats by largest remainder."""
    total = sum(weights)
    exact = [w / total * seats for w in weights]
    out = [int(x) for x in exact]
    for i in sorted(range(len(exact)), key=lambda i: (out[i] - exact[i], i))[: seats - sum(out)]:
        out[i] += 1
    return out


def drop_duplicates_by(df: DataFrame, key: list[str], missing: str, tie: str) -> tuple[DataFrame, DataFrame]:
    """Of each duplicate key the row of least missingness is kept; (kept, excluded)."""
    ranked = df.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(missing, tie)))
    return ranked.where("__k = 1").drop("__k"), ranked.where("__k > 1").drop("__k")

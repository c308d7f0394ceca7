"""Quality control of individuals and markers (Q)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.operators import genotypes as G
from genoframe.operators.windows import kept


def _missing(gt: DataFrame, key: str, cutoff: float) -> DataFrame:
    rate = F.avg(F.col("gt").isNull().cast("double"))
    return gt.groupBy(key).agg(rate.alias("f_miss"), F.count("*").alias("n")).withColumn("excluded", (F.col("f_miss") > cutoff) | F.col("f_miss").isNull())


def missing_ind(gt: DataFrame, cutoff: float = 0.02) -> DataFrame:
    """Q1"""
    return _missing(gt, "iid", cutoff)


def missing_marker(gt: DataFrame, cutoff: float = 0.02) -> DataFrame:
    """Q2"""
    return _missing(gt, "marker", cutoff)


def inbreeding(gt: DataFrame, rule: str | None = None) -> DataFrame:
    """Q4: F = (observed - expected homozygotes) / (calls - expected); ``rule`` marks outliers (f, mean, sd are at hand)."""
    af = G.allele_freq(gt).select("marker", (1 - 2 * F.col("af") * (1 - F.col("af"))).alias("e"))
    rows = gt.where("gt is not null").join(af, "marker")
    out = rows.groupBy("iid").agg(F.count_if(F.col("gt") != 1).alias("o_hom"), F.sum("e").alias("e_hom"), F.count("*").alias("n"))
    out = out.withColumn("f", (F.col("o_hom") - F.col("e_hom")) / (F.col("n") - F.col("e_hom")))
    if rule is None:
        return out
    stats = out.agg(F.avg("f").alias("mean"), F.stddev_samp("f").alias("sd"))
    return out.join(F.broadcast(stats)).withColumn("outlier", F.expr(rule)).drop("mean", "sd")


def sex_check(gt: DataFrame, sample: DataFrame, female_below: float = 0.2, male_above: float = 0.8) -> DataFrame:
    """Q3: sex call from F on chromosome 23 against the recorded sex (1 male, 2 female)."""
    called = inbreeding(gt.where("chr = 23")).select("iid", "f", F.when(F.col("f") < female_below, 2).when(F.col("f") > male_above, 1).alias("called"))
    return sample.select("iid", "sex").join(called, "iid").withColumn("mismatch", F.coalesce(F.col("called") != F.col("sex"), F.lit(False)))


def sex_mixups(checked: DataFrame, most: int = 20) -> DataFrame:
    """Q3: of ``sex_check``: number and share of mismatches, the rate of mix-ups (twice that share, as half of them leave the sex as it was), and the ids, the least ``most`` of them."""
    ids = checked.where("mismatch").select("iid").orderBy("iid").limit(most).agg(F.array_join(F.array_sort(F.collect_list("iid")).cast("array<string>"), ", ").alias("ids"))
    counts = checked.agg(F.count("*").alias("n"), F.count_if("mismatch").alias("mismatches"))
    share = F.col("mismatches") / F.nullif(F.col("n"), F.lit(0))
    return counts.join(F.broadcast(ids)).select("n", "mismatches", share.alias("share"), (2 * share).alias("mixup"), "ids")


def heterozygosity(gt: DataFrame) -> DataFrame:
    """Q5"""
    return gt.groupBy("iid").agg((F.count_if(F.col("gt") == 1) / F.nullif(F.count("gt"), F.lit(0))).alias("het"))


def excl_maf(gt: DataFrame, cutoff: float = 0.01) -> DataFrame:
    """Q6"""
    return G.allele_freq(gt, minor=True).where(F.col("af").isNull() | (F.col("af") < cutoff)).select("marker")


def excl_hwe(gt: DataFrame, af_cut: float = 0.01, p_cut: float = 5e-7) -> DataFrame:
    """Q7: markers of chromosomes 1 to 22 with enough minor alleles and a small P."""
    tested = G.hwe(gt.where("chr <= 22"))
    af = (F.col("n1") + 2 * F.col("n2")) / (2 * (F.col("n0") + F.col("n1") + F.col("n2")))
    return tested.where((F.least(af, 1 - af) >= af_cut) & (F.col("p_hwe") < p_cut)).select("marker")


def hwe_by_missing(gt: DataFrame, floor: float = 1e-10) -> DataFrame:
    """Q8: one aggregation gives both sides of the points."""
    tested = G.hwe(gt)
    rate = F.col("n_missing") / (F.col("n0") + F.col("n1") + F.col("n2") + F.col("n_missing"))
    return tested.where("p_hwe is not null").select("marker", (-F.log10(F.greatest("p_hwe", F.lit(floor)))).alias("hwe"), (-F.log10(F.greatest(rate, F.lit(floor)))).alias("missing"))


#: Individuals of a block and markers of a chunk: a pair of blocks counts the markers of a chunk at a time.
PEOPLE = 1024
MARKERS = 4096
#: Meetings of two calls that are counted one by one cost as much as so many cells of a product of matrices.
CELLS = 300
#: Most meetings of a chunk that are listed.
LISTED = 1 << 23


def _packed_calls(gt: DataFrame) -> tuple[DataFrame, int]:
    """(own, chunk, ids, at, marker, g): the calls of each block of individuals in the order of their ids, by chunk of markers, as packed numbers; chunk -1 has the block's ids. Also the number of blocks."""
    from genoframe.operators.windows import global_rank, stored

    people = stored(global_rank(gt.select("iid").where("iid is not null").distinct(), ["iid"], "k").select("iid", F.expr(f"cast((k - 1) div {PEOPLE} as int)").alias("own"), ((F.col("k") - 1) % PEOPLE).cast("int").alias("at")))
    markers = global_rank(gt.where("gt in (0, 1, 2)").select("marker").distinct(), ["marker"], "m").select("marker", (F.col("m") - 1).alias("m"))
    calls = gt.where("gt in (0, 1, 2)").join(markers, "marker").join(people, "iid").select("own", F.expr(f"cast(m div {MARKERS} as int)").alias("chunk"), "at", (F.col("m") % MARKERS).cast("int").alias("marker"), F.col("gt").cast("int").alias("g"))
    kind = people.schema["iid"].dataType.simpleString()

    def pack(table: pa.Table) -> pa.Table:
        at, marker, g = (table.column(c).to_numpy() for c in ("at", "marker", "g"))
        _, first = np.unique(marker.astype(np.int64) * PEOPLE + at, return_index=True)
        packed = {c: pa.array([x[first].astype(t).tobytes()], pa.binary()) for c, x, t in (("at", at, "<i2"), ("marker", marker, "<i2"), ("g", g, "i1"))}
        return pa.table({"own": table.column("own")[:1], "chunk": table.column("chunk")[:1]} | packed)

    packs = calls.groupBy("own", "chunk").applyInArrow(pack, "own int, chunk int, at binary, marker binary, g binary")
    names = people.groupBy("own").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "iid"))), lambda x: x["iid"]).alias("ids")).withColumn("chunk", F.lit(-1))
    blocks = (people.agg(F.max("own")).first()[0] or 0) + 1
    return stored(names.unionByName(packs, allowMissingColumns=True).select("own", "chunk", F.col("ids").cast(f"array<{kind}>").alias("ids"), "at", "marker", "g")), blocks


def _counts(one: tuple, two: tuple, total: np.ndarray) -> None:
    """Adds to ``total`` (3, individuals, individuals) in how many markers of a chunk two blocks share 0 alleles, 2 alleles, or have calls. Calls (at, marker, g) are sorted by marker.

    Where few calls meet they are listed, elsewhere matrices are multiplied.
    """
    size1, size2 = total.shape[1:]
    starts = np.searchsorted(two[1], one[1])
    k = np.searchsorted(two[1], one[1], "right") - starts
    meetings = int(k.sum())
    if not meetings:
        return
    markers = np.unique(one[1][k > 0])
    if meetings <= LISTED and meetings * CELLS < len(markers) * size1 * size2:
        right = np.arange(meetings) + np.repeat(starts - np.append(0, np.cumsum(k)[:-1]), k)
        apart = np.abs(np.repeat(one[2], k) - two[2][right])
        # three counts side by side in a double, each below 2 ** 17
        found = np.bincount(np.repeat(one[0] * size2, k) + two[0][right], np.array([1 + 2.0**17, 1, 1 + 2.0**34])[apart], size1 * size2).astype(np.int64).reshape(size1, size2)
        total[0] += (found >> 34).astype(np.int32)
        total[1] += (found >> 17 & (1 << 17) - 1).astype(np.int32)
        total[2] += (found & (1 << 17) - 1).astype(np.int32)
        return
    planes = []
    for (at, marker, g), size in ((one, size1), (two, size2)):
        place = np.minimum(np.searchsorted(markers, marker), len(markers) - 1)
        met = markers[place] == marker
        plane = np.zeros((4, size, len(markers)), np.float32)
        # one allele, two alike, which of them, any call
        for row, value in zip(plane, (g == 1, g != 1, g - 1, g >= 0), strict=True):
            row[at[met], place[met]] = value[met]
        planes.append(plane)
    mixed, pure, signed, called = ((x @ y.T).astype(np.int32) for x, y in zip(*planes, strict=True))
    total[0] += (pure - signed) // 2
    total[1] += (pure + signed) // 2 + mixed
    total[2] += called


def pair_blocks(gt: DataFrame, found: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``found(a, b, ids of a, ids of b, counts)`` of each pair of blocks a <= b of individuals, which are in the order of their ids; counts (3, a, b) of markers with 0 and 2 shared alleles and with calls of both.

    A block's calls go to each other block once; a task streams the chunks of markers of one pair of blocks after the other.
    """
    packs, blocks = _packed_calls(gt)
    other = packs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = other.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "chunk", (F.col("own") > F.col("other")).cast("int").alias("side"), "ids", "at", "marker", "g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, ids, total, one = None, [None, None], None, None
        for batch in batches:
            for k, (a, b, chunk, side) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                if (a, b) != pair:
                    if pair is not None:
                        yield from found(*pair, *ids, total)
                    pair, total, one = (a, b), None, None
                if chunk < 0:
                    ids[side] = batch.column(4)[k].values
                    if a == b:
                        ids[1] = ids[0]
                    continue
                if total is None:
                    total = np.zeros((3, len(ids[0]), len(ids[1])), np.int32)
                calls = tuple(np.frombuffer(batch.column(c)[k].as_buffer(), t).astype(np.int64) for c, t in ((5, "<i2"), (6, "<i2"), (7, "i1")))
                if a == b:
                    _counts(calls, calls, total)
                elif side == 0:
                    one = (chunk, calls)
                elif one is not None and one[0] == chunk:
                    _counts(one[1], calls, total)
        if pair is not None:
            yield from found(*pair, *ids, total)

    tasks = max(int(gt.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks * (blocks + 1) // 2 // 16)
    return rows.repartition(tasks, "a", "b").sortWithinPartitions("a", "b", "chunk", "side").mapInArrow(run, schema)


def ibs_pairs(gt: DataFrame) -> DataFrame:
    """Q10: per pair of individuals the numbers of markers with 0, 1, 2 shared alleles, and the distance.

    Calls are compared block by block of individuals; nothing but calls is shuffled. The result has a row per pair by definition.
    """
    kind = gt.schema["iid"].dataType.simpleString()

    def listed(a: int, b: int, ids1: pa.Array, ids2: pa.Array, total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 16) // len(ids2))
        for lo in range(0, len(ids1), step):
            left = np.arange(lo, min(len(ids1), lo + step))
            i, j = np.repeat(left, len(ids2)), np.tile(np.arange(len(ids2)), len(left))
            if a == b:
                i, j = i[j > i], j[j > i]
            n0, n2, n = (np.zeros(len(i), np.int32),) * 3 if total is None else total[:, i, j] if a == b else total[:, left].reshape(3, -1)
            columns = [ids1.take(pa.array(i)), ids2.take(pa.array(j)), pa.array(n0), pa.array(n - n0 - n2), pa.array(n2)]
            yield pa.RecordBatch.from_arrays(columns, names=["id1", "id2", "ibs0", "ibs1", "ibs2"])

    out = pair_blocks(gt, listed, f"id1 {kind}, id2 {kind}, ibs0 int, ibs1 int, ibs2 int")
    return out.withColumn("distance", (F.col("ibs1") * 0.5 + F.col("ibs2")) / F.nullif(F.col("ibs0") + F.col("ibs1") + F.col("ibs2"), F.lit(0)))


def ibd_pairs(pairs: DataFrame, gt: DataFrame) -> DataFrame:
    """Q11: pi-hat by the method of moments: expected counts of shared alleles given 0 or 1 alleles by descent, from allele frequencies. Pairs without common markers have nulls."""
    p, q = F.col("af"), 1 - F.col("af")
    freq = G.allele_freq(gt).where("af > 0 and af < 1")
    sums = freq.agg(
        F.sum(2 * p * p * q * q).alias("e00"), F.sum(4 * p * p * p * q + 4 * p * q * q * q).alias("e10"), F.sum(F.pow(p, 4) + F.pow(q, 4) + 4 * p * p * q * q).alias("e20"),
        F.sum(2 * p * p * q + 2 * p * q * q).alias("e11"), F.sum(F.pow(p, 3) + F.pow(q, 3) + p * p * q + p * q * q).alias("e21"), F.count("*").alias("m"),
    )
    n = F.col("ibs0") + F.col("ibs1") + F.col("ibs2")
    share = F.nullif(n, F.lit(0)) / F.nullif(F.col("m"), F.lit(0))
    j = pairs.join(F.broadcast(sums))
    known = lambda c: F.when(share.isNotNull(), c)  # noqa: E731  (least and greatest skip nulls)
    z0 = known(F.least(F.col("ibs0") / (F.col("e00") * share), F.lit(1.0)))
    z1 = known(F.greatest(F.least((F.col("ibs1") - z0 * F.col("e10") * share) / (F.col("e11") * share), 1 - z0), F.lit(0.0)))
    return j.select("id1", "id2", z0.alias("z0"), z1.alias("z1"), (1 - z0 - z1).alias("z2"), (z1 / 2 + 1 - z0 - z1).alias("pi_hat"))


def ibs_filter(pairs: DataFrame, rule: str) -> DataFrame:
    """Q12: individuals of pairs that a rule picks."""
    return pairs.where(F.coalesce(F.expr(rule), F.lit(False))).select(F.explode(F.array("id1", "id2")).alias("id")).distinct()


def drop_nan_ids(pairs: DataFrame) -> DataFrame:
    """Q14: ids go, the one with the most missing distances first (smallest id on ties), until no pair lacks one.

    Only pairs that lack a distance matter. All ids that come before each of their partners in this order go in one round: counts only fall, and an id's
    own count falls by its partners only, so that it would go before any of them in any case. The ids that went are a table, never a list on the driver.
    """
    bad = kept(pairs.where("value is null or isnan(value)").select("id1", "id2"))
    gone = None
    while not bad.isEmpty():
        ends = bad.select(F.col("id1").alias("id"), F.col("id2").alias("other")).unionByName(bad.select(F.col("id2").alias("id"), F.col("id1").alias("other")))
        ranks = ends.groupBy("id").agg(F.struct((-F.count("*")).alias("k"), F.col("id").alias("at")).alias("rank"))
        against = ends.join(ranks, "id").join(ranks.select(F.col("id").alias("other"), F.col("rank").alias("other_rank")), "other")
        worst = kept(against.groupBy("id").agg(F.max(F.col("rank") > F.col("other_rank")).alias("later")).where("not later").select("id"))
        gone = worst if gone is None else gone.unionByName(worst)
        bad = kept(bad.join(worst.withColumnRenamed("id", "id1"), "id1", "left_anti").join(worst.withColumnRenamed("id", "id2"), "id2", "left_anti").select("id1", "id2"))
    if gone is None:
        return pairs
    return pairs.join(gone.withColumnRenamed("id", "id1"), "id1", "left_anti").join(gone.withColumnRenamed("id", "id2"), "id2", "left_anti").select(*pairs.columns)


def marker_totals(markers: DataFrame, baseline: DataFrame, excluded: DataFrame) -> DataFrame:
    """Q16: markers in all, after the baseline exclusions, after all of them."""
    flags = markers.select("marker").join(baseline.select("marker", F.lit(True).alias("b")).distinct(), "marker", "left").join(excluded.select("marker", F.lit(True).alias("e")).distinct(), "marker", "left")
    return flags.agg(F.count("*").alias("n_all"), F.count_if(F.col("b").isNull()).alias("n_baseline"), F.count_if(F.col("b").isNull() & F.col("e").isNull()).alias("n_post"))


def qc_report(gt: DataFrame, sample: DataFrame, ind_cut: float = 0.02, marker_cut: float = 0.02, maf: float = 0.01, p_hwe: float = 5e-7, most_ids: int = 0) -> DataFrame:
    """Q15: excluded numbers and shares by reason, and with ``most_ids`` the ids as text, the least so many of each."""
    parts = [
        ("individuals", "missing", missing_ind(gt, ind_cut).where("excluded").select(F.col("iid").alias("id")), sample.select("iid")),
        ("markers", "missing", missing_marker(gt, marker_cut).where("excluded").select(F.col("marker").alias("id")), gt.select("marker")),
        ("markers", "maf", excl_maf(gt, maf).select(F.col("marker").alias("id")), gt.select("marker")),
        ("markers", "hwe", excl_hwe(gt, maf, p_hwe).select(F.col("marker").alias("id")), gt.select("marker")),
    ]
    out = None
    for kind, reason, ids, everything in parts:
        row = ids.agg(F.count("*").alias("excluded")).join(F.broadcast(everything.agg(F.count_distinct(everything.columns[0]).alias("total"))))
        row = row.select(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"), "excluded", "total", (F.col("excluded") / F.col("total")).alias("share"))
        if most_ids:
            named = ids.select("id").orderBy("id").limit(most_ids).agg(F.array_join(F.array_sort(F.collect_list("id")).cast("array<string>"), ", ").alias("ids"))
            row = row.join(F.broadcast(named))
        out = row if out is None else out.unionByName(row)
    return out


def describe_variables(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q17: name, missing share, distribution as text: mean and deviation, or the 20 most frequent levels."""
    types = dict(df.dtypes)
    rows = None
    for c in cols:
        miss = F.avg(F.col(c).isNull().cast("double")).alias("missing")
        if types[c] == "string":
            counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n"))
            most = counts.orderBy(F.desc("n"), "v").limit(20)
            top = most.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "v"))), lambda x: F.concat(x["v"], F.lit(": "), (-x["k"]).cast("string"))), ", ").alias("distribution"))
            part = df.agg(miss).join(F.broadcast(top))
        else:
            part = df.agg(miss, F.format_string("mean %.4f, sd %.4f", F.avg(c), F.stddev_samp(c)).alias("distribution"))
        part = part.select(F.lit(c).alias("variable"), "missing", "distribution")
        rows = part if rows is None else rows.unionByName(part)
    return rows

"""Genotype operators on long tables (iid, marker, gt) with gt 0, 1, 2 copies or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators.windows import global_rank

SCORES = {"dominant": (0.0, 1.0, 1.0), "additive": (0.0, 0.5, 1.0), "recessive": (0.0, 0.0, 1.0)}


def _count(k: int, of: str = "gt") -> Column:
    return F.count_if(F.col(of) == k)


def gt_counts(gt: DataFrame, keys: tuple[str, ...] = ("marker",)) -> DataFrame:
    """n0, n1, n2 and the missing calls per marker."""
    return gt.groupBy(*keys).agg(*(_count(k).alias(f"n{k}") for k in range(3)), F.count_if(F.col("gt").isNull()).alias("n_missing"))


def allele_freq(gt: DataFrame, minor: bool = False) -> DataFrame:
    """Share of the counted allele among called alleles; null without calls; ``minor`` gives the smaller side."""
    calls = 2 * F.count("gt")
    af = F.when(calls > 0, F.sum("gt") / calls)
    return gt.groupBy("marker").agg((F.least(af, 1 - af) if minor else af).alias("af"), F.count("gt").alias("n"))


def hwe_column(n0: str = "n0", n1: str = "n1", n2: str = "n2") -> tuple[str, str]:
    """(chi-square, P) of Hardy-Weinberg equilibrium as SQL over genotype counts, one degree of freedom."""
    n = f"nullif({n0} + {n1} + {n2}, 0)"
    p = f"((2e0 * {n2} + {n1}) / (2e0 * {n}))"
    parts = [f"power({obs} - {n} * {exp}, 2) / ({n} * {exp})" for obs, exp in ((n2, f"{p} * {p}"), (n1, f"2e0 * {p} * (1e0 - {p})"), (n0, f"(1e0 - {p}) * (1e0 - {p})"))]
    chi = f"(case when {p} > 0 and {p} < 1 then {' + '.join(parts)} end)"
    return chi, S.chi2_sf(chi, 1)


def hwe(gt: DataFrame) -> DataFrame:
    chi, _ = hwe_column()
    counted = gt_counts(gt).withColumn("chi2", F.expr(chi))
    return counted.withColumn("p_hwe", F.expr(S.chi2_sf("chi2", 1)))


def hwe_multi(pairs: DataFrame) -> DataFrame:
    """K alleles, rows (marker, x, y) of unordered allele numbers; a zero expectation counts as 1; degrees of freedom pairs - alleles."""
    unordered = pairs.where("x is not null and y is not null").select("marker", F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    observed = unordered.groupBy("marker", "x", "y").agg(F.count("*").alias("obs"))
    alleles = unordered.select("marker", F.explode(F.array("x", "y")).alias("a")).groupBy("marker", "a").agg(F.count("*").alias("k"))
    n = F.sum("k").over(Window.partitionBy("marker"))
    freq = alleles.select("marker", "a", (F.col("k") / n).alias("f"), (n / 2).alias("n"))
    left, right = freq.select("marker", F.col("a").alias("x"), F.col("f").alias("fx"), "n"), freq.select("marker", F.col("a").alias("y"), F.col("f").alias("fy"))
    expected = left.join(right, "marker").where("x >= y").withColumn("exp", F.when(F.col("x") == F.col("y"), F.col("fx") * F.col("fy")).otherwise(2 * F.col("fx") * F.col("fy")) * F.col("n"))
    joined = expected.join(observed, ["marker", "x", "y"], "left").withColumn("obs", F.coalesce("obs", F.lit(0)))
    part = F.pow(F.col("obs") - F.col("exp"), 2) / F.when(F.col("exp") == 0, 1.0).otherwise(F.col("exp"))
    kinds = F.count_if(F.col("x") == F.col("y"))
    return joined.groupBy("marker").agg(F.sum(part).alias("chi2"), (F.count("*") - kinds).alias("df"))


def flip_minor(gt: DataFrame) -> DataFrame:
    """Markers whose allele is the major one are counted the other way round."""
    af = allele_freq(gt).select("marker", (F.col("af") > 0.5).alias("flipped"))
    return gt.join(af, "marker").withColumn("gt", F.when(F.col("flipped"), 2 - F.col("gt")).otherwise(F.col("gt")))


def dosage() -> Column:
    """G5"""
    return F.col("p_ab") + 2 * F.col("p_bb")


def gt_table(gt: DataFrame, y: str) -> DataFrame:
    """The 2 x 3 table of a binary phenotype: r0..r2 cases, s0..s2 controls."""
    case, control = F.col(y) == 1, F.col(y) == 0
    cells = [F.count_if(side & (F.col("gt") == k)).alias(f"{name}{k}") for name, side in (("r", case), ("s", control)) for k in range(3)]
    return gt.groupBy("marker").agg(*cells)


def gt_table_imputed(prob: DataFrame, y: str) -> DataFrame:
    """The same from expected counts; the third cell is the rest of those who have calls."""
    out = []
    for name, side in (("r", F.col(y) == 1), ("s", F.col(y) == 0)):
        called = side & (F.col("p_aa") + F.col("p_ab") + F.col("p_bb") > 0)
        first, second = F.sum(F.when(side, F.col("p_aa")).otherwise(0.0)), F.sum(F.when(side, F.col("p_ab")).otherwise(0.0))
        out += [first.alias(f"{name}0"), second.alias(f"{name}1"), (F.count_if(called) - first - second).alias(f"{name}2")]
    return prob.groupBy("marker").agg(*out)


def impute_mean(gt: DataFrame, model: str = "additive") -> DataFrame:
    """Missing calls get the marker's mean score; ``warn`` where more than 1 % were missing."""
    mean = gt.withColumn("score", score(F.col("gt"), model)).groupBy("marker").agg(F.avg("score").alias("mean"), (F.avg(F.col("gt").isNull().cast("double")) > 0.01).alias("warn"))
    return gt.join(mean, "marker").withColumn("score", F.coalesce(score(F.col("gt"), model), F.col("mean"))).drop("mean")


def score(gt: Column, model: str) -> Column:
    """G13"""
    none, one, two = SCORES[model]
    return F.when(gt == 0, none).when(gt == 1, one).when(gt == 2, two)


def is_monomorphic(gt: DataFrame) -> DataFrame:
    """G14"""
    return gt.groupBy("marker").agg((F.count_distinct("gt") == 1).alias("monomorphic"))


def descriptives(gt: DataFrame, markers: DataFrame) -> DataFrame:
    """G17"""
    total = F.col("n0") + F.col("n1") + F.col("n2")
    af = (F.col("n1") + 2 * F.col("n2")) / (2 * total)
    return hwe(gt).join(markers.select("marker", "a1", "a2"), "marker").select("marker", "a1", "a2", F.least(af, 1 - af).alias("maf"), (F.col("n_missing") / (total + F.col("n_missing"))).alias("missing"), "p_hwe")


def encode_alleles(pairs: DataFrame) -> DataFrame:
    """Rows (marker, iid, a, b) of allele letters, '0' missing, to (x, y, code): allele numbers by alphabet per marker, null where missing."""
    letters = pairs.select("marker", F.explode(F.array("a", "b")).alias("letter")).where("letter <> '0'").distinct()
    ordered = letters.groupBy("marker").agg(F.array_sort(F.collect_set("letter")).alias("letters"))
    joined = pairs.join(ordered, "marker")
    number = lambda c: F.when(F.col(c) != "0", F.array_position("letters", F.col(c)) - 1)
    coded = joined.select("marker", "iid", number("a").alias("x"), number("b").alias("y"), "letters")
    return coded.withColumn("code", F.expr(S.pair_enc("x", "y")).cast("long"))


def decode_alleles(coded: DataFrame) -> DataFrame:
    """G2 back: the larger allele first."""
    pair = S.pair_dec(F.col("code"))
    letter = lambda k: F.coalesce(F.get("letters", pair[k].cast("int")), F.lit("0"))
    return coded.select("marker", "iid", letter("x").alias("a"), letter("y").alias("b"))


def recode_char(df: DataFrame, reference: str | None = None) -> DataFrame:
    """Genotypes ``AB`` as text to copies of the minor allele (or of the one that is not ``reference``); ties count the later letter."""
    alleles = df.where("length(g) = 2").select("marker", F.explode(F.split("g", "")).alias("a")).where("a <> ''")
    counts = alleles.groupBy("marker", "a").agg(F.count("*").alias("n"))
    minor = counts.groupBy("marker").agg(F.min(F.struct("n", F.negative(F.ascii("a")).alias("o"), "a"))["a"].alias("counted"), F.count("*").alias("k")) if reference is None else None
    if minor is None:
        return df.withColumn("gt", F.when(F.length("g") == 2, F.length(F.replace(F.col("g"), F.lit(reference), F.lit("")))))
    return df.join(minor, "marker").withColumn("gt", F.when(F.length("g") == 2, F.when(F.col("k") > 1, 2 - F.length(F.replace(F.col("g"), F.col("counted"), F.lit("")))).otherwise(0))).drop("counted", "k")


def ld(pairs: DataFrame) -> DataFrame:
    """(p11, p1, q1) to D, D' and r."""
    d = F.col("p11") - F.col("p1") * F.col("q1")
    most = F.when(d >= 0, F.least(F.col("p1") * (1 - F.col("q1")), (1 - F.col("p1")) * F.col("q1"))).otherwise(F.least(F.col("p1") * F.col("q1"), (1 - F.col("p1")) * (1 - F.col("q1"))))
    return pairs.withColumns({"d": d, "d_prime": F.when(most > 0, d / most), "r": d / F.sqrt(F.col("p1") * (1 - F.col("p1")) * F.col("q1") * (1 - F.col("q1")))})


def merge_gt(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two sets; calls that differ become null."""
    return a.unionByName(b).groupBy("iid", "marker").agg(F.when(F.min("gt") == F.max("gt"), F.min("gt")).alias("gt"))


def genotype_matrix(prob: DataFrame, markers: list[int]) -> DataFrame:
    """Dosages by individual, one column per marker of a short list."""
    return prob.where(F.col("marker").isin(markers)).groupBy("iid").pivot("marker", markers).agg(F.first(dosage()))


def genotype_blocks(prob: DataFrame, width: int = 64) -> DataFrame:
    """G6 for all markers: (iid, block, dosages), blocks of ``width`` markers in the order of their numbers.

    ``dosages`` has a place for each of the block's markers, null where the individual has no call or there are no more markers; of repeated calls the least counts.
    An individual without any call in a block has no row there. A row is bounded by ``width``, whatever the number of markers."""
    ranks = global_rank(prob.select("marker").where("marker is not null").distinct(), ["marker"], "__rank")
    numbered = ranks.select("marker", F.expr(f"(__rank - 1) div {width}").alias("block"), ((F.col("__rank") - 1) % width).cast("int").alias("__place"))
    calls = prob.join(numbered, "marker").groupBy("iid", "block", "__place").agg(F.min(dosage()).alias("__dosage"))
    cells = calls.where("__dosage is not null").groupBy("iid", "block").agg(F.map_from_entries(F.collect_list(F.struct("__place", "__dosage"))).alias("m"))
    return cells.select("iid", "block", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.element_at("m", k)).alias("dosages"))


def alleles_to_gens(tped: DataFrame) -> DataFrame:
    """G1: (marker, chr, iid, a, b) with '0' missing to probabilities; markers without calls go; one allele alone is shown twice."""
    letters = tped.select("marker", F.explode(F.array("a", "b")).alias("x")).where("x <> '0'").groupBy("marker").agg(F.array_sort(F.collect_set("x")).alias("alleles"))
    rows = tped.join(letters, "marker")
    first, second = F.get("alleles", F.lit(0)), F.coalesce(F.get("alleles", F.lit(1)), F.get("alleles", F.lit(0)))
    count = (F.col("a") == second).cast("int") + (F.col("b") == second).cast("int")
    called = (F.col("a") != "0") & (F.col("b") != "0")
    mono = F.size("alleles") == 1
    part = lambda k: F.when(~called, 0.0).when(mono, 1.0 if k == 0 else 0.0).otherwise((count == k).cast("double"))
    return rows.select(F.format_string("snp-%03d-%d", F.col("marker").cast("int"), F.col("chr")).alias("snp"), "marker", "iid", first.alias("a0"), second.alias("a1"), part(0).alias("p_aa"), part(1).alias("p_ab"), part(2).alias("p_bb"))


def chunk_plan(markers: DataFrame, size: int = 4_000_000, buffer: int = 250_000) -> DataFrame:
    """Per chromosome ceil(length / size) chunks [start, stop] with an overlapping buffer on both sides."""
    ends = markers.groupBy("chr").agg(F.max("pos").alias("length"))
    number = F.explode(F.sequence(F.lit(0).cast("long"), (F.ceil(F.col("length") / size) - 1).cast("long"))).alias("chunk")
    chunks = ends.select("chr", "length", number)
    return chunks.select("chr", "chunk", (F.col("chunk") * size + 1).alias("start"), F.least(F.col("chunk") * size + size, F.col("length")).alias("stop"), F.greatest(F.col("chunk") * size + 1 - buffer, F.lit(1)).alias("from"), (F.col("chunk") * size + size + buffer).alias("to"))


def split_chunks(markers: DataFrame, chunks: int) -> DataFrame:
    """Chunks dealt to chromosomes by their number of markers (largest remainder, one at least), markers cut evenly by position."""
    per = markers.groupBy("chr").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    exact = per.withColumn("quota", F.col("n") * chunks / total).withColumn("seats", F.floor("quota"))
    rest = F.lit(chunks) - F.sum("seats").over(Window.partitionBy())
    order = F.row_number().over(Window.partitionBy().orderBy((F.col("quota") - F.col("seats")).desc(), "chr"))
    seats = exact.withColumn("rest", rest).withColumn("place", order).select("chr", F.greatest(F.col("seats") + (F.col("place") <= F.col("rest")).cast("int"), F.lit(1)).alias("seats"), "n")
    ranked = markers.withColumn("k", F.row_number().over(Window.partitionBy("chr").orderBy("pos", "marker")) - 1)
    return ranked.join(F.broadcast(seats), "chr").select("chr", "marker", "pos", F.floor(F.col("k") * F.col("seats") / F.col("n")).cast("long").alias("chunk"))


def to_founders(fam: DataFrame) -> DataFrame:
    """Every individual a family of its own, numbered by iid; parents 0. Numbers come from range partitions and offsets."""
    from genoframe.operators.windows import global_rank

    return global_rank(fam, ["iid"], "new_fid").select("iid", F.col("new_fid").alias("fid"), F.lit("0").alias("pid"), F.lit("0").alias("mid"))


def mendel_errors(fam: DataFrame, gt: DataFrame) -> DataFrame:
    """Per marker, trios whose child can't have its genotype from its parents'."""
    calls = gt.select("iid", "marker", "gt").where("gt is not null")
    child = fam.where("pid is not null and mid is not null").join(calls, "iid")
    father = calls.select(F.col("iid").alias("pid"), "marker", F.col("gt").alias("f"))
    mother = calls.select(F.col("iid").alias("mid"), "marker", F.col("gt").alias("m"))
    trio = child.join(father, ["pid", "marker"]).join(mother, ["mid", "marker"])
    least = (F.col("f") == 2).cast("int") + (F.col("m") == 2).cast("int")
    most = (F.col("f") > 0).cast("int") + (F.col("m") > 0).cast("int")
    return trio.groupBy("marker").agg(F.count("*").alias("trios"), F.count_if((F.col("gt") < least) | (F.col("gt") > most)).alias("errors"))


def extract_genotypes(df: DataFrame, key: str, pattern: str, missing_rate: float = 1.0) -> DataFrame:
    """Columns whose name matches ``pattern`` (one group: the marker; two columns of a marker are its alleles) to (key, marker, a, b); markers with
    a larger share of missing calls go. One column holds both alleles as ``AB`` or ``A/B``."""
    import re

    found: dict[str, list[str]] = {}
    for c in df.columns:
        if m := re.fullmatch(pattern, c):
            found.setdefault(m[1], []).append(c)
    if not found:
        raise ValueError(f"no column matches {pattern!r}")
    rows = []
    for name, cols in found.items():
        if len(cols) == 2:
            a, b = (F.col(f"`{c}`") for c in cols)
        else:
            plain = F.replace(F.col(f"`{cols[0]}`"), F.lit("/"), F.lit(""))
            a, b = F.substring(plain, 1, 1), F.substring(plain, 2, 1)
        rows.append(F.struct(F.lit(name).alias("marker"), F.coalesce(F.nullif(a, F.lit("")), F.lit("0")).alias("a"), F.coalesce(F.nullif(b, F.lit("")), F.lit("0")).alias("b")))
    long = df.select(key, F.explode(F.array(*rows)).alias("x")).select(key, "x.*")
    if missing_rate >= 1:
        return long
    kept = long.groupBy("marker").agg(F.avg(((F.col("a") == "0") | (F.col("b") == "0")).cast("double")).alias("m")).where(F.col("m") <= missing_rate)
    return long.join(kept.select("marker"), "marker", "left_semi")


def group_haplotypes(df: DataFrame, haplotype: str, cutoff: float, other: str = "rare") -> DataFrame:
    """Haplotypes below a frequency become one group."""
    counts = df.where(F.col(haplotype).isNotNull()).groupBy(haplotype).agg(F.count("*").alias("__k"))
    total = counts.agg(F.sum("__k").alias("__n"))
    named = counts.join(F.broadcast(total)).select(haplotype, F.when(F.col("__k") / F.col("__n") < cutoff, F.lit(other)).otherwise(F.col(haplotype)).alias("group"))
    return df.join(named, haplotype, "left")


def haplotype_dosage(df: DataFrame, key: str, haplotypes: list[str], first: str = "h1", second: str = "h2") -> DataFrame:
    """Copies of each listed haplotype per individual (two haplotype columns)."""
    copies = [((F.col(first) == h).cast("int") + (F.col(second) == h).cast("int")).alias(f"n_{h}") for h in haplotypes]
    return df.select(key, *copies)


def flip_to_ref(gt: DataFrame, aligned: DataFrame) -> DataFrame:
    """Calls turned where alleles are swapped against the reference; incompatible markers go (``aligned`` as of ``align_alleles``)."""
    kinds = aligned.where("kind <> 'incompatible'").select(F.col("snp").alias("marker"), F.col("kind").isin("swapped", "flip_swapped").alias("__turn"))
    return gt.join(kinds, "marker").withColumn("gt", F.when(F.col("__turn"), 2 - F.col("gt")).otherwise(F.col("gt"))).drop("__turn")


def reorder(markers: DataFrame) -> DataFrame:
    """Place of each marker by chromosome and position."""
    return markers.withColumn("place", F.row_number().over(Window.partitionBy("chr").orderBy("pos", "marker")))


def split_chr(df: DataFrame, path: str) -> DataFrame:
    """One folder per chromosome; gives the sorted list of chromosomes."""
    df.write.mode("overwrite").partitionBy("chr").parquet(path)
    return df.sparkSession.read.parquet(path).select("chr").distinct().orderBy("chr")


def rename_snps(df: DataFrame, pattern: str, replacement: str, col: str = "id", order: str = "line") -> DataFrame:
    """Ids by a regular expression, repeats numbered."""
    from genoframe.operators.windows import dedup_labels

    return dedup_labels(df.withColumn(col, F.regexp_replace(col, pattern, replacement)), col, [order])


def pedigree_stats(fam: DataFrame) -> DataFrame:
    """(iid, sex by role, offspring, depth, family): depth is 0 for founders, else one more than the deeper parent; families are connected components."""
    from genoframe.operators.reshape import components
    from genoframe.operators.windows import kept

    parents = fam.select(F.col("pid").alias("p"), F.lit(1).alias("sex")).unionByName(fam.select(F.col("mid").alias("p"), F.lit(2).alias("sex"))).where("p is not null")
    roles = parents.groupBy(F.col("p").alias("iid")).agg(F.min("sex").alias("sex"), F.count("*").alias("offspring"))
    links = fam.select(F.col("iid").alias("a"), F.explode(F.array("pid", "mid")).alias("b")).where("b is not null")
    family = components(links)
    depth = kept(fam.select("iid", F.when(F.col("pid").isNull() & F.col("mid").isNull(), 0).alias("depth")))
    while True:
        known = depth.where("depth is not null")
        open_ = fam.join(depth.where("depth is null").select("iid"), "iid", "left_semi")
        up = open_.select("iid", F.explode(F.array_compact(F.array("pid", "mid"))).alias("p")).join(known.select(F.col("iid").alias("p"), F.col("depth").alias("d")), "p", "left")
        ready = up.groupBy("iid").agg(F.count("*").alias("n"), F.count("d").alias("k"), F.max("d").alias("d")).where("n = k").select("iid", (F.col("d") + 1).alias("new"))
        after = kept(depth.join(ready, "iid", "left").select("iid", F.coalesce("depth", "new").alias("depth")))
        if after.where("depth is null").count() == depth.where("depth is null").count():
            break
        depth = after
    out = fam.select("iid").join(roles, "iid", "left").join(after, "iid", "left").join(family.select(F.col("node").alias("iid"), F.col("root").alias("family")), "iid", "left")
    return out.select("iid", "sex", F.coalesce("offspring", F.lit(0)).alias("offspring"), "depth", F.coalesce("family", "iid").alias("family"))


def unique_iid(fam: DataFrame, sep: str = ":") -> DataFrame:
    """G30"""
    return fam.withColumn("iid", F.concat_ws(sep, F.col("fid").cast("string"), F.col("iid").cast("string")))

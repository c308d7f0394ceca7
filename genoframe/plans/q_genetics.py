"""Queries of the genotype layer, quality control and association: G, Q, T, D and the entry slice."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators import assoc as T
from genoframe.operators import cox as C
from genoframe.operators import genotypes as G
from genoframe.operators import ld as LD
from genoframe.operators import permute as P
from genoframe.operators import qc as Q
from genoframe.operators import scaling as M
from genoframe.operators import udf as D
from genoframe.plans import fixtures as X
from genoframe.plans import tails

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _with_y(s, d):
    """Genotypes with the individuals' phenotypes; individuals are one row each."""
    return X.gt(s, d).join(X.sample(s, d).select("iid", "y", "cc", "age", "strat", "fid"), "iid")


def _prob_y(s, d):
    return X.prob(s, d).join(X.sample(s, d).select("iid", "y", "cc", "age"), "iid")


def _rounded(df, n: int, *cols: str):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), n) for c in cols})


_COUNTS = f"select marker, min(chr) as chr, min(pos) as pos, count(*) filter (where gt = 0) as n0, count(*) filter (where gt = 1) as n1, count(*) filter (where gt = 2) as n2, count(*) filter (where gt is null) as n_missing from ({X.GT}) g group by marker"
_TAB = "select marker, " + ", ".join(f"count(*) filter (where cc = {c} and gt = {k}) as {n}{k}" for n, c in (("r", 1), ("s", 0)) for k in range(3)) + f" from ({X.GT}) g join ({X.SAMPLE}) s using (iid) group by marker"
_CHI, _ = G.hwe_column()
_AF = "(n1 + 2 * n2) / (2 * (n0 + n1 + n2))"
# oracle side, written anew: Hardy-Weinberg by the inbreeding coefficient, N * (1 - heterozygotes / expected heterozygotes)^2; trend and allele tests as N * r^2
_HWE = f"select *, case when n1 + 2 * n2 > 0 and n1 + 2 * n0 > 0 then (n0 + n1 + n2) * power(1 - n1 / ((n0 + n1 + n2) * 2 * {_AF} * (1 - {_AF})), 2) end as chi from ({_COUNTS})"
_CALLS = f"select marker, gt, cc from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null"
_TREND = f"select marker, case when stddev_pop(gt) > 0 and stddev_pop(cc) > 0 then count(*) * power(corr(gt, cc), 2) end as chi2 from ({_CALLS}) group by 1"
_ALLELES = f"select marker, case when stddev_pop(a) > 0 and stddev_pop(cc) > 0 then count(*) * power(corr(a, cc), 2) end as chi2 from (select marker, cc, unnest([cast(gt = 2 as int), cast(gt >= 1 as int)]) as a from ({_CALLS})) group by 1"


@query(
    "slice_top_hits",
    f"""with c as ({_HWE}), h as (select *, {tails.chi2("chi", 1)} as p_hwe, {_AF} as af, n_missing / (n0 + n1 + n2 + n_missing) as miss from c), t as ({_TREND})
 select marker, chr, pos, round(af, 6) as af, round(miss, 6) as f_miss, round(chi2, 5) as chi2 from h join t using (marker) where miss <= 0.04e0 and least(af, 1 - af) >= 0.01e0 and not (chr <= 22 and p_hwe < 5e-7) order by chi2 desc, marker limit 20""",
)
def slice_top_hits(s, d):
    """One pass over the genotypes gives counts by case and control; everything after it has one row per marker."""
    cells = [F.count_if((F.col("cc") == c) & (F.col("gt") == k)).alias(f"{n}{k}") for n, c in (("r", 1), ("s", 0)) for k in range(3)]
    g = _with_y(s, d).groupBy("marker").agg(F.min("chr").alias("chr"), F.min("pos").alias("pos"), *cells, *(F.count_if(F.col("gt") == k).alias(f"n{k}") for k in range(3)), F.count_if(F.col("gt").isNull()).alias("n_missing"))
    g = g.withColumns({"af": F.expr(_AF), "f_miss": F.expr("n_missing / (n0 + n1 + n2 + n_missing)"), "chi": F.expr(_CHI)}).withColumns({"p_hwe": F.expr(S.chi2_sf("chi", 1)), "chi2": F.expr(T.armitage()[0])})
    kept = g.where("f_miss <= 0.04e0 and least(af, 1 - af) >= 0.01e0 and not (chr <= 22 and p_hwe < 5e-7)")
    top = kept.orderBy(F.desc("chi2"), "marker").limit(20)
    return _rounded(top.select("marker", "chr", "pos", "af", "f_miss", "chi2"), 6, "af", "f_miss").withColumn("chi2", F.round("chi2", 5))


# --- genotypes


@query("g01_alleles_to_gens", f"select 'snp-' || lpad(cast(marker as varchar), 3, '0') || '-' || cast(chr as varchar) as snp, case when count(*) filter (where gt < 2) = 0 then count(gt) else count(*) filter (where gt = 0) end as k from ({X.GT}) g group by 1 having count(gt) > 0")
def _(s, d):
    g = X.gt(s, d)
    t = g.select("marker", "chr", "iid", F.when(F.col("gt").isNull(), "0").when(F.col("gt") == 2, "C").otherwise("A").alias("a"), F.when(F.col("gt").isNull(), "0").when(F.col("gt") == 0, "A").otherwise("C").alias("b"))
    return G.alleles_to_gens(t).groupBy("snp").agg(F.sum("p_aa").cast("long").alias("k"))


_PAIRS = f"select marker, iid, case when gt is null then '0' when gt = 2 then 'T' else 'C' end as a, case when gt is null then '0' when gt = 0 then 'C' else 'T' end as b from ({X.GT}) g"


def _pairs(s, d):
    g = F.col("gt")
    return X.gt(s, d).select("marker", "iid", F.when(g.isNull(), "0").when(g == 2, "T").otherwise("C").alias("a"), F.when(g.isNull(), "0").when(g == 0, "C").otherwise("T").alias("b"))


@query("g02_encode", f"with p as ({_PAIRS}), c as (select marker, max(cast(a = 'C' or b = 'C' as int)) as both from p group by 1 having max(a) <> '0') select p.marker, iid, case when a <> '0' then (cast(a = 'T' as int) + cast(b = 'T' as int)) * c.both end as code from p join c on c.marker = p.marker")
def _(s, d):
    return G.encode_alleles(_pairs(s, d)).select("marker", "iid", F.col("code").cast("int").alias("code"))


@query("g02_decode", f"select marker, iid, greatest(a, b) as a, least(a, b) as b from ({_PAIRS})")
def _(s, d):
    return G.decode_alleles(G.encode_alleles(_pairs(s, d)))


@query("g03_recode_char", f"with p as (select marker, iid, case when a <> '0' then a || b end as g, a, b from ({_PAIRS})), n as (select marker, sum(case when a = 'T' then 1 else 0 end + case when b = 'T' then 1 else 0 end) as t, sum(case when a = 'C' then 1 else 0 end + case when b = 'C' then 1 else 0 end) as c from p group by 1) select p.marker, iid, cast(case when g is null then null when n.t <= n.c then case when a = 'T' then 1 else 0 end + case when b = 'T' then 1 else 0 end else case when a = 'C' then 1 else 0 end + case when b = 'C' then 1 else 0 end end as int) as gt from p join n on n.marker = p.marker")
def _(s, d):
    return G.recode_char(_pairs(s, d).select("marker", "iid", F.when(F.col("a") != "0", F.concat("a", "b")).alias("g"))).select("marker", "iid", F.col("gt").cast("int").alias("gt"))


@query("g05_dosage", f"select marker, round(sum(p_ab + 2 * p_bb), 4) as dosage from ({X.PROB}) p group by 1")
def _(s, d):
    return X.prob(s, d).groupBy("marker").agg(F.round(F.sum(G.dosage()), 4).alias("dosage"))


@query("g06_genotype_matrix", f"select iid, round(max(p_ab + 2 * p_bb) filter (where marker = 3), 6) as \"3\", round(max(p_ab + 2 * p_bb) filter (where marker = 5), 6) as \"5\" from ({X.PROB}) p where marker in (3, 5) group by 1")
def _(s, d):
    return _rounded(G.genotype_matrix(X.prob(s, d), [3, 5]), 6, "3", "5")


@query("g06_genotype_blocks", f"""with p as (select iid, marker, cast(round(10 * (p_ab + 2 * p_bb)) as bigint) as dose from ({X.PROB}) x), m as (select marker, row_number() over (order by marker) - 1 as k from (select distinct marker from p) y),
 c as (select iid, k // 64 as block, k % 64 as place, dose from p join m using (marker)), b as (select iid, block, place from (select distinct iid, block from c) z, (select unnest(range(64)) as place) r)
 select iid, block, string_agg(coalesce(cast(dose as varchar), 'NA'), ' ' order by place) as dosages from b left join c using (iid, block, place) group by 1, 2""")
def _(s, d):
    """The matrix of all markers, 64 to a row, in tenths."""
    out = G.genotype_blocks(X.prob(s, d))
    shown = F.transform("dosages", lambda x: F.coalesce(F.round(10 * x).cast("long").cast("string"), F.lit("NA")))
    return out.select("iid", "block", F.array_join(shown, " ").alias("dosages"))


@query("g07_allele_freq", f"select marker, round({_AF}, 8) as af, n0 + n1 + n2 as n from ({_COUNTS})")
def _(s, d):
    return _rounded(G.allele_freq(X.gt(s, d)), 8, "af")


@query("g08_flip_minor", f"with c as (select marker, {_AF} > 0.5 as flipped from ({_COUNTS})) select marker, max(flipped) as flipped, cast(sum(case when flipped then 2 - gt else gt end) as bigint) as k from ({X.GT}) g join c using (marker) group by 1")
def _(s, d):
    return G.flip_minor(X.gt(s, d)).groupBy("marker").agg(F.max("flipped").alias("flipped"), F.sum("gt").alias("k"))


@query("g09_gt_counts", f"select marker, n0, n1, n2, n_missing from ({_COUNTS})")
def _(s, d):
    return G.gt_counts(X.gt(s, d))


@query("g10_gt_table", _TAB)
def _(s, d):
    return G.gt_table(_with_y(s, d), "cc")


_ITAB = "select marker, " + ", ".join(f"sum(case when cc = {c} then p_aa else 0 end) as {n}0, sum(case when cc = {c} then p_ab else 0 end) as {n}1, count(*) filter (where cc = {c} and p_aa + p_ab + p_bb > 0) - sum(case when cc = {c} then p_aa else 0 end) - sum(case when cc = {c} then p_ab else 0 end) as {n}2" for n, c in (("r", 1), ("s", 0))) + f" from ({X.PROB}) p join ({X.SAMPLE}) s using (iid) group by marker"


@query("g11_gt_table_imputed", "select marker, " + ", ".join(f"round({n}{k}, 4) as {n}{k}" for n in "rs" for k in range(3)) + f" from ({_ITAB})")
def _(s, d):
    return _rounded(G.gt_table_imputed(_prob_y(s, d), "cc"), 4, *(f"{n}{k}" for n in "rs" for k in range(3)))


@query("g12_impute_mean", f"with m as (select marker, avg(gt * 0.5e0) as m, avg(cast(gt is null as double)) > 0.01 as warn from ({X.GT}) g group by 1) select marker, round(sum(coalesce(gt * 0.5e0, m)), 4) as score, max(warn) as warn from ({X.GT}) g join m using (marker) group by 1")
def _(s, d):
    return G.impute_mean(X.gt(s, d)).groupBy("marker").agg(F.round(F.sum("score"), 4).alias("score"), F.max("warn").alias("warn"))


@query("g13_scores", f"select marker, cast(sum(case gt when 0 then 0 else 1 end) filter (where gt is not null) as double) as dominant, cast(sum(case gt when 2 then 1 else 0 end) filter (where gt is not null) as double) as recessive from ({X.GT}) g group by 1")
def _(s, d):
    return X.gt(s, d).groupBy("marker").agg(F.sum(G.score(F.col("gt"), "dominant")).alias("dominant"), F.sum(G.score(F.col("gt"), "recessive")).alias("recessive"))


@query("g14_monomorphic", f"select marker, count(distinct gt) = 1 as monomorphic from ({X.GT}) g group by 1")
def _(s, d):
    return G.is_monomorphic(X.gt(s, d))


@query("g15_hwe", f"with c as ({_HWE}) select marker, round(chi, 5) as chi2, round({tails.chi2('chi', 1)}, 6) as p_hwe from c")
def _(s, d):
    return G.hwe(X.gt(s, d)).select("marker", F.round("chi2", 5).alias("chi2"), F.round("p_hwe", 6).alias("p_hwe"))


@query("g16_hwe_multi", f"with c as ({_HWE}) select marker, round(chi, 5) as chi2, cast(1 as bigint) as df from c where chi is not null")
def _(s, d):
    g = F.col("gt")
    p = X.gt(s, d).select("marker", F.when(g == 2, 1).when(g.isNotNull(), 0).alias("x"), F.when(g >= 1, 1).when(g.isNotNull(), 0).alias("y"))
    return _rounded(G.hwe_multi(p).where("df > 0"), 5, "chi2")


@query("g17_descriptives", f"with c as ({_HWE}) select c.marker, a1, a2, round(least({_AF}, 1 - {_AF}), 6) as maf, round(n_missing / (n0 + n1 + n2 + n_missing), 6) as missing, round({tails.chi2('chi', 1)}, 6) as p_hwe from c join ({X.MARKER}) m using (marker)")
def _(s, d):
    return _rounded(G.descriptives(X.gt(s, d), X.marker(s, d)), 6, "maf", "missing", "p_hwe")


@query("g19_ld", "select p_partkey, round(p11 - p1 * q1, 8) as d, round((p11 - p1 * q1) / sqrt(p1 * (1 - p1) * q1 * (1 - q1)), 7) as r from (select p_partkey, 0.2e0 + p_size / 500e0 as p11, 0.4e0 + p_size / 400e0 as p1, 0.3e0 + p_size / 300e0 as q1 from part)")
def _(s, d):
    t = X.table(s, d, "part").select("p_partkey", (0.2 + F.col("p_size") / 500).alias("p11"), (0.4 + F.col("p_size") / 400).alias("p1"), (0.3 + F.col("p_size") / 300).alias("q1"))
    return G.ld(t).select("p_partkey", F.round("d", 8).alias("d"), F.round("r", 7).alias("r"))


@query("g21_merge_gt", f"select iid, marker, case when marker % 3 = 0 and gt is not null then null else gt end as gt from ({X.GT}) g")
def _(s, d):
    g = X.gt(s, d).select("iid", "marker", "gt")
    return G.merge_gt(g, g.where("marker % 3 = 0").withColumn("gt", ((F.col("gt") + 1) % 3).cast("int")))


@query("g24_split_chunks", f"""with m as ({X.MARKER}), c as (select chr, count(*) as n, count(*) * 64 / sum(count(*)) over () as quota from m group by 1), f as (select *, 64 - sum(floor(quota)) over () as rest, row_number() over (order by quota - floor(quota) desc, chr) as place from c),
 e as (select chr, n, greatest(floor(quota) + cast(place <= rest as int), 1) as seats from f) select m.chr, marker, pos, cast(floor((row_number() over (partition by m.chr order by pos, marker) - 1) * seats / n) as bigint) as chunk from m join e on e.chr = m.chr""")
def _(s, d):
    return G.split_chunks(X.marker(s, d), 64)


@query("g25_chunk_plan", f"with e as (select chr, max(pos) as length from ({X.ASSOC}) a group by 1), c as (select chr, length, unnest(range(0, cast(ceil(length / 400000) as bigint))) as chunk from e) select chr, chunk, chunk * 400000 + 1 as start, least(chunk * 400000 + 400000, length) as stop, greatest(chunk * 400000 + 1 - 25000, 1) as \"from\", chunk * 400000 + 400000 + 25000 as \"to\" from c")
def _(s, d):
    return G.chunk_plan(X.assoc(s, d).select("chr", "pos"), 400_000, 25_000)


@query("g27_founders", "select c_custkey as iid, row_number() over (order by c_custkey) as fid, '0' as pid, '0' as mid from customer")
def _(s, d):
    return G.to_founders(X.sample(s, d).select("iid"))


_FAM = "select c_custkey as iid, case when c_custkey % 3 = 2 then c_custkey - 2 end as pid, case when c_custkey % 3 = 2 then c_custkey - 1 end as mid from customer"


@query("g29_mendel", f"with f as (select iid, pid, mid from ({_FAM}) f where pid is not null), g as (select iid, marker, gt from ({X.GT}) g where gt is not null) select c.marker, count(*) as trios, count(*) filter (where c.gt < cast(p.gt = 2 as int) + cast(m.gt = 2 as int) or c.gt > cast(p.gt > 0 as int) + cast(m.gt > 0 as int)) as errors from f join g c on c.iid = f.iid join g p on p.iid = f.pid and p.marker = c.marker join g m on m.iid = f.mid and m.marker = c.marker group by 1")
def _(s, d):
    i = F.col("iid")
    fam = X.sample(s, d).select("iid", F.when(i % 3 == 2, i - 2).alias("pid"), F.when(i % 3 == 2, i - 1).alias("mid"))
    return G.mendel_errors(fam, X.gt(s, d))


# --- quality control


@query("q01_missing_ind", f"select iid, round(avg(cast(gt is null as double)), 8) as f_miss, count(*) as n, avg(cast(gt is null as double)) > 0.025e0 as excluded from ({X.GT}) g group by 1")
def _(s, d):
    return _rounded(Q.missing_ind(X.gt(s, d), 0.025), 8, "f_miss")


@query("q02_missing_marker", f"select marker, round(avg(cast(gt is null as double)), 8) as f_miss, count(*) as n, avg(cast(gt is null as double)) > 0.02e0 as excluded from ({X.GT}) g group by 1")
def _(s, d):
    return _rounded(Q.missing_marker(X.gt(s, d)), 8, "f_miss")


_INBREEDING = "with g as (select * from ({gt}) g where gt is not null {where}), a as (select marker, sum(gt) / (2.0e0 * count(*)) as af from g group by 1), i as (select iid, count(*) filter (where gt <> 1) as o, sum(1 - 2 * af * (1 - af)) as e, count(*) as n from g join a using (marker) group by 1)"


@query("q03_sex_check", _INBREEDING.format(gt=X.GT, where="and chr = 23") + f" select iid, sex, case when (o - e) / (n - e) < 0.2 then 2 when (o - e) / (n - e) > 0.8 then 1 end as called, coalesce(case when (o - e) / (n - e) < 0.2 then 2 when (o - e) / (n - e) > 0.8 then 1 end <> sex, false) as mismatch from i join ({X.SAMPLE}) s using (iid)")
def _(s, d):
    return Q.sex_check(X.gt(s, d), X.sample(s, d)).drop("f")


_SEX = _INBREEDING.format(gt=X.GT, where="and chr = 23") + f", c as (select iid, coalesce(case when (o - e) / (n - e) < 0.2 then 2 when (o - e) / (n - e) > 0.8 then 1 end <> sex, false) as mismatch from i join ({X.SAMPLE}) s using (iid))"


@query("q03_sex_mixups", _SEX + " select count(*) as n, count(*) filter (where mismatch) as mismatches, round(avg(cast(mismatch as int)), 8) as share, round(2 * avg(cast(mismatch as int)), 8) as mixup, (select coalesce(string_agg(cast(iid as varchar), ', ' order by iid), '') from (select iid from c where mismatch order by iid limit 20)) as ids from c")
def _(s, d):
    return _rounded(Q.sex_mixups(Q.sex_check(X.gt(s, d), X.sample(s, d))), 8, "share", "mixup")


@query("q04_inbreeding", _INBREEDING.format(gt=X.GT, where="") + " select iid, o as o_hom, round(e, 4) as e_hom, n, round((o - e) / (n - e), 6) as f from i")
def _(s, d):
    return _rounded(_rounded(Q.inbreeding(X.gt(s, d)), 4, "e_hom"), 6, "f")


@query("q05_heterozygosity", f"select iid, round(count(*) filter (where gt = 1) / count(gt), 8) as het from ({X.GT}) g group by 1")
def _(s, d):
    return _rounded(Q.heterozygosity(X.gt(s, d)), 8, "het")


@query("q06_excl_maf", f"select marker from ({_COUNTS}) where least({_AF}, 1 - {_AF}) < 0.1e0")
def _(s, d):
    return Q.excl_maf(X.gt(s, d), 0.1)


@query("q07_excl_hwe", f"with c as ({_HWE}) select marker from c where chr <= 22 and least({_AF}, 1 - {_AF}) >= 0.01e0 and {tails.chi2('chi', 1)} < 0.2e0")
def _(s, d):
    return Q.excl_hwe(X.gt(s, d), 0.01, 0.2)


@query("q08_hwe_by_missing", f"with c as ({_HWE}) select marker, round(-log10(greatest({tails.chi2('chi', 1)}, 1e-10)), 5) as hwe, round(-log10(greatest(n_missing / (n0 + n1 + n2 + n_missing), 1e-10)), 5) as missing from c where chi is not null")
def _(s, d):
    return _rounded(Q.hwe_by_missing(X.gt(s, d)), 5, "hwe", "missing")


@query("q09_ld_prune")
def _(s, d):
    return LD.ld_prune(X.gt(s, d))


@query("q10_ibs_pairs", f"with g as (select iid, marker, gt from ({X.GT}) g), p as (select a.iid as id1, b.iid as id2, count(*) filter (where 2 - abs(a.gt - b.gt) = 0) as ibs0, count(*) filter (where 2 - abs(a.gt - b.gt) = 1) as ibs1, count(*) filter (where 2 - abs(a.gt - b.gt) = 2) as ibs2 from g a join g b on a.marker = b.marker and a.iid < b.iid group by 1, 2), i as (select distinct iid from g) select a.iid as id1, b.iid as id2, cast(coalesce(ibs0, 0) as int) as ibs0, cast(coalesce(ibs1, 0) as int) as ibs1, cast(coalesce(ibs2, 0) as int) as ibs2, round((ibs1 * 0.5e0 + ibs2) / nullif(ibs0 + ibs1 + ibs2, 0), 8) as distance from i a join i b on a.iid < b.iid left join p on p.id1 = a.iid and p.id2 = b.iid")
def _(s, d):
    return _rounded(_ibs(s, d), 8, "distance")


def _ibs(s, d):
    """Pairs of all individuals."""
    return Q.ibs_pairs(X.gt(s, d))


_Q11 = f"""with a as (select {_AF} as p, 1 - {_AF} as q from ({_COUNTS}) where n0 + n1 + n2 > 0), f as (select * from a where p > 0 and q > 0),
 e as (select sum(2 * p * p * q * q) as e00, sum(4 * p * q * (p * p + q * q)) as e10, sum(power(p, 4) + power(q, 4) + 4 * p * p * q * q) as e20, sum(2 * p * q) as e11, count(*) as m from f),
 i as (select id1, id2, ibs0, ibs1, nullif(ibs0 + ibs1 + ibs2, 0) / m as share, e.* from ({ORACLES['q10_ibs_pairs']}) x, e), z as (select *, case when share is not null then least(ibs0 / (e00 * share), 1) end as z0 from i),
 y as (select *, case when share is not null then greatest(least((ibs1 - z0 * e10 * share) / (e11 * share), 1 - z0), 0) end as z1 from z)
 select id1, id2, round(z0, 7) as z0, round(z1, 7) as z1, round(1 - z0 - z1, 7) as z2, round(z1 / 2 + 1 - z0 - z1, 7) as pi_hat from y"""


@query("q11_ibd_pairs", _Q11)
def _(s, d):
    return _rounded(Q.ibd_pairs(_ibs(s, d), X.gt(s, d)), 7, "z0", "z1", "z2", "pi_hat")


@query("q12_ibs_filter", f"select unnest([id1, id2]) as id from ({ORACLES['q10_ibs_pairs']}) x where coalesce(distance > 0.8e0, false) or ibs0 < 5 group by 1")
def _(s, d):
    return Q.ibs_filter(_ibs(s, d), "distance > 0.8e0 or ibs0 < 5")


@query("q13_mds")
def _(s, d):
    return M.mds(_ibs(s, d))


@query("q14_drop_nan_ids")
def _(s, d):
    return Q.drop_nan_ids(_ibs(s, d).select("id1", "id2", F.when((F.col("id1") % 40 == 3) & (F.col("id2") % 3 == 0), None).otherwise(F.col("distance")).alias("value")))


_EXCLUDED = f"""with g as ({X.GT}), i as (select avg(cast(gt is null as double)) > 0.02e0 as x from g group by iid), h as ({_HWE}), m as (select marker, chr, n_missing / (n0 + n1 + n2 + n_missing) > 0.02e0 as miss, n0 + n1 + n2 = 0 or least({_AF}, 1 - {_AF}) < 0.01e0 as low,
 chr <= 22 and least({_AF}, 1 - {_AF}) >= 0.01e0 and {tails.chi2('chi', 1)} < 5e-7 as hwe from h), c as (select 'individuals' as kind, 'missing' as reason, count(*) filter (where x) as excluded, (select count(distinct c_custkey) from customer) as total from i
 union all select 'markers', 'missing', count(*) filter (where miss), count(*) from m union all select 'markers', 'maf', count(*) filter (where low), count(*) from m union all select 'markers', 'hwe', count(*) filter (where hwe), count(*) from m)
 select kind, reason, excluded, total, round(excluded / total, 8) as share from c"""


@query("q15_qc_report", _EXCLUDED)
def _(s, d):
    return _rounded(Q.qc_report(X.gt(s, d), X.sample(s, d)), 8, "share")


_LISTS = f"""with g as ({X.GT}), i as (select iid as id from g group by iid having avg(cast(gt is null as double)) > 0.02e0), h as ({_HWE}), m as (select marker as id, chr, n_missing / (n0 + n1 + n2 + n_missing) > 0.02e0 as miss, n0 + n1 + n2 = 0 or least({_AF}, 1 - {_AF}) < 0.01e0 as low,
 chr <= 22 and least({_AF}, 1 - {_AF}) >= 0.01e0 and {tails.chi2('chi', 1)} < 5e-7 as hwe from h), e as (select 'individuals' as kind, 'missing' as reason, id from i union all select 'markers', 'missing', id from m where miss union all select 'markers', 'maf', id from m where low union all select 'markers', 'hwe', id from m where hwe),
 r as (select *, row_number() over (partition by kind, reason order by id) as k from e) select n.kind, n.reason, coalesce(string_agg(cast(id as varchar), ', ' order by id) filter (where k <= 12), '') as ids from (values ('individuals', 'missing'), ('markers', 'missing'), ('markers', 'maf'), ('markers', 'hwe')) n(kind, reason) left join r using (kind, reason) group by 1, 2"""


@query("q15_qc_ids", _LISTS)
def _(s, d):
    return Q.qc_report(X.gt(s, d), X.sample(s, d), most_ids=12).select("kind", "reason", "ids")


@query("q16_marker_totals", f"select count(*) as n_all, count(*) filter (where marker % 5 <> 0) as n_baseline, count(*) filter (where marker % 5 <> 0 and marker % 3 <> 0) as n_post from ({X.MARKER}) m")
def _(s, d):
    m = X.marker(s, d)
    return Q.marker_totals(m, m.where("marker % 5 = 0"), m.where("marker % 3 = 0"))


@query("q17_describe_variables", f"""with s as ({X.SAMPLE}), k as (select strat, count(*) as n from s group by 1), m as (select avg(y) as my, stddev_samp(y) as sy, avg(age) as ma, stddev_samp(age) as sa from s) select 'y' as variable, 0e0 as missing, format('mean {{:.4f}}, sd {{:.4f}}', my, sy) as distribution from m
 union all select 'age', 0e0, format('mean {{:.4f}}, sd {{:.4f}}', ma, sa) from m union all select 'strat', 0e0, string_agg(strat || ': ' || n, ', ' order by n desc, strat) from k""")
def _(s, d):
    return Q.describe_variables(X.sample(s, d), ["y", "age", "strat"])


# --- association


@query("t01_trend", f"with t as ({_TREND}) select marker, round(chi2, 5) as chi2, round({tails.chi2('chi2', 1)}, 6) as p from t")
def _(s, d):
    t = T.count_tests(G.gt_table(_with_y(s, d), "cc"))
    return t.select("marker", F.round("chi2_trend", 5).alias("chi2"), F.round("p_trend", 6).alias("p"))


@query("t02_allelic", f"with t as ({_ALLELES}) select marker, round(chi2, 5) as chi2, round({tails.chi2('chi2', 1)}, 6) as p from t")
def _(s, d):
    t = T.count_tests(G.gt_table(_with_y(s, d), "cc"))
    return t.select("marker", F.round("chi2_allelic", 5).alias("chi2"), F.round("p_allelic", 6).alias("p"))


_CELLS = f"""with c as ({_CALLS}), m as (select marker, count(*) as n from c group by 1), r as (select marker, cc, count(*) as n from c group by 1, 2), k as (select marker, gt, count(*) as n from c group by 1, 2),
 o as (select marker, cc, gt, count(*) as n from c group by 1, 2, 3), e as (select r.marker, r.cc, k.gt, r.n * 1e0 * k.n / m.n as e, coalesce(o.n, 0) as o from r join k using (marker) join m using (marker) left join o on o.marker = r.marker and o.cc = r.cc and o.gt = k.gt),
 t as (select marker, sum(power(o - e, 2) / e) as chi2, (count(distinct cc) - 1) * (count(distinct gt) - 1) as df, count(*) = 6 and min(o) >= 5 as large from e group by 1)"""


@query("t03_genotype_chi2", _CELLS + f" select marker, round(chi2, 5) as chi2, cast(df as int) as df, case when large then round({tails.chi2('chi2', 2)}, 6) end as p from t")
def _(s, d):
    """P of tables without small cells; the others have random tables behind their P, which the tests look at."""
    out = T.genotype_test(G.gt_table(_with_y(s, d), "cc"))
    return out.select("marker", F.round("chi2", 5).alias("chi2"), "df", F.when(~F.col("simulated"), F.round("p", 6)).alias("p"))


@query("t04_linear", f"select marker, count(*) as n, round(regr_slope(y, gt), 4) as beta, round(regr_intercept(y, gt), 4) as intercept, round(regr_r2(y, gt) / (1 - regr_r2(y, gt)) * (count(*) - 2), 5) as stat from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null group by 1")
def _(s, d):
    out = T.lm_per_marker(_with_y(s, d), "y", ["gt"])
    return out.select("marker", "n", F.round("`beta1.gt`", 4).alias("beta"), F.round("`beta1.(Intercept)`", 4).alias("intercept"), F.round("stat", 5).alias("stat"))


@query("t05_glm_gauss", f"select marker, round(-count(*) * ln(1 - regr_r2(y, gt)), 5) as stat from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null group by 1")
def _(s, d):
    return T.lm_per_marker(_with_y(s, d), "y", ["gt"], test="LR").select("marker", F.round("stat", 5).alias("stat"))


_GTCELLS = f"select marker, {', '.join(f'count(*) filter (where cc = {c} and gt = {k}) * 1e0 as {n}{k}' for n, c in (('r', 1), ('s', 0)) for k in range(3))} from ({_CALLS}) group by 1"


def _logistic_sql(scores: tuple[float, float, float]) -> str:
    """Newton steps of a logistic fit on six cells, as a recursive query; one row per marker and step. The last step (40) is the fit."""
    p = [f"(1 / (1 + exp(-(b0 + b1 * {x}e0))))" for x in scores]
    n = [f"(r{k} + s{k})" for k in range(3)]
    w = [f"({n[k]} * {p[k]} * (1 - {p[k]}))" for k in range(3)]
    total = lambda parts: "(" + " + ".join(parts) + ")"
    g0, g1 = total([f"(r{k} - {n[k]} * {p[k]})" for k in range(3)]), total([f"{scores[k]}e0 * (r{k} - {n[k]} * {p[k]})" for k in range(3)])
    h00, h01, h11 = total(w), total([f"{scores[k]}e0 * {w[k]}" for k in range(3)]), total([f"{scores[k] ** 2}e0 * {w[k]}" for k in range(3)])
    return f"""c as ({_GTCELLS}), fit as (with recursive f(k, marker, b0, b1, h00, h01, h11) as (select 0, marker, 0e0, 0e0, 0e0, 0e0, 0e0 from c union all
 select k + 1, marker, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01), h00, h01, h11 from (
 select k, f.marker, b0, b1, {g0} as g0, {g1} as g1, {h00} as h00, {h01} as h01, {h11} as h11 from f join c on c.marker = f.marker where k < 40)) select * from f where k = 40),
 t as (select c.marker, cast(r0 + r1 + r2 + s0 + s1 + s2 as bigint) as n, b1 as beta, sqrt(h00 / (h00 * h11 - h01 * h01)) as sd, 2 * ({" + ".join(f"r{k} * ln({p[k]}) + s{k} * ln(1 - {p[k]})" for k in range(3))}
 - (r0 + r1 + r2) * ln((r0 + r1 + r2) / (r0 + r1 + r2 + s0 + s1 + s2)) - (s0 + s1 + s2) * ln((s0 + s1 + s2) / (r0 + r1 + r2 + s0 + s1 + s2))) as stat from c join fit using (marker))"""


# gt and age against age: cells by genotype and age, three and two coefficients in one recursion (m = 1 and 0)
_T06 = f"""with recursive c as (select marker, gt * 1e0 as g, (age - 45) / 10e0 as a, sum(cc) * 1e0 as r, count(*) * 1e0 as n from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null group by 1, 2, 3),
 f(k, marker, m, b0, b1, b2) as (select 0, marker, m, 0e0, 0e0, 0e0 from (select distinct marker from c), (values (0), (1)) v(m) union all
 select k + 1, marker, m, b0 + (g0 * (hgg * haa - hga * hga) + gg * (hga * h0a - h0g * haa) + ga * (h0g * hga - hgg * h0a)) / det, b1 + m * (g0 * (hga * h0a - h0g * haa) + gg * (h00 * haa - h0a * h0a) + ga * (h0g * h0a - h00 * hga)) / det,
 b2 + (g0 * (h0g * hga - hgg * h0a) + gg * (h0a * h0g - h00 * hga) + ga * (h00 * hgg - h0g * h0g)) / det from (select *, h00 * (hgg * haa - hga * hga) - h0g * (h0g * haa - hga * h0a) + h0a * (h0g * hga - hgg * h0a) as det from (
 select k, marker, m, b0, b1, b2, sum(e) as g0, sum(m * g * e) as gg, sum(a * e) as ga, sum(w) as h00, sum(m * g * w) as h0g, sum(a * w) as h0a, sum(case when m = 1 then g * g * w else 1e0 end) as hgg, sum(m * g * a * w) as hga, sum(a * a * w) as haa from (
 select f.*, g, a, r - n / (1 + exp(-(b0 + b1 * g + b2 * a))) as e, n / (1 + exp(-(b0 + b1 * g + b2 * a))) / (1 + exp(b0 + b1 * g + b2 * a)) as w from f join c using (marker) where k < 25) group by all))),
 l as (select marker, m, max(b1) as b1, sum(r * (b0 + b1 * g + b2 * a) - n * ln(1 + exp(b0 + b1 * g + b2 * a))) as l, cast(sum(n) as bigint) as n from f join c using (marker) where k = 25 group by 1, 2),
 t as (select one.marker, one.n, one.b1, 2 * (one.l - null.l) as stat from l as one join l as null using (marker) where one.m = 1 and null.m = 0)
 select marker, n, round(b1, 5) as beta, round(stat, 5) as stat, round({tails.chi2("stat", 1)}, 6) as p from t""".replace("null.l", "zero.l").replace("as null", "as zero").replace("null.m", "zero.m")


@query("t06_logistic", _T06)
def _(s, d):
    out = T.logistic_per_marker(_with_y(s, d), "cc", ["gt", "age"], ["age"])
    return out.select("marker", "n", F.round("`beta1.gt`", 5).alias("beta"), F.round("stat", 5).alias("stat"), F.round("p", 6).alias("p"))


@query("t07_logistic_table", f"with {_logistic_sql((0.0, 0.5, 1.0))} select marker, round(beta, 5) as beta, round(sd, 5) as sd, round(stat, 5) as stat, round({tails.chi2('stat', 1)}, 6) as p from t")
def _(s, d):
    return _rounded(_rounded(T.logistic_table(G.gt_table(_with_y(s, d), "cc")), 5, "beta", "sd", "stat"), 6, "p")


@query("t08_ordinal")
def _(s, d):
    return T.ordinal_per_marker(_with_y(s, d).withColumn("grade", F.least(F.floor(F.col("y") / 3500), F.lit(2))), "grade", ["gt"])


def _cox_sql(steps: int = 12) -> str:
    """One covariate, each step of each tie a row: Newton steps b0.., information i{steps}, risk sets z{steps} at the last coefficient."""
    at = "(s0 - j / m * e0)"
    sql = f"c as materialized (select marker as k, age as t, cc as d, gt * 1e0 as x, fid, count(*) as w from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null group by all), b0 as materialized (select distinct k, 0e0 as b from c)"
    for n in range(steps + 1):
        sql += f""", y{n} as (select k, t, sum(w * exp(b * x)) as s0, sum(w * x * exp(b * x)) as s1, sum(w * x * x * exp(b * x)) as s2, sum(w * d) as m, sum(w * d * x) as dx, sum(w * d * exp(b * x)) as e0, sum(w * d * x * exp(b * x)) as e1, sum(w * d * x * x * exp(b * x)) as e2 from c join b{n} using (k) group by 1, 2),
 z{n} as materialized (select k, t, m, dx, e0, e1, e2, sum(s0) over o as s0, sum(s1) over o as s1, sum(s2) over o as s2 from y{n} window o as (partition by k order by t desc)),
 j{n} as (select *, unnest(range(cast(m as bigint))) as j from z{n} where m > 0),
 i{n} as materialized (select k, sum(case when j = 0 then dx else 0 end) - sum((s1 - j / m * e1) / {at}) as g, sum((s2 - j / m * e2) / {at} - power((s1 - j / m * e1) / {at}, 2)) as h from j{n} group by 1),
 b{n + 1} as materialized (select k, b + case when h > 1e-9 then g / h end as b from b{n} join i{n} using (k))"""
    return sql


_COX_N = "n as (select k, cast(sum(w) as bigint) as n from c group by 1)"
_T09 = f"with {_cox_sql()}, {_COX_N}, f as (select k, n, b, 1 / sqrt(h) as sd, b * b * h as stat from b12 join i12 using (k) join n using (k)) select k as marker, n, round(b, 6) as beta, round(sd, 6) as sd, round({tails.chi2('stat', 1)}, 6) as p from f"
#: Score residuals: what each row had, less what was expected of it up to its own time.
_T09_CLUSTERS = f"""with {_cox_sql()}, {_COX_N}, a as (select k, t, m, j, s0 - j / m * e0 as a, (s1 - j / m * e1) / (s0 - j / m * e0) as x from j12),
 q as (select k, t, sum(1 / a) as a, sum(x / a) as b, sum((1 - j / m) / a) as ao, sum((1 - j / m) * x / a) as bo, avg(x) as x from a group by 1, 2),
 l as (select k, t, coalesce(a, 0) as a, coalesce(b, 0) as b, coalesce(ao, 0) as ao, coalesce(bo, 0) as bo, coalesce(q.x, 0) as mean, sum(coalesce(a, 0)) over o as ca, sum(coalesce(b, 0)) over o as cb from (select distinct k, t from c) u left join q using (k, t) window o as (partition by k order by t)),
 u as (select c.k, fid, sum(w * (d * (x - mean) - exp(f.b * x) * (x * ca - cb - d * ((x * a - l.b) - (x * ao - bo))))) as u from c join l on l.k = c.k and l.t = c.t join b12 f on f.k = c.k group by 1, 2),
 v as (select k, sum(u * u) as v from u group by 1), f as (select k, n, b, sqrt(v) / h as sd, power(b * h, 2) / v as stat from b12 join i12 using (k) join n using (k) join v using (k))
 select k as marker, n, round(b, 6) as beta, round(sd, 6) as sd, round({tails.chi2('stat', 1)}, 6) as p from f"""


def _cox(df, cluster=None):
    out = C.cox_per_marker(df, "age", "cc", ["gt"], cluster=cluster)
    return out.select("marker", "n", F.round("`beta1.gt`", 6).alias("beta"), F.round("`sd1.gt`", 6).alias("sd"), F.round("p", 6).alias("p"))


@query("t09_cox", _T09)
def _(s, d):
    return _cox(_with_y(s, d))


@query("t09_cox_clusters", _T09_CLUSTERS)
def _(s, d):
    return _cox(_with_y(s, d), "fid")


@query("t10_glmm")
def _(s, d):
    return T.glmm_binary(_with_y(s, d), "cc", ["gt"], [], "fid")


@query("t11_lmm")
def _(s, d):
    return T.lmm(_with_y(s, d), "y", ["gt"], [], "fid")


_T12 = f"""with d as (select marker, gt * 1e0 as x, y, fid from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null), b as (select marker, count(*) as n, regr_slope(y, x) as b1, regr_intercept(y, x) as b0, sum(x) as sx, sum(x * x) as sxx from d group by 1),
 u as (select d.marker, fid, sum(y - b0 - b1 * x) as u0, sum(x * (y - b0 - b1 * x)) as u1 from d join b on b.marker = d.marker group by 1, 2), m as (select marker, sum(u0 * u0) as m00, sum(u0 * u1) as m01, sum(u1 * u1) as m11 from u group by 1),
 t as (select marker, n, b1, sqrt(sx * sx * m00 - 2 * n * sx * m01 + n * n * m11) / (n * sxx - sx * sx) as sd from b join m using (marker)), z as (select *, power(b1 / sd, 2) as stat from t) select marker, n, round(b1, 4) as beta, round(sd, 4) as sd, round({tails.chi2("stat", 1)}, 6) as p from z"""


@query("t12_gee", _T12)
def _(s, d):
    out = T.gee(_with_y(s, d), "y", ["gt"], [], "fid")
    return out.select("marker", "n", F.round("`beta1.gt`", 4).alias("beta"), F.round("`sd1.gt`", 4).alias("sd"), F.round("p", 6).alias("p"))


_T12_BINOMIAL = f"""with {_logistic_sql((0.0, 1.0, 2.0))}, d as (select g.marker, gt, fid, cc - 1 / (1 + exp(-(b0 + b1 * gt))) as e from ({X.GT}) g join ({X.SAMPLE}) s using (iid) join fit on fit.marker = g.marker where gt is not null),
 u as (select marker, fid, sum(e) as u0, sum(gt * e) as u1 from d group by 1, 2), m as (select marker, sum(u0 * u0) as m00, sum(u0 * u1) as m01, sum(u1 * u1) as m11 from u group by 1),
 z as (select marker, n, b1, sqrt(h01 * h01 * m00 - 2 * h00 * h01 * m01 + h00 * h00 * m11) / (h00 * h11 - h01 * h01) as sd from t join fit using (marker) join m using (marker)), w as (select *, power(b1 / sd, 2) as stat from z)
 select marker, n, round(b1, 5) as beta, round(sd, 5) as sd, round({tails.chi2("stat", 1)}, 6) as p from w"""


@query("t12_gee_binomial", _T12_BINOMIAL)
def _(s, d):
    out = T.gee(_with_y(s, d), "cc", ["gt"], [], "fid", "binomial")
    return out.select("marker", "n", F.round("`beta1.gt`", 5).alias("beta"), F.round("`sd1.gt`", 5).alias("sd"), F.round("p", 6).alias("p"))


_DOSE = "(p_ab + 2 * p_bb)"


@query("t17_imputed_score", f"with r as (select marker, y, {_DOSE} as x, (p_ab + 4 * p_bb) - {_DOSE} * {_DOSE} as v from ({X.PROB}) p join ({X.SAMPLE}) s using (iid) where p_aa + p_ab + p_bb > 0), m as (select marker, avg(y) as m from r group by 1) select marker, round(sum((y - m) * x) / 1000, 3) as score, round(sum((y - m) * (y - m) * v) / sum(v), -1) as lost from r join m using (marker) group by 1")
def _(s, d):
    out = T.imputed_score(_prob_y(s, d), "y")
    return out.select("marker", F.round(F.col("score") / 1000, 3).alias("score"), F.round(F.col("missing_information") / F.col("uncertainty"), -1).alias("lost"))


_T18 = f"""with q as (select marker, y, p_ab as a, p_bb as b from ({X.PROB}) p join ({X.SAMPLE}) s using (iid) where p_aa + p_ab + p_bb > 0), m as (select marker, avg(y) as my, avg(a) as ma, avg(b) as mb from q group by 1),
 v as (select marker, sum((y - my) * a) as ua, sum((y - my) * b) as ub, sum(power(y - my, 2) * (ma * (1 - ma) - a * (1 - a))) as vaa, sum(power(y - my, 2) * (mb * (1 - mb) - b * (1 - b))) as vbb, sum(power(y - my, 2) * (a * b - ma * mb)) as vab from q join m using (marker) group by 1),
 t as (select marker, case when vaa * vbb - vab * vab > 0 then (ua * ua * vbb - 2 * ua * ub * vab + ub * ub * vaa) / (vaa * vbb - vab * vab) end as stat from v) select marker, round(stat, 4) as stat, round(exp(-stat / 2), 5) as p from t"""


@query("t18_imputed_score_gt", _T18)
def _(s, d):
    return _rounded(_rounded(T.imputed_score_gt(_prob_y(s, d), "y"), 4, "stat"), 5, "p")


@query("t19_imputed_lr")
def _(s, d):
    return T.imputed_lr(_prob_y(s, d).select("marker", "cc", "p_aa", "p_ab", "p_bb"), "cc")


@query("t20_r2_max_post", f"select marker, round(power(corr(case when p_bb > p_ab and p_bb > p_aa then 2.0e0 when p_ab > p_aa then 1.0e0 else 0.0e0 end, {_DOSE}), 2), 7) as r2 from ({X.PROB}) p where p_aa + p_ab + p_bb > 0 group by 1")
def _(s, d):
    return _rounded(T.r2_max_post(X.prob(s, d)), 7, "r2")


@query("t21_assoc_multi", " union all ".join(f"select '{y}' as phenotype, marker, count(*) as n, round(regr_slope({y}, gt), 4) as beta, round(regr_r2({y}, gt) / (1 - regr_r2({y}, gt)) * (count(*) - 2), 5) as stat from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null group by marker" for y in ("y", "cc")))
def _(s, d):
    out = T.assoc_multi(_with_y(s, d).select("marker", "gt", "y", "cc"), ["y", "cc", "absent"], ["gt"])
    return out.select("phenotype", "marker", "n", F.round("`beta1.gt`", 4).alias("beta"), F.round("stat", 5).alias("stat"))


@query("t22_assoc_cc", f"with {_logistic_sql((0.0, 1.0, 2.0))} select marker, n, round(beta, 5) as beta, round(sd, 5) as sd, round(stat, 5) as stat, round({tails.chi2('stat', 1)}, 6) as p from t")
def _(s, d):
    out = T.logistic_per_marker(_with_y(s, d), "cc", ["gt"])
    return out.select("marker", "n", F.round("`beta1.gt`", 5).alias("beta"), F.round("`sd1.gt`", 5).alias("sd"), F.round("stat", 5).alias("stat"), F.round("p", 6).alias("p"))


@query("t23_expected_dosage", f"select marker, count(*) as n, case when stddev_pop({_DOSE}) > 1e-6 then round(regr_slope(y, {_DOSE}), 4) end as beta from ({X.PROB}) p join ({X.SAMPLE}) s using (iid) where p_aa + p_ab + p_bb > 0 group by 1")
def _(s, d):
    p = _prob_y(s, d).withColumn("dosage", F.when(F.col("p_aa") + F.col("p_ab") + F.col("p_bb") > 0, G.dosage()))
    return T.lm_per_marker(p, "y", ["dosage"]).select("marker", "n", F.round("`beta1.dosage`", 4).alias("beta"))


@query("t24_set_permutation")
def _(s, d):
    return T.set_permutation(X.prob(s, d), X.sample(s, d), "cc")


@query("t25_global_emp")
def _(s, d):
    return T.global_emp(X.gt(s, d), X.sample(s, d), "cc")


def _permutable(s, d):
    """Calls with the individuals' phenotypes; households of three by their numbers."""
    people = X.sample(s, d).select("iid", "y", F.floor(F.col("iid") / 3).alias("household"))
    return X.gt(s, d).where("gt is not null").join(people, "iid").select("iid", "marker", "gt", "y", "household")


@query("t26_permuted_lr")
def _(s, d):
    """Every marker, chunk by chunk until its own P is precise enough."""
    return P.adaptive_p(_permutable(s, d), "iid", "y", ["gt"], P.absolute_correlation, by="marker")


@query("t26_permuted_clusters")
def _(s, d):
    """The same with households changing places as a whole."""
    return P.adaptive_p(_permutable(s, d), "iid", "y", ["gt"], P.absolute_correlation, by="marker", cluster="household")


@query("t27_permute_p")
def _(s, d):
    """All markers; a replicate deals each individual's phenotype once."""
    return P.permutation_p(_permutable(s, d), "iid", "y", ["gt"], P.absolute_correlation, by="marker")


@query("d01_per_marker", f"select marker, round(case when stddev_pop({_DOSE}) > 1e-9 then corr({_DOSE}, y) end, 7) as r from ({X.PROB}) p join ({X.SAMPLE}) s using (iid) where p_aa + p_ab + p_bb > 0 group by 1")
def _(s, d):
    def fit(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"marker": p["marker"].iloc[:1], "r": [np.corrcoef(p["dosage"], p["y"])[0, 1]]})

    p = _prob_y(s, d).where("p_aa + p_ab + p_bb > 0").select("marker", G.dosage().alias("dosage"), "y")
    return D.per_marker(p, fit, "marker long, r double").select("marker", F.round(F.nanvl("r", F.lit(None).cast("double")), 7).alias("r"))


@query("d01_per_marker_pieces", f"select marker, count(*) as n, round(case when stddev_pop({_DOSE}) > 1e-9 then corr({_DOSE}, y) end, 7) as r from ({X.PROB}) p join ({X.SAMPLE}) s using (iid) where p_aa + p_ab + p_bb > 0 group by 1")
def _(s, d):
    """The same correlation by parts: means and centred sums of each part, put together afterwards."""

    def piece(p: pd.DataFrame) -> pd.DataFrame:
        x, y = p["dosage"].to_numpy(float), p["y"].to_numpy(float)
        dx, dy = x - x.mean(), y - y.mean()
        return pd.DataFrame({"marker": p["marker"].iloc[:1], "n": [len(p)], "x": [x.mean()], "y": [y.mean()], "xx": [dx @ dx], "xy": [dx @ dy], "yy": [dy @ dy]})

    def finish(p: pd.DataFrame) -> pd.DataFrame:
        n, total = p["n"].to_numpy(float), float(p["n"].sum())
        dx, dy = (p[c].to_numpy(float) - (n * p[c].to_numpy(float)).sum() / total for c in "xy")
        xx, xy, yy = p["xx"].sum() + n @ (dx * dx), p["xy"].sum() + n @ (dx * dy), p["yy"].sum() + n @ (dy * dy)
        return pd.DataFrame({"marker": p["marker"].iloc[:1], "n": [int(total)], "r": [xy / np.sqrt(xx * yy) if xx * yy > 0 else None]})

    p = _prob_y(s, d).where("p_aa + p_ab + p_bb > 0").select("marker", G.dosage().alias("dosage"), "y")
    out = D.per_marker_pieces(p, piece, finish, "marker long, n long, x double, y double, xx double, xy double, yy double", "marker long, n long, r double", rows=2_000)
    return out.select("marker", "n", F.round("r", 7).alias("r"))


@query("d01_per_marker_counted", f"select marker, count(*) as n, round(sum(case when cc = 1 then gt end) / (2e0 * count(*) filter (where cc = 1)) - sum(case when cc = 0 then gt end) / (2e0 * count(*) filter (where cc = 0)), 7) as difference from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null group by 1")
def _(s, d):
    """Allele frequency of cases less that of controls, from counted combinations."""

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        share = lambda k: (p["gt"] * p["w"])[p["cc"] == k].sum() / (2 * p["w"][p["cc"] == k].sum()) if (p["cc"] == k).any() else None
        one, none = share(1), share(0)
        return pd.DataFrame({"marker": p["marker"].iloc[:1], "n": [int(p["w"].sum())], "difference": [None if one is None or none is None else one - none]})

    rows = _with_y(s, d).where("gt is not null").select("marker", "gt", "cc")
    return D.per_marker(rows, fit, "marker long, n long, difference double", dosage="gt", counted="w").select("marker", "n", F.round("difference", 7).alias("difference"))


@query("d02_n_to_one", "select (select count(*) from customer) + (select count(*) from supplier) as n")
def _(s, d):
    frames = [X.table(s, d, "customer").select(F.lit(1).alias("x")), X.table(s, d, "supplier").select(F.lit(1).alias("x"))]
    return D.n_to_one(frames, lambda a, b: a.unionByName(b).agg(F.count("*").alias("n")))


@query("d03_row_apply", "select p_partkey, p_size * 2 as twice from part")
def _(s, d):
    return D.row_apply(X.table(s, d, "part").select("p_partkey", "p_size"), lambda r: {"p_partkey": r["p_partkey"], "twice": r["p_size"] * 2}, "p_partkey long, twice int")


@query("d04_cl_apply", "select p_partkey as k, cast(p_size * (p_size + 1) // 2 as bigint) as total from part")
def _(s, d):
    return D.cl_apply(X.table(s, d, "part").select(F.col("p_partkey").alias("k"), "p_size"), lambda r: {"k": r["k"], "total": sum(range(r["p_size"] + 1))}, "k long, total long")


@query("d05_iterate_models", "select r_regionkey as a, s_suppkey as b, r_regionkey * 100 + s_suppkey as value from region, supplier where s_suppkey > r_regionkey")
def _(s, d):
    grid = [X.table(s, d, "region").select(F.col("r_regionkey").alias("a")), X.table(s, d, "supplier").select(F.col("s_suppkey").alias("b"))]
    return D.iterate_models(grid, lambda r: {"a": r["a"], "b": r["b"], "value": r["a"] * 100 + r["b"]}, "a int, b long, value long", "b > a")


@query("d08_sow_reap", "select 'ind' as kind, 'sex' as reason, c_custkey as id from customer where c_custkey % 7 = 0 union all select 'ind', 'missing', c_custkey from customer where c_custkey % 9 = 0")
def _(s, d):
    i = X.sample(s, d)
    return D.reap([D.sow("ind", "sex", i.where("iid % 7 = 0").select("iid")), D.sow("ind", "missing", i.where("iid % 9 = 0").select("iid")), D.sow("marker", "maf", X.marker(s, d).select("marker"))], "ind")

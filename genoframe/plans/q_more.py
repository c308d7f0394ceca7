"""Queries of haplotypes, pedigrees, model runs and collected outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe.operators import genotypes as G
from genoframe.operators import joins as J
from genoframe.operators import models as M
from genoframe.operators import reshape as A
from genoframe.operators import windows as W
from genoframe.plans import fixtures as X
from genoframe.plans.q_genetics import _COUNTS, _FAM, _with_y
from genoframe.plans.q_results import _folder
from genoframe.sources import tables as SC

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("g04_extract_genotypes", "select c_custkey, 'rs1' as marker, case when c_custkey % 5 = 0 then '0' else 'A' end as a, 'C' as b from customer union all select c_custkey, 'rs2', 'G', 'T' from customer")
def _(s, d):
    c = F.col("c_custkey")
    t = X.table(s, d, "customer").select("c_custkey", F.when(c % 5 != 0, "A").alias("rs1_1"), F.lit("C").alias("rs1_2"), F.lit("G/T").alias("rs2"))
    return G.extract_genotypes(t, "c_custkey", r"(rs\d+)(?:_[12])?")


@query("g18_group_haplotypes", "with c as (select c_nationkey as h, count(*) as k from customer group by 1), g as (select h, case when k / (select sum(k) from c) < 0.04e0 then 'rare' else cast(h as varchar) end as grp from c) select grp as \"group\", count(*) as n from customer join g on h = c_nationkey group by 1")
def _(s, d):
    t = X.table(s, d, "customer").select(F.col("c_nationkey").cast("string").alias("h"))
    return G.group_haplotypes(t, "h", 0.04).groupBy("group").agg(F.count("*").alias("n"))


@query("g18_haplotype_dosage", "select c_custkey, cast(c_custkey % 3 = 0 as int) + cast(c_custkey % 4 = 0 as int) as \"n_0\", cast(c_custkey % 3 = 1 as int) + cast(c_custkey % 4 = 1 as int) as \"n_1\" from customer")
def _(s, d):
    c = F.col("c_custkey")
    t = X.table(s, d, "customer").select("c_custkey", (c % 3).cast("string").alias("h1"), (c % 4).cast("string").alias("h2"))
    return G.haplotype_dosage(t, "c_custkey", ["0", "1"])


@query("g20_flip_to_ref", f"select marker, cast(sum(case when marker % 4 = 1 then 2 - gt else gt end) as bigint) as k from ({X.GT}) g where marker % 4 <> 2 group by 1")
def _(s, d):
    m = X.marker(s, d).withColumnRenamed("marker", "snp")
    ref = m.select("chr", "snp", F.when(F.col("snp") % 4 == 2, "N").when(F.col("snp") % 4 == 1, F.col("a2")).otherwise(F.col("a1")).alias("a1"), F.when(F.col("snp") % 4 == 1, F.col("a1")).otherwise(F.col("a2")).alias("a2"))
    return G.flip_to_ref(X.gt(s, d), J.align_alleles(m, ref)).groupBy("marker").agg(F.sum("gt").alias("k"))


@query("g22_reorder", f"select marker, cast(row_number() over (partition by chr order by pos, marker) as int) as place from ({X.MARKER}) m")
def _(s, d):
    return G.reorder(X.marker(s, d)).select("marker", "place")


@query("g23_split_chr", f"select distinct chr from ({X.MARKER}) m")
def _(s, d):
    return G.split_chr(X.marker(s, d), _folder(s))


@query("g26_rename", "select line, case when k = 1 then id else id || '-' || cast(k - 1 as varchar) end as id from (select line, id, row_number() over (partition by id order by line) as k from (select p_partkey as line, replace(p_brand, 'Brand#', 'rs') as id from part))")
def _(s, d):
    return G.rename_snps(X.table(s, d, "part").select(F.col("p_partkey").alias("line"), F.col("p_brand").alias("id")), "Brand#", "rs")


@query("g28_pedigree", f"with f as ({_FAM}), p as (select pid as iid, 1 as sex from f where pid is not null union all select mid, 2 from f where mid is not null) select f.iid, p.sex, case when p.sex is null then 0 else 1 end as offspring, cast(f.pid is not null as int) as depth, case when f.pid is not null then f.pid when p.sex is null then f.iid else f.iid - f.iid % 3 end as family from f left join p on p.iid = f.iid")
def _(s, d):
    i = F.col("iid")
    fam = X.sample(s, d).select("iid", F.when(i % 3 == 2, i - 2).alias("pid"), F.when(i % 3 == 2, i - 1).alias("mid"))
    return G.pedigree_stats(fam)


@query("g30_unique_iid", "select cast(c_nationkey as varchar) || ':' || cast(c_custkey as varchar) as iid from customer")
def _(s, d):
    return G.unique_iid(X.sample(s, d)).select("iid")


@query("j20_disease_genes", "select distinct 'g' || cast(l_suppkey as varchar) as gene from lineitem join part on l_partkey = p_partkey where p_size > 25 and p_brand like '%3'")
def _(s, d):
    li, p = X.table(s, d, "lineitem"), X.table(s, d, "part")
    variant, disease = F.concat(F.lit("v"), "l_partkey"), F.concat(F.lit("d"), "p_partkey")
    t = li.select(variant.alias("subject"), F.lit("in_gene").alias("predicate"), F.concat(F.lit("g"), "l_suppkey").alias("object"))
    t = t.unionByName(p.where("p_size > 25").select(F.concat(F.lit("v"), "p_partkey").alias("subject"), F.lit("causes").alias("predicate"), disease.alias("object")))
    t = t.unionByName(p.select(disease.alias("subject"), F.lit("name").alias("predicate"), F.col("p_brand").alias("object")))
    return J.disease_genes(t, "3$")


@query("a20_concat_chunks", f"select marker, chr from ({X.ASSOC}) a")
def _(s, d):
    """Results written as chunks by chromosome, header once each, and read as one table."""
    path = _folder(s)
    X.assoc(s, d).select("marker", "chr").repartition("chr").write.options(sep="\t", header=True).csv(path)
    return SC.read_table(s, path, schema="marker long, chr int")


@query("a21_concat_phenotypes", f"select 'y' as phenotype, count(*) as n from ({X.ASSOC}) a where p < 0.01e0 union all select 'z', count(*) from ({X.ASSOC}) a where p < 0.02e0")
def _(s, d):
    a = X.assoc(s, d)
    return A.rbind_all({"y": a.where("p < 0.01e0"), "z": a.where("p < 0.02e0")}, "phenotype").groupBy("phenotype").agg(F.count("*").alias("n"))


@query("r13_prs_base", f"select marker, chr, pos from ({X.ASSOC}) a")
def _(s, d):
    return SC.csv_to_table(X.assoc(s, d), _folder(s), {"marker": "marker", "chr": "chr", "pos": "pos", "p": "p"}, {}, ["chr", "pos"], ["marker"]).drop("p")


_AF = "(n1 + 2 * n2) / (2 * (n0 + n1 + n2))"


@query("t14_association", f"with c as (select marker, least({_AF}, 1 - {_AF}) >= 0.1e0 and cast(n0 < 5 as int) + cast(n1 < 5 as int) + cast(n2 < 5 as int) < 2 as ok from ({_COUNTS})) select 'y_all' as tag, count(*) filter (where ok) as ok, cast(0 as bigint) as failed, count(*) filter (where not ok) as excluded from c")
def _(s, d):
    models = M.expand_models([M.Model("y", ("gt",))])
    return M.status_counts(M.association(_with_y(s, d), models, maf=0.1))


_T13 = f"with g as (select * from ({X.GT}) g join ({X.SAMPLE}) s using (iid))" + "".join(
    f", {t} as (select marker, count(*) filter (where gt = 0) as n0, count(*) filter (where gt = 1) as n1, count(*) filter (where gt = 2) as n2 from g where {w} group by 1)" for t, w in (("a", "true"), ("o", "age > 40"))
) + " union all ".join(
    f"{'' if k else ' '}select '{tag}' as tag, marker, case when ok then round({_AF}, 7) end as af, case when ok then 'ok' else 'excluded' end as status from (select *, least({_AF}, 1 - {_AF}) >= 0.01e0 and cast(n0 < 5 as int) + cast(n1 < 5 as int) + cast(n2 < 5 as int) < 2 as ok from {t})"
    for k, (tag, t) in enumerate((("y_all", "a"), ("y_old", "o"), ("cc_all", "a"), ("cc_old", "o"), ("y_all_mds1-2", "a")))
)


@query("t13_expanded_models", _T13)
def _(s, d):
    """Two responses on two subsets, and one model with scaling components as covariates."""
    models = M.expand_models([M.Model("y", ("gt",), responses=("y", "cc"), subsets={"all": None, "old": "age > 40"}), M.Model("y", ("gt",), components=(1, 2))])
    # two covariates stand for the components
    rows = _with_y(s, d).withColumns({"c1": F.col("iid") % 17 - 8, "c2": F.col("iid") % 23 - 11})
    return M.association(rows, models).select("tag", "marker", F.round("af", 7).alias("af"), "status")


@query("t15_single_marker", f"select marker, round(regr_slope(y, gt), 4) as beta from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null and marker = 12 group by 1")
def _(s, d):
    return M.test_snp(_with_y(s, d), M.Model("y", ("gt",)), 12).select("marker", F.round("`beta1.gt`", 4).alias("beta"))


@query("t16_marginal", f"select marker, round(regr_slope(y, gt), 4) as beta from ({X.GT}) g join ({X.SAMPLE}) s using (iid) where gt is not null and chr = 3 group by 1")
def _(s, d):
    return M.test_marginal(_with_y(s, d), M.Model("y", ("gt",)), X.marker(s, d).where("chr = 3")).select("marker", F.round("`beta1.gt`", 4).alias("beta"))


@query("w17_chunks", "select p_partkey, cast(ntile(8) over (order by p_partkey) as int) - 1 as chunk from part")
def _(s, d):
    """Equal chunks by rank: the first chunks take the remainder, as largest-remainder seats do."""
    ranked = W.global_rank(X.table(s, d, "part").select("p_partkey"), ["p_partkey"], "k")
    n = ranked.count()
    seats, ends, total = W.split_seats([1.0] * 8, n), [], 0
    for size in seats:
        total += size
        ends.append(total)
    return ranked.select("p_partkey", F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("k"))).alias("chunk"))


@query("sc05_prefixed_table", "select c_custkey, c_name, 'two, 3' as head from customer")
def _(s, d):
    """A folder of files with a head each, in which a key is repeated."""
    path = _folder(s)
    lines = X.table(s, d, "customer").select((F.col("c_custkey") % 3).alias("part"), (F.col("c_custkey") + 10).alias("at"), F.concat_ws("\t", "c_custkey", "c_name").alias("value"))
    head = [(0, "source: one"), (1, "source: two"), (2, "version: 3"), (3, ""), (4, "c_custkey\tc_name")]
    heads = s.createDataFrame([(p, k, v) for p in range(3) for k, v in head], "part long, at long, value string")
    heads.unionByName(lines).repartition(3, "part").sortWithinPartitions("part", "at").drop("at").write.partitionBy("part").text(path)
    found, table = SC.read_prefixed(s, path)
    return table.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.lit(f"{found['source']}, {found['version']}").alias("head"))


@query("sc06_combine_files", "select c_custkey, c_nationkey as part from customer")
def _(s, d):
    path = _folder(s)
    X.table(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k")).write.partitionBy("k").options(sep="\t", header=True).csv(path)
    out = SC.combine_files(s, f"{path}/*", r"k=(\d+)/", {"part": 1}, "part")
    return out.select(F.col("c_custkey").cast("long").alias("c_custkey"), "part")


@query("sc25_probe_columns", "select distinct cast(k + 2 as int) as n from (select l_linenumber as k from lineitem)")
def _(s, d):
    """One folder of files for each line number k, whose lines have k + 2 fields."""
    path = _folder(s)
    fields = F.concat_ws("\t", F.concat_ws("\t", "l_orderkey", "l_partkey"), F.array_repeat(F.col("l_quantity").cast("string"), F.col("l_linenumber").cast("int")))
    X.table(s, d, "lineitem").select(F.col("l_linenumber").alias("k"), fields.alias("v")).write.partitionBy("k").text(path)
    return SC.probe_columns(s, [path]).select("n").distinct()


@query("sc27_dataset_meta", "select * from (values ('s_suppkey', 'id', 'integer id'), ('s_name', 'text', 'name'), ('s_nationkey', 'id', 'integer id'), ('s_acctbal', 'unknown', 'unknown')) v(\"column\", type, full_type)")
def _(s, d):
    return SC.dataset_meta(X.table(s, d, "supplier"), {r".*key": ("id", "integer id"), r".*name": ("text", "name")})

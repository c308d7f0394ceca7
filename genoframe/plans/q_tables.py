"""Queries of the table layer: P, F, J, A, W, U."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe.operators import joins as J
from genoframe.operators import reshape as A
from genoframe.operators import sets as U
from genoframe.operators import tables as P
from genoframe.operators import windows as W
from genoframe.plans import fixtures as X
from genoframe.plans.fixtures import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# --- columns and filters


@query("p01_select_cols", "select c_custkey, c_name, c_acctbal, c_custkey as k2 from customer")
def _(s, d):
    return P.select_cols(table(s, d, "customer"), "0:1,c_acctbal").withColumn("k2", F.col("c_custkey"))


@query("p02_drop_cols", "select s_suppkey, s_acctbal from supplier")
def _(s, d):
    return P.drop_cols(table(s, d, "supplier"), "1,s_nationkey")


@query("p03_delete_then_select", "select s_acctbal, s_suppkey from supplier")
def _(s, d):
    return P.drop_cols(table(s, d, "supplier"), "s_name", then_select="2,0")


@query("p04_reshuffle", "select o_totalprice as o_orderkey, o_custkey, o_orderkey as o_totalprice from orders")
def _(s, d):
    return P.reshuffle(table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), [0, 2], [2, 0])


@query("p05_constants", "select 'x' as \"C_0\", o_orderkey, 7 as \"C_1\", o_custkey from orders")
def _(s, d):
    return P.add_constants(table(s, d, "orders").select("o_orderkey", "o_custkey"), {0: "x", 2: 7})


@query("p06_set_header", "select p_partkey as key, p_name from part")
def _(s, d):
    return P.set_header(table(s, d, "part").select("p_partkey", "p_name"), {0: "key"})


@query("p07_edit_cols", "select c_custkey, lower(c_name) as c_name, lower(c_mktsegment) as c_mktsegment from customer")
def _(s, d):
    return P.edit_cols(table(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name", "c_mktsegment"], "lower(_)")


@query("p08_cols_to_front", "select o_totalprice, o_orderkey, o_custkey from orders")
def _(s, d):
    return P.cols_to_front(table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice")


@query("p09_header_table", "select * from (values (0, 'r_regionkey'), (1, 'r_name')) v(position, name)")
def _(s, d):
    return P.header_table(table(s, d, "region"))


@query("p10_add_col", "select p_partkey, round(p_retailprice * 1.1e0, 6) as price from part")
def _(s, d):
    return P.add_col(table(s, d, "part"), "price", "round(p_retailprice * 1.1e0, 6)").select("p_partkey", "price")


@query("p11_project", "select o_orderkey, o_totalprice from orders")
def _(s, d):
    return P.select_cols(table(s, d, "orders"), ["o_orderkey", "o_totalprice"])


@query("p12_project_to", "select p_partkey, p_brand from part")
def _(s, d):
    p = table(s, d, "part")
    return P.project_to(p, P.header_table(p.select("p_partkey", "p_brand")))


@query("p13_cols_like", "select l_discount, l_tax from lineitem")
def _(s, d):
    return P.cols_like(table(s, d, "lineitem"), "^l_(d|t|s)", "ship|supp")


@query("p14_reframe", "select s_suppkey as id, round(case when s_acctbal > 1 then ln(s_acctbal) end, 6) as bal, cast(s_nationkey as varchar) as nation from supplier")
def _(s, d):
    out = P.reframe(table(s, d, "supplier"), {"s_suppkey": "id", "s_acctbal": "bal", "s_nationkey": "nation"}, {"nation": "string"}, ["s_name"], log=["bal"], least=1.0)
    return out.withColumn("bal", F.round("bal", 6)).select("id", "bal", "nation")


@query("f01_filter_in", "select c_custkey, c_nationkey from customer where c_nationkey in (select n_nationkey from nation where n_regionkey = 1)")
def _(s, d):
    return P.filter_in(table(s, d, "customer"), "c_nationkey", table(s, d, "nation").where("n_regionkey = 1"), "n_nationkey").select("c_custkey", "c_nationkey")


@query("f02_filter_expr", "select l_orderkey, l_linenumber from lineitem where l_quantity > 40 and l_returnflag = 'R'")
def _(s, d):
    return P.filter_expr(table(s, d, "lineitem"), "l_quantity > 40 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber")


@query("f03_filter_cols", "select l_orderkey, l_linenumber from lineitem where abs(l_discount) < 0.05e0 and abs(l_tax) < 0.05e0")
def _(s, d):
    return P.filter_cols(table(s, d, "lineitem"), "^l_(discount|tax)$", "abs(_) < 0.05e0").select("l_orderkey", "l_linenumber")


@query("f04_filter_rownum", "select c_custkey, line from (select c_custkey, row_number() over (order by c_custkey) as line from customer) where line between 3 and 7 or line = 20")
def _(s, d):
    return P.filter_rownum(P.with_line(table(s, d, "customer").select("c_custkey"), ["c_custkey"]), "line", [(3, 7), 20])


@query("f05_kept_rownums", "select line from (select c_acctbal, row_number() over (order by c_custkey) as line from customer) where c_acctbal > 5000")
def _(s, d):
    return P.kept_rownums(P.with_line(table(s, d, "customer").select("c_custkey", "c_acctbal"), ["c_custkey"]), "line", "c_acctbal > 5000")


@query("f06_filter_results", f"select marker, chr, pos, round(p, 7) as p from ({X.ASSOC}) a where p < 0.5e0 and af between 0.02e0 and 0.98e0 and info >= 0.4e0 and abs(beta) < 10000")
def _(s, d):
    a = X.assoc(s, d).withColumnsRenamed({"af": "allele_freq", "info": "impute_info", "beta": "beta1.marker"})
    return P.filter_results(a, p=0.5).select("marker", "chr", "pos", F.round("p", 7).alias("p"))


@query("f07_complete_cases", f"select iid, marker from ({X.GT}) g where gt is not null")
def _(s, d):
    return P.complete_cases(X.gt(s, d), ["gt", "iid"]).select("iid", "marker")


@query("f08_subset", f"select iid, marker from ({X.GT}) g where gt > 1")
def _(s, d):
    return P.filter_expr(X.gt(s, d), "gt > 1").select("iid", "marker")


@query("f09_search_rows", "select s_suppkey from supplier where s_nationkey = 3")
def _(s, d):
    return P.search_rows(table(s, d, "supplier"), {"s_nationkey": 3}).select("s_suppkey")


@query("f10_null_logic", f"select marker, count(*) filter (where coalesce(gt = 2, false)) as f, count(*) filter (where coalesce(gt = 2, true)) as t, cast(sum(coalesce(gt, 0)) as bigint) as z, cast(sum(coalesce(gt, 9)) as bigint) as v from ({X.GT}) g group by marker")
def _(s, d):
    g = F.col("gt")
    return X.gt(s, d).groupBy("marker").agg(F.count_if(P.nif(g == 2)).alias("f"), F.count_if(P.nit(g == 2)).alias("t"), F.sum(P.niz(g)).alias("z"), F.sum(P.nina(g, 9)).alias("v"))


@query("f11_query", "select distinct o_custkey, o_orderstatus from orders where o_totalprice > 100000 and o_orderstatus like 'F%'")
def _(s, d):
    return P.query(table(s, d, "orders"), {"o_totalprice": (">", 100000), "o_orderstatus": ("like", "F%")}, columns=["o_custkey", "o_orderstatus"])


@query("f12_select_qc", f"select marker, round(stat, 5) as stat, 'y' as phenotype from (select *, 1 / p as stat from ({X.ASSOC}) a) where info * 100 >= 40 and af between 0.1e0 and 0.9e0 and p <= 0.001e0")
def _(s, d):
    a = X.assoc(s, d).withColumns({"r2t": F.col("info") * 100, "stat": 1 / F.col("p")})
    return P.select_qc(a, maf=0.1, p=0.001, phenotype="y")[2].select("marker", F.round("stat", 5).alias("stat"), "phenotype")


@query("f13_filter_topn", f"with a as ({X.ASSOC}), c as (select ceil(max(p) * 1e9) / 1e9 as cut from (select p from a order by p limit 50)) select marker, round(p, 7) as p from a, c where p < cut")
def _(s, d):
    return P.filter_topn(X.assoc(s, d), 50).select("marker", F.round("p", 7).alias("p"))


@query("f15_check_input", f"select count(*) as n, count(distinct iid) as n_ids, count(*) filter (where sex not in (1, 2)) as bad_sex, count(*) filter (where y is not null and age is not null) as n_complete, true as ok from ({X.SAMPLE}) s")
def _(s, d):
    return P.check_input(X.sample(s, d), ["y", "age"], "iid", "sex", ["y", "age"])


@query("f16_get_records", "select p_partkey, p_brand from part where p_partkey in (1, 2, 3)")
def _(s, d):
    ids = table(s, d, "part").where("p_partkey in (1, 2, 3)").select("p_partkey")
    return P.get_records(table(s, d, "part").select("p_partkey", "p_brand"), ids, "p_partkey")


# --- joins


@query("j01_merge", "select s_suppkey, n_name from supplier join nation on s_nationkey = n_nationkey")
def _(s, d):
    return J.merge(table(s, d, "supplier").withColumnRenamed("s_nationkey", "k"), table(s, d, "nation").withColumnRenamed("n_nationkey", "k")).select("s_suppkey", "n_name")


@query("j02_left_stable", "select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.col("c_custkey").alias("k"))
    return J.left_join_stable(c, table(s, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey"), ["k"], "c_custkey").select("c_custkey", "o_orderkey")


@query("j03_outer", "select coalesce(a.k, b.k) as k, a.na, b.nb from (select s_nationkey + 5 as k, count(*) as na from supplier group by 1) a full join (select c_nationkey as k, count(*) as nb from customer group by 1) b on a.k = b.k")
def _(s, d):
    a = table(s, d, "supplier").groupBy((F.col("s_nationkey") + 5).alias("k")).agg(F.count("*").alias("na"))
    b = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("nb"))
    return J.outer_join(a, b, ["k"])


@query("j04_merge_all", "select * from (select l_partkey as id, count(*) as a from lineitem where l_suppkey % 3 = 0 group by 1) x full join (select l_partkey as id, count(*) as b from lineitem where l_suppkey % 3 = 1 group by 1) y using (id) full join (select l_partkey as id, count(*) as c from lineitem where l_suppkey % 3 = 2 group by 1) z using (id)")
def _(s, d):
    li = table(s, d, "lineitem")
    return J.merge_all([li.where(f"l_suppkey % 3 = {k}").groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias(n)) for k, n in enumerate("abc")], ["id"])


@query("j05_map_values", "select n_nationkey, case r_name when 'ASIA' then 'east' when 'EUROPE' then 'west' else r_name end as r_name from nation join region on n_regionkey = r_regionkey")
def _(s, d):
    n = table(s, d, "nation").join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return J.map_values(n, "r_name", {"ASIA": "east", "EUROPE": "west"})


@query("j06_which_indices", "select c.c_custkey as line, min(o.o_orderkey) as at from customer c left join orders o on c.c_custkey = o.o_custkey group by 1")
def _(s, d):
    see = table(s, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("line"))
    return J.which_indices(see, table(s, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("line")), "key", "line")


@query("j07_range_join", f"with a as ({X.ASSOC}), h as (select marker as hit_marker, chr, pos as hit_pos from a where p < 0.002e0) select h.hit_marker, a.marker from a join h on a.chr = h.chr and abs(a.pos - h.hit_pos) < 5000")
def _(s, d):
    a = X.assoc(s, d).select("marker", "chr", "pos", "p")
    return J.range_join(a.where("p < 0.002e0").select("marker", "chr", "pos"), a.select("marker", "chr", "pos"), 5000).select("hit_marker", "marker")


@query("j08_intersect_order", "select a.c_nationkey as key, a.line as o1, b.line as o2 from (select c_nationkey, min(c_custkey) as line from customer group by 1) a join (select s_nationkey, min(s_suppkey) as line from supplier group by 1) b on a.c_nationkey = b.s_nationkey")
def _(s, d):
    a = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("key")).agg(F.min("c_custkey").alias("line"))
    b = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("key")).agg(F.min("s_suppkey").alias("line"))
    return J.intersect_order(a, b, "key", "line")


@query("j09_lookup_qc", f"with a as ({X.ASSOC}), q as (select chr, pos, min(info) as call_rate from a where info > 0.8e0 group by 1, 2) select a.marker, round(coalesce(q.call_rate, 1), 6) as call_rate from a left join q on a.chr = q.chr and a.pos = q.pos")
def _(s, d):
    a = X.assoc(s, d)
    q = a.where("info > 0.8e0").groupBy("chr", "pos").agg(F.min("info").alias("call_rate"))
    return J.lookup_qc(a.select("marker", "chr", "pos"), q, ["chr", "pos"], {"call_rate": 1.0}).select("marker", F.round("call_rate", 6).alias("call_rate"))


@query("j10_semi", "select p_partkey from part where p_partkey in (select l_partkey from lineitem where l_quantity > 49)")
def _(s, d):
    return P.filter_in(table(s, d, "part"), "p_partkey", table(s, d, "lineitem").where("l_quantity > 49"), "l_partkey").select("p_partkey")


@query("j11_anti", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)")
def _(s, d):
    return P.exclude_ids(table(s, d, "customer"), "c_custkey", table(s, d, "orders"), "o_custkey").select("c_custkey")


@query("j12_product", "select a.n_name as a, b.c_custkey as b from nation a, customer b where a.n_nationkey <> b.c_nationkey")
def _(s, d):
    a, b = table(s, d, "nation").select(F.col("n_name").alias("a"), "n_nationkey"), table(s, d, "customer").select(F.col("c_custkey").alias("b"), "c_nationkey")
    return J.product([b, a], drop_equal=("n_nationkey", "c_nationkey")).select("a", "b")


@query("j13_row_search", "select a.s_suppkey as line_a, b.c_custkey as line_b from supplier a join customer b on a.s_nationkey is not distinct from b.c_nationkey and floor(a.s_acctbal / 1000) is not distinct from floor(b.c_acctbal / 1000)")
def _(s, d):
    a = table(s, d, "supplier").select(F.col("s_nationkey").alias("k"), F.floor(F.col("s_acctbal") / 1000).alias("b"), F.col("s_suppkey").alias("line"))
    b = table(s, d, "customer").select(F.col("c_nationkey").alias("k"), F.floor(F.col("c_acctbal") / 1000).alias("b"), F.col("c_custkey").alias("line"))
    return J.row_search(a, b, ["k", "b"], "line")


@query("j14_analysis_frame", f"select g.marker, g.gt, s.strat, count(*) as n, round(sum(s.y), 2) as y from ({X.GT}) g left join ({X.SAMPLE}) s using (iid) group by 1, 2, 3")
def _(s, d):
    p = X.sample(s, d)
    return J.analysis_frame(X.gt(s, d).select("iid", "marker", "gt"), p.select("iid", "sex"), p.select("iid", "y", "strat")).groupBy("marker", "gt", "strat").agg(F.count("*").alias("n"), F.round(F.sum("y"), 2).alias("y"))


@query("j15_read_variables", "select o_custkey as id, min_by(o_orderstatus, o_orderkey) as st, c_acctbal as bal from (select * from orders) o full join customer c on o.o_custkey = c.c_custkey where o_custkey is not null group by o_custkey, c_acctbal")
def _(s, d):
    o = table(s, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("line"), F.col("o_orderstatus").alias("st"))
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("line"), F.col("c_acctbal").alias("bal"))
    return J.read_variables([o, c], "id", "line", "st")


@query("j16_replace_positions", "select p_partkey as id, case when p_partkey % 3 = 0 then p_partkey * 2 else p_size end as pos from part")
def _(s, d):
    p = table(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("pos"))
    return J.replace_positions(p, p.where("id % 3 = 0").select("id", (F.col("id") * 2).alias("pos")), "id")


@query("j17_remap_ids", "select line, case when k = 1 then id else id || '-' || cast(k - 1 as varchar) end as id from (select line, id, row_number() over (partition by id order by line) as k from (select p_partkey as line, case when p_brand = 'Brand#11' then 'X' else p_brand end as id from part))")
def _(s, d):
    bim = table(s, d, "part").select(F.col("p_partkey").alias("line"), F.col("p_brand").alias("id"))
    mapping = bim.where("id = 'Brand#11'").select(F.col("id").alias("from"), F.lit("X").alias("to")).distinct()
    return J.remap_ids(bim, mapping, "line").select("line", "id")


@query("j18_complete_pairs", "with i as (select s_suppkey as id from supplier), p as (select a.id as id1, b.id as id2, a.id * b.id as value from i a, i b where a.id < b.id and (a.id + b.id) % 2 = 0), f as (select * from p union all select id2, id1, value from p) select a.id as id1, b.id as id2, f.value from i a cross join i b left join f on f.id1 = a.id and f.id2 = b.id")
def _(s, d):
    i = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"))
    p = i.select(F.col("id").alias("id1")).crossJoin(i.select(F.col("id").alias("id2"))).where("id1 < id2 and (id1 + id2) % 2 = 0").withColumn("value", F.col("id1") * F.col("id2"))
    return J.complete_pairs(p, i)


@query("j19_genes_to_markers", "select cast(c_nationkey as varchar) as gene, count(distinct c_custkey) as n from customer group by 1")
def _(s, d):
    c = table(s, d, "customer").select(F.concat(F.lit("/x/"), F.col("c_nationkey").cast("string"), F.lit(".txt")).alias("path"), F.col("c_custkey").alias("marker"))
    return J.genes_to_markers(c).select("gene", F.size("markers").cast("long").alias("n"))


_TRIPLES = "select 'g' || l_partkey as subject, 'interacts' as predicate, 'g' || l_suppkey as object from lineitem union all select 'g' || p_partkey, 'in_pathway', 'w' || p_size from part union all select 'w' || p_size, 'label', p_brand from part"


def _triples(s, d):
    li, p = table(s, d, "lineitem"), table(s, d, "part")
    t = li.select(F.concat(F.lit("g"), "l_partkey").alias("subject"), F.lit("interacts").alias("predicate"), F.concat(F.lit("g"), "l_suppkey").alias("object"))
    return t.unionByName(p.select(F.concat(F.lit("g"), "p_partkey").alias("subject"), F.lit("in_pathway").alias("predicate"), F.concat(F.lit("w"), "p_size").alias("object"))).unionByName(p.select(F.concat(F.lit("w"), "p_size").alias("subject"), F.lit("label").alias("predicate"), F.col("p_brand").alias("object")))


@query("j20_pathway_genes", f"with t as ({_TRIPLES}) select distinct a.subject as gene from t a join t b on a.object = b.subject where a.predicate = 'in_pathway' and b.predicate = 'label' and b.object like '%2'")
def _(s, d):
    return J.pathway_genes(_triples(s, d), "2$")


@query("j21_partners", f"with t as ({_TRIPLES}), s as (select distinct 'g' || p_partkey as g from part where p_partkey % 7 = 0), e as (select object as gene from t join s on subject = g where predicate = 'interacts' union select subject from t join s on object = g where predicate = 'interacts') select gene from e where gene not in (select g from s)")
def _(s, d):
    return J.partners(_triples(s, d), table(s, d, "part").where("p_partkey % 7 = 0").select(F.concat(F.lit("g"), "p_partkey").alias("gene")))


@query("j22_missing_snps", "select distinct l_partkey as rs from lineitem where l_partkey not in (select p_partkey from part where p_size < 25)")
def _(s, d):
    return J.extract_snps(table(s, d, "lineitem").select(F.col("l_partkey").alias("rs")), table(s, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("rs")))[1]


@query("j23_align_alleles", f"select marker as snp, case when marker % 5 = 0 then 'swapped' when marker % 5 = 1 then case when translate(a1, 'ACGT', 'TGCA') = a2 then 'swapped' else 'flip' end when marker % 5 = 2 then 'incompatible' else 'same' end as kind from ({X.MARKER}) m")
def _(s, d):
    m = X.marker(s, d).withColumnRenamed("marker", "snp")
    ref = m.select("chr", "snp", F.when(F.col("snp") % 5 == 0, F.col("a2")).when(F.col("snp") % 5 == 1, F.translate("a1", "ACGT", "TGCA")).when(F.col("snp") % 5 == 2, "N").otherwise(F.col("a1")).alias("a1"), F.when(F.col("snp") % 5 == 0, F.col("a1")).when(F.col("snp") % 5 == 1, F.translate("a2", "ACGT", "TGCA")).otherwise(F.col("a2")).alias("a2"))
    return J.align_alleles(m.select("chr", "snp", "a1", "a2"), ref).select("snp", "kind")


# --- sets


@query("u01_union", "select c_nationkey as id from customer union select s_nationkey from supplier")
def _(s, d):
    return U.union_sets(table(s, d, "customer").select(F.col("c_nationkey").alias("id")), table(s, d, "supplier").select(F.col("s_nationkey").alias("id")))


@query("u02_intersect", "select l_partkey as id from lineitem where l_quantity > 45 intersect select l_partkey from lineitem where l_discount = 0")
def _(s, d):
    li = table(s, d, "lineitem")
    return U.intersect(li.where("l_quantity > 45").select(F.col("l_partkey").alias("id")), li.where("l_discount = 0").select(F.col("l_partkey").alias("id")))


@query("u03_minus", "select o_custkey as id from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 5000)")
def _(s, d):
    return U.minus(table(s, d, "orders").select(F.col("o_custkey").alias("id")), table(s, d, "customer").where("c_acctbal < 5000").select(F.col("c_custkey").alias("id")), "id")


@query("u04_compare", "with a as (select distinct l_partkey as id from lineitem), b as (select p_partkey as id from part where p_size > 5), c as (select (select count(*) from a where id not in (select id from b)) as only_a, (select count(*) from b where id not in (select id from a)) as only_b) select only_a, only_b, only_a = 0 and only_b = 0 as identical from c")
def _(s, d):
    return U.compare_sets(table(s, d, "lineitem").select(F.col("l_partkey").alias("id")), table(s, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("id")))


@query("u05_df_diff", "select l_returnflag, l_linestatus, l_linenumber from lineitem except select l_returnflag, l_linestatus, l_linenumber from lineitem where l_linenumber > 2")
def _(s, d):
    li = table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return U.df_diff(li, li.where("l_linenumber > 2"))


def _changed(s, d):
    a = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("v"))
    b = a.where("id % 5 <> 0").select("id", F.when(F.col("id") % 3 == 0, F.col("v") + 1).otherwise(F.col("v")).alias("v")).unionByName(a.where("id < 4").select((F.col("id") + 1000000).alias("id"), "v"))
    return a, b


@query("u06_change_set", "select s_suppkey as id, case when s_suppkey % 5 = 0 then 'deleted' else 'updated' end as state from supplier where s_suppkey % 5 = 0 or s_suppkey % 3 = 0 union all select s_suppkey + 1000000, 'new' from supplier where s_suppkey < 4")
def _(s, d):
    return U.change_set(*_changed(s, d), "id").select("id", "state")


@query("u07_apply_changes", "select s_suppkey as id, case when s_suppkey % 3 = 0 then s_nationkey + 1 else s_nationkey end as v from supplier where s_suppkey % 5 <> 0 union all select s_suppkey + 1000000, s_nationkey from supplier where s_suppkey < 4")
def _(s, d):
    a, b = _changed(s, d)
    return U.apply_changes(a, U.change_set(a, b, "id"), "id")


@query("u08_sync", "select coalesce(a.id, b.id) as id, case when b.id is null then 'new' when a.id is null then 'deleted' when a.ts > b.ts then 'newer_leaf' when a.ts < b.ts then 'newer_reference' else 'same' end as state from (select o_custkey as id, max(o_orderdate) as ts from orders where o_orderstatus = 'F' group by 1) a full join (select o_custkey as id, max(o_orderdate) as ts from orders where o_orderstatus = 'O' group by 1) b on a.id = b.id")
def _(s, d):
    side = lambda x: table(s, d, "orders").where(f"o_orderstatus = '{x}'").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderdate").alias("ts"))
    return U.sync_sets(side("F"), side("O"), "id", "ts")


def _exclusions(s, d):
    i = X.sample(s, d)
    rows = [i.where(c).select(F.lit("ind").alias("kind"), F.lit(r).alias("reason"), F.col("iid").alias("id")) for r, c in (("missing", "iid % 10 = 0"), ("sex", "iid % 7 = 0"), ("inbreeding", "iid % 11 = 0"), ("external", "iid % 13 = 0"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("u09_exclusions", "select c_custkey as id from customer where c_custkey % 10 = 0 or c_custkey % 7 = 0")
def _(s, d):
    return U.exclusions(_exclusions(s, d), "ind", "baseline")


@query("u10_exclusion_summary", "with i as (select c_custkey as id from customer), n as (select count(*) as n from i) select 'missing' as reason, count(*) filter (where id % 10 = 0) as ne, round(100.0e0 * count(*) filter (where id % 10 = 0) / max(n), 6) as percent, cast(count(*) filter (where id % 10 = 0) as bigint) as cumulative from i, n union all select 'sex', count(*) filter (where id % 7 = 0), round(100.0e0 * count(*) filter (where id % 7 = 0) / max(n), 6), count(*) filter (where id % 10 = 0 or id % 7 = 0) from i, n union all select 'inbreeding', count(*) filter (where id % 11 = 0), round(100.0e0 * count(*) filter (where id % 11 = 0) / max(n), 6), count(*) filter (where id % 10 = 0 or id % 7 = 0 or id % 11 = 0) from i, n")
def _(s, d):
    n = table(s, d, "customer").count()
    return U.exclusion_summary(_exclusions(s, d), ["missing", "sex", "inbreeding"], n).withColumn("percent", F.round("percent", 6))


@query("u11_external", "select c_custkey as id from customer where c_custkey % 13 = 0 or c_custkey % 17 = 0 or c_acctbal < 0")
def _(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return U.external_exclusions(c.where("id % 13 = 0"), [c.where("id % 17 = 0")], None, c.where("c_acctbal < 0"))


# --- aggregation and reshaping


@query("a01_group_max_row", "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders) where k = 1")
def _(s, d):
    return A.group_max_row(table(s, d, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("a02_by_apply", "select c_nationkey, round(max(c_acctbal) - min(c_acctbal), 4) as spread from customer group by 1")
def _(s, d):
    import pandas as pd

    def spread(p):
        return pd.DataFrame({"c_nationkey": p["c_nationkey"].iloc[:1], "spread": [round(p["c_acctbal"].max() - p["c_acctbal"].min(), 4)]})

    return A.by_apply(table(s, d, "customer").select("c_nationkey", "c_acctbal"), ["c_nationkey"], spread, "c_nationkey int, spread double")


@query("a03_table_n", "select l_linenumber, count(*) filter (where l_returnflag = 'A') as \"n_A\", count(*) filter (where l_returnflag = 'N') as \"n_N\", count(*) filter (where l_returnflag = 'Z') as \"n_Z\" from lineitem group by 1")
def _(s, d):
    return A.table_n(table(s, d, "lineitem"), "l_returnflag", ["A", "N", "Z"], ["l_linenumber"])


@query("a04_table_freq", "select event_type, count(*) as n, round(count(*) / (select count(*) from events where event_type is not null), 8) as freq from events where event_type is not null group by 1")
def _(s, d):
    return A.table_freq(table(s, d, "events"), "event_type").withColumn("freq", F.round("freq", 8))


@query("a05_truth", "select count(*) filter (where l_quantity > 25) as n_true, round(avg(cast(l_quantity > 25 as double)), 8) as fraction, count(distinct l_partkey) as cardinality from lineitem")
def _(s, d):
    return A.truth(table(s, d, "lineitem"), "l_quantity > 25", "l_partkey").withColumn("fraction", F.round("fraction", 8))


@query("a06_entropy", "with f as (select count(*) / (select count(*) from orders) as f from orders group by o_orderpriority) select round(-sum(f * ln(f)), 8) as entropy from f")
def _(s, d):
    return A.entropy(table(s, d, "orders"), "o_orderpriority").withColumn("entropy", F.round("entropy", 8))


_SUMMARY = "select '{c}' as variable, round(min({c}), 5) as min, round(quantile_cont({c}, 0.25), 5) as q25, round(quantile_cont({c}, 0.5), 5) as median, round(quantile_cont({c}, 0.75), 5) as q75, round(max({c}), 5) as max, round(avg({c}), 5) as mean, round(stddev_samp({c}), 5) as sd, round(avg(cast({c} is null as double)), 5) as missing from lineitem"


@query("a07_summary_num", " union all ".join(_SUMMARY.format(c=c) for c in ("l_quantity", "l_discount")))
def _(s, d):
    out = A.summary_num(table(s, d, "lineitem"), ["l_quantity", "l_discount"])
    return out.select("variable", *(F.round(c, 5).alias(c) for c in out.columns[1:]))


_A08 = """with x as (select l_extendedprice * 1e0 as x, row_number() over (order by l_extendedprice) as k, count(*) over () as n from lineitem), h as (select quantile_cont(x, 0.5e0) filter (where k <= (n + 1) // 2) as lo, quantile_cont(x, 0.5e0) filter (where k > n // 2) as hi, quantile_cont(x, 0.5e0) as median from x)
 select count(*) as n, cast(0 as bigint) as n_na, 0e0 as na_percent, round(avg(x), 4) as mean, round(max(median), 4) as median, round(stddev_samp(x) / sqrt(count(*)), 5) as se, count(*) filter (where x < lo - 1.5e0 * (hi - lo) or x > hi + 1.5e0 * (hi - lo)) as outliers from x, h"""


@query("a08_descriptives", _A08)
def _(s, d):
    out = A.descriptives(table(s, d, "lineitem"), "l_extendedprice")
    return out.withColumns({"mean": F.round("mean", 4), "median": F.round("median", 4), "se": F.round("se", 5)})


@query("a09_sample_description", "select round(avg(o_totalprice), 4) as mean, round(quantile_cont(o_totalprice, 0.5e0), 4) as median, round(stddev_samp(o_totalprice), 4) as sd, round(quantile_cont(o_totalprice, 0.25e0), 4) as lo, round(quantile_cont(o_totalprice, 0.75e0), 4) as hi from orders")
def _(s, d):
    out = A.sample_description(table(s, d, "orders"), "o_totalprice")
    return out.select(*(F.round(c, 4).alias(c) for c in ("mean", "median", "sd")), F.round(F.get("quantiles", F.lit(0)), 4).alias("lo"), F.round(F.get("quantiles", F.lit(1)), 4).alias("hi"))


@query("a10_skewness", "with m as (select avg(l_extendedprice) as m, count(*) as n from lineitem) select round(sum(power(l_extendedprice - m, 3)) / max(n) / power(sum(power(l_extendedprice - m, 2)) / max(n), 1.5e0) * power(1 - 1.0e0 / max(n), 1.5e0), 6) as skewness from lineitem, m")
def _(s, d):
    return A.skewness(table(s, d, "lineitem"), "l_extendedprice").withColumn("skewness", F.round("skewness", 6))


_SETS = "(select distinct l_linenumber as set, l_partkey as id from lineitem)"


@query("a12_set_overlaps", f"with s as {_SETS}, z as (select set, count(*) as n from s group by 1), c as (select a.set as s1, b.set as s2, count(*) as common from s a join s b on a.id = b.id group by 1, 2) select x.set as s1, y.set as s2, coalesce(common, 0) as common, x.n + y.n - coalesce(common, 0) as either, x.n - coalesce(common, 0) as only1 from z x cross join z y left join c on c.s1 = x.set and c.s2 = y.set")
def _(s, d):
    return A.set_overlaps(table(s, d, "lineitem").select(F.col("l_linenumber").alias("set"), F.col("l_partkey").alias("id")))


@query("a13_union_cum", f"with s as {_SETS}, f as (select id, min(set) as set from s group by 1), k as (select set, count(*) as k from f group by 1) select x.set, cast((select sum(k) from k where k.set <= x.set) as bigint) as size from (select distinct set from s) x")
def _(s, d):
    return A.union_cum(table(s, d, "lineitem").select(F.col("l_linenumber").alias("set"), F.col("l_partkey").alias("id")))


@query("a14_reshape_wide", "select l_orderkey, case when count(*) filter (where l_linenumber = 1) = 1 then max(l_quantity) filter (where l_linenumber = 1) end as \"l_quantity.1\", case when count(*) filter (where l_linenumber = 2) = 1 then max(l_quantity) filter (where l_linenumber = 2) end as \"l_quantity.2\" from lineitem group by 1")
def _(s, d):
    return A.reshape_wide(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_linenumber", [1, 2], ["l_quantity"])


@query("a15_reshape_long", "select s_suppkey, 'a' as part, s_acctbal as value from supplier union all select s_suppkey, 'b', s_acctbal * 2 from supplier")
def _(s, d):
    return A.reshape_long(table(s, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("a"), (F.col("s_acctbal") * 2).alias("b")), ["a", "b"], "part", "value")


@query("a16_reshape_long_re", "select s_suppkey, 1 as k, s_acctbal as x, cast(s_nationkey as bigint) as y from supplier union all select s_suppkey, 2, s_acctbal + 1, null from supplier")
def _(s, d):
    t = table(s, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("x1"), (F.col("s_acctbal") + 1).alias("x.2"), F.col("s_nationkey").cast("long").alias("y_1"))
    return A.reshape_long_re(t, ["x", "y"])


@query("a17_transpose", "select 0 as \"column\", string_agg(cast(s_suppkey as varchar), ',' order by s_suppkey) as cells from supplier union all select 1, string_agg(s_name, ',' order by s_suppkey) from supplier")
def _(s, d):
    return A.transpose(table(s, d, "supplier"), "s_suppkey", ["s_suppkey", "s_name"]).select("column", F.array_join("cells", ",").alias("cells"))


@query("a18_cbind", "select coalesce(a.line, b.line) as line, a.n_name as name, b.s_name as \"name.1\" from (select n_nationkey + 1 as line, n_name from nation) a full join (select s_suppkey as line, s_name from supplier) b on a.line = b.line")
def _(s, d):
    a = table(s, d, "nation").select((F.col("n_nationkey") + 1).cast("long").alias("line"), F.col("n_name").alias("name"))
    return A.cbind([a, table(s, d, "supplier").select(F.col("s_suppkey").alias("line"), F.col("s_name").alias("name"))], "line")


@query("a19_rbind_all", "select c_custkey as k, c_acctbal as bal, null as x, 'c' as id from customer union all select s_suppkey, null, s_nationkey, 's' from supplier")
def _(s, d):
    return A.rbind_all({"c": table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal")), "s": table(s, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("x"))})


@query("a22_expand_weights", "select p_partkey, cast(unnest(range(1, p_size % 4 + 1)) as int) as copy from part where p_size % 4 > 0")
def _(s, d):
    return A.expand_weights(table(s, d, "part").select("p_partkey", (F.col("p_size") % 4).alias("w")), "w").select("p_partkey", "copy")


@query("a23_expand_factors", "select s_suppkey, cast(s_nationkey % 3 = 1 as int) as \"f.1\", cast(s_nationkey % 3 = 2 as int) as \"f.2\" from supplier")
def _(s, d):
    return A.expand_factors(table(s, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 3).alias("f")), ["f"])


@query("a24_recode", "select o_orderkey, case o_orderstatus when 'F' then 'done' when 'O' then 'open' end as o_orderstatus from orders")
def _(s, d):
    return A.recode_levels(table(s, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "done", "O": "open"})


@query("a25_factor_from", "select l_orderkey, l_linenumber, l_returnflag || ';' || l_linestatus as factor from lineitem")
def _(s, d):
    return A.factor_from(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", "factor")


@query("a26_value_combinations", "select a.l_returnflag, b.l_linenumber from (select distinct l_returnflag from lineitem) a, (select distinct l_linenumber from lineitem) b")
def _(s, d):
    return A.value_combinations(table(s, d, "lineitem"), ["l_returnflag", "l_linenumber"])


@query("a27_lump_factor")
def _(s, d):
    return A.lump_factor(table(s, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", 50)


@query("a28_corr_clusters", "select * from (select case when abs(corr(l_quantity, l_extendedprice)) > 0.99e0 then 1 else 0 end as near from lineitem) x, (values ('l_quantity', 'l_quantity'), ('twice', 'l_quantity'), ('l_tax', 'l_tax')) v(\"column\", cluster) union all select near, 'l_extendedprice', case when near = 1 then 'l_quantity' else 'l_extendedprice' end from (select cast(abs(corr(l_quantity, l_extendedprice)) > 0.99e0 as int) as near from lineitem) y")
def _(s, d):
    t = table(s, d, "lineitem").select("l_quantity", "l_extendedprice", (F.col("l_quantity") * 2).alias("twice"), "l_tax")
    out = A.corr_clusters(t, ["l_quantity", "l_extendedprice", "twice", "l_tax"], 0.01)
    return out.select("column", "cluster", F.lit(0).alias("near"))


def _label_rounds(edges: str, rounds: int) -> str:
    """Least labels over ``rounds`` steps; the graph of the query is far narrower."""
    parts = [f"e as materialized ({edges})", "l as materialized (select a, b from e union select b, a from e)", "r0 as materialized (select distinct a as node, a as root from l)"]
    for k in range(rounds):
        parts.append(f"r{k + 1} as materialized (select r.node, least(r.root, min(o.root)) as root from r{k} r join l on l.a = r.node join r{k} o on o.node = l.b group by r.node, r.root)")
    return f"with {', '.join(parts)} select node, root from r{rounds}"


@query("a29_components", _label_rounds("select distinct l_partkey * 2 as a, l_suppkey * 2 + 1 as b from lineitem", 12))
def _(s, d):
    li = table(s, d, "lineitem")
    return A.components(li.select((F.col("l_partkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b")).where("a <> b"))


@query("a30_center", "select s_suppkey, round(s_acctbal - (select avg(s_acctbal) from supplier), 5) as s_acctbal from supplier")
def _(s, d):
    return A.center(table(s, d, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal"]).withColumn("s_acctbal", F.round("s_acctbal", 5))


@query("a31_standardize", "select s_suppkey, round((s_acctbal - (select avg(s_acctbal) from supplier)) / (select stddev_samp(s_acctbal) from supplier), 6) as s_acctbal from supplier")
def _(s, d):
    return A.center(table(s, d, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal"], scale=True).withColumn("s_acctbal", F.round("s_acctbal", 6))


@query("a32_minimax", "select p_partkey, greatest(1000, least(1500, p_retailprice)) as x from part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", A.minimax(F.col("p_retailprice"), 1000.0, 1500.0).alias("x"))


@query("a33_design_matrix", f"select iid, y, age, cast(strat = (select strat from (select distinct strat from ({X.SAMPLE}) x) order by strat limit 1 offset 1) as int) as second, 1e0 as intercept from ({X.SAMPLE}) s")
def _(s, d):
    m = A.design_matrix(X.sample(s, d), "y ~ age + strat", "iid")
    second = next(c for c in m.columns if c.startswith("strat."))
    return m.select("iid", "y", "age", F.col(f"`{second}`").alias("second"), "intercept")


@query("a33_design_offset", f"select iid, y, age, ln(20e0 + sex) as \"offset\" from ({X.SAMPLE}) s where age is not null")
def _(s, d):
    m = A.design_matrix(X.sample(s, d), "y ~ age", "iid", intercept=False, offset="ln(20 + sex)")
    return m


@query("a34_records", "select s_suppkey, s_name as a, case when s_suppkey % 2 = 0 then cast(s_nationkey as varchar) end as b from supplier")
def _(s, d):
    t = table(s, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.create_map(F.lit("a"), "s_name", F.lit("b"), F.col("s_nationkey").cast("string"))).otherwise(F.create_map(F.lit("a"), "s_name")).alias("m"))
    return A.records_to_frame(t, "m", "s_suppkey")


# --- order and windows


@query("w01_lag_cum", "select o_orderkey, round(o_totalprice - lag(o_totalprice) over w, 4) as diff, round(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows unbounded preceding), 4) as cum from orders window w as (partition by o_custkey order by o_orderkey)")
def _(s, d):
    out = W.cum_sum(W.lag_diff(table(s, d, "orders"), "o_totalprice", ["o_custkey"], ["o_orderkey"]), "o_totalprice", ["o_custkey"], ["o_orderkey"])
    return out.select("o_orderkey", F.round("diff", 4).alias("diff"), F.round("cum", 4).alias("cum"))


_PRUNE = "select marker, chr, pos, p from (select *, row_number() over (partition by chr, g order by p, marker) as k from (select *, sum(nw) over (partition by chr order by pos, marker rows unbounded preceding) as g from (select *, case when pos - lag(pos) over (partition by chr order by pos, marker) > {d} or lag(pos) over (partition by chr order by pos, marker) is null then 1 else 0 end as nw from ({t})))) where k = 1"


@query("w02_prune_distance", f"select marker, chr, pos, round(p, 7) as p from ({_PRUNE.format(d=500, t=X.ASSOC)})")
def _(s, d):
    return W.prune_distance(X.assoc(s, d), 500).select("marker", "chr", "pos", F.round("p", 7).alias("p"))


def prune_rounds(d: int, rounds: int, source: str = X.ASSOC, wanted: str = "marker") -> str:
    """All rounds as chained tables, from d/100 to d in steps even in logs; the distances are written out as they are at d = 20000."""
    steps = [200, 278, 386, 537, 746, 1036, 1439, 2000, 2779, 3861, 5365, 7455, 10359, 14394, 20000]
    assert len(steps) == rounds and steps[-1] == d
    parts = [f"r0 as materialized ({source})"]
    for k, step in enumerate(steps):
        parts.append(f"r{k + 1} as materialized ({_PRUNE.format(d=step, t=f'select * from r{k}')})")
    return f"with {', '.join(parts)} select {wanted} from r{rounds}"


@query("w03_prune_iter", prune_rounds(20000, 15))
def _(s, d):
    return W.prune_distance_iter(X.assoc(s, d), 20000).select("marker")


_W04 = f"""with recursive c as materialized (select marker, chr, pos, p from ({X.ASSOC}) a order by p, marker limit 600), t(k, taken) as (select 0, cast([] as struct(marker bigint, chr int, pos bigint)[]) union all
 select k + 1, list_append(taken, (select struct_pack(marker := marker, chr := chr, pos := pos) from c where len([x for x in t.taken if x.marker = c.marker or (x.chr = c.chr and abs(x.pos - c.pos) > 0 and abs(x.pos - c.pos) < 20000)]) = 0 order by p, marker limit 1)) from t where k < 20)
 select h.marker, c.chr, c.pos, round(c.p, 7) as p from (select unnest(taken).marker as marker from t where k = 20) h join c on c.marker = h.marker"""


@query("w04_top_hits", _W04)
def _(s, d):
    return W.top_hits(X.assoc(s, d), 20, 20000).select("marker", "chr", "pos", F.round("p", 7).alias("p"))


@query("w05_genome_positions", f"with a as ({X.ASSOC}), e as (select chr, max(pos) as length from a group by 1) select a.marker, cast(coalesce((select sum(length) from e where e.chr < a.chr), 0) + a.pos as bigint) as genome_pos from a")
def _(s, d):
    return W.genome_positions(X.assoc(s, d))[0].select("marker", "genome_pos")


@query("w06_qq_points", f"with a as (select marker, p, row_number() over (order by p, marker) as rank, count(*) over () as n from ({X.ASSOC}) a) select rank, marker, round(-log10(rank / n), 8) as expected, round(-log10(p), 8) as observed from a")
def _(s, d):
    return W.qq_points(X.assoc(s, d)).select("rank", "marker", F.round("expected", 8).alias("expected"), F.round("observed", 8).alias("observed"))


@query("w07_dedup_labels", "select p_partkey, case when k = 1 then p_brand else p_brand || '-' || cast(k - 1 as varchar) end as p_brand from (select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) as k from part)")
def _(s, d):
    return W.dedup_labels(table(s, d, "part").select("p_partkey", "p_brand"), "p_brand", ["p_partkey"])


_CELL = "select least(cast(floor((l_quantity - x0) / (x1 - x0) * 20) as bigint), 19) as cell_x, least(cast(floor((l_extendedprice - y0) / (y1 - y0) * 20) as bigint), 19) as cell_y from lineitem, (select min(l_quantity) as x0, max(l_quantity) as x1, min(l_extendedprice) as y0, max(l_extendedprice) as y1 from lineitem) e"


@query("w08_bin_thin", f"select cell_x, cell_y, least(count(*), 3) as n from ({_CELL}) c group by 1, 2")
def _(s, d):
    """How many rows are left in each cell; which ones is up to the hash."""
    out = W.bin_thin(table(s, d, "lineitem").select(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"), "l_quantity", "l_extendedprice"), "l_quantity", "l_extendedprice", 20, 3, "key")
    return out.groupBy("cell_x", "cell_y").agg(F.count("*").alias("n"))


@query("w09_order_rows", "select o_orderkey from orders order by o_orderstatus, o_orderkey")
def _(s, d):
    return W.order_rows(table(s, d, "orders"), ["o_orderstatus", "o_orderkey"], dictionary={"o_orderstatus": ["F", "O", "P"]}).select("o_orderkey")


@query("w10_insert_order", "select c_name, lpad(cast(c_custkey as varchar), 6, '0') as \"order\" from customer")
def _(s, d):
    c = table(s, d, "customer")
    return W.insert_order(c.select("c_name"), "c_name", c, "c_name", "c_custkey")


@query("w11_order_align", "select c_custkey from customer where c_custkey in (select o_custkey from orders)")
def _(s, d):
    ref = table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("at"))
    return W.order_align(ref, table(s, d, "customer").select("c_custkey"), "c_custkey", "at")


@query("w12_top_n", "select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 25")
def _(s, d):
    return W.top_n(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"), "l_extendedprice", 25, False, ["l_orderkey", "l_linenumber", "l_partkey"]).drop("l_partkey")


@query("w12_which_max", "select min(p_partkey) as at from part where p_size = (select max(p_size) from part)")
def _(s, d):
    return W.which_max(table(s, d, "part"), "p_size", "p_partkey")


@query("w13_unique_by", "select o_custkey, o_orderstatus, min(o_orderkey) as o_orderkey from orders group by 1, 2")
def _(s, d):
    return W.unique_by(table(s, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey"), ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("w14_quantile_bins", "with q as (select quantile_cont(p_retailprice, 0.25) as a, quantile_cont(p_retailprice, 0.5) as b, quantile_cont(p_retailprice, 0.75) as c from part) select p_partkey, 1 + cast(p_retailprice > a as int) + cast(p_retailprice > b as int) + cast(p_retailprice > c as int) as bin from part, q")
def _(s, d):
    return W.quantile_bins(table(s, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 4).select("p_partkey", "bin")


def _normalized(cols: dict[str, str]) -> str:
    """Each column at the quantiles of ``a``, from mean ranks."""
    levels = ", ".join(f"{k / 1000!r}" for k in range(1001))
    ranks = " union all ".join(f"select s_suppkey, '{c}' as col, (rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2 - 1) / greatest(count(*) over () - 1, 1) * 1000 as u from t" for c in cols)
    value = "g[cast(floor(u) as int) + 1] * (1 - (u - floor(u))) + coalesce(g[cast(floor(u) as int) + 2], g[cast(floor(u) as int) + 1]) * (u - floor(u))"
    wide = ", ".join(f"round(max(x) filter (where col = '{c}'), 4) as {c}" for c in cols)
    return f"with t as (select s_suppkey, {', '.join(f'{e} as {c}' for c, e in cols.items())} from supplier), g as (select quantile_cont(a, [{levels}]) as g from t), r as ({ranks}), v as (select s_suppkey, col, {value} as x from r, g) select s_suppkey, {wide} from v group by 1"


@query("w15_quantile_normalize", _normalized({"a": "s_acctbal", "b": "s_acctbal * s_acctbal"}))
def _(s, d):
    t = table(s, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("a"), (F.col("s_acctbal") * F.col("s_acctbal")).alias("b"))
    out = W.quantile_normalize(t.select("a"), t, ["a", "b"], "s_suppkey")
    return out.select("s_suppkey", F.round("a", 4).alias("a"), F.round("b", 4).alias("b"))


@query("w16_quantile_medians", _normalized({"a": "s_acctbal", "b": "s_acctbal * 3", "c": "s_acctbal - 5"}))
def _(s, d):
    t = table(s, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("a"), (F.col("s_acctbal") * 3).alias("b"), (F.col("s_acctbal") - 5).alias("c"))
    out = W.quantile_normalize_medians(t, ["a", "b", "c"], "s_suppkey", 0)
    return out.select("s_suppkey", *(F.round(c, 4).alias(c) for c in "abc"))


@query("w18_drop_duplicates", "select c_custkey from (select c_custkey, row_number() over (partition by c_nationkey, c_mktsegment order by c_acctbal, c_custkey) as k from customer) where k > 1")
def _(s, d):
    return W.drop_duplicates_by(table(s, d, "customer"), ["c_nationkey", "c_mktsegment"], "c_acctbal", "c_custkey")[1].select("c_custkey")

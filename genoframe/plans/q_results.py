"""Queries of summaries, meta-analysis, scores, prediction and survival (R), scalars (X), sources and streams (SC)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators import genotypes as G
from genoframe.operators import results as R
from genoframe.operators import windows as W
from genoframe.operators.windows import shared_base
from genoframe.plans import fixtures as X
from genoframe.plans import tails
from genoframe.plans.q_genetics import _COUNTS
from genoframe.plans.q_tables import prune_rounds
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


def _rounded(df, n: int, *cols: str):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), n) for c in cols})


A = X.ASSOC


@query("r01_inflation", f"with m as (select quantile_disc(p, 0.5e0) as a, (select max(p) from (select p from ({A}) b order by p limit (select count(*) // 2 + 1 from ({A}) c))) as b from ({A}) a), x as (select {tails.chi2_quantile_of('(select a from m)')} as x, {tails.chi2_quantile_of('(select b from m)')} as y) select round((x + y) / 2 / 0.4549e0, 6) as lambda_median, round(power((sqrt(x) + sqrt(y)) / 2, 2) / 0.4549e0, 6) as lambda_roots, round((x + y) / 2 / 0.456e0, 6) as lambda_stat from x")
def _(s, d):
    return _rounded(R.inflation(X.assoc(s, d)), 6, "lambda_median", "lambda_roots", "lambda_stat")


@query("r02_correct", f"select marker, round({S.chi2_sf(f'({S.chi2_isf_1(chr(112))} / 1.2e0)', 1)}, 6) as p_corrected, round(sd * sqrt(1.2e0), 6) as sd_corrected from ({A}) a")
def _(s, d):
    return _rounded(R.correct_inflation(X.assoc(s, d), 1.2), 6, "p_corrected", "sd_corrected").select("marker", "p_corrected", "sd_corrected")


@query("r03_summarize", f"with a as ({A}) select marker, round(p, 7) as p, p < 0.05e0 / 50000 as significant from a order by a.p, marker limit 40")
def _(s, d):
    a = X.assoc(s, d)
    return R.summarize_p(a.select("marker", "p"), a.select("marker", "chr", "pos"), 40, tests=50000).select("marker", F.round("p", 7).alias("p"), "significant")


@query("r04_top_table", f"with a as ({A}) select marker, round(beta - {S.norm_quantile('0.975e0')} * sd, 6) as lo, round(beta + {S.norm_quantile('0.975e0')} * sd, 6) as up from a order by p, marker limit 30")
def _(s, d):
    t = R.top_table(X.assoc(s, d).withColumnsRenamed({"beta": "beta1.snp", "sd": "sd1.snp"}), 30)
    return t.select("marker", F.round("`ciL.snp`", 6).alias("lo"), F.round("`ciU.snp`", 6).alias("up"))


@query("r05_manhattan", f"with a as ({A}), e as (select chr, max(pos) as length from a group by 1), o as (select x.chr, coalesce(sum(y.length), 0) as s from e x left join e y on y.chr < x.chr group by 1) select marker, a.chr, cast(s + pos as bigint) as genome_pos, round(least(-log10(p), 15), 7) as y, case when p < 0.001e0 then 'hit' when a.chr % 2 = 1 then 'odd' else 'even' end as colour from a join o on a.chr = o.chr")
def _(s, d):
    return _rounded(R.manhattan_points(X.assoc(s, d), cutoff=0.001), 7, "y")


@query("r06_qq_by", f"with a as ({A}) select chr, row_number() over (partition by chr order by p, marker) as rank, marker, round(-log10(row_number() over (partition by chr order by p, marker) / count(*) over (partition by chr)), 7) as expected, round(-log10(p), 7) as observed from a")
def _(s, d):
    out = W.qq_points_by(X.assoc(s, d), "chr")
    return _rounded(out.withColumn("rank", F.col("rank").cast("long")), 7, "expected", "observed")


@query("r07_alpha_levels", f"with a as ({A}), l as (select unnest(range(1, 41)) as k) select round(k / 40e0, 6) as alpha, round(avg(cast(p < k / 40e0 as double)), 8) as share from l, a group by k")
def _(s, d):
    return _rounded(_rounded(R.alpha_levels(X.assoc(s, d)), 6, "alpha"), 8, "share")


@query("r08_tail_strength", f"with a as (select p, row_number() over (order by p, marker) as k, count(*) over () as m from ({A}) a) select round(avg(1 - p * (m + 1) / k), 8) as tail_strength from a")
def _(s, d):
    return _rounded(R.tail_strength(X.assoc(s, d)), 8, "tail_strength")


@query("r09_q_value", f"with a as (select marker, p, row_number() over (order by p, marker) as k, count(*) over () as m, least(avg(cast(p > 0.5e0 as double)) over () / 0.5e0, 1) as pi0 from ({A}) a) select marker, round(least(min(pi0 * m * p / k) over (order by k desc rows unbounded preceding), 1), 7) as q from a")
def _(s, d):
    return R.q_value(X.assoc(s, d)).select("marker", F.round("q", 7).alias("q"))


@query("r10_fisher", f"select marker, round(p * af * (1 - ln(p * af)), 8) as p from ({A}) a where af > 0 and af <= 1")
def _(s, d):
    return X.assoc(s, d).where("af > 0 and af <= 1").select("marker", F.round(R.fisher_p(["p", "af"]), 8).alias("p"))


_ST = [X.study_sql(k) for k in range(3)]


@query("r11_join_studies", f"select * from (select id, round(p, 7) as \"p.a\" from ({_ST[0]}) x) a full join (select id, round(p, 7) as \"p.b\" from ({_ST[1]}) x) b using (id)")
def _(s, d):
    out = R.join_studies({"a": X.study(s, d, 0).select("id", "p"), "b": X.study(s, d, 1).select("id", "p")})
    return _rounded(out, 7, "p.a", "p.b")


_META = "with r as (" + " union all ".join(f"select id, case when maf > 0.6e0 then -beta else beta end as b, power(sd, -2) as w from ({q}) x" for q in _ST) + "), f as (select id, count(*) as k, sum(w) as sw, sum(w * b) as wb, sum(w * b * b) as wbb, sum(w * w) as ww from r group by 1)"


@query("r12_meta", _META + ", t as (select *, case when k > 1 then greatest((greatest(wbb - wb * wb / sw, 0) - (k - 1)) / (sw - ww / sw), 0) else 0 end as tau2 from f), x as (select id, sum(b / (1 / w + tau2)) / sum(1 / (1 / w + tau2)) as br from r join t using (id) group by 1) select id, k, round(wb / sw, 6) as beta_fixed, round(1 / sqrt(sw), 7) as sd_fixed, round(tau2, 6) as tau2, round(br, 6) as beta_random from t join x using (id)")
def _(s, d):
    m = R.meta({str(k): X.study(s, d, k) for k in range(3)})
    return _rounded(_rounded(m, 6, "beta_fixed", "tau2", "beta_random"), 7, "sd_fixed").select("id", "k", "beta_fixed", "sd_fixed", "tau2", "beta_random")


# restricted likelihood by its fixed point, 400 steps from the moment estimate, one row an id and step
_REML = f"""with recursive r as materialized ({" union all ".join(f"select id, beta as b, sd * sd as v from ({q}) x" for q in _ST)}), t(k, id, tau) as (select 0, id, case when count(*) > 1 then greatest(var_samp(b) - avg(v), 0) else 0e0 end from r group by id union all
 select k + 1, id, greatest(sum(w * w * ((b - m) * (b - m) - v)) / sum(w * w) + 1 / sum(w), 0) from (select k, id, b, v, 1 / (v + tau) as w, sum(b / (v + tau)) over (partition by id) / sum(1 / (v + tau)) over (partition by id) as m from t join r using (id) where k < 400) group by k, id having count(*) > 1),
 f as (select id, max(k) as k from t group by 1), e as (select r.id, sum(b / (v + tau)) / sum(1 / (v + tau)) as beta, power(sum(1 / (v + tau)), -0.5e0) as sd, max(tau) as tau2 from r join t using (id) join f on f.id = r.id and f.k = t.k group by 1) select id, round(beta, 5) as beta, round(sd, 5) as sd, round(tau2, 5) as tau2 from e"""


@query("r12_meta_reml", _REML)
def _(s, d):
    return _rounded(R.meta_reml({str(k): X.study(s, d, k) for k in range(3)}, 400), 5, "beta", "sd", "tau2")


def _origin_sql(k: int) -> str:
    """A study's chromosomes, positions and alleles; some studies differ, and one has no alleles of some markers."""
    return f"select l_partkey as id, cast(1 + l_partkey % 22 + {int(k == 2)} * cast(l_partkey % 10 = 0 as int) as int) as chr, l_partkey * 10 + {5 * int(k == 1)} * cast(l_partkey % 7 = 0 as int) as pos, case when {k} = 0 and l_partkey % 3 = 0 then null else substr('ACGT', cast(1 + l_partkey % 4 as int), 1) end as allele from lineitem where l_suppkey % 3 = {k}"


_ORIGIN = "with s as (" + " union all ".join(f"select distinct {k} as k, id, cast(chr as varchar) as chr, pos, allele from ({_origin_sql(k)}) x" for k in range(3)) + """), l as (select id, list(chr order by k) as cs, list(cast(pos as varchar) order by k) as ps, coalesce(max(allele) filter (where k = 0), 'NA') || ':' || coalesce(max(allele) filter (where k = 1), 'NA') || ':' || coalesce(max(allele) filter (where k = 2), 'NA') as allele from s group by 1),
 w as (select *, case when len(list_distinct(cs)) > 1 then 'C: ' || cs[1] || ':' || list_filter(cs, lambda c: c <> cs[1])[1] end as c, case when len(list_distinct(ps)) > 1 then 'P: ' || ps[1] || ':' || list_filter(ps, lambda p: p <> ps[1])[1] end as p from l)
 select id, cs[1] as chr, cast(ps[1] as bigint) as pos, allele, nullif(concat_ws(', ', c, p), '') as warnings from w"""


@query("r12_meta_origin", _ORIGIN)
def _(s, d):
    studies = {str(k): X._run(s, d, _origin_sql(k), "lineitem") for k in range(3)}
    return R.meta_origin(studies)


@query("r14_prs_snps", prune_rounds(20000, 15, f"select * from ({A}) a where p < 0.01e0", "marker, round(p, 7) as p"))
def _(s, d):
    return R.prs_snps(X.assoc(s, d), 0.01, 20000).select("marker", F.round("p", 7).alias("p"))


@query("r16_prs_score", f"select iid, round(sum((marker % 7 - 3) * (p_ab + 2 * p_bb) * 0.1e0), 5) as score from ({X.PROB}) p group by 1")
def _(s, d):
    w = X.marker(s, d).select("marker", ((F.col("marker") % 7 - 3) * 0.1).alias("beta"))
    return _rounded(R.prs_score(X.prob(s, d).select("iid", "marker", G.dosage().alias("dosage")), w), 5, "score")


def _people(s, d):
    return X.sample(s, d).select("iid", "cc", F.col("age").cast("double").alias("age"), F.col("sex").cast("double").alias("sex"), (F.col("y") / 1000).alias("y"))


@query("r15_prs_fit")
def _(s, d):
    p = _people(s, d)
    return R.prs_fit(p.where(R.fold_of("iid", 2) == 0), p.where(R.fold_of("iid", 2) == 1), "cc", ["age", "sex", "y"], 0.01)[1].select("iid", "predicted")


@query("r17_cross_validate")
def _(s, d):
    return R.cross_validate(_people(s, d), "iid", "cc", ["age", "sex"], 3, 0.01).select("iid", "fold", "predicted")


@query("r17_class_folds", f"select strat, fold, count(*) as n from (select strat, cast((row_number() over (order by strat, iid) - 1) % 15 as int) as fold from ({X.SAMPLE}) s) group by 1, 2")
def _(s, d):
    return R.class_folds(X.sample(s, d), "iid", "strat").groupBy("strat", "fold").agg(F.count("*").alias("n"))


@query("r18_refit")
def _(s, d):
    return R.refit(_people(s, d), "y", ["age", "sex"], [0.001, 0.1], binary=False)


_SCORED = "(select l_discount as s, cast(l_returnflag = 'R' as int) as y from lineitem)"


def _scored(s, d):
    return X.table(s, d, "lineitem").select(F.col("l_discount").alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))


@query("r19_roc", f"with t as (select s, sum(y) as pos, count(*) as n from {_SCORED} group by 1), z as (select sum(pos) as p, sum(n - pos) as q from t) select a.s as cutoff, round(sum(b.pos) / max(p), 8) as tp, round(1 - sum(b.n - b.pos) / max(q), 8) as tn, round(sum(b.n - b.pos) / max(q), 8) as fpr from t a join t b on b.s >= a.s, z group by 1")
def _(s, d):
    return _rounded(R.roc(_scored(s, d), "s", "y"), 8, "tp", "tn", "fpr")


@query("r19_auc", f"with r as (select y, avg(k) over (partition by s) as r from (select s, y, row_number() over (order by s) as k from {_SCORED})) select round((sum(r) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0e0) / (count(*) filter (where y = 1) * count(*) filter (where y = 0) * 1e0), 8) as auc from r")
def _(s, d):
    return _rounded(R.auc(_scored(s, d), "s", "y"), 8, "auc").select("auc")


@query("r20_calibrate", f"with q as (select quantile_cont(s, 0.25) as a, quantile_cont(s, 0.5) as b, quantile_cont(s, 0.75) as c from {_SCORED}) select 1 + cast(s > a as int) + cast(s > b as int) + cast(s > c as int) as bin, round(avg(y), 8) as truth, round(avg(s), 8) as prediction, count(*) as n from {_SCORED} t, q group by 1")
def _(s, d):
    return _rounded(R.calibrate(_scored(s, d), "s", "y", 4), 8, "truth", "prediction")


_KM = f"with t as (select strat, age as time, sum(cc) as events, count(*) as n from ({X.SAMPLE}) s group by 1, 2), r as (select *, sum(n) over (partition by strat order by time desc rows unbounded preceding) as at_risk from t)"


@query("r21_kaplan_meier", _KM + " select strat, time, cast(at_risk as bigint) as at_risk, cast(events as bigint) as events, round(case when max(cast(events = at_risk as int)) over (partition by strat order by time) = 1 then 0 else exp(sum(case when events < at_risk then ln(1 - events / at_risk) end) over (partition by strat order by time)) end, 7) as survival from r")
def _(s, d):
    return _rounded(R.kaplan_meier(X.sample(s, d), "age", "cc", "strat"), 7, "survival")


@query("r21_log_rank", f"with t as (select age, sum(cc) as d, count(*) as n, sum(case when sex = 1 then cc else 0 end) as d1, count(*) filter (where sex = 1) as n1 from ({X.SAMPLE}) s group by 1), r as (select a.age, a.d, a.d1, sum(b.n) as rn, sum(b.n1) as rn1 from t a join t b on b.age >= a.age group by 1, 2, 3) select cast(sum(d1) as bigint) as observed, round(sum(d * rn1 / rn), 6) as expected, round(sum(case when rn > 1 then d * (rn1 / rn) * (1 - rn1 / rn) * (rn - d) / (rn - 1) else 0 end), 6) as variance from r")
def _(s, d):
    p = X.sample(s, d).withColumn("g", (F.col("sex") == 1).cast("int"))
    return _rounded(R.log_rank(p, "age", "cc", "g"), 6, "expected", "variance").select("observed", "expected", "variance")


_R22 = _KM + """, k as (select strat, time, case when max(cast(events = at_risk as int)) over (partition by strat order by time) = 1 then 0 else exp(sum(case when events < at_risk then ln(1 - events / at_risk) end) over (partition by strat order by time)) end as survival from r),
 m as (select *, coalesce(lag(survival) over (partition by strat order by time), 1) * (time - coalesce(lag(time) over (partition by strat order by time), 0)) as area from k) select strat, min(time) filter (where survival <= 0.5) as median, round(sum(area), 6) as mean from m group by 1"""


@query("r22_surv_table", _R22)
def _(s, d):
    return _rounded(R.surv_table(R.kaplan_meier(X.sample(s, d), "age", "cc", "strat"), "strat"), 6, "mean")


@query("r23_impute_mean", "select o_orderkey, round(coalesce(case when o_orderkey % 5 <> 0 then o_totalprice end, (select avg(o_totalprice) from orders where o_orderkey % 5 <> 0)), 4) as x from orders")
def _(s, d):
    t = X.table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("x"))
    return _rounded(R.impute_value(t, "x"), 4, "x")


@query("r23_impute_draw")
def _(s, d):
    t = X.table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("x"))
    return R.impute_draw(t, "x", "o_orderkey", 2)


@query("r23_impute_cross")
def _(s, d):
    """Gaps of two columns of the customers are filled from the suppliers."""
    c = X.table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("balance"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("nation"))
    return R.impute_cross(c, X.table(s, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")), ["balance", "nation"], "c_custkey")


@query("r24_compare", f"with g as (select cc, y from ({X.SAMPLE}) s), m as (select count(*) filter (where sex = 1) as n1, count(*) filter (where sex = 2) as n0, avg(y) filter (where sex = 1) as m1, avg(y) filter (where sex = 2) as m0, var_samp(y) filter (where sex = 1) as v1, var_samp(y) filter (where sex = 2) as v0 from ({X.SAMPLE}) s), k as (select sex, avg(r) over (partition by y) as r from (select sex, y, row_number() over (order by y) as r from ({X.SAMPLE}) s)) select n0, n1, round((m1 - m0) / sqrt(v0 / n0 + v1 / n1), 6) as t, round((select sum(r) from k where sex = 1) - n1 * (n1 + 1) / 2, 3) as u from m")
def _(s, d):
    p = X.sample(s, d).withColumn("g", (F.col("sex") == 1).cast("int"))
    return _rounded(_rounded(R.compare_samples(p, "y", "g"), 6, "t"), 3, "u").select("n0", "n1", "t", "u")


@query("r25_histogram", "with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem) select l_returnflag, cast(least(floor((l_extendedprice - lo) / (hi - lo) * 25), 24) as bigint) as bin, count(*) as n from lineitem, e group by 1, 2")
def _(s, d):
    return R.histogram(X.table(s, d, "lineitem"), "l_extendedprice", 25, "l_returnflag")


# --- scalars


@query("x01_regex", "select o_orderkey, regexp_extract(o_orderpriority, '^(\\d)-(\\w+)', 2) as word from orders")
def _(s, d):
    return X.table(s, d, "orders").select("o_orderkey", S.regex_extract(F.col("o_orderpriority"), r"^(\d)-(\w+)", 2).alias("word"))


@query("x02_interpolate", "select c_custkey, replace(replace('Hello NAME_LONG', 'NAME_LONG', c_name), 'NAME', 'x') as t from customer")
def _(s, d):
    n = X.table(s, d, "customer").withColumn("t", F.concat(F.lit("Hello "), F.lit("NAME_LONG")))
    return n.select("c_custkey", F.replace(F.replace("t", F.lit("NAME_LONG"), F.col("c_name")), F.lit("NAME"), F.lit("x")).alias("t"))


@query("x03_abbreviate", "select p_partkey, case when length(p_name) > 12 then substr(p_name, 1, 9) || '...' else p_name end as short, upper(trim(p_brand)) as brand from part")
def _(s, d):
    return X.table(s, d, "part").select("p_partkey", S.abbreviated(F.col("p_name"), 12).alias("short"), F.upper(S.trimmed(F.col("p_brand"))).alias("brand"))


@query("x04_digits", "select p_partkey, (p_partkey // 49) % 7 as d2, (p_partkey // 7) % 7 as d1, p_partkey % 7 as d0, p_partkey % 343 as back from part")
def _(s, d):
    x = S.digits(F.col("p_partkey"), 7, 3)
    return X.table(s, d, "part").select("p_partkey", x[0].alias("d2"), x[1].alias("d1"), x[2].alias("d0"), S.from_digits(x, 7).alias("back"))


@query("x05_pair_enc", "select l_suppkey as a, l_partkey as b, cast(greatest(l_suppkey, l_partkey) * (greatest(l_suppkey, l_partkey) + 1) // 2 + least(l_suppkey, l_partkey) as bigint) as code, cast(greatest(l_suppkey, l_partkey) as bigint) as x, cast(least(l_suppkey, l_partkey) as bigint) as y from lineitem")
def _(s, d):
    t = X.table(s, d, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).withColumn("code", F.expr(S.pair_enc("a", "b")).cast("long"))
    return t.select("a", "b", "code", S.pair_dec(F.col("code"))["x"].alias("x"), S.pair_dec(F.col("code"))["y"].alias("y"))


@query("x06_round_n", "select l_orderkey, l_linenumber, ceil(l_extendedprice * 10) / 10 as c, floor(l_extendedprice * 10) / 10 as f, floor(l_extendedprice / 250) * 250 as m from lineitem")
def _(s, d):
    return X.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr(S.ceil_n("l_extendedprice", 1)).alias("c"), F.expr(S.floor_n("l_extendedprice", 1)).alias("f"), F.expr(S.mod_floor("l_extendedprice", "250")).cast("double").alias("m"))


@query("x07_logistic", "select s_suppkey, round(1 / (1 + exp(-s_acctbal / 1000)), 8) as e, round(ln(1 / (1 + exp(-s_acctbal / 1000))), 7) as l from supplier")
def _(s, d):
    return X.table(s, d, "supplier").select("s_suppkey", F.round(F.expr(S.expit("s_acctbal / 1000")), 8).alias("e"), F.round(F.expr(S.log_expit("s_acctbal / 1000")), 7).alias("l"))


@query("x08_log_sum_exp", "select l_returnflag, round(max(l_quantity) + ln(sum(exp(l_quantity - 50))) + 50 - max(l_quantity), 7) as lse from lineitem group by 1")
def _(s, d):
    return _rounded(S.log_sum_exp(X.table(s, d, "lineitem"), ["l_returnflag"], "l_quantity"), 7, "lse")


@query("x09_ci", f"select marker, round({S.ci_to_sd('lo', 'up')}, 7) as sd, round({S.two_sided('z')}, 6) as p, round(1 / (1 + {S.beta_p_to_sd('beta', 'a.p')}), 6) as share from (select marker, beta, p, lo, up, {S.ci_to_z('lo', 'up')} as z from (select *, beta - 2 * sd as lo, beta + 2 * sd as up from ({A}) b) c) a")
def _(s, d):
    limits = X.assoc(s, d).selectExpr("marker", "beta", "p", "beta - 2 * sd as lo", "beta + 2 * sd as up")
    # deviations grow without bounds as P nears 1: they are shown as 1 / (1 + sd)
    out = S.with_ci_p(limits, "lo", "up", "of_limits")
    return out.select("marker", F.round(F.expr(S.ci_to_sd("lo", "up")), 7).alias("sd"), F.round("of_limits", 6).alias("p"), F.round(1 / (1 + F.expr(S.beta_p_to_sd("beta", "p"))), 6).alias("share"))


@query("x10_errors", "select l_orderkey, l_linenumber, round(sqrt(power(l_tax, 2) + power(l_discount, 2) + 0.002e0), 8) as s, round(abs(l_quantity * l_extendedprice) * sqrt(power(0.1e0 / l_quantity, 2) + power(0.2e0 / l_extendedprice, 2) + 2 * 0.1e0 * 0.2e0 * 0.5e0), 2) as p from lineitem")
def _(s, d):
    return X.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.expr(S.err_sum("l_tax", "l_discount", "0.001e0")), 8).alias("s"), F.round(F.expr(S.err_prod("l_quantity", "l_extendedprice", "0.1e0", "0.2e0", "0.5e0")), 2).alias("p"))


@query("x11_tails", f"select marker, round(-log10(p), 7) as m, round({tails.chi2('x', 1)}, 7) as c1, round({tails.chi2('x', 2)}, 7) as c2, round({tails.chi2('x', 5)}, 6) as c5, 1 as inverse from (select *, beta * 20 + 20 as x from ({A})) a")
def _(s, d):
    x = "(beta * 20 + 20)"
    a = X.assoc(s, d).withColumn("isf", F.expr(S.chi2_isf_1("p")))
    return a.select("marker", F.round(F.expr(S.mlog10("p")), 7).alias("m"), F.round(F.expr(S.chi2_sf(x, 1)), 7).alias("c1"), F.round(F.expr(S.chi2_sf(x, 2)), 7).alias("c2"), F.round(F.expr(S.chi2_sf(x, 5)), 6).alias("c5"), (F.abs(F.expr(S.chi2_sf("isf", 1)) / F.col("p") - 1) < 1e-7).cast("int").alias("inverse"))


@query("x12_complement", f"select marker, translate(a1, 'ACGT', 'TGCA') as c, translate(a1, 'ACGT', 'TGCA') = a2 as f from ({X.MARKER}) m")
def _(s, d):
    return X.marker(s, d).select("marker", F.expr(S.complement("a1")).alias("c"), (F.expr(S.complement("a1")) == F.col("a2")).alias("f"))


@query("x13_parse_counts", f"select marker, cast(n0 as int) as a, cast(n1 as int) as b, cast(n2 as int) as c from ({_COUNTS})")
def _(s, d):
    t = G.gt_counts(X.gt(s, d)).select("marker", S.parse_counts(F.concat_ws("/", "n0", "n1", "n2")).alias("x"))
    return t.select("marker", F.col("x")[0].alias("a"), F.col("x")[1].alias("b"), F.col("x")[2].alias("c"))


@query("x15_parse_date", "select event_id, date_trunc('second', ts) as t from events")
def _(s, d):
    return X.table(s, d, "events").select("event_id", S.parse_date(F.date_format("ts", "yyyy/MM/dd HH-mm-ss"), "yyyy/MM/dd HH-mm-ss").alias("t"))


@query("x16_chromosome", "select p_partkey, cast(p_partkey % 23 as varchar) as chr from part")
def _(s, d):
    return X.table(s, d, "part").select("p_partkey", S.chromosome_of(F.concat(F.lit("/a/b/x_chr"), F.col("p_partkey") % 23, F.lit("_c3.gens"))).alias("chr"))


@query("x17_factor_guess", "select round(count(distinct l_linenumber) / count(l_linenumber), 8) as share, count(distinct l_linenumber) / count(l_linenumber) <= 0.05e0 as is_factor, count(distinct l_linenumber) = 2 as is_binary from lineitem")
def _(s, d):
    return _rounded(S.factor_guess(X.table(s, d, "lineitem"), "l_linenumber"), 8, "share")


@query("x18_multinomial", f"select marker, round(lgamma(n0 + n1 + n2 + 1) - lgamma(n0 + 1) - lgamma(n1 + 1) - lgamma(n2 + 1), 5) as coef from ({_COUNTS})")
def _(s, d):
    return G.gt_counts(X.gt(s, d)).select("marker", F.round(S.log_multinomial(F.array("n0", "n1", "n2")), 5).alias("coef"))


# --- sources, sinks, streams: written to a new folder and read back


def _folder(s) -> str:
    return f"{shared_base(s)}/tables-{uuid.uuid4().hex}"


@query("sc01_csv_round_trip", "select s_suppkey, s_name, s_acctbal from supplier")
def _(s, d):
    path = _folder(s)
    SC.write_table(X.table(s, d, "supplier"), [path], ["s_suppkey", "s_name", "s_acctbal"])
    return SC.read_table(s, path, schema="s_suppkey long, s_name string, s_acctbal double")


@query("sc02_extended_path", "select s_suppkey as id, 'x' as src, round(s_acctbal, 2) as bal from supplier")
def _(s, d):
    path = _folder(s)
    SC.write_table(X.table(s, d, "supplier"), [path], ["s_suppkey", "s_name", "s_acctbal"], sep=",")
    df = SC.read_ext(s, f"[SEP=C,HEADERMAP=s_suppkey:id;s_acctbal:bal,PROJECT=id;bal,CONST=src:x,NUMERIC=bal]:{path}")
    return df.select(F.col("id").cast("long").alias("id"), "src", F.round("bal", 2).alias("bal"))


@query("sc03_read_cols", "select s_suppkey, s_acctbal from supplier")
def _(s, d):
    path = _folder(s)
    SC.write_table(X.table(s, d, "supplier"), [path])
    return SC.read_cols(s, path, {"s_suppkey": "long", "s_acctbal": "double"})


@query("sc12_sample_rows", "select count(*) + 1 as n, min(c_custkey) as least from customer")
def _(s, d):
    rows = SC.sample_rows(X.sample(s, d), ["iid"], {"sex": "D", "y": "P"})
    return rows.agg(F.count("*").alias("n"), F.min(F.when(F.col("line") > 0, F.col("iid").cast("long"))).alias("least"))


@query("sc14_variables", f"select fid, iid, y, age from ({X.SAMPLE}) s")
def _(s, d):
    p = X.sample(s, d)
    return SC.variables_table(p.select("iid", "y", "age"), p.select("fid", "iid"), ["y", "age"])


@query("sc15_gzip", "select c_custkey, c_name from customer")
def _(s, d):
    path = _folder(s) + ".gz"
    SC.write_table(X.table(s, d, "customer"), [path], ["c_custkey", "c_name"])
    return SC.read_table(s, path, schema="c_custkey long, c_name string")


@query("sc17_indexed", "select o_orderkey as id, o_custkey as cust from orders")
def _(s, d):
    return SC.csv_to_table(X.table(s, d, "orders"), _folder(s), {"o_orderkey": "id", "o_custkey": "cust"}, {}, ["cust"], ["id"])


def _variant(s, d):
    a = X.assoc(s, d)
    gens = a.select(F.col("chr").cast("string").alias("chrom"), F.col("pos").alias("start"), F.col("marker").cast("string").alias("name"), F.when(F.col("marker") % 9 == 0, "A|-").otherwise("A|G").alias("alleles"), F.lit("0.1 0.8 0.1").alias("gvar_data"))
    return SC.variant_db(gens, a.select(F.col("marker").cast("string").alias("name"), F.col("p").alias("pval_t")), "test")


@query("sc19_variant_db", f"select 'data' as name, count(*) as n, count(*) as ids, 0 as nulls, 1 as least, count(*) as most from ({A}) a union all select 'map', count(*), count(*), 0, 1, count(*) from ({A}) a union all select 'result', count(*), count(*), 0, 1, count(*) from ({A}) a")
def _(s, d):
    return SC.validate_db(_variant(s, d))


@query("sc24_consortium", f"with a as ({A}), q as (select chr, pos, min(sd) as call_rate from a where marker % 2 = 0 group by 1, 2) select a.marker as \"SNP\", coalesce(round(q.call_rate, 6), 1) as \"CALL_RATE\", round(a.af, 6) as \"EAF\" from a left join q using (chr, pos) where a.af > 0 and a.af < 1")
def _(s, d):
    a = X.assoc(s, d)
    rows = a.select("marker", "chr", "pos", F.lit("A").alias("a1"), F.lit("G").alias("a0"), F.lit(1500).alias("n"), "af", "beta", "sd", "p", "info")
    qc = a.where("marker % 2 = 0").groupBy("chr", "pos").agg(F.min("sd").alias("call_rate")).select("chr", "pos", "call_rate", *(F.lit(None).cast("string").alias(c) for c in ("n0", "n1", "n2", "p_hwe")))
    return R.export_consortium(rows, qc)[0].select("SNP", F.round(F.col("CALL_RATE").cast("double"), 6).alias("CALL_RATE"), F.round("EAF", 6).alias("EAF"))


@query("sc28_normalize_map", f"select row_number() over (order by chr, pos, cast(marker as varchar)) as map_incl, cast(marker as varchar) as gvar_name from ({A}) a where marker % 9 <> 0 union all select 0, cast(marker as varchar) from ({A}) a where marker % 9 = 0")
def _(s, d):
    db = _variant(s, d)
    return SC.normalize_map(db["map"], db["data"]).select("map_incl", "gvar_name")


@query("sc07_gens", f"with m as (select distinct marker from ({X.PROB}) p) select m.marker, s.iid, coalesce(p_aa, 0e0) as p_aa, coalesce(p_ab, 0e0) as p_ab, coalesce(p_bb, 0e0) as p_bb from m cross join ({X.SAMPLE}) s left join ({X.PROB}) p on p.marker = m.marker and p.iid = s.iid")
def _(s, d):
    """Probabilities written as gens lines by marker (0 0 0 where there is no call) and read back."""
    path, info = _folder(s), _folder(s)
    people = W.global_rank(X.sample(s, d).select("iid"), ["iid"], "no")
    rows = X.prob(s, d).join(people, "iid").groupBy("marker").agg(F.array_sort(F.collect_list(F.struct("no", F.concat_ws(" ", "p_aa", "p_ab", "p_bb").alias("p")))).alias("m"))
    # an individual's probabilities behind those of the individuals before it that have none
    empty = lambda before, no: F.repeat(F.lit("0 0 0 "), (no - before - 1).cast("int"))
    known = F.transform("m", lambda x, k: F.concat(empty(F.coalesce(F.get("m", k - 1)["no"], F.lit(0)), x["no"]), x["p"]))
    rest = F.repeat(F.lit(" 0 0 0"), (F.lit(people.count()) - F.element_at("m", -1)["no"]).cast("int"))
    line = F.concat(F.concat_ws(" ", F.lit("---"), F.concat(F.lit("rs"), "marker"), "marker", F.lit("A"), F.lit("G"), F.array_join(known, " ")), rest)
    # lines are made before they go to the one writer of the file
    rows.select("marker", line.alias("value")).repartition(1).sortWithinPartitions("marker").select("value").write.text(path)
    names = s.createDataFrame([(-1, "snp_id rs_id position")], "marker long, value string").unionByName(rows.select("marker", F.concat_ws(" ", F.lit("---"), F.concat(F.lit("rs"), "marker"), "marker").alias("value")))
    names.coalesce(1).sortWithinPartitions("marker").select("value").write.text(info)
    t = SC.read_gens(s, path, info).select(F.col("position").alias("marker"), F.col("k").cast("long").alias("k"), "p_aa", "p_ab", "p_bb")
    return t.join(people.withColumn("k", F.col("no") - 1), "k").select("marker", "iid", "p_aa", "p_ab", "p_bb")


@query("st06_stream_filter", f"select marker, round(p, 7) as p from ({A}) a where p < 0.5e0 and af between 0.02e0 and 0.98e0 and info >= 0.4e0")
def _(s, d):
    """F6 on a file stream: results arrive as files, the query ends when all are taken."""
    from genoframe.streaming import stages

    path, out, state = _folder(s), _folder(s), _folder(s)
    X.assoc(s, d).select("marker", F.col("p"), F.col("af").alias("allele_freq"), F.col("info").alias("impute_info")).write.options(sep="\t", header=True).csv(path)
    stream = stages.file_stream(s, path, "marker long, p double, allele_freq double, impute_info double")
    stages.to_table(stages.filtered_results(stream, p=0.5), out, state).awaitTermination(300)
    return s.read.parquet(out).select("marker", F.round("p", 7).alias("p"))

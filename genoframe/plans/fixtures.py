"""Deterministic genetic views over the test tables: once as DataFrames, once as oracle SQL with the same arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SAMPLE = "select c_custkey as iid, c_nationkey as fid, cast(1 + c_custkey % 2 as int) as sex, c_acctbal as y, cast(c_acctbal > 4500 as int) as cc, cast(20 + c_custkey % 50 as int) as age, c_mktsegment as strat from customer"
MARKER = """select s_suppkey as marker, cast(case when s_suppkey % 40 = 0 then 23 else 1 + s_suppkey % 22 end as int) as chr, (s_suppkey * 7919 % 50 + 1) * 10000 + s_suppkey * 37 as pos,
 substr('ACGT', cast(1 + s_suppkey % 4 as int), 1) as a1, substr('CGTA', cast(1 + s_suppkey % 4 as int), 1) as a2 from supplier"""
_GT = """select iid, marker, chr, pos, cast(case when (iid * 13 + marker * 11) % (20 + marker % 40) = 0 then null when v < {sq} then 2 when v < {sq} + {het} then 1 else 0 end as int) as gt
 from (select c.iid, m.marker, m.chr, m.pos, ((c.iid * 7919 + m.marker * 104729 + (c.iid * m.marker) % 9973) % 1000003) % 1000 as v, 50 + (m.marker * 37) % 400 as q
 from (select distinct o_custkey as iid, l_suppkey as marker from lineitem join orders on l_orderkey = o_orderkey) c join ({marker}) m on m.marker = c.marker) g"""
ASSOC = """select marker, min(chr) as chr, min(pos) as pos, min(p) as p, min(af) as af, min(info) as info, min(beta) as beta, min(sd) as sd from (
 select l_orderkey * 10 + l_linenumber as marker, cast(1 + l_orderkey % 22 as int) as chr, l_partkey * 1000 + l_suppkey as pos,
 ((l_orderkey * 7919 + l_linenumber * 104729) % 999983 + 1) / 1000000e0 as p, l_discount * 9 + 0.05e0 as af, 1 - l_tax * 10 as info, l_quantity / 50 - 0.5e0 as beta, 0.01e0 + l_tax as sd from lineitem) a group by marker"""


def gt_sql(spark: bool) -> str:
    divide = "div" if spark else "//"
    return _GT.format(sq=f"(q * q {divide} 1000)", het=f"(2 * q * (1000 - q) {divide} 1000)", marker=MARKER)


GT = gt_sql(False)
PROB = f"select iid, marker, chr, pos, case when gt is null then 0e0 when gt = 0 then 0.8e0 else 0.1e0 end as p_aa, case when gt is null then 0e0 when gt = 1 then 0.8e0 else 0.1e0 end as p_ab, case when gt is null then 0e0 when gt = 2 then 0.8e0 else 0.1e0 end as p_bb from ({GT}) x"


def study_sql(k: int) -> str:
    return f"select l_partkey as id, min(l_discount * 9 + 0.05e0) as maf, min(((l_orderkey * 7919 + l_linenumber * 104729) % 999983 + 1) / 1000000e0) as p, min(l_quantity / 50 - 0.5e0) as beta, min(0.01e0 + l_tax) as sd from lineitem where l_suppkey % 3 = {k} group by l_partkey"


def _run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    for n in names:
        sql = re.sub(rf"\b(from|join) {n}\b", rf"\1 {{{n}}}", sql)
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SAMPLE, "customer")


def marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, MARKER, "supplier")


def gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard genotypes: one row for each customer and supplier with an order between them, so that calls grow with the tables in both directions."""
    return _run(spark, sf_dir, gt_sql(True), "lineitem", "orders", "supplier")


def prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.col("gt")
    part = lambda k: F.when(call.isNull(), 0.0).when(call == k, 0.8).otherwise(0.1)
    return gt(spark, sf_dir).select("iid", "marker", "chr", "pos", part(0).alias("p_aa"), part(1).alias("p_ab"), part(2).alias("p_bb"))


def assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, ASSOC, "lineitem")


def study(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return _run(spark, sf_dir, study_sql(k), "lineitem")

"""Queries of the readers, writers and helpers that work on files: written to a new folder of the shared store and read back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators import assoc as T
from genoframe.operators import joins as J
from genoframe.operators import reshape as A
from genoframe.operators import windows as W
from genoframe.plans import fixtures as X
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


@query("sc04_read_headed", "select p_partkey, 'multi' || chr(10) || p_name as note, case when p_partkey % 3 = 0 then 'none' else p_brand end as brand from part")
def _(s, d):
    """Quoted newlines, a separator that is guessed, empty cells with a default."""
    path = _folder(s)
    rows = X.table(s, d, "part").select("p_partkey", F.concat(F.lit("multi\n"), "p_name").alias("note"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("brand"))
    rows.write.options(sep=";", header=True, nullValue="", escape='"').csv(path)
    return SC.read_headed(s, path, {"brand": "none"}).select(F.col("p_partkey").cast("long").alias("p_partkey"), "note", "brand")


_GENS = "select p_partkey, 'rs' || p_partkey as rs_id, p_partkey * 37 as position, (p_partkey % 10) / 10e0 as aa from part"


@query("sc08_gens_packed", f"select rs_id, position, 'A|G' as alleles, cast(6 as int) as k, round(aa + (1 - aa) * 2, 6) as total from ({_GENS}) g")
def _(s, d):
    """Two individuals a line."""
    path = _folder(s)
    aa = (F.col("p_partkey") % 10) / 10
    line = F.concat_ws(" ", F.lit("---"), F.concat(F.lit("rs"), "p_partkey"), F.col("p_partkey") * 37, F.lit("A"), F.lit("G"), aa, 1 - aa, F.lit(0), F.lit(0), F.lit(0), 1 - aa)
    X.table(s, d, "part").select(line.alias("value")).write.text(path)
    g = SC.read_gens_packed(s, path)
    return g.select("rs_id", "position", "alleles", F.size("p").alias("k"), F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("sc09_gens_info", "select 'rs' || p_partkey as rs_id, p_size * 1e0 / 100 as info, cast((p_partkey * 7) % 4 as int) as file_no from part")
def _(s, d):
    """Four folders; which one a row came from is known from nothing but its file."""
    base = _folder(s)
    paths = [f"{base}/info{k}" for k in (2, 0, 3, 1)]
    for k, path in enumerate(paths):
        rows = X.table(s, d, "part").where((F.col("p_partkey") * 7) % 4 == k)
        columns = {"snp_id": F.lit("---"), "rs_id": F.concat(F.lit("rs"), "p_partkey"), "position": F.lit(1), "a0": F.lit("A"), "a1": F.lit("G"), "exp_freq_a1": F.lit(0.5), "info": F.col("p_size") / 100, "certainty": F.lit(1.0), "type": F.lit(0), "info_type0": F.lit(None).cast("double"), "concord_type0": F.lit(None).cast("double"), "r2_type0": F.lit(None).cast("double")}
        rows.select(*(c.alias(n) for n, c in columns.items())).write.options(sep=" ", header=True, nullValue="NA").csv(path)
    return SC.read_gens_info(s, paths).select("rs_id", "info", "file_no")


@query("sc10_fam_bim", f"select 'fam' as kind, cast(iid as varchar) as id, sex as a from ({X.SAMPLE}) s union all select 'bim', cast(marker as varchar), chr from ({X.MARKER}) m")
def _(s, d):
    fam, bim = _folder(s), _folder(s)
    X.sample(s, d).select("fid", "iid", F.lit(0), F.lit(0), "sex", F.col("cc") + 1).write.options(sep=" ").csv(fam)
    X.marker(s, d).select("chr", "marker", F.lit(0.0), "pos", "a1", "a2").write.options(sep="\t").csv(bim)
    people, markers = SC.read_fam(s, fam), SC.read_bim(s, bim)
    return people.select(F.lit("fam").alias("kind"), F.col("iid").alias("id"), F.col("sex").alias("a")).unionByName(markers.select(F.lit("bim").alias("kind"), F.col("marker").alias("id"), F.col("chr").alias("a")))


def _packed(s, d):
    """Calls packed two bits each into one file: its path, individuals and markers with their numbers in it."""
    path = _folder(s)
    people = W.global_rank(X.sample(s, d).select("iid"), ["iid"], "no").withColumn("person_no", F.col("no") - 1).drop("no")
    markers = W.global_rank(X.marker(s, d).select("marker"), ["marker"], "no").withColumn("marker_no", F.col("no") - 1).drop("no")
    calls = X.gt(s, d).join(people, "iid").join(markers, "marker")
    # markers without any call have a record too
    every = calls.select("marker_no", "person_no", "gt").unionByName(markers.select("marker_no", F.lit(0).cast("long").alias("person_no"), F.lit(None).cast("int").alias("gt")).join(calls.select("marker_no").distinct(), "marker_no", "left_anti"))
    records = SC.bed_records(every, people.count())

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        with store.open_output_stream(place, compression=None) as out:
            out.write(b"\x6c\x1b\x01")
            for batch in batches:
                for data in batch.column(1).to_pylist():
                    out.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], names=["written"])

    # one file is one writer by its format; calls are packed before they go there, and the reader splits it
    records.repartition(1).sortWithinPartitions("marker_no").mapInArrow(write, "written int").count()
    return path, people, markers


@query("sc11_packed_genotypes", f"select marker, iid, gt from ({X.GT}) g where gt is not null")
def _(s, d):
    """Read back by ranges of markers."""
    path, people, markers = _packed(s, d)
    read = SC.read_bed(s, path, markers, people, 30, called=True)
    return read.join(people, "person_no").join(markers, "marker_no").select("marker", "iid", "gt")


@query("sc11_packed_marker_list", f"with g as ({X.GT}), f as (select marker, sum(gt) > count(gt) as flipped from g group by 1) select marker, iid, cast(case when flipped then 2 - gt else gt end as int) as gt, flipped from g join f using (marker) where chr = 4 and gt is not null")
def _(s, d):
    """The markers of one chromosome only, by their places in the file, counting the rarer allele."""
    path, people, markers = _packed(s, d)
    wanted = markers.join(X.marker(s, d).where("chr = 4").select("marker"), "marker", "left_semi")
    read = SC.read_bed(s, path, markers, people, only=wanted, flip=True, called=True)
    return read.join(people, "person_no").join(markers, "marker_no").select("marker", "iid", "gt", "flipped")


@query("sc13_sex_file", f"select cast(fid as varchar) as \"ID_1\", cast(iid as varchar) as \"ID_2\", '0' as missing, cast(sex as varchar) as sex from ({X.SAMPLE}) s union all select '0', '0', '0', 'D'")
def _(s, d):
    path = _folder(s)
    SC.write_sample(SC.sex_rows(X.sample(s, d)), ["ID_1", "ID_2", "missing"], {"sex": "D"}, path)
    return SC.read_table(s, path, sep=" ")


@query("sc16_append", "select o_orderkey, o_custkey from orders union all select s_suppkey, s_nationkey from supplier")
def _(s, d):
    path = _folder(s)
    SC.write_table(X.table(s, d, "orders"), [path], ["o_orderkey", "o_custkey"], header=False)
    SC.write_table(X.table(s, d, "supplier"), [path], ["s_suppkey", "s_nationkey"], header=False, mode="append")
    return SC.read_table(s, path, header=False, schema="o_orderkey long, o_custkey long")


@query("sc18_table_copy", "select o_custkey as cust, count(*) as n, sum(o_orderkey) as total from orders group by 1")
def _(s, d):
    found = s.sql("select o_custkey as cust, count(*) as n, sum(o_orderkey) as total from {orders} group by 1", orders=X.table(s, d, "orders"))
    return SC.csv_to_table(found, _folder(s), {"cust": "cust", "n": "n", "total": "total"}, {}, ["cust"], ["cust"])


@query("sc20_add_map", f"select 'map' as kind, marker, chr, '2' as version from ({X.MARKER}) m where marker % 2 = 0 union all select 'backup', marker, chr, '1' from ({X.MARKER}) m")
def _(s, d):
    folder, m = _folder(s), X.marker(s, d)
    SC.add_map(folder, m, "first", "1")
    SC.add_map(folder, m.where("marker % 2 = 0"), "second", "2", overwrite=True)
    version = s.read.parquet(f"{folder}/metadata").agg(F.max("version").alias("new"), F.min("version").alias("old"))
    part = lambda name, kind, v: s.read.parquet(f"{folder}/{name}").select(F.lit(kind).alias("kind"), "marker", "chr").join(F.broadcast(version)).select("kind", "marker", "chr", F.col(v).alias("version"))
    return part("map", "map", "new").unionByName(part("map-backup", "backup", "old"))


@query("sc21_validate", f"select 'data' as name, count(*) as n, count(*) as ids, cast(0 as bigint) as nulls, min(marker) as least, max(marker) as most, false as fits from ({X.MARKER}) m union all select 'map', count(*), count(distinct marker // 2), cast(0 as bigint), min(marker // 2), max(marker // 2), true from ({X.MARKER}) m where marker % 5 <> 1 union all select 'qc', count(*), count(distinct marker // 3), cast(0 as bigint), min(marker // 3), max(marker // 3), true from ({X.MARKER}) m where marker % 5 <> 1")
def _(s, d):
    m = X.marker(s, d)
    return SC.validate_db({"data": m.select(F.col("marker").alias("gvar_id")), "map": m.where("marker % 5 <> 1").select(F.expr("marker div 2").alias("gvar_id"), "chr"), "qc": m.where("marker % 5 <> 1").select(F.expr("marker div 3").alias("gvar_id"))}, lengths=True)


@query("sc22_inject", "select cast(l_linenumber as varchar) as number, true as found from lineitem group by 1")
def _(s, d):
    path = _folder(s)
    X.table(s, d, "lineitem").select(F.col("l_linenumber").alias("k"), "l_orderkey").write.partitionBy("k").parquet(path)
    return SC.inject(s, [path], r"/k=(\d+)/part-", ["number"], unique=True).select("number", (F.col("length") > 0).alias("found"))


@query("sc23_union_specs", "select '/new/' || p_partkey as path, 'a' as source from part union all select '/new/' || s_suppkey, 'b' from supplier")
def _(s, d):
    a = X.table(s, d, "part").select(F.concat(F.lit("/old/"), "p_partkey").alias("path"))
    b = X.table(s, d, "supplier").select(F.concat(F.lit("/old/"), "s_suppkey").alias("path"))
    return SC.union_specs({"a": a, "b": b}, ("^/old/", "/new/")).select("path", "source")


@query("sc26_export_clean", f"select 'variables' as name, cast(iid as varchar) as id, case when iid % 4 <> 0 then cast(iid % 9 as varchar) end as c1 from ({X.SAMPLE}) s where iid % 5 <> 0 union all select 'individuals-included', cast(iid as varchar), null from ({X.SAMPLE}) s where iid % 5 <> 0 union all select 'individuals-excluded', cast(iid as varchar), null from ({X.SAMPLE}) s where iid % 5 = 0 union all select 'markers-excluded', cast(marker as varchar), null from ({X.MARKER}) m where marker % 7 = 0")
def _(s, d):
    people = X.sample(s, d).select(F.col("iid").alias("id"), "y", "age")
    scaled = people.where("id % 4 <> 0").select("id", (F.col("id") % 9).alias("c1"))
    out = people.where("id % 5 = 0").select("id")
    paths = SC.export_clean(people, scaled, out.unionByName(out), X.marker(s, d).where("marker % 7 = 0").select(F.col("marker").alias("id")), _folder(s))
    found = None
    for name, path in paths.items():
        rows = SC.read_table(s, path, sep=",")
        part = rows.select(F.lit(name).alias("name"), F.col("id"), (F.col("c1") if "c1" in rows.columns else F.lit(None).cast("string")).alias("c1"))
        found = part if found is None else found.unionByName(part)
    return found


@query("u12_id_files", "select distinct cast(c_custkey as varchar) as id from customer where c_nationkey in (1, 2, 3)")
def _(s, d):
    """Files of three nations, one that is empty and one that is not there."""
    path = _folder(s)
    c = X.table(s, d, "customer")
    for k in (1, 2, 3):
        c.where(F.col("c_nationkey") == k).select(F.concat_ws("\t", "c_custkey", "c_name").alias("value")).write.text(f"{path}/ids-{k}")
    c.limit(0).select(F.col("c_name").alias("value")).write.text(f"{path}/ids-4")
    return SC.join_id_files(s, [path + "/ids-{k}"], {"k": ["1", "2", "3", "4", "5"]})


@query("f14_range_around", f"select b.marker from ({X.MARKER}) a join ({X.MARKER}) b on a.chr = b.chr and abs(a.pos - b.pos) < 200000 where a.marker = 7")
def _(s, d):
    m = X.marker(s, d)
    return J.range_join(m.where("marker = 7").select("chr", "pos"), m, 200_000).select("marker")


@query("a11_compare_vectors", "with s as (select distinct l_linenumber as set, l_suppkey as id from lineitem) select a.set as s1, b.set as s2, count(*) filter (where a.id = b.id) as common, (select count(*) from s x where x.set = a.set) + (select count(*) from s x where x.set = b.set) - count(*) filter (where a.id = b.id) as either, (select count(*) from s x where x.set = a.set) - count(*) filter (where a.id = b.id) as only1 from s a, s b group by a.set, b.set")
def _(s, d):
    sets = X.table(s, d, "lineitem").select(F.col("l_linenumber").alias("set"), F.col("l_suppkey").alias("id"))
    return A.set_overlaps(sets)


@query("x14_ranges", "select p_partkey, case when p_partkey % 26 in (1, 2, 3, 4, 7, 23) then 'Q' else 'C' end as type from part")
def _(s, d):
    """Ranges and typed names as they are parsed, put to use on a column."""
    wanted, types = S.int_ranges("1-4,7,23"), S.typed_list("in:Q;out:C")
    return X.table(s, d, "part").select("p_partkey", F.when((F.col("p_partkey") % 26).isin(wanted), types["in"]).otherwise(types["out"]).alias("type"))


@query("d06_user_likelihood", f"select marker, count(*) as n, round(sum(gt) / (2e0 * count(*)), 4) as frequency, round(2 * (sum(gt) * ln(sum(gt) / (2e0 * count(*))) + (2 * count(*) - sum(gt)) * ln(1 - sum(gt) / (2e0 * count(*))) - 2 * count(*) * ln(0.5e0)), 3) as stat from ({X.GT}) g where gt is not null group by 1 having sum(gt) > 0 and sum(gt) < 2 * count(*)")
def _(s, d):
    """Allele frequency 1 / (1 + exp(-t)) against one half, by the user's own log likelihood."""

    def loglik(t: np.ndarray, rows) -> float:
        p = np.clip(1 / (1 + np.exp(-t[0])), 1e-12, 1 - 1e-12)
        g = rows["gt"].to_numpy(float)
        return float((rows["w"].to_numpy() * (g * np.log(p) + (2 - g) * np.log(1 - p))).sum())

    out = T.lh_test_lr(X.gt(s, d).where("gt is not null"), ["gt"], loglik, [0.1], [], lambda t: np.zeros(1), counted="w")
    return out.select("marker", "n", F.round(1 / (1 + F.exp(-F.col("t0"))), 4).alias("frequency"), F.round("stat", 3).alias("stat"))


@query("sc27_transform_columns", "select c_custkey, upper(c_name) as c_name, c_nationkey, round(c_acctbal / 1000, 6) as c_acctbal, c_mktsegment from customer")
def _(s, d):
    """Names by one template, the balance by another; two templates find the segment, which stays."""
    t = X.table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return SC.transform_columns(t, {"NAME$": "upper({x})", "bal": "round({x} / 1000, 6)", "^c_mkt": "lower({x})", "segment": "upper({x})"})

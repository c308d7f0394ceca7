"""Joins (J). Keys that R would match as NA to NA are joined null-safely."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(x: DataFrame, y: DataFrame, by: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Merge on common columns (an error without any); other common columns get .x and .y. Null keys match null keys."""
    by = by if by is not None else [c for c in x.columns if c in y.columns]
    if not by:
        raise ValueError("no common columns to merge by")
    clash = [c for c in x.columns if c in y.columns and c not in by]
    left = x.withColumnsRenamed({c: f"{c}.x" for c in clash})
    right = y.withColumnsRenamed({c: f"{c}.y" for c in clash} | {k: f"__{k}" for k in by})
    joined = left.join(right, functools.reduce(Column.__and__, (F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in by)), how)
    if how in ("full", "outer", "right"):
        joined = joined.withColumns({k: F.coalesce(F.col(f"`{k}`"), F.col(f"`__{k}`")) for k in by})
    return joined.drop(*(f"__{k}" for k in by))


def left_join_stable(x: DataFrame, y: DataFrame, by: list[str], line: str) -> DataFrame:
    """Left merge in the order of the left rows."""
    return x.join(y, by, "left").orderBy(line)


def outer_join(x: DataFrame, y: DataFrame, by: list[str]) -> DataFrame:
    """J3"""
    return x.join(y, by, "full")


def merge_all(frames: list[DataFrame], by: list[str], how: str = "full") -> DataFrame:
    """J4"""
    return functools.reduce(lambda a, b: a.join(b, by, how), frames)


def map_values(df: DataFrame, col: str, mapping: dict | DataFrame, regex: bool = False) -> DataFrame:
    """Values through a dictionary (as regular expressions: the first that matches wins) or a map table (from, to); others stay."""
    if isinstance(mapping, dict) and not regex:
        return df.replace({str(k): str(v) for k, v in mapping.items()}, subset=[col])
    if isinstance(mapping, dict):
        out = None
        for pattern, value in mapping.items():
            test = F.col(col).rlike(pattern)
            out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
        return df.withColumn(col, out.otherwise(F.col(col)) if out is not None else F.col(col))
    table = mapping.select(F.col("from").alias(col), F.col("to").alias("__to"))
    return df.join(table, col, "left").withColumn(col, F.coalesce("__to", col)).drop("__to").select(*df.columns)


def which_indices(see: DataFrame, sed: DataFrame, key: str, line: str, multi: bool = False, missing: bool = True) -> DataFrame:
    """(line of ``see``, line of the match in ``sed``), the first match or all; without one null or nothing."""
    right = sed.select(key, F.col(line).alias("at"))
    if not multi:
        right = right.groupBy(key).agg(F.min("at").alias("at"))
    return see.select(key, line).join(right, key, "left" if missing else "inner").select(line, "at")


def range_join(hits: DataFrame, other: DataFrame, r: int, chr: str = "chr", pos: str = "pos", inclusive: bool = False) -> DataFrame:
    """Rows of ``other`` within r of a hit on its chromosome: an equi-join on bins of width r (a hit is in three), then the distance."""
    cell = lambda c: F.floor(F.col(c) / r).cast("long")
    left = hits.select(F.col(chr), F.col(pos).alias("hit_pos"), *(F.col(c).alias(f"hit_{c}") for c in hits.columns if c not in (chr, pos)))
    left = left.withColumn("__bin", F.explode(F.sequence(cell("hit_pos") - 1, cell("hit_pos") + 1)))
    joined = left.join(other.withColumn("__bin", cell(pos)), [chr, "__bin"]).drop("__bin")
    distance = F.abs(F.col(pos) - F.col("hit_pos"))
    return joined.where(distance <= r if inclusive else distance < r)


def intersect_order(a: DataFrame, b: DataFrame, key: str, line: str) -> DataFrame:
    """Common keys with their places in both."""
    return a.select(key, F.col(line).alias("o1")).join(b.select(key, F.col(line).alias("o2")), key)


def lookup_qc(assoc: DataFrame, qc: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left look-up with defaults for what is not matched."""
    return assoc.join(qc, keys, "left").fillna(defaults)


def product(frames: list[DataFrame], constraint: str | None = None, drop_equal: tuple[str, str] | None = None) -> DataFrame:
    """Parameter grid, with a constraint; the result is the product by definition."""
    out = functools.reduce(DataFrame.crossJoin, frames)
    if drop_equal:
        out = out.where(F.col(drop_equal[0]) != F.col(drop_equal[1]))
    return out.where(constraint) if constraint else out


def row_search(a: DataFrame, b: DataFrame, cols: list[str], line: str) -> DataFrame:
    """(line of a, line of b) of equal rows."""
    left, right = a.select(*cols, F.col(line).alias("line_a")), b.select(*(F.col(c).alias(f"__{c}") for c in cols), F.col(line).alias("line_b"))
    return left.join(right, functools.reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols))).select("line_a", "line_b")


def analysis_frame(gt: DataFrame, ped: DataFrame, variables: DataFrame) -> DataFrame:
    """Genotypes with individuals and variables; both sides have one row per individual, so genotype rows stay where AQE can broadcast them."""
    return gt.join(ped, "iid", "left").join(variables, "iid", "left")


def read_variables(frames: list[DataFrame], key: str, line: str, genotyped: str | None = None) -> DataFrame:
    """Of each table the first row per id, merged full outer; rows without genotype go."""
    first = [f.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(line))).where("__k = 1").drop("__k", line) for f in frames]
    out = merge_all(first, [key])
    return out.where(F.col(genotyped).isNotNull()) if genotyped else out


def replace_positions(table: DataFrame, reference: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Positions of a reference map where it has them; the reference must not repeat a key."""
    ref = reference.groupBy(key).agg(F.min(pos).alias("__new"), F.count("*").alias("__n"))
    checked = ref.withColumn("__new", F.when(F.col("__n") > 1, F.raise_error(F.lit("the reference repeats a key")).cast("long")).otherwise(F.col("__new")))
    return table.join(checked, key, "left").withColumn(pos, F.coalesce("__new", pos)).select(*table.columns)


def remap_ids(bim: DataFrame, mapping: DataFrame, line: str) -> DataFrame:
    """Ids through a map (from, to), repeats made unique as ``id-k``."""
    from genoframe.operators.windows import dedup_labels

    joined = bim.join(mapping.select(F.col("from").alias("id"), F.col("to").alias("__to")), "id", "left").withColumn("id", F.coalesce("__to", "id")).drop("__to")
    return dedup_labels(joined, "id", [line])


def complete_pairs(df: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(id1, id2, value) made symmetric over all ids; missing pairs null, the diagonal as given."""
    both = df.select("id1", "id2", "value").unionByName(df.where("id1 <> id2").select(F.col("id2").alias("id1"), F.col("id1").alias("id2"), "value"))
    names = ids if ids is not None else both.select(F.col("id1").alias("id")).distinct()
    # the result itself has a row for every pair of ids
    grid = names.select(F.col("id").alias("id1")).crossJoin(names.select(F.col("id").alias("id2")))
    return grid.join(both.groupBy("id1", "id2").agg(F.min("value").alias("value")), ["id1", "id2"], "left")


def genes_to_markers(df: DataFrame, path: str = "path", pattern: str = r"([^/]+)\.\w+$") -> DataFrame:
    """Gene (captured from the file name) to its markers."""
    return df.select(F.regexp_extract(path, pattern, 1).alias("gene"), "marker").groupBy("gene").agg(F.array_sort(F.collect_set("marker")).alias("markers"))


def pattern(triples: DataFrame, predicate: str, s: str = "s", o: str = "o") -> DataFrame:
    """Subjects and objects of a predicate, under names of your own."""
    return triples.where(F.col("predicate") == predicate).select(F.col("subject").alias(s), F.col("object").alias(o))


def pathway_genes(triples: DataFrame, name: str) -> DataFrame:
    """Genes of pathways whose label matches. A pathway may have many labels: its genes meet it once."""
    named = pattern(triples, "label", "pathway", "text").where(F.col("text").rlike(name)).select("pathway").distinct()
    return pattern(triples, "in_pathway", "gene", "pathway").join(named, "pathway", "left_semi").select("gene").distinct()


def partners(triples: DataFrame, seeds: DataFrame) -> DataFrame:
    """Interaction partners of seed genes at either end, without the seeds."""
    edges = pattern(triples, "interacts", "a", "b")
    s = seeds.select(F.col("gene").alias("__g")).distinct()
    ends = edges.join(s, F.col("a") == F.col("__g")).select(F.col("b").alias("gene")).unionByName(edges.join(s, F.col("b") == F.col("__g")).select(F.col("a").alias("gene")))
    return ends.distinct().join(seeds.select("gene").distinct(), "gene", "left_anti")


def disease_genes(triples: DataFrame, disease: str) -> DataFrame:
    """Disease by name to variant to gene."""
    named = pattern(triples, "name", "disease", "text").where(F.col("text").rlike(disease)).select("disease")
    variants = pattern(triples, "causes", "variant", "disease").join(named, "disease", "left_semi").select("variant")
    return pattern(triples, "in_gene", "variant", "gene").join(variants, "variant", "left_semi").select("gene").distinct()


def extract_snps(wanted: DataFrame, gens: DataFrame, key: str = "rs") -> tuple[DataFrame, DataFrame]:
    """(found rows, wanted keys that are missing)."""
    return gens.join(wanted.select(key).distinct(), key, "left_semi"), wanted.select(key).distinct().join(gens.select(key), key, "left_anti")


def align_alleles(target: DataFrame, reference: DataFrame) -> DataFrame:
    """Class of each marker's alleles against the reference: same, swapped, flip, flip_swapped or incompatible; an allele ``0`` takes the reference's missing one."""
    ref = reference.select("chr", "snp", F.col("a1").alias("r1"), F.col("a2").alias("r2"))
    j = target.join(ref, ["chr", "snp"])
    turned = lambda c: F.translate(c, "ACGT", "TGCA")
    fill = F.when(F.col("a2") == F.col("r1"), F.col("r2")).when(F.col("a2") == F.col("r2"), F.col("r1")).when(turned("a2") == F.col("r1"), turned("r2")).when(turned("a2") == F.col("r2"), turned("r1")).otherwise(F.col("a1"))
    j = j.withColumn("a1", F.when(F.col("a1") == "0", fill).otherwise(F.col("a1")))
    same = lambda x, y: (x == F.col("r1")) & (y == F.col("r2"))
    kind = (
        F.when(same(F.col("a1"), F.col("a2")), "same")
        .when(same(F.col("a2"), F.col("a1")), "swapped")
        .when(same(turned("a1"), turned("a2")), "flip")
        .when(same(turned("a2"), turned("a1")), "flip_swapped")
        .otherwise("incompatible")
    )
    return j.withColumn("kind", kind)

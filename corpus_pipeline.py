"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and works on what the one before it kept.

All stages but the last return the columns of ``documents``. ``run`` applies them in order to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm import jaccard_join, merge_replay, pii, rule_quality, temperature_mix
from genoframe.llm.common import free_names, release, settle

#: Documents under this score are rejected.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rule ensemble rejects go."""
    model = rule_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rule_quality.accepted(docs, model, LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of linked rows one stays, the one with the smallest id (rows of one id: the first as settled; rows without an id come last). Rows without words are in no group and stay."""
    # a key by row, in a settled table: it must not change between the readings
    (key,), again = free_names(docs, "__row"), [F.col(f"`{c}`") for c in docs.columns]
    rows = settle(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")
    named = jaccard_join.grouped(rows.select(F.col(key).alias("doc_id"), "text")).where("n > 0").select(F.col("doc_id").alias(key), "cls")
    ids = rows.select(key, F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", key))
    kept = named.join(ids, key).groupBy("cls").agg(first.alias("first")).select(F.col(f"first.{key}").alias(key))
    wordless = rows.join(named.select(key), key, "left_anti").select(key)
    return rows.join(kept.unionByName(wordless), key, "left_semi").select(*again)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: spans of personal data are replaced by their kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: sources at their temperature weights; a document stands once for each pass that takes it, and all are taken at least once."""
    return temperature_mix.mixed(docs).select(*(F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: byte-level BPE ids."""
    return merge_replay.with_ids(docs.select("doc_id", "lang", "source", "text")).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]

#: A fitted classifier decides in the first stage: SQL can't express it, the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each but the last is written before the next one reads it, as later stages read their input more than once."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        before, written = written, settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        docs = written
        if before is not None:
            release(before)  # nothing reads what the next stage has taken up
    return STAGES[-1][1](spark, docs, sf_dir)

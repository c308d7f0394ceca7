"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that setting is missing, a temporary folder takes its place on a single machine (master ``local``); on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="genoframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.settled_in = path
    return table


def release(*tables: DataFrame) -> None:
    """Removes settled tables of which nothing is read any more, neither directly nor by a table that is still to be computed."""
    for table in tables:
        context = table.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(table.settled_in)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` has not got yet (names are compared without case, as Spark does): underscores are added until they are free."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def place_of(df: DataFrame, name: str) -> int:
    """The place of a column, found as Spark does: the spelling does not matter unless several columns differ by it alone."""
    if name in df.columns:
        return df.columns.index(name)
    found = [k for k, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"there are {len(found)} columns {name}")
    return found[0]


def must_be_free(df: DataFrame, *names: str) -> None:
    """An error for columns that are to be added but are there already, in whatever spelling."""
    clash = sorted({n for n in names if n.lower() in {c.lower() for c in df.columns}})
    if clash:
        raise ValueError(f"columns there already: {clash}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc32_of_id(doc_id: Column | str) -> Column:
    """crc32 of the decimal text of an id (null id: of the empty text)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def reduce_tasks(spark: SparkSession, least: int = 8) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words_of(text: bytes) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at space and 0x09-0x0D."""
    return text.lower().split()

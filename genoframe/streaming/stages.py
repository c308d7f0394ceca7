"""Row-wise and counting operators on file streams: the same functions as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from genoframe.operators.reshape import table_n
from genoframe.operators.tables import filter_results


def file_stream(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    return spark.readStream.schema(schema).options(sep=sep, header=True, nullValue="NA").csv(path)


def filtered_results(stream: DataFrame, **limits: float) -> DataFrame:
    """F6 on results as they arrive."""
    return filter_results(stream, **limits)


def running_counts(stream: DataFrame, col: str, categories: list) -> DataFrame:
    """A3 over all that has arrived (complete output mode)."""
    return table_n(stream, col, categories)


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that has arrived, appended to one table, then the query ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()

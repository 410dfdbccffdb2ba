"""Incremental mode: micro-batches of new files, upserted idempotently, failures set aside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import newest_first


def new_files(spark: SparkSession, path: str, schema, kind: str = "parquet", per_batch: int = 100) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_batch).load(path)


def first_seen(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Each key once; the state of keys older than the delay is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, time: str, width: str, delay: str, *keys: str) -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def split_failures(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def upsert_stream(stream: DataFrame, keys: list[str], version: str, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Each batch becomes a numbered folder of rows under the target (written over if the batch is run again); read_latest() gives the newest row of each key."""
    def write(batch: DataFrame, number: int) -> None:
        newest_first(prepare(batch), keys, [F.col(version).desc()]).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    return newest_first(spark.read.parquet(target), keys, [F.col("batch").desc()]).drop("batch")

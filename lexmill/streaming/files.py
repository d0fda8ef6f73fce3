"""File streams: each new file exactly once, with checkpointed progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_new_files(spark: SparkSession, source: str, schema, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d, max_files: int = 1000) -> None:
    """Run transform over the Parquet files that came since the last call and append the result; a broken run repeats nothing."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    q = transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def first_deliveries(stream: DataFrame, key: str, time: str, lateness: str = "30 days") -> DataFrame:
    """The first delivery of each key within the lateness bound, which also bounds the state."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])

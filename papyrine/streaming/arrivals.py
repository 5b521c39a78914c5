"""Run a stage on the subsets that arrived since the last run, instead of naming a subset per run.

For stages that treat rows one by one, as extraction and finishing do. A subset is processed once, also across failures:
the checkpoint remembers the files read and the sink commits whole batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def process_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    stage: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Apply `stage` to the new files of a Parquet stage table, append to `sink`, and stop when all are done."""
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = stage(arrived).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(sink)

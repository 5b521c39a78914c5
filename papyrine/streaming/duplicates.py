"""Exact duplicates across arrivals: texts seen in earlier subsets are known by their hashes, which a state store keeps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_of_each_text(arriving: DataFrame, key: str = "pdf_path", text: str = "ocr_text") -> DataFrame:
    """Of a stream's rows with equal texts one, for all time: in a batch that with the smallest key, and none if an earlier
    batch had the text. Rows without a text all pass.

    The state is one row per different text, its SHA-256. A text that fills much of a batch passes through its state's task in
    pieces, of which only the row with the smallest key is kept; rows without a key go last.
    """
    names, schema = arriving.columns, arriving.schema

    def choose(_: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        best = None
        for piece in pieces:
            rows = piece if best is None else pd.concat([best, piece], ignore_index=True)
            best = rows if len(rows) == 1 else rows.sort_values(key, na_position="last", kind="stable").head(1)
        if best is not None:
            state.update((True,))
            yield best[names]

    full = arriving.filter(F.col(text).isNotNull()).withColumn("_hash", F.sha2(text, 256))
    kept = full.groupBy("_hash").applyInPandasWithState(choose, schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)
    return kept.unionByName(arriving.filter(F.col(text).isNull()))


def drop_duplicates_across_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    key: str = "pdf_path",
    text: str = "ocr_text",
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Append the rows of the new files of a Parquet stage table whose texts no earlier run had, and stop when all are done.

    The checkpoint holds the hashes, so it must go on from run to run; after a failure a batch is done again with the state as it
    was before it. Hashes are kept on the executors' disks and in the checkpoint, not in memory.
    """
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        writer = first_of_each_text(arrived, key, text).writeStream.outputMode("append").format("parquet")
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)

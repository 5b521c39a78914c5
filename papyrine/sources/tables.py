"""Stage tables: Parquet between stages, CSV as an export."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Columns and column order of the tables that stages exchange.
LISTING_SCHEMA = _schema(path=T.StringType())
QUALITY_SCHEMA = _schema(
    pdf_path=T.StringType(), page_count=T.IntegerType(), is_relevant=T.BooleanType(), ocr_text=T.StringType()
)
EXTRACTION_SCHEMA = _schema(
    pdf_path=T.StringType(),
    page_count=T.IntegerType(),
    md_extraction_result=T.StringType(),
    extracted_meaningful_text=T.StringType(),
)
FINAL_SCHEMA = _schema(
    pdf_path=T.StringType(), md_extraction_result=T.StringType(), regex_applied_text=T.StringType()
)

# Quotes inside a field are doubled, and a backslash is an ordinary character.
CSV_OPTIONS = {
    "header": True,
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _on_one_machine(spark: SparkSession) -> bool:
    """Tasks run in the driver's process. (`local-cluster` has executors of its own.)"""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, which the cluster names in `spark.checkpoint.dir`."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not _on_one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="papyrine-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/papyrine/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The result has no lineage into costly or order-dependent steps, outlives executors, and has a known size. Use it
    where a plan would otherwise run twice, or differently the second time. The shuffle files of the write are given up when it
    is done.
    """
    folder = new_folder(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        rows = _write(df, lambda writer: writer.parquet(folder)).rows
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    doubtful = re.match(r"file:|/", folder) and not _on_one_machine(df.sparkSession)
    if doubtful and (found := written.count()) != rows:
        raise OSError(f"{found} of {rows} rows are in {folder}: spark.checkpoint.dir is no folder that all executors share")
    return written


class Written(NamedTuple):
    """What a write reports: rows, counted on the way, and wall-clock seconds."""

    rows: int
    seconds: float


def _write(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> Written:
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    start = time.perf_counter()
    write(counted.write.mode("overwrite"))
    return Written(seen.get["rows"], time.perf_counter() - start)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Written:
    """Overwrite a Parquet stage table.

    With `partition_by`, rows of a folder meet in one task before, or in a few where they are many; otherwise every task would
    leave a file in every folder.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    return _write(rows, lambda writer: writer.partitionBy(*partition_by).parquet(path))


def read_stage(spark: SparkSession, path: str, schema: T.StructType, subset_id: int | Sequence[int] | None = None) -> DataFrame:
    """Read a stage table, or only the folders of one subset or of several, in one scan."""
    if subset_id is None:
        return spark.read.schema(schema).parquet(path)
    if "subset_id" not in spark.read.parquet(path).columns:
        raise ValueError(f"{path} is not divided into subsets")
    with_subset = T.StructType([*schema.fields, T.StructField("subset_id", T.LongType())])
    wanted = F.col("subset_id") == subset_id if isinstance(subset_id, int) else F.col("subset_id").isin(list(subset_id))
    return spark.read.schema(with_subset).parquet(path).filter(wanted)


def subsets_in(spark: SparkSession, path: str) -> list[int]:
    """The subsets that a stage table is divided into, in order; a subset is some 10,000 files."""
    stored = spark.read.parquet(path)
    if "subset_id" not in stored.columns:
        raise ValueError(f"{path} is not divided into subsets")
    return sorted(row["subset_id"] for row in stored.select(F.col("subset_id").cast("long")).distinct().collect())


NULL_MARKER = "\\N"  # tells missing texts from empty ones


def write_csv(df: DataFrame, path: str, rows_per_file: int = 10_000) -> Written:
    """Export as CSV with a header, replacing what is there.

    Texts hold line breaks, and a file with those is read back by one task, so files are kept small.
    """
    options = {**CSV_OPTIONS, "nullValue": NULL_MARKER, "quoteAll": True, "lineSep": "\n", "maxRecordsPerFile": rows_per_file}
    return _write(df, lambda writer: writer.options(**options).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_marker: str = NULL_MARKER) -> DataFrame:
    """Read CSV stage files whose texts may span lines.

    A field that is `null_marker` is null: by default what `write_csv` writes, "" for files of writers that leave missing
    fields empty. In a file whose rows end in CR LF, a CR LF
    within a text becomes LF.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, nullValue=null_marker).option("mode", "FAILFAST").csv(path)

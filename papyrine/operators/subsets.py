"""Fixed-size subsets of a file list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.functions.paths import subset_folder
from papyrine.operators.ordering import number_rows

SUBSET_SIZE = 10_000


def assign_subsets(files: DataFrame, size: int = SUBSET_SIZE, order_by: Sequence[str] = ("path",)) -> DataFrame:
    """Add `subset_id`: 1 for the first `size` files in order, 2 for the next ones, and so on; the last may be short."""
    numbered = number_rows(files, order_by, "_index")
    return numbered.withColumn("subset_id", F.floor(F.col("_index") / size) + 1).drop("_index")


def subset_manifest(assigned: DataFrame, path: str = "path") -> DataFrame:
    """One row per subset: folder, number of files, first and last path."""
    return assigned.groupBy("subset_id").agg(
        subset_folder(F.first("subset_id")).alias("folder"),
        F.count(F.lit(1)).alias("files"),
        F.min(path).alias("first_path"),
        F.max(path).alias("last_path"),
    )


def subset_count(files: DataFrame, size: int = SUBSET_SIZE) -> DataFrame:
    """One row: the number of files and of subsets they fill."""
    return files.agg(
        F.count(F.lit(1)).alias("total_files"), F.ceil(F.count(F.lit(1)) / size).alias("num_subsets")
    )

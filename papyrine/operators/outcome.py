"""Looking at results: good rows, bad rows, counts and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.functions.texts import is_error
from papyrine.sources.tables import Written


def is_success(base: str, path: str = "pdf_path", text: str = "extracted_meaningful_text") -> Column:
    """A path below `base`, and a text that is there and is no error. Null for some rows that miss one of them."""
    good_path = F.col(path).isNotNull() & F.startswith(path, F.lit(base))
    good_text = F.col(text).isNotNull() & ~is_error(F.col(text))
    return good_path & good_text


def success_rows(df: DataFrame, base: str, **columns: str) -> DataFrame:
    """The good rows. The tests are separate conjuncts, which reach the file scan."""
    return df.filter(is_success(base, **columns))


def error_rows(df: DataFrame, base: str, **columns: str) -> DataFrame:
    """Exactly the rows that `success_rows` leaves out; the complement of the condition, so nothing is joined."""
    return df.filter(~F.coalesce(is_success(base, **columns), F.lit(False)))


def residual_errors(df: DataFrame, text: str = "extracted_meaningful_text") -> DataFrame:
    """Rows whose text is an error; none are left among the success rows."""
    return df.filter(is_error(F.col(text)))


def null_count(df: DataFrame, column: str = "pdf_path") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("null_rows"))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: its place, type, number of values that are not null, and the rows of the table. One scan."""
    counts = [F.count(F.col(name)).alias(f"_{place}") for place, name in enumerate(df.columns)]
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    entries = [
        F.struct(
            F.lit(place).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("dtype"),
            F.col(f"_{place}").alias("non_null"),
            F.col("_rows").alias("total_rows"),
        )
        for place, (name, kind) in enumerate(df.dtypes)
    ]
    return totals.select(F.inline(F.array(*entries)))


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One row per stage, in order: how many rows of `df` reach it. One scan for all stages."""
    totals = df.agg(*[F.count_if(reached).alias(f"_{place}") for place, reached in enumerate(stages.values())])
    entries = [
        F.struct(F.lit(place).alias("step"), F.lit(name).alias("stage"), F.col(f"_{place}").alias("rows"))
        for place, name in enumerate(stages)
    ]
    return totals.select(F.inline(F.array(*entries)))


def run_metrics(spark: SparkSession, runs: dict[str, Written]) -> DataFrame:
    """One row per run on record: its name, rows and seconds, as `throughput_estimate` takes them."""
    rows = [(name, run.rows, run.seconds) for name, run in runs.items()]
    return spark.createDataFrame(rows, "stage string, total_rows long, total_seconds double")


def throughput_estimate(totals: DataFrame, seconds: str = "total_seconds", rows: str = "total_rows") -> DataFrame:
    """Add the average seconds per row and what 1,000 and 10,000 rows would take; null when there are no rows."""
    average = F.try_divide(F.col(seconds).cast("double"), F.col(rows))

    def two_decimals(value: Column) -> Column:
        return F.call_function("format_number", value, F.lit("0.00"))

    return totals.select(
        "*",
        two_decimals(average).alias("sec_per_row"),
        two_decimals(average * 1_000).alias("sec_per_1000"),
        two_decimals(average * 1_000 / 60).alias("min_per_1000"),
        two_decimals(average * 10_000).alias("sec_per_10000"),
        two_decimals(average * 10_000 / 60).alias("min_per_10000"),
    )


def sample_rows(df: DataFrame, n: int, key: str, seed: int | None = None) -> DataFrame:
    """n rows at random; without a seed the choice depends on the key alone, so it is the same every time."""
    order = F.md5(F.col(key).cast("string")) if seed is None else F.rand(seed)
    return df.orderBy(order, key).limit(n)


def preview_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(key).limit(n)


def row_at(df: DataFrame, position: int, key: str) -> DataFrame:
    """The row at a 0-based position in key order, for looking at a table's head."""
    return df.orderBy(key).offset(position).limit(1)

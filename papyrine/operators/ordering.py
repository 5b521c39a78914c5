"""Row numbers over whole tables and inside groups of any size, without a task that sees more than its share.

Rows are range-partitioned by the sort key and written once, each with its partition and its place there. What precedes a
partition is then a sum over a table of one row per partition, which is small whatever the data. Writing first matters:
the range bounds come from a sample, and a second evaluation could draw them differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyrine.sources.tables import materialize

PARTITION, PLACE = "_partition", "_place"
_PLACE_BITS = 33  # monotonically_increasing_id() counts rows in its lower 33 bits, partitions above them


def _sorted_and_placed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in key order with their partition and their 0-based place in it.

    Equal keys are ordered by the rest of the row and then by where the row came from, so that a key held by very many rows
    still falls into several ranges.
    """
    rest = [name for name in df.columns if name not in keys]
    tie = F.xxhash64(*rest) if rest else F.lit(0).cast("long")
    order = [*keys, "_tie", "_origin"]
    ordered = (
        df.select("*", tie.alias("_tie"), F.monotonically_increasing_id().alias("_origin"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    partition = F.shiftright("_id", _PLACE_BITS).alias(PARTITION)
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(PLACE)
    return materialize(ordered.select(*df.columns, partition, place), "ordered")


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the order of `order_by`. One shuffle."""
    return _numbered(_sorted_and_placed(df, order_by), df.columns, name)


def number_in_any_order(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Add a number to each row, from 0 and without gaps, as the rows come: they are written once and not sorted."""
    numbers = df.withColumn("_id", F.monotonically_increasing_id())
    partition = F.shiftright("_id", _PLACE_BITS).alias(PARTITION)
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(PLACE)
    return _numbered(materialize(numbers.select(*df.columns, partition, place), "numbered"), df.columns, name)


def _numbered(placed: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    sizes = placed.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PARTITION, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), PARTITION)  # one row per partition
    return numbered.select(*columns, (F.col("_before") + F.col(PLACE)).alias(name))


def rank_in_groups(df: DataFrame, group_by: str, order_by: Sequence[str], name: str = "rank") -> DataFrame:
    """Add the 1-based rank of each row among those of equal `group_by`, in the order of `order_by`.

    A group may hold any share of the rows: ranges cut it into pieces, each piece is ranked by itself, and the rows of the
    pieces before it are added. `group_by` must not be null.
    """
    placed = _sorted_and_placed(df, [group_by, *order_by])
    # A group's rows follow each other within a partition, so a row's rank there is its place less that of the first.
    pieces = placed.groupBy(PARTITION, group_by).agg(F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group_by).orderBy(PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select(
        PARTITION,
        group_by,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return placed.join(shifts, [PARTITION, group_by]).select(*df.columns, (F.col(PLACE) + F.col("_shift")).alias(name))

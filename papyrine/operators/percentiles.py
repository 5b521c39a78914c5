"""Exact percentiles of a column, by selection instead of sorting.

The value of a given rank is sought in a histogram whose bins know how many values they hold, the smallest and the largest.
The bin that the rank falls into is cut into bins again, until its ends tell the value. Each pass reads the column once for
all ranks together and shuffles one row per bin and task. A pass narrows a range to a thousandth or less, so whole numbers
take a few passes, and never more than `PASSES`; the values themselves are never sorted or gathered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1 << 16  # of all ranges of a pass together
PASSES = 128  # doubles differ in 2098 powers of two, and a pass goes through 17 of them at least
FRACTIONS = (0.0, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


@dataclass
class _Range:
    """Values from `low` to `high`, of which `rows` exist; `before` values are smaller."""

    low: Any
    high: Any
    rows: int
    before: int

    def value_at(self, rank: int) -> Any:
        """The value of a rank in this range where its ends tell it, else None."""
        if self.low == self.high or rank == self.before:
            return self.low
        return self.high if rank == self.before + self.rows - 1 else None


def _offset(value: Column, limits: _Range, whole: bool, bins: int) -> Column:
    """The bin of a value of a range, which rises with the value."""
    if whole:
        place = (value - F.lit(limits.low)).cast("double") / float(limits.high - limits.low)
    else:
        half = 0.5 if limits.high - limits.low == math.inf else 1.0  # the distance of two doubles may be none
        place = (value * half - limits.low * half) / (limits.high * half - limits.low * half)
    return F.least(F.floor(place * bins), F.lit(bins - 1)).cast("int")


def values_at(df: DataFrame, column: str, ranks: Sequence[int], bins: int = BINS) -> dict[int, Any]:
    """The values of the given ranks (from 0) among the sorted values of a numeric column; nulls and NaN are none."""
    kind = df.schema[column].dataType
    whole = isinstance(kind, (T.IntegralType, T.DecimalType))
    value = F.col(column).cast("decimal(38,0)" if isinstance(kind, T.LongType) else kind)
    if isinstance(kind, T.FloatType):
        value = value.cast("double")
    values = df.select(value.alias("_value")).filter(F.col("_value").isNotNull())
    if not whole:
        values = values.filter(~F.isnan("_value"))
    finite = F.lit(True) if whole else F.abs("_value") < float("inf")
    ends = values.agg(
        F.min(F.when(finite, F.col("_value"))),
        F.max(F.when(finite, F.col("_value"))),
        F.count_if(finite),
        F.lit(0) if whole else F.count_if(F.col("_value") == float("-inf")),
        F.count(F.lit(1)),
    ).first()
    low, high, rows, below, total = ends
    found = {rank: -math.inf if rank < below else math.inf for rank in ranks if not below <= rank < below + rows}
    open_at = {rank: _Range(low, high, rows, below) for rank in ranks if 0 <= rank < total and rank not in found}
    for _ in range(PASSES):
        for rank, limits in list(open_at.items()):
            known = limits.value_at(rank)
            if known is not None:
                found[rank] = known
                del open_at[rank]
        if not open_at:
            break
        ranges = list({(r.low, r.high): r for r in open_at.values()}.values())
        each = max(2, bins // len(ranges))
        place = F.lit(None).cast("int")
        for number, limits in enumerate(ranges):
            inside = F.col("_value").between(F.lit(limits.low), F.lit(limits.high))
            place = F.when(inside, number * each + _offset(F.col("_value"), limits, whole, each)).otherwise(place)
        counted = values.select("_value", place.alias("_bin")).filter("_bin IS NOT NULL").groupBy("_bin")
        rows_of = counted.agg(F.min("_value").alias("low"), F.max("_value").alias("high"), F.count(F.lit(1)).alias("rows"))
        cut: dict[int, list[_Range]] = {}
        for row in sorted(rows_of.collect(), key=lambda row: row["_bin"]):  # `bins` at most
            parts = cut.setdefault(row["_bin"] // each, [])
            before = parts[-1].before + parts[-1].rows if parts else ranges[row["_bin"] // each].before
            parts.append(_Range(row["low"], row["high"], row["rows"], before))
        places = {(r.low, r.high): number for number, r in enumerate(ranges)}
        for rank, limits in open_at.items():
            parts = cut[places[limits.low, limits.high]]
            open_at[rank] = next(part for part in parts if part.before <= rank < part.before + part.rows)
    return found


def percentiles(df: DataFrame, column: str, fractions: Sequence[float] = FRACTIONS) -> DataFrame:
    """fraction, `discrete` and `continuous` percentile of a numeric column; nulls and NaN are left out.

    The discrete one is a value of the column, the first that has at least the fraction of the values up to it. The continuous
    one lies between the two values next to (rows - 1) * fraction. Both are null if there is no value.
    """
    if any(not 0 <= fraction <= 1 for fraction in fractions):
        raise ValueError("fractions lie between 0 and 1")
    fractions = [float(fraction) for fraction in fractions]
    kind = df.schema[column].dataType
    counted = F.col(column).isNotNull() & (F.lit(True) if isinstance(kind, (T.IntegralType, T.DecimalType)) else ~F.isnan(column))
    rows = df.agg(F.count_if(counted)).first()[0]
    made = []
    discrete = {f: max(1, rows - math.floor(rows - f * rows)) - 1 for f in fractions}
    between = {f: (rows - 1) * f for f in fractions}
    wanted = {*discrete.values(), *(math.floor(h) for h in between.values()), *(math.ceil(h) for h in between.values())}
    values = values_at(df, column, sorted(wanted)) if rows else {}
    for f in fractions:
        if not rows:
            made.append((f, None, None))
            continue
        low, high = float(values[math.floor(between[f])]), float(values[math.ceil(between[f])])
        inside = low if low == high else low + (high - low) * (between[f] - math.floor(between[f]))
        exact = values[discrete[f]]
        made.append((f, int(exact) if isinstance(kind, T.IntegralType) else exact if isinstance(exact, Decimal) else float(exact), inside))
    kept = T.DoubleType() if isinstance(kind, T.FloatType) else kind
    schema = T.StructType([T.StructField("fraction", T.DoubleType()), T.StructField("discrete", kept), T.StructField("continuous", T.DoubleType())])
    return df.sparkSession.createDataFrame(made, schema)

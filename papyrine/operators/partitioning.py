"""How rows are dealt out over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, tasks: int | None) -> DataFrame:
    """Deal out rows over `tasks` ahead of costly work on each of them; None leaves them where they are.

    Scans of large tables have splits enough. Small files and rows that take seconds each are what this is for.
    """
    return rows.repartition(tasks) if tasks else rows

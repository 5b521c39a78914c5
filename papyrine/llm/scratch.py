"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from papyrine.sources.tables import materialize

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_and_read(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder; the shuffle files of the write are given up when it is there."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, label)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)

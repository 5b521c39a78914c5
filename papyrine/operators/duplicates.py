"""Documents with the same text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame, key: str = "pdf_path", text: str = "ocr_text") -> DataFrame:
    """Of rows with equal texts one: that with the smallest key, one without a key only if none has one.

    Rows without a text are no duplicates of each other and all stay. A key may be on several texts, and whole rows may be
    repeated; one row of each text is kept all the same. Texts are compared by SHA-256. The smallest keys come from partial
    minima, and rows are sought by text and key together, so a text that fills much of the table goes to no single task;
    rows repeated with their key are cut down to one by partial aggregates.
    """
    full = df.filter(F.col(text).isNotNull()).withColumn("_hash", F.sha2(text, 256))
    same = full.groupBy("_hash", F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    first = F.min(F.struct(F.col("_key").isNull().alias("_unnamed"), "_key", "_rows"))
    kept = same.groupBy(F.col("_hash").alias("_kept")).agg(first.alias("_first"))
    kept = kept.select("_kept", F.col("_first._key").alias("_key"), F.col("_first._rows").alias("_rows"))
    found = full.join(kept, (full["_hash"] == kept["_kept"]) & full[key].eqNullSafe(kept["_key"]))
    row = F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("_row")
    repeated = found.filter("_rows > 1").groupBy("_hash").agg(F.first(row).alias("_row")).select("_row.*")
    return found.filter("_rows = 1").select(df.columns).union(repeated).union(df.filter(F.col(text).isNull()))

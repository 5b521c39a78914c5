"""Good and bad rows, counts and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators import outcome
from papyrine.workload.inputs import EXTRACTION, rows_of, table

BASE = "/mnt/scrape/"
COLUMNS = ("doc_id", "pdf_path", "extracted_meaningful_text")


def success_rows(spark, sf_dir):
    return outcome.success_rows(rows_of(spark, sf_dir, EXTRACTION), BASE).select(*COLUMNS)


def error_rows(spark, sf_dir):
    return outcome.error_rows(rows_of(spark, sf_dir, EXTRACTION), BASE).select(*COLUMNS)


def residual_error_count(spark, sf_dir):
    kept = outcome.success_rows(rows_of(spark, sf_dir, EXTRACTION), BASE)
    return outcome.residual_errors(kept).agg(F.count(F.lit(1)).alias("residual_errors"))


def null_path_count(spark, sf_dir):
    return outcome.null_count(rows_of(spark, sf_dir, EXTRACTION))


def column_profile(spark, sf_dir):
    return outcome.column_profile(rows_of(spark, sf_dir, EXTRACTION).select(*COLUMNS))


def throughput_estimate(spark, sf_dir):
    """Each event is a processed row that took `value` seconds; each type of event is a run."""
    seconds = F.sum(F.col("value").cast("decimal(18,4)")).alias("total_seconds")
    runs = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("total_rows"), seconds)
    return outcome.throughput_estimate(runs).drop("total_seconds")


def sample_rows(spark, sf_dir):
    return outcome.sample_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"), 10, "doc_id")


def preview_rows(spark, sf_dir):
    return outcome.preview_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), 5, "doc_id")


QUERIES = {
    "success_rows": success_rows,
    "error_rows": error_rows,
    "residual_error_count": residual_error_count,
    "null_path_count": null_path_count,
    "column_profile": column_profile,
    "throughput_estimate": throughput_estimate,
    "sample_rows": sample_rows,
    "preview_rows": preview_rows,
}

_IS_SUCCESS = f"""(pdf_path IS NOT NULL AND pdf_path LIKE '{BASE}%'
    AND extracted_meaningful_text IS NOT NULL AND extracted_meaningful_text NOT LIKE 'Error%')"""
_SELECT = f"SELECT {', '.join(COLUMNS)} FROM ({EXTRACTION})"

ORACLES = {
    "success_rows": f"{_SELECT} WHERE {_IS_SUCCESS}",
    "error_rows": f"{_SELECT} WHERE {_IS_SUCCESS} IS NOT TRUE",
    "residual_error_count": f"""SELECT count(*) FILTER (extracted_meaningful_text LIKE 'Error%') AS residual_errors
        FROM ({_SELECT} WHERE {_IS_SUCCESS})""",
    "null_path_count": f"SELECT count(*) - count(pdf_path) AS null_rows FROM ({EXTRACTION})",
    "column_profile": " UNION ALL ".join(
        f"""SELECT {place} AS position, '{name}' AS column_name, '{"bigint" if name == "doc_id" else "string"}' AS dtype,
        count({name}) AS non_null, count(*) AS total_rows FROM ({EXTRACTION})"""
        for place, name in enumerate(COLUMNS)
    ),
    "throughput_estimate": """SELECT event_type, total_rows, printf('%.2f', average) AS sec_per_row,
        printf('%.2f', average * 1000) AS sec_per_1000, printf('%.2f', average * 1000 / 60) AS min_per_1000,
        printf('%.2f', average * 10000) AS sec_per_10000, printf('%.2f', average * 10000 / 60) AS min_per_10000
        FROM (SELECT event_type, count(*) AS total_rows,
          CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS average FROM events GROUP BY event_type)""",
    "sample_rows": "SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 10",
    "preview_rows": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5",
}

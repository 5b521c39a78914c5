"""Whole stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators.outcome import stage_counts
from papyrine.operators.pages import in_page_range, with_page_counts
from papyrine.operators.relevance import mark_by_language
from papyrine.plans.stages import collate, curate_documents, extract, finish, mark_quality
from papyrine.workload.cleaning import oracle_clean
from papyrine.workload.files import oracle_names
from papyrine.workload.inputs import EXTRACTION, FILE_PAGES, FILE_PATHS, rows_of, table
from papyrine.workload.relevance import TARGET, oracle_shares


def curate(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text"
    )
    return curate_documents(pages, TARGET, key="doc_id")


def quality_stage(spark, sf_dir):
    return mark_quality(rows_of(spark, sf_dir, FILE_PAGES), lambda df: mark_by_language(df, TARGET))


def extraction_stage(spark, sf_dir):
    return extract(quality_stage(spark, sf_dir))


def final_projection(spark, sf_dir):
    return finish(rows_of(spark, sf_dir, EXTRACTION), "/mnt/scrape/")


def _file_page_text(spark, sf_dir):
    """Every file has two pages; those of some are blank."""
    documents = rows_of(spark, sf_dir, FILE_PATHS)
    return documents.select(
        F.col("path").alias("pdf_path"),
        F.explode(F.sequence(F.lit(1), F.lit(2))).alias("page_no"),
        F.when(F.col("page_id") % 6 == 0, F.lit(" \n")).otherwise(F.col("html")).alias("text"),
    )


def collation_manifest(spark, sf_dir):
    return collate(rows_of(spark, sf_dir, FILE_PATHS), _file_page_text(spark, sf_dir))


def stage_funnel(spark, sf_dir):
    """How many of the listed documents reach each stage."""
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text"
    )
    listing = with_page_counts(table(spark, sf_dir, "documents").select("doc_id"), pages, "doc_id")
    quality = mark_quality(pages, lambda df: mark_by_language(df, TARGET), key="doc_id")
    reached = listing.join(quality.select(F.col("pdf_path").alias("doc_id"), "is_relevant", "error"), "doc_id", "left")
    return stage_counts(
        reached,
        {
            "listed": F.lit(True),
            "has pages": F.col("page_count") > 0,
            "page range": in_page_range(F.col("page_count")),
            "text read": F.col("is_relevant").isNotNull() & F.col("error").isNull(),
            "relevant": F.col("is_relevant"),
        },
    )


QUERIES = {
    "curate_documents": curate,
    "quality_stage": quality_stage,
    "extraction_stage": extraction_stage,
    "final_projection": final_projection,
    "collation_manifest": collation_manifest,
    "stage_funnel": stage_funnel,
}

_DOCUMENTS = """SELECT conv_id AS doc_id, count(*) AS pages, string_agg(text || chr(10), '' ORDER BY turn) AS text
    FROM conversations GROUP BY conv_id HAVING count(*) > 2 AND count(*) < 500"""
_SHARES = f"SELECT d.*, share FROM ({_DOCUMENTS}) d JOIN ({oracle_shares(f'({_DOCUMENTS})')}) s USING (doc_id)"
_QUALITY = f"""SELECT 'file:/scrape/doc_' || doc_id || '.pdf' AS pdf_path, CAST(pages AS INTEGER) AS page_count,
    CASE WHEN doc_id % 19 = 0 THEN false ELSE coalesce(share >= 0.8, false) END AS is_relevant,
    CASE WHEN doc_id % 19 = 0 THEN 'Error processing file:/scrape/doc_' || doc_id || '.pdf: bad page' ELSE text END
      AS ocr_text,
    CASE WHEN doc_id % 19 = 0 THEN 'bad page' END AS error
    FROM ({_SHARES})"""

ORACLES = {
    "curate_documents": f"""SELECT doc_id, CAST(pages AS INTEGER) AS page_count, true AS is_relevant,
        {oracle_clean("text")} AS extracted_text FROM ({_SHARES}) WHERE share >= 0.8""",
    "quality_stage": _QUALITY,
    "extraction_stage": f"""SELECT pdf_path, page_count, ocr_text AS md_extraction_result,
        {oracle_clean("ocr_text")} AS extracted_meaningful_text FROM ({_QUALITY}) WHERE is_relevant""",
    "final_projection": f"""SELECT pdf_path, md_extraction_result, {oracle_clean("md_extraction_result")} AS regex_applied_text
        FROM ({EXTRACTION}) WHERE pdf_path IS NOT NULL AND starts_with(pdf_path, '/mnt/scrape/')
        AND extracted_meaningful_text IS NOT NULL AND NOT starts_with(extracted_meaningful_text, 'Error')""",
    "collation_manifest": oracle_names(
        f"""SELECT path FROM ({FILE_PATHS}) WHERE lower(path) LIKE '%.pdf' AND page_id % 6 <> 0"""  # the blank ones
    ),
    "stage_funnel": f"""WITH listed AS (
          SELECT d.doc_id, count(c.conv_id) AS pages FROM documents d LEFT JOIN conversations c ON c.conv_id = d.doc_id
          GROUP BY d.doc_id),
        reached AS (SELECT l.doc_id, l.pages, s.doc_id IS NOT NULL AS read, coalesce(share >= 0.8, false) AS relevant
          FROM listed l LEFT JOIN ({_SHARES}) s ON s.doc_id = l.doc_id)
        SELECT 0 AS step, 'listed' AS stage, count(*) AS rows FROM reached
        UNION ALL SELECT 1, 'has pages', count(*) FROM reached WHERE pages > 0
        UNION ALL SELECT 2, 'page range', count(*) FROM reached WHERE pages > 2 AND pages < 500
        UNION ALL SELECT 3, 'text read', count(*) FROM reached WHERE read
        UNION ALL SELECT 4, 'relevant', count(*) FROM reached WHERE relevant""",
}

"""Page rows to documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.functions.texts import truncate
from papyrine.operators.pages import (
    assemble_documents,
    document_segments,
    documents_in_range,
    page_count_histogram,
    page_range_filter,
    valid_documents,
    with_page_counts,
)
from papyrine.workload.inputs import SPARSE_PAGES, rows_of, table

# Conversations have 2 to 8 turns: with these bounds both ends cut.
ABOVE, BELOW = 2, 7
HEAD = 15_000
# Small, so that conversations fall into several blocks and segments.
BLOCK, SEGMENT, MOST = 2, 1_000, 3_000


def _conversation_pages(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text"
    )


def document_page_count(spark, sf_dir):
    listing = table(spark, sf_dir, "documents").select("doc_id")
    return with_page_counts(listing, _conversation_pages(spark, sf_dir), "doc_id")


def filter_page_range(spark, sf_dir):
    return page_range_filter(document_page_count(spark, sf_dir), ABOVE, BELOW)


def assemble_document_text(spark, sf_dir):
    return assemble_documents(_conversation_pages(spark, sf_dir), "doc_id").select("doc_id", "page_count", "ocr_text")


def assemble_in_range(spark, sf_dir):
    documents = documents_in_range(_conversation_pages(spark, sf_dir), "doc_id", ABOVE, BELOW)
    return documents.select("doc_id", "page_count", "ocr_text")


def count_pages_histogram(spark, sf_dir):
    return page_count_histogram(document_page_count(spark, sf_dir), 2)


def find_valid_documents(spark, sf_dir):
    pages = rows_of(spark, sf_dir, SPARSE_PAGES)
    return valid_documents(pages, "conv_id").select(F.col("conv_id").alias("doc_id"))


def truncate_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", truncate(F.col("text"), HEAD).alias("head"))


def segment_documents(spark, sf_dir):
    segments = document_segments(_conversation_pages(spark, sf_dir), "doc_id", SEGMENT, BLOCK)
    return segments.select("doc_id", "segment", F.col("first_page").alias("page_no"), "pages", "bytes_before", "text")


def assemble_long_documents(spark, sf_dir):
    """Conversations of more than three turns by segments, and none of 3000 bytes in one row."""
    documents = assemble_documents(_conversation_pages(spark, sf_dir), "doc_id", long_pages=3, long_bytes=SEGMENT, most_bytes=MOST)
    return documents.select("doc_id", "page_count", "ocr_text", "error")


QUERIES = {
    "document_page_count": document_page_count,
    "page_range_filter": filter_page_range,
    "assemble_document_text": assemble_document_text,
    "assemble_in_range": assemble_in_range,
    "document_segments": segment_documents,
    "assemble_long_documents": assemble_long_documents,
    "page_count_histogram": count_pages_histogram,
    "valid_documents": find_valid_documents,
    "truncate_text": truncate_text,
}

PAGE_COUNTS = """SELECT d.doc_id, CAST(count(c.conv_id) AS INTEGER) AS page_count
FROM documents d LEFT JOIN conversations c ON c.conv_id = d.doc_id GROUP BY d.doc_id"""

ORACLES = {
    "document_page_count": PAGE_COUNTS,
    "page_range_filter": f"SELECT * FROM ({PAGE_COUNTS}) WHERE page_count > {ABOVE} AND page_count < {BELOW}",
    "assemble_document_text": f"""SELECT conv_id AS doc_id, CAST(count(*) AS INTEGER) AS page_count,
        string_agg(text || chr(10), '' ORDER BY turn) AS ocr_text
        FROM conversations GROUP BY conv_id""",
    "assemble_in_range": f"""SELECT conv_id AS doc_id, CAST(count(*) AS INTEGER) AS page_count,
        string_agg(text || chr(10), '' ORDER BY turn) AS ocr_text
        FROM conversations GROUP BY conv_id HAVING count(*) > {ABOVE} AND count(*) < {BELOW}""",
    "document_segments": f"""WITH ranked AS (SELECT conv_id AS doc_id, turn, text || chr(10) AS text,
          (row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1) // {BLOCK} AS block FROM conversations),
        blocks AS (SELECT doc_id, block, min(turn) AS page_no, count(*) AS pages, string_agg(text, '' ORDER BY turn) AS text
          FROM ranked GROUP BY doc_id, block),
        placed AS (SELECT *, CAST(coalesce(sum(strlen(text)) OVER (PARTITION BY doc_id ORDER BY block
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM blocks)
        SELECT doc_id, before // {SEGMENT} AS segment, min(page_no) AS page_no, CAST(sum(pages) AS BIGINT) AS pages,
          min(before) AS bytes_before, string_agg(text, '' ORDER BY block) AS text FROM placed GROUP BY doc_id, before // {SEGMENT}""",
    "assemble_long_documents": f"""WITH whole AS (SELECT conv_id AS doc_id, CAST(count(*) AS INTEGER) AS page_count,
          string_agg(text || chr(10), '' ORDER BY turn) AS ocr_text, sum(strlen(text)) AS b FROM conversations GROUP BY conv_id),
        judged AS (SELECT *, CASE WHEN (page_count > 3 OR b > {SEGMENT}) AND strlen(ocr_text) > {MOST}
          THEN 'its text has ' || strlen(ocr_text) || ' bytes' END AS error FROM whole)
        SELECT doc_id, page_count, coalesce('Error processing ' || doc_id || ': ' || error, ocr_text) AS ocr_text, error FROM judged""",
    "page_count_histogram": f"""SELECT CAST(page_count // 2 * 2 AS INTEGER) AS first, CAST(page_count // 2 * 2 + 1 AS INTEGER) AS last,
        count(*) AS documents FROM ({PAGE_COUNTS}) GROUP BY page_count // 2""",
    "valid_documents": rf"""SELECT DISTINCT conv_id AS doc_id FROM ({SPARSE_PAGES}) WHERE regexp_matches(text, '\S')""",
    "truncate_text": f"SELECT doc_id, substr(text, 1, {HEAD}) AS head FROM documents",  # the operator's own limit
}

"""The stages: collate files, split into subsets, mark quality, extract and clean, finish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.functions.cleaning import clean_text
from papyrine.functions.paths import has_extension, plain_path
from papyrine.operators.naming import cap_candidates, collision_safe_names
from papyrine.operators.outcome import success_rows
from papyrine.operators.pages import MAX_PAGES, MIN_PAGES, documents_in_range, valid_documents
from papyrine.operators.relevance import mark_by_language, relevant_only
from papyrine.operators.subsets import SUBSET_SIZE, assign_subsets

Stage = Callable[[DataFrame], DataFrame]


def collate(
    listing: DataFrame, pages: DataFrame, max_files: int | None = None, extensions: tuple[str, ...] = (".pdf",)
) -> DataFrame:
    """Manifest (path, name) of the files that have text, with names for one flat folder."""
    files = listing.select(plain_path(F.col("path")).alias("path")).filter(has_extension(F.col("path"), *extensions))
    candidates = cap_candidates(files, max_files)
    valid = valid_documents(pages.select(plain_path(F.col("pdf_path")).alias("path"), "text"), "path")
    return collision_safe_names(candidates.join(valid, "path", "left_semi"))


def split(manifest: DataFrame, size: int = SUBSET_SIZE, key: str = "name") -> DataFrame:
    """Add `subset_id`; write the result with `write_stage(..., partition_by=["subset_id"])`."""
    return assign_subsets(manifest, size, [key])


def with_subset(quality: DataFrame, subsets: DataFrame) -> DataFrame:
    """Add the `subset_id` that `split` gave a document's file; documents without a file there are left out."""
    known = subsets.select(plain_path(F.col("path")).alias("_path"), "subset_id")
    return quality.withColumn("_path", plain_path(F.col("pdf_path"))).join(known, "_path").drop("_path")


def mark_quality(
    pages: DataFrame,
    mark: Stage = mark_by_language,
    above: int = MIN_PAGES,
    below: int = MAX_PAGES,
    key: str = "pdf_path",
) -> DataFrame:
    """Quality table (pdf_path, page_count, is_relevant, ocr_text, error) of the documents in the page range.

    `mark` adds `is_relevant`; give `mark_by_classifier` with a classifier of your own for a model's judgement.
    """
    marked = mark(documents_in_range(pages, key, above, below))
    return marked.select(F.col(key).alias("pdf_path"), "page_count", "is_relevant", "ocr_text", "error")


def read_text_as_markdown(relevant: DataFrame) -> DataFrame:
    """Take the text read from the pages as the extraction result."""
    return relevant.withColumn("md_extraction_result", F.col("ocr_text"))


def extract(quality: DataFrame, to_markdown: Stage = read_text_as_markdown) -> DataFrame:
    """Extraction table (pdf_path, page_count, md_extraction_result, extracted_meaningful_text) of relevant documents, and
    their subset_id if they have one.

    `to_markdown` adds `md_extraction_result`. If it is costly, write what it gives with `materialize` before cleaning.
    """
    subset = ["subset_id"] if "subset_id" in quality.columns else []
    return to_markdown(relevant_only(quality)).select(
        "pdf_path",
        "page_count",
        "md_extraction_result",
        clean_text(F.col("md_extraction_result")).alias("extracted_meaningful_text"),
        *subset,
    )


def finish(extraction: DataFrame, base: str) -> DataFrame:
    """Final table (pdf_path, md_extraction_result, regex_applied_text): rows without errors, cleaned anew."""
    kept = success_rows(extraction, base).select("pdf_path", "md_extraction_result")
    return kept.withColumn("regex_applied_text", clean_text(F.col("md_extraction_result")))


def curate_documents(
    pages: DataFrame,
    target: str = "id",
    threshold: float = 0.8,
    above: int = MIN_PAGES,
    below: int = MAX_PAGES,
    key: str = "pdf_path",
) -> DataFrame:
    """Page rows in, clean texts of the documents in the wanted language out."""
    quality = mark_quality(pages, lambda df: mark_by_language(df, target, threshold), above, below, key)
    return relevant_only(quality).select(
        F.col("pdf_path").alias(key),
        "page_count",
        F.lit(True).alias("is_relevant"),  # known after the filter; the column would be worked out a second time
        clean_text(F.col("ocr_text")).alias("extracted_text"),
    )

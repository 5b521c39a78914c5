"""From page rows (document, page_no, text, error) to documents.

A page table has one row per page. A row with an `error` and no `page_no` says that its document could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.texts import is_blank, read_error
from papyrine.operators.ordering import rank_in_groups
from papyrine.sources.tables import materialize

# Documents are kept with more than MIN_PAGES and fewer than MAX_PAGES pages.
MIN_PAGES, MAX_PAGES = 2, 500

SALTS = 64  # tasks that share the pages of one document that is too long
BLOCK_PAGES = 1024  # pages joined at once of a document that is not gathered whole
SEGMENT_BYTES = 1 << 26
LONG_PAGES, LONG_BYTES = 4 * BLOCK_PAGES, SEGMENT_BYTES  # documents beyond are joined by segments
MOST_BYTES = 1 << 30  # of a text in one row; Spark's rows end at twice that


def page_counts(pages: DataFrame, key: str = "pdf_path") -> DataFrame:
    """Pages per document; 0 for one that could not be read."""
    return pages.groupBy(key).agg(F.count("page_no").cast("int").alias("page_count"))


def with_page_counts(listing: DataFrame, pages: DataFrame, key: str = "pdf_path") -> DataFrame:
    """Add `page_count` to a listing; 0 for documents without page rows."""
    counted = listing.join(page_counts(pages, key), key, "left")
    return counted.withColumn("page_count", F.coalesce("page_count", F.lit(0)))


def in_page_range(page_count: Column, above: int = MIN_PAGES, below: int = MAX_PAGES) -> Column:
    return (page_count > above) & (page_count < below)


def page_range_filter(df: DataFrame, above: int = MIN_PAGES, below: int = MAX_PAGES) -> DataFrame:
    return df.filter(in_page_range(F.col("page_count"), above, below))


def valid_documents(pages: DataFrame, key: str = "pdf_path") -> DataFrame:
    """Documents with text on at least one page."""
    has_text = F.coalesce(~is_blank(F.col("text")), F.lit(False))
    return pages.groupBy(key).agg(F.bool_or(has_text).alias("_valid")).filter("_valid").select(key)


def without_oversized(pages: DataFrame, key: str = "pdf_path", below: int = MAX_PAGES) -> DataFrame:
    """Leave out the pages of documents with `below` pages or more, wherever those pages are.

    One document may own much of the table, so its pages must go before anything gathers rows by document. Such documents
    are found from partial counts over the key column, and each is sought in SALTS tasks that share its pages.
    """
    return _apart(pages, page_counts(pages, key).filter(F.col("page_count") >= below).select(key), key, "left_anti")


def _apart(pages: DataFrame, documents: DataFrame, key: str, how: str) -> DataFrame:
    """The pages of the given documents (left_semi) or of all others (left_anti), each document sought in SALTS tasks."""
    salted = documents.select(key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    return pages.withColumn("_salt", salt).join(salted, [key, "_salt"], how).drop("_salt")


def _line(text: str = "text") -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit("\n"))


def document_segments(
    pages: DataFrame, key: str = "pdf_path", segment_bytes: int = SEGMENT_BYTES, block_pages: int = BLOCK_PAGES
) -> DataFrame:
    """The texts of documents of any length, in segments: key, segment (from 0), first_page, pages, bytes_before, text.

    The text is every page in order, each followed by a newline, and the segments of a document joined in order are its
    text. Pages are ranked by ranges, so a document may hold most of the table; `block_pages` at a time are joined, and blocks go
    to the segment that their first byte falls into. No task holds more of a document than a segment and a block. Rows
    without a key or a page number belong to no text; pages with the same number follow each other by their texts.
    """
    rows = pages.filter(F.col(key).isNotNull() & F.col("page_no").isNotNull()).select(key, "page_no", _line().alias("text"))
    ranked = rank_in_groups(rows, key, ["page_no", "text"], "_rank")
    ranked = ranked.withColumn("_block", F.floor((F.col("_rank") - 1) / block_pages))
    page = F.struct("_rank", "text")
    blocks = ranked.groupBy(key, "_block").agg(
        F.min("page_no").alias("first_page"),
        F.count(F.lit(1)).alias("pages"),
        F.array_join(F.sort_array(F.collect_list(page))["text"], "").alias("text"),
    )
    blocks = materialize(blocks.withColumn("_bytes", F.octet_length("text").cast("long")), "blocks")
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select(key, "_block", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_before"))
    placed = blocks.join(sizes, [key, "_block"]).withColumn("segment", F.floor(F.col("_before") / segment_bytes))
    return placed.groupBy(key, "segment").agg(
        F.min("first_page").alias("first_page"),
        F.sum("pages").alias("pages"),
        F.min("_before").alias("bytes_before"),
        F.array_join(F.sort_array(F.collect_list(F.struct("_block", "text")))["text"], "").alias("text"),
    )


def _gathered(pages: DataFrame, key: str) -> DataFrame:
    """(key, page_count, _joined, error), each document in one go."""
    page = F.when(F.col("page_no").isNotNull(), F.struct("page_no", _line().alias("text")))
    return pages.groupBy(key).agg(
        F.count("page_no").cast("int").alias("page_count"),
        F.array_join(F.sort_array(F.collect_list(page))["text"], "").alias("_joined"),
        F.min("error").alias("error"),
    )


def _by_segments(pages: DataFrame, key: str, segment_bytes: int, block_pages: int, most_bytes: int) -> DataFrame:
    """The same, with the texts joined from segments; those beyond `most_bytes` fit in no row and are an error."""
    counted = pages.groupBy(key).agg(
        F.count("page_no").cast("int").alias("page_count"),
        F.sum(F.when(F.col("page_no").isNotNull(), F.octet_length(_line()).cast("long"))).alias("_bytes"),
        F.min("error").alias("_error"),
    )
    counted = materialize(counted, "lengths")
    fitting = counted.filter((F.col("_bytes") <= most_bytes) & F.col("_error").isNull()).select(key)
    segments = document_segments(_apart(pages, fitting, key, "left_semi"), key, segment_bytes, block_pages)
    ordered = F.sort_array(F.collect_list(F.struct("segment", "text")))["text"]
    joined = segments.groupBy(key).agg(F.array_join(ordered, "").alias("_joined"))
    failure = F.concat(F.lit("its text has "), F.col("_bytes").cast("string"), F.lit(" bytes"))
    error = F.coalesce("_error", F.when(F.col("_bytes") > most_bytes, failure))
    return counted.join(joined, key, "left").select(key, "page_count", "_joined", error.alias("error"))


def assemble_documents(
    pages: DataFrame,
    key: str = "pdf_path",
    long_pages: int | None = LONG_PAGES,
    long_bytes: int = LONG_BYTES,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """All documents as (key, page_count, ocr_text, error).

    The text is every page in order, each followed by a newline. A document with an unreadable part carries the error, in
    `error` and as its text. Pages that name no document belong to none. Texts are shuffled once.

    Documents with more than `long_pages` pages or `long_bytes` bytes are found from partial counts first and joined from
    segments, so that no task gathers all their pages; `long_pages` None says that there are none. A text of more than
    `most_bytes` bytes fits in no row and counts as unreadable; `document_segments` has it in pieces.
    """
    rows = pages.filter(F.col(key).isNotNull())
    if "error" not in pages.columns:
        rows = rows.withColumn("error", F.lit(None).cast("string"))
    rows = rows.select(key, "page_no", "text", "error")
    documents = None
    if long_pages is not None:
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.octet_length("text").cast("long")).alias("_bytes"))
        long = materialize(sizes.filter((F.col("_rows") > long_pages) | (F.col("_bytes") > long_bytes)).select(key), "long")
        if not long.isEmpty():
            parts = _by_segments(_apart(rows, long, key, "left_semi"), key, SEGMENT_BYTES, BLOCK_PAGES, most_bytes)
            documents = _gathered(_apart(rows, long, key, "left_anti"), key).unionByName(parts)
    if documents is None:
        documents = _gathered(rows, key)
    failure = read_error(F.col(key), F.col("error"))
    ocr_text = F.when(F.col("error").isNull(), F.coalesce("_joined", F.lit(""))).otherwise(failure)
    return documents.select(key, "page_count", ocr_text.alias("ocr_text"), "error")


def documents_in_range(
    pages: DataFrame, key: str = "pdf_path", above: int = MIN_PAGES, below: int = MAX_PAGES
) -> DataFrame:
    """The documents with more than `above` and fewer than `below` pages, as `assemble_documents` gives them."""
    return page_range_filter(assemble_documents(without_oversized(pages, key, below), key, long_pages=None), above, below)


def page_count_histogram(documents: DataFrame, width: int = 1, page_count: str = "page_count") -> DataFrame:
    """How many documents there are for each range of `width` page counts: first, last, documents."""
    first = (F.floor(F.col(page_count) / width) * width).cast("int")
    counted = documents.groupBy(first.alias("first")).agg(F.count(F.lit(1)).alias("documents"))
    return counted.select("first", (F.col("first") + width - 1).alias("last"), "documents")

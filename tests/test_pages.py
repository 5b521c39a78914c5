"""Documents from pages."""

import pytest
from pyspark.sql import functions as F

from papyrine.operators import pages as P
from papyrine.operators.relevance import mark_by_language

SCHEMA = "pdf_path string, page_no int, text string, error string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_counts_and_range(spark):
    df = frame(spark, [("a", 1, "x", None), ("a", 2, None, None), ("b", None, None, "broken")])
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "pdf_path string")
    counts = P.with_page_counts(listing, df)
    assert sorted(counts.collect()) == [("a", 2), ("b", 0), ("c", 0)]
    assert P.page_range_filter(counts, 1, 3).collect() == [("a", 2)]
    edges = spark.createDataFrame([(n,) for n in (0, 2, 3, 499, 500)], "page_count int")
    assert [row.page_count for row in P.page_range_filter(edges).collect()] == [3, 499]


def test_valid_needs_one_page_with_text(spark):
    rows = [("a", 1, " \n", None), ("a", 2, "x", None), ("b", 1, "\u00a0\x1c", None), ("c", None, None, "e")]
    assert P.valid_documents(frame(spark, rows)).collect() == [("a",)]


def test_assembly_orders_pages_and_carries_errors(spark):
    rows = [("a", n, f"p{n}", None) for n in (11, 2, 1, 10)]
    rows += [("e", n, "x", "second" if n == 2 else None) for n in range(3)]
    rows += [("n", n, None if n == 1 else "y", None) for n in range(3)]
    rows += [(None, n, "z", None) for n in range(4)]
    rows += [("short", 1, "x", None), ("short", 2, "x", None), ("broken", None, None, "bad")]
    got = {row.pdf_path: row for row in P.assemble_documents(frame(spark, rows)).collect()}
    assert set(got) == {"a", "e", "n", "short", "broken"}
    assert (got["broken"].page_count, got["broken"].ocr_text) == (0, "Error processing broken: bad")
    assert (got["a"].ocr_text, got["a"].page_count, got["a"].error) == ("p1\np2\np10\np11\n", 4, None)
    assert (got["e"].ocr_text, got["e"].error) == ("Error processing e: second", "second")
    assert got["n"].ocr_text == "y\n\ny\n"


@pytest.mark.parametrize("number", ["int(id)", "1", "int(null)"])
def test_oversized_documents_go_first(many_partitions, number):
    # One document owns most pages, and several are one page too long; numbers may repeat or be missing.
    hot = many_partitions.range(5_000).select(F.lit("hot").alias("pdf_path"), F.expr(number).alias("page_no"))
    if "null" in number:
        hot = hot.withColumn("page_no", F.when(F.monotonically_increasing_id() % 2 == 0, 7))
    rest = many_partitions.range(60).select(
        F.concat(F.lit("d"), F.col("id")).alias("pdf_path"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("id") < 5, 10).otherwise(9))).alias("page_no"),
    )
    df = hot.unionByName(rest).withColumn("text", F.lit("t"))
    left = P.without_oversized(df, "pdf_path", below=10)
    assert left.columns == df.columns
    assert left.groupBy("pdf_path").count().count() == 55
    assert left.count() == 55 * 9
    documents = P.documents_in_range(df, above=2, below=10)
    assert documents.count() == 55
    assert {row.ocr_text for row in documents.collect()} == {"t\n" * 9}


def test_oversized_documents_are_found_without_a_job(many_partitions):
    df = many_partitions.range(100).select(F.lit("a").alias("pdf_path"), F.col("id").alias("page_no"))
    tracker = many_partitions.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    P.without_oversized(df, below=10)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_page_count_histogram(spark):
    counts = spark.createDataFrame([(n,) for n in (0, 1, 9, 10, 25)], "page_count int")
    assert sorted(map(tuple, P.page_count_histogram(counts, 10).collect())) == [(0, 9, 3), (10, 19, 1), (20, 29, 1)]


def test_documents_with_errors_are_not_relevant(spark):
    df = spark.createDataFrame([("yang dan ini", None), ("yang dan ini", "bad")], "ocr_text string, error string")
    assert [row.is_relevant for row in mark_by_language(df).orderBy("error").collect()] == [True, False]


def plain_segments(pages, segment_bytes, block_pages):
    """Blocks of pages in order, put into segments by where they begin."""
    out = {}
    texts = [(no, (text or "") + "\n") for no, text in sorted(pages, key=lambda page: (page[0], (page[1] or "") + "\n"))]
    before = 0
    for first in range(0, len(texts), block_pages):
        block = texts[first : first + block_pages]
        made = out.setdefault(before // segment_bytes, [block[0][0], 0, before, ""])
        made[1] += len(block)
        made[3] += "".join(text for _, text in block)
        before += sum(len(text.encode()) for _, text in block)
    return {segment: tuple(made) for segment, made in out.items()}


@pytest.mark.parametrize(("segment_bytes", "block_pages"), [(1 << 20, 1024), (50, 3), (1, 1)])
def test_segments_of_long_documents(many_partitions, segment_bytes, block_pages):
    documents = {"hot": [(n * 7 % 1000, f"page é {n}") for n in range(1_000)], "same": [(5, f"t{n % 9}") for n in range(100)]}
    documents |= {"one": [(1, None)], "long": [(1, "x" * 500), (2, "y" * 500), (3, None)]}
    rows = [(key, no, text, None) for key, pages in documents.items() for no, text in pages]
    rows += [(None, 1, "z", None), ("hot", None, "z", None), ("unread", None, None, "bad")]
    got = P.document_segments(frame(many_partitions, rows), segment_bytes=segment_bytes, block_pages=block_pages).collect()
    found = {key: {} for key in documents}
    for r in got:
        found[r.pdf_path][r.segment] = (r.first_page, r.pages, r.bytes_before, r.text)
    assert found == {key: plain_segments(pages, segment_bytes, block_pages) for key, pages in documents.items()}


def test_long_documents_are_assembled_as_others_are(many_partitions):
    rows = [("hot", n, f"p{n}", None) for n in range(500)] + [("big", n, "x" * 400, None) for n in range(3)]
    rows += [("bad", n, "y", "broken" if n == 7 else None) for n in range(50)] + [("a", 1, "x", None), ("a", 2, None, None), (None, 1, "z", None)]
    rows += [("unread", None, None, "no")] * 30
    df = frame(many_partitions, rows)
    plain = sorted(P.assemble_documents(df, long_pages=None).collect())
    assert sorted(P.assemble_documents(df).collect()) == plain
    assert sorted(P.assemble_documents(df, long_pages=20, long_bytes=1_000).collect()) == plain
    beyond = {r.pdf_path: r for r in P.assemble_documents(df, long_pages=20, long_bytes=1_000, most_bytes=1_200).collect()}
    assert beyond["big"].error == "its text has 1203 bytes" and beyond["big"].page_count == 3
    assert beyond["big"].ocr_text == "Error processing big: its text has 1203 bytes" and beyond["bad"].error == "broken"


def test_documents_beyond_any_row_keep_their_segments(many_partitions):
    df = many_partitions.range(60_000).select(F.lit("hot").alias("pdf_path"), F.col("id").alias("page_no"), F.lit("some text").alias("text"))
    segments = P.document_segments(df, segment_bytes=100_000, block_pages=100)
    sizes = [(r.segment, r.pages, len(r.text)) for r in segments.collect()]
    assert sorted(segment for segment, _, _ in sizes) == list(range(6)) and sum(pages for _, pages, _ in sizes) == 60_000
    assert max(size for _, _, size in sizes) <= 101_000

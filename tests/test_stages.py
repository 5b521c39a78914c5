"""Hooks and stages put together."""

import pytest
from pyspark.sql import functions as F

from papyrine.operators.hooks import extract_markdown, extract_pages
from papyrine.operators.hooks import append_result
from papyrine.operators.partitioning import spread
from papyrine.operators.relevance import mark_by_classifier, relevant_only
from papyrine.plans.stages import collate, curate_documents, extract, finish, mark_quality, split
from papyrine.sources.tables import EXTRACTION_SCHEMA, FINAL_SCHEMA, QUALITY_SCHEMA, materialize, read_stage, write_stage
from papyrine.streaming.arrivals import process_arrivals

TEXTS = {
    "/in/x/a.pdf": ["# Judul\nyang dan ini", "untuk **tebal** dengan", "pada (1) itu"],
    "/in/y/a.pdf": ["the and of", "was with", "from this"],
    "/in/y/short.PDF": ["yang dan"],
    "/in/y/blank.pdf": [" ", "\n"],
}


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame([(path,) for path in [*TEXTS, "/in/z/gone.pdf", "/in/z/n.html", None]], "path string")


@pytest.fixture(scope="module")
def pages(spark, listing):
    texts = TEXTS

    def page_reader():
        def read(path):
            if path not in texts:
                raise OSError("no such file")
            return texts[path]

        return read

    return materialize(extract_pages(listing, page_reader, partitions=3), "pages")


def test_extracted_pages(pages):
    rows = [tuple(row) for row in pages.filter("pdf_path LIKE '%/y/a.pdf'").orderBy("page_no").collect()]
    assert rows[0] == ("/in/y/a.pdf", 1, "the and of", None) and len(rows) == 3
    assert pages.filter("pdf_path = '/in/z/gone.pdf'").first().error == "no such file"
    assert pages.filter("pdf_path IS NULL").first().error == "Error: PDF path is None"


def test_many_pages_are_flushed(spark):
    files = spark.range(5).select(F.col("id").cast("string").alias("path"))
    many = extract_pages(files, lambda: lambda path: (str(n) for n in range(2_500)))
    assert many.count() == 5 * 2_500
    assert many.filter("page_no = 2500").count() == 5


def test_odd_results_of_user_code(spark):
    files = spark.createDataFrame([("a",), ("b",)], "path string")

    def reader():
        def read(path):
            yield "x\ud800y"
            yield 7
            if path == "b":
                raise ValueError("\udfff")

        return read

    got = {(row.pdf_path, row.page_no): (row.text, row.error) for row in extract_pages(files, reader).collect()}
    assert got == {("a", 1): ("x?y", None), ("a", 2): ("7", None), ("b", 1): ("x?y", None), ("b", 2): ("7", None),
                   ("b", None): (None, "?")}
    marked = mark_by_classifier(files.withColumn("ocr_text", F.lit("x")), lambda: lambda prompts: [True] * len(prompts))
    assert {row.is_relevant for row in marked.collect()} == {True}


def test_whole_files_on_default_settings(spark):
    files = spark.createDataFrame([("a", bytearray(b"x\fy"))], "path string, content binary")
    got = extract_pages(files, lambda: lambda path, content: content.decode().split("\f"), content="content").collect()
    assert [row.text for row in got] == ["x", "y"]


def test_functions_get_lists_and_failures_keep_their_reason(spark):
    seen = spark.sparkContext.accumulator(0)

    def factory():
        def run(values):
            seen.add(1)
            if len(values) > 1 and "poison" in values:
                raise MemoryError("list")
            return [ValueError("no") if value == "bad" else None if value == "none" else value * 2 for value in values]

        return run

    df = spark.createDataFrame([("a",), ("bad",), (None,), ("none",), ("b",)], "x string").coalesce(1)
    got = {row.x: tuple(row.y) for row in append_result(df, factory, "x", "y", batch_size=3).collect()}
    assert got == {"a": ("aa", None), "bad": (None, "no"), None: (None, None), "none": (None, None), "b": ("bb", None)}
    assert seen.value == 2
    nested = spark.createDataFrame([(["a", "poison", "bad"],), ([],), (None,)], "x array<string>").coalesce(1)
    rows = [row.y for row in append_result(nested, factory, "x", "y").collect()]
    assert [[tuple(y) for y in row] if row is not None else None for row in rows] == [
        [("aa", None), ("poisonpoison", None), (None, "no")], [], None,
    ]


def test_the_classifier_judges_every_piece(spark):
    df = spark.createDataFrame([("good " * 3_000 + "evil " * 1_500,), ("good " * 4_000 + "evil " * 500,), ("",), (None,)], "ocr_text string")

    def classifier():
        return lambda prompts: [f'{{"answer": {str("evil" not in prompt).lower()}}}' for prompt in prompts]

    marked = mark_by_classifier(df, classifier, piece_chars=500)
    assert [row.is_relevant for row in marked.collect()] == [False, True, False, False]


def test_collation(listing, pages):
    manifest = collate(listing, pages)
    assert sorted(map(tuple, manifest.collect())) == [
        ("/in/x/a.pdf", "a.pdf"), ("/in/y/a.pdf", "a_1.pdf"), ("/in/y/short.PDF", "short.PDF"),
    ]
    assert collate(listing, pages, max_files=1).collect() == [("/in/x/a.pdf", "a.pdf")]
    assert [row.subset_id for row in split(manifest, 2).orderBy("name").collect()] == [1, 1, 2]


def test_quality_then_extraction_then_final(pages):
    quality = mark_quality(pages)
    assert quality.columns == [*QUALITY_SCHEMA.names, "error"]
    assert {row.pdf_path: row.is_relevant for row in quality.collect()} == {"/in/x/a.pdf": True, "/in/y/a.pdf": False}
    extraction = extract(quality)
    assert extraction.columns == EXTRACTION_SCHEMA.names
    [row] = extraction.collect()
    assert row.page_count == 3
    assert row.extracted_meaningful_text == "Judul yang dan ini untuk dengan pada itu"
    final = finish(extraction, "/in/")
    assert final.columns == FINAL_SCHEMA.names
    assert final.first().regex_applied_text == row.extracted_meaningful_text
    curated = curate_documents(pages)
    assert curated.first().extracted_text == row.extracted_meaningful_text


def test_own_classifier(spark, pages):
    def classifier():
        def reply(prompts):
            assert all("<ocr_output>" in prompt for prompt in prompts)
            if any("Judul" in prompt for prompt in prompts):
                raise ConnectionError("down")
            return ['{"reasoning": "", "answer": true}' for _ in prompts]

        return reply

    quality = mark_quality(pages, lambda df: mark_by_classifier(df, classifier))
    assert {row.pdf_path: row.is_relevant for row in quality.collect()} == {"/in/x/a.pdf": False, "/in/y/a.pdf": True}


def test_failed_documents_are_not_sent_to_the_classifier(spark):
    df = spark.createDataFrame([("text", None), ("Error processing x", "e")], "ocr_text string, error string")
    marked = mark_by_classifier(df, lambda: lambda prompts: ['{"answer": true}'] * len(prompts))
    assert [row.is_relevant for row in marked.orderBy("error").collect()] == [True, False]
    assert relevant_only(marked).count() == 1


def test_a_filter_does_not_call_the_classifier_again(pages):
    quality = mark_quality(pages, lambda df: mark_by_classifier(df, lambda: lambda prompts: ['{"answer": true}'] * len(prompts)))
    kept = relevant_only(quality).filter(~F.startswith("pdf_path", F.lit("/none")))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert kept.count() == 2


def test_own_extractor(spark):
    def extractor():
        def run(path):
            return ValueError(path) if "bad" in path else f"## {path}\nisi\n"

        return lambda paths: [run(path) for path in paths]

    df = spark.createDataFrame([("/a.pdf", 3, True), ("/bad (1).pdf", 4, True), (None, 5, True), ("/c", 3, None)],
                               "pdf_path string, page_count int, is_relevant boolean")
    got = extract(df, lambda rows: extract_markdown(rows, extractor, partitions=2)).collect()
    assert {(row.pdf_path, row.md_extraction_result, row.extracted_meaningful_text) for row in got} == {
        ("/a.pdf", "## /a.pdf\nisi\n", "# /a.pdf isi"),
        ("/bad (1).pdf", "Error: Failed to process PDF /bad (1).pdf", "Error: Failed to process PDF /bad .pdf"),
        (None, "Error: PDF path is None", "Error: PDF path is None"),
    }


def test_subsets_are_processed_as_they_arrive(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("quality", "extraction", "checkpoint"))

    def arrive(subset_id):
        rows = spark.createDataFrame(
            [(f"/{subset_id}/{n}.pdf", 3, n % 2 == 0, f"**x** teks {n}") for n in range(4)], QUALITY_SCHEMA
        )
        write_stage(rows, f"{source}/subset_id={subset_id}")

    def run():
        query = process_arrivals(spark, f"{source}/*", QUALITY_SCHEMA, extract, sink, checkpoint)
        query.awaitTermination()
        return read_stage(spark, sink, EXTRACTION_SCHEMA)

    arrive(1)
    assert run().count() == 2
    arrive(2)
    done = run()
    assert done.count() == 4 and run().count() == 4
    assert {row.extracted_meaningful_text for row in done.collect()} == {"teks 0", "teks 2"}


def test_spread(spark):
    rows = spark.range(0, 100, 1, 2)
    assert spread(rows, 4).rdd.getNumPartitions() == 4 and spread(rows, None) is rows

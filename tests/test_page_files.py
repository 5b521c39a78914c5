"""Files of pages as a data source."""

import pytest
from pyspark.sql import functions as F

from papyrine.operators.hooks import extract_pages
from papyrine.sources.files import scan_files
from papyrine.sources.page_files import FORMAT, lines_as_pages, planned, register


def broken_pages(path, content):
    yield "first"
    if "bad" in path:
        raise ValueError("unreadable")


@pytest.fixture
def folder(spark, tmp_path):
    register(spark)
    (tmp_path / "sub").mkdir()
    for name, text in {"a.pdf": "one\ntwo\n", "sub/B.PDF": "three", "bad.pdf": "x", "n.html": "no", "big.pdf": "z" * 5_000, "é ä.pdf": "\n"}.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def load(spark, folder, **options):
    return spark.read.format(FORMAT).options(**options).load(folder)


def test_rows_equal_those_of_the_hook(spark, folder):
    got = load(spark, folder)
    assert got.columns == ["pdf_path", "page_no", "text", "error"]
    files = scan_files(spark, folder)
    hooked = extract_pages(files, lambda: lines_as_pages, content="content")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, hooked.collect())) and got.count() == 6
    assert load(spark, f"file://{folder}").count() == load(spark, f"file:{folder}").count() == 6
    assert load(spark, folder, extensions=".html").first().text == "no"
    assert load(spark, folder, extensions=".xyz").collect() == []


def test_a_large_file_has_a_partition_for_itself(spark, folder):
    pages = load(spark, folder, partitionBytes="1000").withColumn("part", F.spark_partition_id())
    parts = {row.pdf_path.rsplit("/", 1)[1]: row.part for row in pages.collect()}
    assert [name for name, part in parts.items() if part == parts["big.pdf"]] == ["big.pdf"]
    assert len(set(parts.values())) == 2
    assert planned([("a", 5), ("b", 50), ("c", 6), ("d", 0)], 10) == [["b"], ["c"], ["a", "d"]]
    assert planned([], 10) == []
    many = planned([(str(i), i % 7) for i in range(1_000)], 100)
    assert sorted(name for group in many for name in group) == sorted(str(i) for i in range(1_000)) and len(many) < 40


def test_filters_reach_the_planning(spark, folder):
    path = F.col("pdf_path")
    for test, names in ((path.endswith("a.pdf"), {"a.pdf"}), (path == f"{folder}/a.pdf", {"a.pdf"}), (path.startswith(f"{folder}/sub"), {"B.PDF"}), (path.isin(f"{folder}/a.pdf", f"{folder}/bad.pdf"), {"a.pdf", "bad.pdf"})):
        df = load(spark, folder, partitionBytes="1").filter(test)
        assert {row.pdf_path.rsplit("/", 1)[1] for row in df.collect()} == names
        assert df.rdd.getNumPartitions() == len(names)
    both = load(spark, folder).filter(path.endswith("a.pdf") & (F.col("page_no") == 2)).collect()
    assert [row.text for row in both] == ["two"]


def test_a_file_that_fails_is_a_row(spark, folder):
    got = load(spark, folder, reader="tests.test_page_files:broken_pages")
    rows = {(row.pdf_path.rsplit("/", 1)[1], row.page_no): (row.text, row.error) for row in got.collect()}
    assert rows["bad.pdf", None] == (None, "unreadable") and rows["bad.pdf", 1] == ("first", None) and rows["a.pdf", 1] == ("first", None)
    with pytest.raises(Exception, match="folder"):
        spark.read.format(FORMAT).load().collect()


def test_many_bytes_make_no_more_partitions_but_larger_ones():
    from papyrine.sources import page_files as P

    assert P.bytes_each(6 << 30, 1 << 16) == (6 << 30) // P.MOST_PARTITIONS
    assert P.bytes_each(1 << 20, 1 << 16) == 1 << 16 and P.bytes_each(1 << 50, 1 << 16) == P.PARTITION_BYTES
    files = [(str(i), 100_000) for i in range(60_000)]
    assert len(planned(files, P.bytes_each(6 * 10**9, 1 << 16))) < 1_100

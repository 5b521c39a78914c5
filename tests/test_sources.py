"""Listings and stage tables."""

import csv

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from papyrine.functions.paths import basename
from papyrine.sources.files import list_files, outer_roots, scan_files, walk_files
from papyrine.sources.tables import QUALITY_SCHEMA, materialize, read_csv, read_stage, shared_folder, write_csv, write_stage

ROWS = [
    ("file:/a", 3, True, 'line1\nline2, "q"'),
    ("file:/b", 4, False, "x"),
    ("file:/c", 5, None, "x\\"),
    ("file:/d", None, None, None),
    (' "" ', 1, True, " a\r\nb\rc, "),
]


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    (root / "sub").mkdir(parents=True)
    (root / "s p").mkdir()
    for name in ["a.pdf", "sub/B.PDF", "c d.pdf", "e%20f.pdf", "n.html"]:
        (root / name).write_bytes(b"data")
    (root / "empty.pdf").write_bytes(b"")
    return root


def names(df):
    return sorted(row[0] for row in df.select(basename(F.col("path"))).collect())


def test_listing_is_recursive_and_ignores_case(spark, tree):
    listing = list_files(spark, str(tree))
    assert listing.columns == ["path"]
    assert names(listing) == ["B.PDF", "a.pdf", "c d.pdf", "e%20f.pdf"]
    assert names(list_files(spark, str(tree), extensions=(".html", ".pdf"))) == sorted([*names(listing), "n.html"])


def test_flat_listing_and_several_roots(spark, tree):
    assert names(list_files(spark, str(tree), recursive=False)) == ["a.pdf", "c d.pdf", "e%20f.pdf"]
    assert names(list_files(spark, str(tree / "sub"), str(tree), recursive=False)) == [
        "B.PDF", "a.pdf", "c d.pdf", "e%20f.pdf",
    ]


def test_walk_finds_the_same_and_empty_files(spark, tree):
    walked = walk_files(spark, str(tree))
    assert names(walked) == ["B.PDF", "a.pdf", "c d.pdf", "e%20f.pdf", "empty.pdf"]
    assert {basename: size for basename, size in walked.select(F.substring_index("path", "/", -1), "length").collect()} == {
        "B.PDF": 4, "a.pdf": 4, "c d.pdf": 4, "e%20f.pdf": 4, "empty.pdf": 0,
    }
    (tree / "s p" / "deep%").mkdir()
    (tree / "s p" / "deep%" / "x y.Pdf").write_bytes(b"data")
    assert f"{tree}/s p/deep%/x y.Pdf" in {row.path for row in walk_files(spark, f"file://{tree}/").collect()}
    assert walk_files(spark, f"file://{tree}/sub", extensions=(".html",)).count() == 0
    both = walk_files(spark, str(tree / "sub"), str(tree / "s p"))
    assert names(both) == ["B.PDF", "x y.Pdf"]


def test_walk_lists_each_file_once(spark, tree):
    (tree / "sub" / "up").symlink_to(tree, target_is_directory=True)
    (tree / "link.pdf").symlink_to(tree / "a.pdf")
    want = ["B.PDF", "a.pdf", "c d.pdf", "e%20f.pdf", "empty.pdf", "link.pdf"]
    assert names(walk_files(spark, str(tree), f"file:{tree}/sub/", f"file://{tree}", str(tree / "sub"))) == want
    assert outer_roots(("/t/sub", "/t", "/tt", "file:///t/x", "s3://b/a/", "s3://b/a/c")) == ["/t", "/tt", "s3://b/a"]


def test_listings_spell_paths_alike(spark, tree):
    (tree / "empty.pdf").write_bytes(b"x")
    assert set(walk_files(spark, str(tree)).select("path").collect()) == set(list_files(spark, f"file://{tree}").collect())


def test_subset_of_an_undivided_table(spark, tmp_path):
    write_stage(spark.createDataFrame(ROWS, QUALITY_SCHEMA), str(tmp_path / "quality"))
    with pytest.raises(ValueError, match="not divided"):
        read_stage(spark, str(tmp_path / "quality"), QUALITY_SCHEMA, subset_id=1)


def test_walk_fails_without_the_root(spark, tmp_path):
    with pytest.raises(Exception, match="absent"):
        walk_files(spark, str(tmp_path / "absent"))


def test_listing_does_not_read_contents(spark, tree):
    plan = list_files(spark, str(tree))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert scan_files(spark, str(tree)).agg(F.sum(F.length("content"))).first()[0] == 16


def test_missing_folder_and_no_files(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        list_files(spark, str(tmp_path / "absent"))
    (tmp_path / "bare").mkdir()
    assert list_files(spark, str(tmp_path / "bare")).count() == 0


def test_csv_roundtrip(spark, tmp_path):
    rows = [*ROWS, ("", 2, False, "")]  # empty is not missing
    df = spark.createDataFrame(rows, QUALITY_SCHEMA)
    assert write_csv(df, str(tmp_path / "csv")).rows == len(rows)
    got = read_csv(spark, str(tmp_path / "csv"), QUALITY_SCHEMA)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_csv_of_other_writers(spark, tmp_path):
    with open(tmp_path / "quality.csv", "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(QUALITY_SCHEMA.names)
        writer.writerows(ROWS)
    got = read_csv(spark, str(tmp_path / "quality.csv"), QUALITY_SCHEMA, null_marker="")
    want = [(*row[:3], row[3] and row[3].replace("\r\n", "\n")) for row in ROWS]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_csv_files_stay_small(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("pdf_path")).coalesce(1)
    write_csv(df, str(tmp_path / "csv"), rows_per_file=3)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 4


def test_stage_table_counts_rows_and_prunes_subsets(spark, tmp_path):
    df = spark.createDataFrame([(*row, i % 2 + 1) for i, row in enumerate(ROWS)], [*QUALITY_SCHEMA.names, "subset_id"])
    path = str(tmp_path / "quality")
    assert write_stage(df, path, ["subset_id"]).rows == len(ROWS)
    assert write_stage(df, path, ["subset_id"]).rows == len(ROWS)  # overwrites
    assert read_stage(spark, path, QUALITY_SCHEMA).count() == len(ROWS)
    second = read_stage(spark, path, QUALITY_SCHEMA, subset_id=2)
    assert second.count() == 2
    assert "PartitionFilters: [isnotnull(subset_id" in second._jdf.queryExecution().executedPlan().toString()


def test_materialized_rows_are_fixed(spark):
    df = materialize(spark.range(100).withColumn("r", F.rand()), "random")
    assert sorted(df.collect()) == sorted(df.collect())
    assert df.inputFiles()[0].replace("file://", "").startswith(shared_folder(spark))


def test_several_subsets_are_one_scan_of_a_file_each(spark, tmp_path):
    rows = [(f"p{i}", 1, True, "text", i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "pdf_path string, page_count int, is_relevant boolean, ocr_text string, subset_id long").repartition(8)
    path = str(tmp_path / "divided")
    write_stage(df, path, ["subset_id"])
    assert [len(list((tmp_path / "divided").glob(f"subset_id={i}/*.parquet"))) for i in range(5)] == [1] * 5
    some = read_stage(spark, path, QUALITY_SCHEMA, [1, 3])
    assert sorted(row.pdf_path for row in some.collect()) == sorted(f"p{i}" for i in range(200) if i % 5 in (1, 3))
    assert {row.subset_id for row in some.collect()} == {1, 3}
    assert read_stage(spark, path, QUALITY_SCHEMA, []).collect() == []

"""Good rows, bad rows, counts and samples."""

from pyspark.sql import functions as F

from papyrine.operators import outcome
from papyrine.sources.tables import write_stage

BASE = "/mnt/scrape/"
ROWS = [
    ("/mnt/scrape/a.pdf", "text"),
    ("/mnt/scrape/b.pdf", "Error: Failed"),
    ("/mnt/scrape/c.pdf", None),
    ("/tmp/d.pdf", "text"),
    (None, "text"),
    (None, None),
    ("/mnt/scrape/e.pdf", "an Error"),
    ("/mnt/scrape/f.pdf", ""),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "pdf_path string, extracted_meaningful_text string")


def test_success_and_error_split_the_rows(spark):
    df = frame(spark)
    good, bad = outcome.success_rows(df, BASE), outcome.error_rows(df, BASE)
    assert sorted(map(tuple, good.collect())) == [ROWS[0], ROWS[6], ROWS[7]]
    assert good.count() + bad.count() == len(ROWS)
    assert good.intersectAll(bad).count() == 0
    assert outcome.residual_errors(good).count() == 0
    assert outcome.residual_errors(df).count() == 1


def test_profile_and_null_count(spark):
    df = frame(spark)
    assert list(map(tuple, outcome.column_profile(df).collect())) == [
        (0, "pdf_path", "string", 6, 8),
        (1, "extracted_meaningful_text", "string", 6, 8),
    ]
    assert outcome.null_count(df).first().null_rows == 2


def test_stage_counts_take_nulls_for_false(spark):
    df = frame(spark)
    stages = {"all": F.lit(True), "text": F.col("extracted_meaningful_text") == "text"}
    assert list(map(tuple, outcome.stage_counts(df, stages).collect())) == [(0, "all", 8), (1, "text", 3)]


def test_throughput(spark):
    totals = spark.createDataFrame([(14901.58, 7898), (0.0, 0), (2.01, 400)], "total_seconds double, total_rows long")
    rows = {row.total_rows: row for row in outcome.throughput_estimate(totals).collect()}
    assert (rows[7898].sec_per_row, rows[7898].sec_per_1000, rows[7898].min_per_10000) == ("1.89", "1886.75", "314.46")
    assert rows[0].sec_per_row is None
    assert rows[400].sec_per_row == f"{2.01 / 400:.2f}"


def test_writes_report_rows_and_time(spark, tmp_path):
    run = write_stage(spark.range(7), str(tmp_path / "table"))
    [row] = outcome.throughput_estimate(outcome.run_metrics(spark, {"extract": run})).collect()
    assert (row.stage, row.total_rows) == ("extract", 7) and run.seconds > 0
    assert row.sec_per_1000 == f"{run.seconds / 7 * 1000:.2f}"


def test_success_filter_reaches_the_scan(spark, tmp_path):
    write_stage(frame(spark), str(tmp_path / "table"))
    good = outcome.success_rows(spark.read.parquet(str(tmp_path / "table")), BASE)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(pdf_path,/mnt/scrape/)" in plan.split("PushedFilters")[1]


def test_samples_and_previews(spark):
    df = spark.range(1_000)
    first = outcome.sample_rows(df, 10, "id").collect()
    assert first == outcome.sample_rows(df.repartition(7), 10, "id").collect() and len(set(first)) == 10
    assert outcome.sample_rows(df, 10, "id", seed=1).count() == 10
    assert [row.id for row in outcome.preview_rows(df, 3, "id").collect()] == [0, 1, 2]
    assert outcome.row_at(df, 1, "id").first().id == 1

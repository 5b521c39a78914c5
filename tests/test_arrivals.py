"""Duplicates across arrivals, with restarts in between."""

from pyspark.sql import functions as F

from papyrine.operators.duplicates import drop_exact_duplicates
from papyrine.streaming.duplicates import drop_duplicates_across_arrivals


def arrive(spark, folder, rows, **more):
    df = spark.createDataFrame(rows, "id string, body string, more int").coalesce(2)
    df.write.mode("append").parquet(f"{folder}/in")
    query = drop_duplicates_across_arrivals(spark, f"{folder}/in", df.schema, f"{folder}/out", f"{folder}/checkpoint", "id", "body", **more)
    query.awaitTermination()
    return sorted((tuple(row) for row in spark.read.parquet(f"{folder}/out").collect()), key=repr)


def test_three_arrivals_equal_one_batch(spark, tmp_path):
    folder = str(tmp_path)
    first = [(f"a{i:03}", f"text {i % 40}", i) for i in range(100)] + [(None, "text 5", 1), (None, "nobody's", 2), ("a500", None, 3)]
    second = [(f"b{i:03}", f"text {i % 60}", i) for i in range(120)] + [("b500", None, 4), ("b501", "hot", 5)] + [(f"b{600 + i}", "hot", i) for i in range(300)]
    third = [(f"c{i:03}", f"text {i}", i) for i in range(30, 90)] + [("c500", "hot", 1), (None, "nobody's", 9)]
    arrive(spark, folder, first)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    arrive(spark, folder, second)
    got = arrive(spark, folder, third)
    whole = spark.createDataFrame(first + second + third, "id string, body string, more int")
    want = sorted((tuple(row) for row in drop_exact_duplicates(whole, "id", "body").collect()), key=repr)
    # a repeated text without any key has one row of its own choice
    assert [row for row in got if row[0]] == [row for row in want if row[0]] and len(got) == len(want)
    assert arrive(spark, folder, []) == got  # nothing new, started again from the checkpoint
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_rows_of_a_stream_go_in_pieces(spark, tmp_path):
    rows = [(f"k{i:05}", "same", i) for i in range(5_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = arrive(spark, str(tmp_path), rows[::-1])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [("k00000", "same", 0)]
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.count(F.lit(1))).first()[0] == 1

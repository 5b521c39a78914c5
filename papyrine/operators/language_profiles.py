"""The language of texts by profiles learned from a labelled table.

A profile holds how often each run of 1 to `LONGEST` characters occurs in words of a language, with the word's two ends as
characters. A text is in the language under which its runs are likeliest (multinomial, with `ALPHA` added to each count).
The likelihood of a word depends on nothing else, so runs are counted over different words, in training as in scoring, and
texts are only ever joined with their words. Nothing runs in Python, and what grows is joined: only a bounded number of the
most frequent words goes to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators import scoring
from papyrine.operators.scoring import WORD, sums_by_key
from papyrine.sources.tables import materialize

LONGEST = 3
ALPHA = 0.5
LEAST_ROWS = 3  # labels with fewer texts are taken for errors


def _words(df: DataFrame, text: str, *columns: str) -> DataFrame:
    return df.select(*columns, F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("word"))


def runs_of(word: Column, longest: int = LONGEST) -> Column:
    """All runs of 1 to `longest` characters of a word with a space at either end, but for lone spaces."""
    marked = F.concat(F.lit(" "), word, F.lit(" "))

    def of(size: int) -> Column:
        last = F.char_length(marked) - size + 1
        return F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda first: F.substring(marked, first, F.lit(size)))

    runs = F.concat(*(of(size) for size in range(1, longest + 1)))
    return F.filter(runs, lambda run: run != " ")


@dataclass
class Profiles:
    """`runs`: run, logs (one for each of `labels`); `unseen[size]`: the same for runs that no text had."""

    labels: list[str]
    runs: DataFrame
    unseen: dict[int, list[float]]
    longest: int


def train(df: DataFrame, label: str = "lang", text: str = "text", longest: int = LONGEST, alpha: float = ALPHA, least_rows: int = LEAST_ROWS) -> Profiles:
    """Profiles of all labels with at least `least_rows` texts; rows without label or text tell nothing.

    The driver sees the labels and, for each, how many runs there are of each length.
    """
    rows = df.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_rows)
    labels = sorted(row["label"] for row in counted.collect())
    words = _words(rows.filter(F.col("label").isin(labels)), "text", "label").groupBy("label", "word").agg(F.count(F.lit(1)).alias("n"))
    runs = words.select("label", "n", F.explode(runs_of(F.col("word"), longest)).alias("run"))
    each = [F.sum(F.when(F.col("label") == name, F.col("n")).otherwise(0)).alias(f"n{i}") for i, name in enumerate(labels)]
    if not labels:
        empty = runs.select("run", F.array().cast("array<double>").alias("logs")).filter("false")
        return Profiles([], empty, {}, longest)
    table = materialize(runs.groupBy("run").agg(*each), "runs")
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(labels))]
    totals = {row["size"]: row for row in table.groupBy(F.char_length("run").alias("size")).agg(F.count(F.lit(1)).alias("kinds"), *sums).collect()}

    def share(count: Column, size: int, place: int) -> Column:
        row = totals[size]
        return F.ln((count + alpha) / F.lit(row[f"n{place}"] + alpha * (row["kinds"] + 1)))

    logs = F.lit(None).cast("array<double>")
    for size in totals:
        own = F.array(*(share(F.col(f"n{i}"), size, i) for i in range(len(labels))))
        logs = F.when(F.char_length("run") == size, own).otherwise(logs)
    none = df.sparkSession.range(1)
    unseen = {size: list(none.select(F.array(*(share(F.lit(0), size, i) for i in range(len(labels))))).first()[0]) for size in totals}
    return Profiles(labels, table.select("run", logs.alias("logs")), unseen, longest)


def word_likelihoods(words: DataFrame, profiles: Profiles) -> DataFrame:
    """word, runs (how many), and l0, l1, ...: the log likelihood of each different word under each label."""
    runs = words.select("word").distinct().select("word", F.explode(runs_of(F.col("word"), profiles.longest)).alias("run"))
    found = runs.join(profiles.runs, "run", "left")
    unseen = F.lit(None).cast("array<double>")
    for size, logs in profiles.unseen.items():
        unseen = F.when(F.char_length("run") == size, F.array(*(F.lit(x) for x in logs))).otherwise(unseen)
    sums = [F.sum(F.coalesce(F.col("logs")[i], unseen[i])).alias(f"l{i}") for i in range(len(profiles.labels))]
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("runs"), *sums)


def predict_language(df: DataFrame, profiles: Profiles, key: str = "pdf_path", text: str = "ocr_text") -> DataFrame:
    """`key`, `language` and `margin` for each key of `df`, over all its text.

    The margin is by how much a run is likelier, in logarithms and on average, than under the next language; null if there is
    but one. Both are null for texts without a letter, and of equally likely languages the first in order is taken. Rows that
    share a key are one text.
    """
    keys = df.select(F.col(key).alias("_key")).distinct()
    if not profiles.labels:
        return keys.select(F.col("_key").alias(key), F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("margin"))
    words = _words(df, text, key).withColumnRenamed(key, "_key")
    counts = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("_n")), "vocabulary")
    likely = materialize(word_likelihoods(counts, profiles).join(counts, "word"), "words")
    common = likely.orderBy(F.desc("_n"), "word").limit(scoring.COMMON)
    summed = ["runs", *(f"l{i}" for i in range(len(profiles.labels)))]
    counted = sums_by_key(words, likely, common, dict.fromkeys(summed))
    scored = counted.groupBy("_key").agg(*(F.sum(name).alias(name) for name in summed)).withColumnRenamed("_key", "_scored")
    ranked = F.sort_array(F.array(*(F.struct(F.col(f"l{i}").alias("log"), F.lit(-i).alias("place")) for i in range(len(profiles.labels)))), asc=False)
    names = F.array(*(F.lit(name) for name in profiles.labels))
    both = keys.join(scored.withColumn("_best", ranked), keys["_key"].eqNullSafe(scored["_scored"]), "left")
    margin = (F.col("_best")[0]["log"] - F.try_element_at("_best", F.lit(2))["log"]) / F.col("runs")
    language = F.when(F.col("runs").isNotNull(), F.element_at(names, 1 - F.col("_best")[0]["place"]))
    return both.select(F.col("_key").alias(key), language.alias("language"), margin.alias("margin"))

"""How much a document's words are like those of the collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.sources.tables import materialize

# Fixed value: words are runs of letters, in lower case.
WORD = r"\p{L}+"
COMMON = 100_000  # words that go to all tasks with what is known of them; the others are joined


def unigram_model(df: DataFrame, text: str = "ocr_text", vocabulary: int | None = None) -> DataFrame:
    """All words with their log probability, and one row without a word for those that do not occur.

    With a `vocabulary`, so many of the most frequent words are listed (ties: in their order), and the others share what is
    left, each by an equal part. Words are counted once; the collection is not read again.
    """
    words = df.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("word"))
    counts = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    listed = counts if vocabulary is None else counts.orderBy(F.desc("n"), "word").limit(vocabulary)
    total, kinds = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not total:
        return listed.select("word", F.lit(None).cast("double").alias("log_p"))
    each = listed.select("word", F.ln(F.col("n") / total).alias("log_p"))
    share = (total - F.sum("n") + 1) / (total * (kinds - F.count(F.lit(1)) + 1))
    rest = listed.agg(share.alias("share")).select(F.lit(None).cast("string").alias("word"), F.ln("share").alias("log_p"))
    return each.unionByName(rest)


def quality_score(df: DataFrame, model: DataFrame, key: str = "pdf_path", text: str = "ocr_text") -> DataFrame:
    """key and `score`, the mean log probability of a document's words under `unigram_model`; null without a word.

    The likeliest `COMMON` words of the model are known to every task, so a document's sum over them is one row before anything
    moves. A model of all words grows with the collection: the document's other words are counted and joined with it.
    """
    words = F.explode_outer(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
    known = model.filter("word IS NOT NULL")
    rest = model.filter("word IS NULL").agg(F.max("log_p")).scalar()
    rows = df.select(F.col(key).alias("_key"), words.alias("word"))
    counted = sums_by_key(rows, known, known.orderBy(F.desc("log_p"), "word").limit(COMMON), {"log_p": rest})
    return counted.groupBy(F.col("_key").alias(key)).agg(F.try_divide(F.sum("log_p"), F.sum("n")).alias("score"))


def sums_by_key(rows: DataFrame, known: DataFrame, common: DataFrame, otherwise: dict[str, Column | None]) -> DataFrame:
    """For rows (_key, word): _key, n, and the sum of each column of `otherwise` over the words, which `known` (word, the columns)
    has, or `otherwise` where it has not. A key may have several rows, one for its `common` words and others for the rest.

    `common` is a part of `known` that fits into every task. Only words that are not in it are shuffled as words.
    """
    names = list(otherwise)
    joined = rows.join(F.broadcast(common.select("word", *names, F.lit(True).alias("_found"))), "word", "left")
    counted = joined.groupBy("_key", F.when(F.col("_found").isNull(), F.col("word")).alias("_rare"))
    counted = materialize(counted.agg(F.count("word").alias("n"), *(F.sum(name).alias(name) for name in names)), "counted")
    found = counted.filter("_rare IS NULL").select("_key", "n", *names)
    rare = counted.filter("_rare IS NOT NULL").select("_key", F.col("_rare").alias("word"), "n")
    rest = [F.col(name) if other is None else F.coalesce(F.col(name), other) for name, other in otherwise.items()]
    joined = rare.join(known.select("word", *names), "word", "left")
    return found.unionByName(joined.select("_key", "n", *((F.col("n") * one).alias(name) for name, one in zip(names, rest, strict=True))))

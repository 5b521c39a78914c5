"""The corpus pipeline: language, repeated lines, near-duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame; all but the last return
the columns of documents. `run` writes each stage's rows to the shared folder and reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm import decontaminate, language_id, line_dedup, packing, simhash
from papyrine.llm.scratch import write_and_read

LEAST_LANGUAGE_SCORE = 0.3  # below it no language stands out


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in some language: one is predicted, and with more than a guess.

    Rows without a letter go (null and empty texts among them); other rows keep all their columns, repeated rows too.
    """
    found = language_id.identify(docs, language_id.train(docs))
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(known).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least five of them share; n_chars, if there is one, follows the text.

    Rows with null or repeated ids and repeated rows are rows like others; a null text becomes an empty one.
    """
    kept = line_dedup.drop_repeated_lines(docs).select(docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: SimHash of three-word shingles, linked at three differing bits or fewer.

    The row of the smallest doc_id stays; rows without one go after those with one, ties are broken by a hash of the text, and of
    equal rows one stays.
    """
    return simhash.keep_one_of_each(docs, width=3, distance=3)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give away no item of `benchmark`; null and empty texts give away nothing, of equal rows all stay or go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens; a null or empty text is its end token alone."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("decontaminate", decontaminate_benchmark),
    ("packing", pack),
]

ORACLE_SQL = None  # the machines of the first stage and the tokenizer of the last are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), name)
    return docs

"""The registered queries of this package, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm import decontaminate, fuzzy_hash, hard_negatives, html_text, language_id, line_dedup, packing, sharding, simhash, suffix_dedup
from papyrine.llm import token_files, toxicity, whitening
from papyrine.sources.tables import new_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeated(documents(spark, sf_dir), length=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    examples = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, examples).withColumn("held_out", language_id.held_out(F.col("doc_id")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(documents(spark, sf_dir), tokenizer, keep_ids=False)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_overlaps(documents(spark, sf_dir), items)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language_id.identify(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), width=3, distance=3)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    token_files.write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(spark, folder)


def op10_fuzzy_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_hash.compare_with_edit(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))  # null where it exceeds a long


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_LINE_KEY = f"""translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{line_dedup.UPPER}', '{line_dedup.LOWER}')"""

LINE_DEDUP_SQL = f"""
WITH lines AS (
  SELECT doc_id, line, {_LINE_KEY} AS k, place
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), common AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT l.*, coalesce(l.doc_id <> c.keeper, false) AS gone FROM lines l LEFT JOIN common c ON l.k = c.k)
GROUP BY doc_id
"""

# Scores of floats that hold whole numbers are exact below 2^53.
HARD_NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(CAST(c AS DOUBLE) * 256) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT n.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id, positive_score,
  score AS negative_score
FROM pairs n JOIN positives p ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
WINDOW best AS (PARTITION BY n.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 10
"""

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_language_id": op5_language_id,
    "op6_simhash": op6_simhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_text": op8_html_text,
    "op9_token_files": op9_token_files,
    "op10_fuzzy_hash": op10_fuzzy_hash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_sharding": op13_sharding,
    "pipeline": pipeline,
}
ORACLES = {"op7_line_dedup": LINE_DEDUP_SQL, "op11_hard_negatives": HARD_NEGATIVES_SQL}

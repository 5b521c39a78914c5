"""Scores of texts under models of the collection, and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators.language_model import BEGIN, END, ORDER, perplexity, train
from papyrine.operators.percentiles import FRACTIONS, percentiles
from papyrine.operators.scoring import WORD, quality_score, unigram_model
from papyrine.workload.pages import PAGE_COUNTS, document_page_count
from papyrine.workload.inputs import table

HELD_OUT = "doc_id % 5 = 0"  # rows that the n-gram model has not seen


def score_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_score(documents, unigram_model(documents, "text"), "doc_id", "text")
    return scored.select("doc_id", F.round("score", 6).alias("score"))


def score_perplexity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents.filter(f"NOT ({HELD_OUT})"), "text", ORDER)
    scored = perplexity(documents, model, "doc_id", "text")
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "words", F.round(F.ln("perplexity"), 6).alias("log_perplexity"))


def page_count_percentiles(spark, sf_dir):
    """Of page counts, of text lengths, and of a measure with fractions."""
    documents = table(spark, sf_dir, "documents").select("n_chars", F.expr(_DENSITY).alias("density"))
    pages = percentiles(document_page_count(spark, sf_dir), "page_count").withColumn("discrete", F.col("discrete").cast("double"))
    characters = percentiles(documents, "n_chars").withColumn("discrete", F.col("discrete").cast("double"))
    parts = {"pages": pages, "characters": characters, "density": percentiles(documents, "density")}
    united = [part.withColumn("measure", F.lit(name)) for name, part in parts.items()]
    return united[0].union(united[1]).union(united[2]).withColumn("continuous", F.round("continuous", 6))


_DENSITY = "sqrt(n_chars) / (doc_id + 1)"

QUERIES = {"quality_score": score_quality, "perplexity": score_perplexity, "page_count_percentiles": page_count_percentiles}

_WORDS = rf"(SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents)"


def _kneser_ney(length: int, source: str) -> str:
    """CTEs k{length}, with counts of `source`, and g{length}, with each context's total and what it hands on."""
    words = [f"w{i}" for i in range(ORDER - length + 1, ORDER + 1)]
    context = ", ".join(words[:-1])
    by = f"GROUP BY {context}" if context else ""
    listed = f"{context}, " if context else ""
    return f"""c{length} AS (SELECT {", ".join(words)}, count(*) AS n FROM {source} GROUP BY {", ".join(words)}),
      y{length} AS (SELECT *, n1 / (n1 + 2 * n2) AS y FROM (SELECT count(*) FILTER (n = 1) AS n1, count(*) FILTER (n = 2) AS n2,
        count(*) FILTER (n = 3) AS n3, count(*) FILTER (n = 4) AS n4 FROM c{length})),
      d{length} AS (SELECT 1 - 2 * y * n2 / n1 AS d1, 2 - 3 * y * n3 / n2 AS d2, 3 - 4 * y * n4 / n3 AS d3 FROM y{length}),
      k{length} AS (SELECT c.*, CASE WHEN (d1 > 0 AND d1 < 1 AND d2 > 0 AND d2 < 2 AND d3 > 0 AND d3 < 3) IS NOT TRUE THEN least(n, 3) * 0.5::DOUBLE
        WHEN n = 1 THEN d1 WHEN n = 2 THEN d2 ELSE d3 END AS lost FROM c{length} c, d{length}),
      g{length} AS (SELECT {listed}sum(n) AS total, sum(lost) / sum(n) AS handed FROM k{length} {by})"""


_PERPLEXITY = rf"""WITH marked AS (SELECT doc_id, [{", ".join([f"'{BEGIN}'"] * (ORDER - 1))}] || regexp_extract_all(lower(text), '{WORD}') || ['{END}'] AS w FROM documents),
  runs AS (SELECT doc_id, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT doc_id, w, unnest(range(1, len(w) - {ORDER - 2})) AS i FROM marked)),
  {_kneser_ney(3, f"(SELECT * FROM runs WHERE NOT ({HELD_OUT}))")}, {_kneser_ney(2, "c3")}, {_kneser_ney(1, "c2")},
  rest AS (SELECT total, handed / ((SELECT count(*) FROM c1) + 1) AS even FROM g1),
  p1 AS (SELECT w3, (n - lost) / total + even AS p FROM k1, rest),
  p2 AS (SELECT k.w2, k.w3, (n - lost) / total + handed * p AS p FROM k2 k JOIN g2 USING (w2) JOIN p1 USING (w3)),
  p3 AS (SELECT k.w1, k.w2, k.w3, (n - lost) / total + handed * p AS p FROM k3 k JOIN g3 USING (w1, w2) JOIN p2 USING (w2, w3))
SELECT doc_id, {HELD_OUT} AS held_out, CAST(count(*) AS BIGINT) AS words, round(-avg(ln(coalesce(p3.p, coalesce(g3.handed, 1) * coalesce(p2.p, coalesce(g2.handed, 1)
  * coalesce(p1.p, (SELECT even FROM rest)))))), 6) AS log_perplexity
FROM runs LEFT JOIN p3 USING (w1, w2, w3) LEFT JOIN p2 USING (w2, w3) LEFT JOIN p1 USING (w3) LEFT JOIN g3 USING (w1, w2) LEFT JOIN g2 USING (w2)
GROUP BY doc_id"""

ORACLES = {
    "quality_score": f"""WITH counts AS (SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word), total AS (SELECT sum(n) AS words FROM counts),
        scored AS (SELECT doc_id, avg(ln(n / words)) AS score FROM {_WORDS} w JOIN counts c ON c.word = w.word, total GROUP BY doc_id)
        SELECT d.doc_id, round(score, 6) AS score FROM documents d LEFT JOIN scored s ON s.doc_id = d.doc_id""",
    "perplexity": _PERPLEXITY,
    "page_count_percentiles": " UNION ALL ".join(
        f"""SELECT '{measure}' AS measure, {fraction}::DOUBLE AS fraction, quantile_disc({value}, {fraction})::DOUBLE AS discrete,
        round(quantile_cont({value}::DOUBLE, {fraction}), 6) AS continuous FROM {source}"""
        for measure, value, source in (("pages", "page_count", f"({PAGE_COUNTS})"), ("characters", "n_chars", "documents"), ("density", _DENSITY, "documents"))
        for fraction in FRACTIONS
    ),
}

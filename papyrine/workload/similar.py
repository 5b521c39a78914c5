"""Repeated and nearly repeated documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators.duplicates import drop_exact_duplicates
from papyrine.operators.near_duplicates import LEAST, WIDTH, WORD, near_duplicates
from papyrine.sources.tables import new_folder
from papyrine.streaming.duplicates import drop_duplicates_across_arrivals
from papyrine.workload.inputs import rows_of, table

# Two documents share a key, some have none, some have no text, and a seventh of the rows is there twice.
_KEYED = """SELECT doc_id, CASE WHEN doc_id % 29 = 0 THEN CAST(NULL AS BIGINT) ELSE doc_id - doc_id % 2 END AS id,
  CASE WHEN doc_id % 31 = 0 THEN CAST(NULL AS STRING) ELSE text END AS text
FROM documents"""


def dedup_exact(spark, sf_dir):
    rows = rows_of(spark, sf_dir, _KEYED)
    rows = rows.union(rows.filter("doc_id % 7 = 0")).select("id", "text")
    return drop_exact_duplicates(rows, "id", "text").select("id", F.md5("text").alias("digest"))


def find_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def dedup_arrivals(spark, sf_dir):
    """The documents arrive in three parts, each of which is a run of its own."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    source, sink, checkpoint = (new_folder(spark, name) for name in ("arriving", "unique", "progress"))
    last = documents.agg(F.max("doc_id")).first()[0] or 0
    for part in range(3):
        documents.filter(F.floor(F.col("doc_id") * 3 / (last + 1)) == part).write.mode("append").parquet(source)
        drop_duplicates_across_arrivals(spark, source, documents.schema, sink, checkpoint, "doc_id", "text").awaitTermination()
    return spark.read.schema(documents.schema).parquet(sink).select("doc_id", F.md5("text").alias("digest"))


QUERIES = {"dedup_exact": dedup_exact, "dedup_arrivals": dedup_arrivals, "near_duplicates": find_near_duplicates}

# All pairs of documents that share a shingle, and all that can be reached from each.
_COMPONENTS = rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM documents),
  sets AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {WIDTH - 1}], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WIDTH - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.shingle = b.shingle GROUP BY a.doc_id, b.doc_id),
  links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE s.n >= {LEAST} * (x.n + y.n - s.n)),
  reached AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(min(other), d.doc_id) AS component FROM documents d LEFT JOIN reached r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""

_TWICE = f"(SELECT id, text FROM ({_KEYED}) UNION ALL SELECT id, text FROM ({_KEYED}) WHERE doc_id % 7 = 0)"
ORACLES = {
    "dedup_exact": f"""SELECT min(id) AS id, md5(text) AS digest FROM {_TWICE} WHERE text IS NOT NULL GROUP BY text
        UNION ALL SELECT id, NULL FROM {_TWICE} WHERE text IS NULL""",
    "dedup_arrivals": """SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents WHERE text IS NOT NULL GROUP BY text
        UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL""",
    "near_duplicates": _COMPONENTS,
}

"""Inputs of the registered queries.

The tables hold no markdown, page errors or file paths to speak of, so these are added to every row. An added piece is one
SQL expression that Spark and the oracle both evaluate; rows are never left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

NEWLINE = "chr(10)"
ID = "CAST(doc_id AS STRING)"


def lines(*parts: str) -> str:
    """SQL for the parts, each followed by a newline."""
    return " || ".join(f"{part} || {NEWLINE}" for part in parts)


# Text with every kind of markdown the cleaner handles, in front and behind.
MARKED_TEXT = f"""(
  CASE doc_id % 4
    WHEN 0 THEN {lines("'---'", f"'id: ' || {ID}", "'---'", "'# Judul'")}
    WHEN 1 THEN {lines(f"'# Judul ' || {ID}")}
    WHEN 2 THEN {lines("'## Abstrak'")}
    ELSE '' END
  || text || {NEWLINE} ||
  {lines(
      "'### Bagian'", f"'#### Metode ' || {ID}", "'##'", "''", "'Hasil'", "'## Hasil'",
      f"'lihat [' || {ID} || '] dan (Tabel ' || {ID} || ') ![](a.png)'", "'**tebal** lalu **putus'", "'baris**'",
      f"'harga $5 dan $$x_' || {ID} || '$$'", f"'Gambar ' || {ID} || '. Keterangan'",
      "'| a | b |'", "'|---|:-:|'", f"'| ' || {ID} || ' | 2 |'", "'z | w'",
      "'Keywords: satu,'", "'dua'", "''", "'Penutup Keywords: ekor'")}
)"""

# Texts with lines that are in no listed language: another script, formulas, and words that tell nothing.
MIXED_TEXT = f"""SELECT doc_id, text || CASE doc_id % 5
  WHEN 0 THEN {NEWLINE} || repeat('Этот текст написан на другом языке и другим письмом. ', CAST(doc_id % 40 AS INT))
  WHEN 1 THEN {NEWLINE} || repeat('x | y | z' || {NEWLINE}, CAST(doc_id % 60 AS INT))
  WHEN 2 THEN {NEWLINE} || repeat('lorem ipsum dolor sit amet ', CAST(doc_id % 50 AS INT))
  ELSE '' END AS text
FROM documents"""

# Extraction results: some paths are missing or below another folder, some texts are missing or errors.
EXTRACTION = f"""SELECT doc_id,
  CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '/tmp/' || {ID} || '.pdf'
       ELSE '/mnt/scrape/' || {ID} || ' (1).pdf' END AS pdf_path,
  doc_id % 40 AS page_count,
  text AS md_extraction_result,
  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'Error: Failed to process PDF ' || {ID}
       ELSE text END AS extracted_meaningful_text
FROM documents"""

# Page rows; some documents have blank pages, some nothing else.
SPARSE_PAGES = f"""SELECT conv_id, turn,
  CASE WHEN turn % 3 = 0 OR conv_id % 5 = 0 THEN ' ' || {NEWLINE} ELSE text END AS text
FROM conversations"""

# Page rows under file paths; the first page of some documents could not be read.
FILE_PAGES = """SELECT 'file:/scrape/doc_' || CAST(conv_id AS STRING) || '.pdf' AS pdf_path, turn AS page_no, text,
  CASE WHEN conv_id % 19 = 0 AND turn = 0 THEN 'bad page' ELSE CAST(NULL AS STRING) END AS error
FROM conversations"""

# File paths with few different names. A third of the files bear one name, and some are numbered by themselves.
_NUMBER = "CAST(CAST(regexp_extract(url, '/([0-9]+)', 1) AS INT) % 40 AS STRING)"
FILE_PATHS = f"""SELECT page_id, html,
  '/scrape/site_' || CAST(page_id AS STRING) || '/' ||
  CASE WHEN page_id % 3 = 0 THEN 'unduh.pdf'
       WHEN page_id % 11 = 0 THEN 'unduh_' || {_NUMBER} || '.pdf'
       WHEN page_id % 5 = 0 THEN 'artikel.' || {_NUMBER} || '_1.pdf'
       WHEN page_id % 7 = 0 THEN 'artikel.' || {_NUMBER} || '_1_1.pdf'
       WHEN page_id % 4 = 0 THEN 'berkas_' || {_NUMBER}
       ELSE 'artikel.' || {_NUMBER} || CASE WHEN page_id % 2 = 0 THEN '.PDF' ELSE '.pdf' END END AS path
FROM pages"""

# Classifier replies of every kind: proper ones with the label as the answer, wrong types, broken and missing ones.
_ANSWER = "CASE WHEN quality = 1 THEN 'true' ELSE 'false' END"
REPLIES = f"""SELECT doc_id, CASE doc_id % 20
  WHEN 0 THEN '{{"answer":"true"}}'
  WHEN 1 THEN '{{"answer":1}}'
  WHEN 2 THEN '{{"answer":null}}'
  WHEN 3 THEN '{{}}'
  WHEN 4 THEN '[true]'
  WHEN 5 THEN 'true'
  WHEN 6 THEN CAST(NULL AS STRING)
  WHEN 7 THEN 'not json but True'
  WHEN 8 THEN 'nope'
  WHEN 9 THEN '{{"answer":false}} trailing'
  WHEN 10 THEN '{{"answer":false, "reasoning":"it is true"'
  WHEN 11 THEN '<output>{{"answer":' || {_ANSWER} || '}}</output>'
  WHEN 12 THEN ''
  WHEN 13 THEN '{{"answer":false}} {{"answer":true}}'
  WHEN 14 THEN '{{"answer":false}},{{"answer":false}}'
  WHEN 15 THEN '{{"answer":true,"answer":' || {_ANSWER} || '}}'
  WHEN 16 THEN '{{"answer":false}}] it is true'
  ELSE '{{"reasoning":"label","answer":' || {_ANSWER} || '}}' END AS reply
FROM labels"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Evaluate one of the SELECTs above: its last word is the table it reads."""
    columns, _, name = sql.rpartition("\nFROM ")
    escaped = columns.replace("{", "{{").replace("}", "}}")
    return spark.sql(f"{escaped}\nFROM {{source}}", source=table(spark, sf_dir, name))

"""Paths, names, subsets, listings and CSV."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.functions.paths import has_extension, normalize_path, rebase_path, subset_folder
from papyrine.operators import naming, subsets
from papyrine.sources.files import scan_files, walk_files
from papyrine.sources.tables import new_folder, read_csv, write_csv
from papyrine.workload.inputs import FILE_PATHS, ID, NEWLINE, Query, rows_of, table

SUBSET_SIZE = 100
CAP = 40


def filter_by_extension(spark, sf_dir):
    return rows_of(spark, sf_dir, FILE_PATHS).filter(has_extension(F.col("path"), ".pdf")).select("page_id", "path")


def source_file_count(spark, sf_dir):
    return subsets.subset_count(filter_by_extension(spark, sf_dir), SUBSET_SIZE)


_ESCAPED_PATHS = """SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'file:' WHEN 1 THEN 'file:/x%20y+z' ELSE '' END || url ||
  CASE page_id % 4 WHEN 0 THEN '%C3%A9.pdf' WHEN 1 THEN '100%.pdf' WHEN 2 THEN '%zz%41.pdf' ELSE '.pdf' END AS path
FROM pages"""


def normalize_paths(spark, sf_dir):
    path = F.col("path")
    return rows_of(spark, sf_dir, _ESCAPED_PATHS).select(
        "page_id", normalize_path(path).alias("decoded"), normalize_path(path, always_decode=False).alias("local")
    )


_NULLABLE_PATHS = """SELECT page_id, CASE WHEN page_id % 9 = 0 THEN CAST(NULL AS STRING) ELSE 'file:' || url END AS path
FROM pages"""


def rebase_paths(spark, sf_dir):
    rebased = rebase_path(F.col("path"), "file:https?://(www\\.)?", "/mnt/scrape/")
    return rows_of(spark, sf_dir, _NULLABLE_PATHS).select("page_id", rebased.alias("pdf_path"))


_PATHLESS = "page_id % 13 = 0"


def collision_safe_names(spark, sf_dir):
    path = F.when(~F.expr(_PATHLESS), F.col("path")).alias("path")
    return naming.collision_safe_names(rows_of(spark, sf_dir, FILE_PATHS).select(path))


def candidate_cap(spark, sf_dir):
    return naming.cap_candidates(rows_of(spark, sf_dir, FILE_PATHS).select("path"), CAP)


def _with_subsets(spark, sf_dir):
    listing = table(spark, sf_dir, "pages").select("page_id", "url")
    return subsets.assign_subsets(listing, SUBSET_SIZE, ["url", "page_id"])


def assign_subsets(spark, sf_dir):
    assigned = _with_subsets(spark, sf_dir)
    return assigned.select("page_id", "subset_id", subset_folder(F.col("subset_id")).alias("folder"))


def subset_manifest(spark, sf_dir):
    return subsets.subset_manifest(_with_subsets(spark, sf_dir), "url")


def _written_pages(spark, sf_dir):
    """Write every page's html below its subset's folder; returns the root of the tree."""
    root = new_folder(spark, "listed")
    assigned = subsets.assign_subsets(table(spark, sf_dir, "pages"), SUBSET_SIZE, ["url", "page_id"])
    assigned.select("html", "subset_id").write.partitionBy("subset_id").text(root)
    return root


def _bytes_per_folder(files):
    folder = F.regexp_extract("path", "/subset_id=([0-9]+)/[^/]*$", 1).cast("long")
    return files.groupBy(folder.alias("subset_id")).agg(F.sum("length").alias("bytes"))


def list_files(spark, sf_dir):
    return _bytes_per_folder(scan_files(spark, _written_pages(spark, sf_dir), extensions=(".TXT",)))


def list_tree(spark, sf_dir):
    return _bytes_per_folder(walk_files(spark, _written_pages(spark, sf_dir), extensions=(".TXT",)))


CSV_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("is_relevant", T.BooleanType()),
        T.StructField("ocr_text", T.StringType()),
    ]
)
_CSV_ROWS = f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_relevant,
  CASE WHEN doc_id % 10 = 0 THEN CAST(NULL AS STRING) ELSE ' "' || text || {NEWLINE} || '"", ' || {ID} || '\\' END AS ocr_text
FROM documents"""


def csv_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "csv")
    # The literal ends in one backslash; Spark's SQL needs it doubled.
    write_csv(rows_of(spark, sf_dir, _CSV_ROWS.replace("\\", "\\\\")), folder)
    return read_csv(spark, folder, CSV_SCHEMA)


QUERIES: dict[str, Query] = {
    "filter_by_extension": filter_by_extension,
    "source_file_count": source_file_count,
    "normalize_path": normalize_paths,
    "rebase_path": rebase_paths,
    "collision_safe_names": collision_safe_names,
    "candidate_cap": candidate_cap,
    "assign_subsets": assign_subsets,
    "subset_manifest": subset_manifest,
    "list_files": list_files,
    "walk_files": list_tree,
    "csv_roundtrip": csv_roundtrip,
}


def oracle_names(source: str) -> str:
    """SELECT path, name: collision-safe names of the paths in `source`, numbers found by trying them all."""
    return rf"""WITH based AS (SELECT path, regexp_extract(path, '[^/]*$') AS base FROM ({source})),
      split AS (SELECT path, base, regexp_extract(base, '^(.+?)(\.[^.]*)?$', 1) AS stem,
        regexp_extract(base, '^(.+?)(\.[^.]*)?$', 2) AS ext,
        row_number() OVER (PARTITION BY base ORDER BY path) - 1 AS copy FROM based),
      most AS (SELECT base, any_value(stem) AS stem, any_value(ext) AS ext, max(copy) AS copies FROM split GROUP BY base),
      tried AS (SELECT base, stem || '_' || n || ext AS name, n
        FROM (SELECT *, unnest(generate_series(1, copies + (SELECT count(*) FROM most))) AS n FROM most WHERE copies > 0)),
      free AS (SELECT base, name, row_number() OVER (PARTITION BY base ORDER BY n) AS copy
        FROM tried WHERE name NOT IN (SELECT base FROM most))
      SELECT path, base AS name FROM split WHERE copy = 0
      UNION ALL SELECT s.path, f.name FROM split s JOIN free f ON f.base = s.base AND f.copy = s.copy"""


_SUBSETS = f"""SELECT *, (row_number() OVER (ORDER BY url, page_id) - 1) // {SUBSET_SIZE} + 1 AS subset_id FROM pages"""
_UNESCAPED = """CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '/x y+z' ELSE '' END || url ||
    CASE page_id % 4 WHEN 0 THEN 'é.pdf' WHEN 1 THEN '100%.pdf' WHEN 2 THEN '%zzA.pdf' ELSE '.pdf' END"""

# Each page is one line of a text file.
_BYTES = f"""SELECT subset_id, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM ({_SUBSETS}) GROUP BY subset_id"""

ORACLES = {
    "filter_by_extension": f"SELECT page_id, path FROM ({FILE_PATHS}) WHERE regexp_matches(path, '(?i)\\.pdf$')",
    "source_file_count": f"""SELECT count(*) AS total_files, CAST(ceil(count(*) / {SUBSET_SIZE}) AS BIGINT) AS num_subsets
        FROM ({FILE_PATHS}) WHERE path ILIKE '%.pdf'""",
    "normalize_path": f"""SELECT page_id, {_UNESCAPED} AS decoded,
        CASE WHEN page_id % 5 < 2 THEN {_UNESCAPED} ELSE path END AS local FROM (
          SELECT *, ({_ESCAPED_PATHS.partition("page_id, ")[2].partition(" AS path")[0]}) AS path FROM pages)""",
    "rebase_path": f"""SELECT page_id, regexp_replace(path, 'file:https?://(www\\.)?', '/mnt/scrape/', 'g') AS pdf_path
        FROM ({_NULLABLE_PATHS})""",
    "collision_safe_names": f"""{oracle_names(f"SELECT path FROM ({FILE_PATHS}) WHERE NOT {_PATHLESS}")}
        UNION ALL SELECT NULL, NULL FROM pages WHERE {_PATHLESS}""",
    "candidate_cap": f"SELECT path FROM ({FILE_PATHS}) ORDER BY path LIMIT {CAP}",
    "assign_subsets": f"SELECT page_id, subset_id, 'subset_' || subset_id AS folder FROM ({_SUBSETS})",
    "subset_manifest": f"""SELECT subset_id, 'subset_' || subset_id AS folder, count(*) AS files, min(url) AS first_path,
        max(url) AS last_path FROM ({_SUBSETS}) GROUP BY subset_id""",
    "list_files": _BYTES,
    "walk_files": _BYTES,
    "csv_roundtrip": _CSV_ROWS,
}

"""The hooks, with small stand-ins for what users plug in."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators.hooks import extract_markdown, extract_pages
from papyrine.operators.relevance import mark_by_classifier
from papyrine.operators.replies_store import ask_once
from papyrine.sources.tables import new_folder
from papyrine.workload.inputs import ID, rows_of, table

CLASSIFIED_CHARS = 700

_FILES = f"""SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN CAST(NULL AS STRING) ELSE '/scrape/' || {ID} || '.pdf' END AS path,
  text
FROM documents"""


def pages_hook(spark, sf_dir):
    def line_reader():
        """Takes every line for a page and refuses short documents."""

        def read(path, text):
            if len(text) < 300:
                raise ValueError("too short")
            return text.split("\n")

        return read

    pages = extract_pages(rows_of(spark, sf_dir, _FILES), line_reader, content="text")
    return pages.withColumn("page_no", F.coalesce("page_no", F.lit(0)))


def classifier_hook(spark, sf_dir):
    def word_classifier():
        """Replies to a list of prompts as a model would, from single words; breaks down over some lists."""

        def reply(prompt):
            if " con " in prompt:
                return ValueError("no reply")
            return f'{{"reasoning":"word","answer":{str(" the " in prompt).lower()}}}'

        def replies(prompts):
            if len(prompts) > 1 and any(" von " in prompt for prompt in prompts):
                raise ValueError("out of memory")
            return [reply(prompt) for prompt in prompts]

        return replies

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_by_classifier(documents, word_classifier, "English", "text", CLASSIFIED_CHARS, 0.5, template="{text} {language}")
    return marked.select("doc_id", "is_relevant")


def markdown_hook(spark, sf_dir):
    def title_extractor():
        """Makes a heading of the path and fails for some."""

        def extract(path):
            if path.endswith("7.pdf"):
                return None
            return ValueError("unreadable") if path.endswith("3.pdf") else f"# {path}\n"

        return lambda paths: [extract(path) for path in paths]

    files = rows_of(spark, sf_dir, _FILES).withColumnRenamed("path", "pdf_path")
    extracted = extract_markdown(files.select("doc_id", "pdf_path"), title_extractor)
    return extracted.select("doc_id", "pdf_path", "md_extraction_result", "error")


def stored_replies_hook(spark, sf_dir):
    """Two runs over one store: the second asks only about what failed in the first."""

    def first():
        return lambda prompts: [ValueError("no reply") if " con " in prompt else str(" the " in prompt).lower() for prompt in prompts]

    def second():
        return lambda prompts: ["second"] * len(prompts)

    store = new_folder(spark, "replies")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ask_once(documents, first, store, "text", wait=0.0)
    return ask_once(documents, second, store, "text", wait=0.0).select("doc_id", "reply", "error")


QUERIES = {"extract_pages_hook": pages_hook, "classify_hook": classifier_hook, "extract_markdown_hook": markdown_hook, "stored_replies": stored_replies_hook}

ORACLES = {
    "stored_replies": """SELECT doc_id, CASE WHEN contains(text, ' con ') THEN 'second' WHEN contains(text, ' the ') THEN 'true' ELSE 'false' END AS reply,
        CAST(NULL AS VARCHAR) AS error FROM documents""",
    "extract_pages_hook": f"""WITH files AS ({_FILES}),
        split AS (SELECT path, string_split(text, chr(10)) AS parts FROM files
          WHERE path IS NOT NULL AND length(text) >= 300)
        SELECT path AS pdf_path, CAST(n AS INTEGER) AS page_no, parts[n] AS text, CAST(NULL AS VARCHAR) AS error
        FROM (SELECT path, parts, unnest(generate_series(1, len(parts))) AS n FROM split)
        UNION ALL SELECT path, 0, NULL, CASE WHEN path IS NULL THEN 'Error: PDF path is None' ELSE 'too short' END
        FROM files WHERE path IS NULL OR length(text) < 300""",
    "classify_hook": f"""SELECT doc_id, CASE WHEN length(any_value(text)) = 0 THEN false
          ELSE sum(CASE WHEN contains(asked, ' the ') AND NOT contains(asked, ' con ') THEN length(piece) ELSE 0 END)
            >= 0.5 * sum(length(piece)) END AS is_relevant
        FROM (SELECT doc_id, text, substr(text, 1 + i * {CLASSIFIED_CHARS}, {CLASSIFIED_CHARS}) || ' English' AS asked,
            substr(text, 1 + i * {CLASSIFIED_CHARS}, {CLASSIFIED_CHARS}) AS piece
          FROM (SELECT *, unnest(range(greatest((length(text) + {CLASSIFIED_CHARS} - 1) // {CLASSIFIED_CHARS}, 1))) AS i FROM documents))
        GROUP BY doc_id""",
    "extract_markdown_hook": f"""SELECT doc_id, path AS pdf_path, CASE WHEN path IS NULL THEN 'Error: PDF path is None'
          WHEN path LIKE '%3.pdf' THEN 'Error: Failed to process PDF ' || path
          WHEN path NOT LIKE '%7.pdf' THEN '# ' || path || chr(10) END AS md_extraction_result,
          CASE WHEN path IS NULL THEN 'Error: PDF path is None' WHEN path LIKE '%3.pdf' THEN 'unreadable' END AS error
        FROM ({_FILES})""",
}

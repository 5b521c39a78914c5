"""Language, prompts and replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.functions.language import FUNCTION_WORDS, WINDOW, detect_language, is_mainly_in, language_share
from papyrine.functions.sections import BORDER, LONGEST, is_mainly_in_sections, language_sections, longest_foreign, target_share
from papyrine.functions.replies import PROMPT_TEMPLATE, build_prompt, extract_tagged, parse_reply
from papyrine.operators import language_profiles
from papyrine.operators.relevance import relevant_only
from papyrine.operators.scoring import WORD
from papyrine.workload.inputs import MIXED_TEXT, REPLIES, rows_of, table

TARGET = "en"  # the tables have no Indonesian


def language_relevance(spark, sf_dir):
    scored = rows_of(spark, sf_dir, MIXED_TEXT).select("doc_id", language_share(F.col("text"), TARGET).alias("share"))
    return scored.withColumn("is_relevant", F.coalesce(F.col("share") >= 0.8, F.lit(False)))


def keep_relevant(spark, sf_dir):
    documents = rows_of(spark, sf_dir, MIXED_TEXT)
    return relevant_only(documents.withColumn("is_relevant", is_mainly_in(F.col("text"), TARGET))).select("doc_id")


def detect_languages(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", detect_language(F.col("text")).alias("language"))


def find_sections(spark, sf_dir):
    documents = rows_of(spark, sf_dir, MIXED_TEXT)
    found = documents.select("doc_id", F.explode(language_sections(F.col("text"), TARGET)).alias("section"))
    return found.select("doc_id", "section.*")


def judge_sections(spark, sf_dir):
    documents = rows_of(spark, sf_dir, MIXED_TEXT).select("doc_id", F.array(language_sections(F.col("text"), TARGET)).alias("held"))
    judged = F.transform("held", lambda s: F.struct(target_share(s).alias("share"), longest_foreign(s).alias("foreign"), is_mainly_in_sections(s).alias("is_relevant")))
    return documents.select("doc_id", judged[0].alias("judged")).select("doc_id", "judged.*")


SEEN = "doc_id % 5 <> 0"  # rows whose labels are learned


def predict_languages(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    profiles = language_profiles.train(documents.filter(SEEN))
    predicted = language_profiles.predict_language(documents, profiles, "doc_id", "text")
    return predicted.select("doc_id", "language", F.round("margin", 6).alias("margin"))


def make_prompts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", build_prompt(F.col("text"), "English").alias("prompt"))


def parse_classifier_reply(spark, sf_dir):
    return rows_of(spark, sf_dir, REPLIES).select("doc_id", parse_reply(F.col("reply")).alias("is_relevant"))


_TAGGED = """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text
  WHEN 1 THEN 'x <output>' || chr(10) || text || ' </output> y <output>z</output>'
  ELSE '<output>' || text END AS reply
FROM documents"""


def extract_tagged_output(spark, sf_dir):
    return rows_of(spark, sf_dir, _TAGGED).select("doc_id", extract_tagged(F.col("reply")).alias("output"))


QUERIES = {
    "language_relevance": language_relevance,
    "relevant_only": keep_relevant,
    "detect_language": detect_languages,
    "language_sections": find_sections,
    "section_verdict": judge_sections,
    "predict_language": predict_languages,
    "build_prompt": make_prompts,
    "parse_classifier_reply": parse_classifier_reply,
    "extract_tagged_output": extract_tagged_output,
}


def _hits(language: str, words: str) -> str:
    listed = ", ".join(f"'{word}'" for word in FUNCTION_WORDS[language])
    return f"len(list_filter({words}, lambda word: word IN ({listed})))"


def oracle_shares(source: str, key: str = "doc_id") -> str:
    """SELECT key, share: the share of letters of `text` in `source` that stand in windows of the target language."""
    others = ", ".join(_hits(name, "part") for name in FUNCTION_WORDS if name != TARGET)
    return rf"""SELECT {key},
      sum(CASE WHEN mine > other THEN letters ELSE 0 END) / nullif(sum(letters), 0) AS share
      FROM (SELECT {key}, len(array_to_string(part, '')) AS letters, {_hits(TARGET, "part")} AS mine, greatest({others}) AS other
        FROM (SELECT {key}, list_slice(words, i * {WINDOW} + 1, CASE WHEN i = last THEN len(words) ELSE (i + 1) * {WINDOW} END) AS part
          FROM (SELECT *, unnest(range(last + 1)) AS i
            FROM (SELECT {key}, words, greatest(len(words) // {WINDOW}, 1) - 1 AS last
              FROM (SELECT {key}, regexp_extract_all(lower(text), '\p{{L}}+') AS words FROM {source})))))
      GROUP BY {key}"""


# The best division as a recursion over windows: letters that fit less those that don't, for either kind of the last section.
# A border is a number: twice its window, and one more where a section of the target language begins.
_SECTIONS = rf"""WITH RECURSIVE windows AS (
      SELECT doc_id, i, CAST(len(array_to_string(part, '')) AS BIGINT) AS letters, {_hits(TARGET, "part")} > greatest({", ".join(_hits(name, "part") for name in FUNCTION_WORDS if name != TARGET)}) AS fits
      FROM (SELECT doc_id, i, list_slice(words, i * {WINDOW} + 1, CASE WHEN i = last THEN len(words) ELSE (i + 1) * {WINDOW} END) AS part
        FROM (SELECT *, unnest(range(last + 1)) AS i FROM (SELECT doc_id, words, greatest(len(words) // {WINDOW}, 1) - 1 AS last
          FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS words FROM ({MIXED_TEXT})) WHERE len(words) > 0)))),
    best AS (SELECT doc_id, 0::BIGINT AS done, 0::BIGINT AS a, 0::BIGINT AS b, [1::BIGINT] AS pa, [0::BIGINT] AS pb FROM windows WHERE i = 0
      UNION ALL SELECT w.doc_id, done + 1, greatest(a, b - {BORDER}) + CASE WHEN fits THEN letters ELSE -letters END,
        greatest(b, a - {BORDER}) - CASE WHEN fits THEN letters ELSE -letters END,
        CASE WHEN b - {BORDER} > a THEN list_append(pb, 2 * done + 1) ELSE pa END, CASE WHEN a - {BORDER} > b THEN list_append(pa, 2 * done) ELSE pb END
      FROM best JOIN windows w ON w.doc_id = best.doc_id AND w.i = best.done),
    path AS (SELECT doc_id, done AS n, CASE WHEN a >= b THEN pa ELSE pb END AS p FROM best QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY done DESC) = 1),
    cut AS (SELECT doc_id, code % 2 = 1 AS target, code // 2 AS first, coalesce(lead(code) OVER (PARTITION BY doc_id ORDER BY code) // 2, n) AS last
      FROM (SELECT doc_id, n, unnest(p) AS code FROM path)),
    sections AS (SELECT c.doc_id, target, CAST(first AS INTEGER) AS first_window, CAST(last - first AS INTEGER) AS windows, CAST(sum(letters) AS BIGINT) AS letters,
      CAST(coalesce(sum(letters) FILTER (fits), 0) AS BIGINT) AS target_letters FROM cut c JOIN windows w ON w.doc_id = c.doc_id AND i >= first AND i < last
      GROUP BY c.doc_id, target, first, last)"""

_RUNS = " UNION ALL ".join(
    f"SELECT *, substr(' ' || word || ' ', unnest(range(1, len(word) + 4 - {size})), {size}) AS run FROM ({{source}})" for size in range(1, language_profiles.LONGEST + 1)
)
_LANGUAGES = rf"""WITH words AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents),
    labels AS (SELECT lang FROM documents WHERE {SEEN} AND lang IS NOT NULL GROUP BY lang HAVING count(*) >= {language_profiles.LEAST_ROWS}),
    seen AS (SELECT lang, word, count(*) AS n FROM words JOIN labels USING (lang) WHERE {SEEN} GROUP BY lang, word),
    kinds AS (SELECT run, lang, sum(n) AS n FROM ({_RUNS.format(source="SELECT * FROM seen")}) WHERE run <> ' ' GROUP BY run, lang),
    totals AS (SELECT len(run) AS size, count(DISTINCT run) AS kinds FROM kinds GROUP BY len(run)),
    sums AS (SELECT len(run) AS size, lang, sum(n) AS n FROM kinds GROUP BY len(run), lang),
    shares AS (SELECT lang, size, s.n + {language_profiles.ALPHA}::DOUBLE * (kinds + 1) AS below FROM sums s JOIN totals USING (size)),
    asked AS (SELECT word, run FROM ({_RUNS.format(source="SELECT DISTINCT word FROM words")}) WHERE run <> ' '),
    likely AS (SELECT word, s.lang, count(*) AS runs, sum(ln((coalesce(k.n, 0) + {language_profiles.ALPHA}::DOUBLE) / below)) AS log
      FROM asked a JOIN shares s ON s.size = len(a.run) LEFT JOIN kinds k ON k.run = a.run AND k.lang = s.lang GROUP BY word, s.lang),
    scored AS (SELECT doc_id, l.lang, sum(n * log) AS log, sum(n * runs) AS runs FROM (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word) w
      JOIN likely l ON l.word = w.word GROUP BY doc_id, l.lang),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY log DESC, lang) AS place FROM scored)
    SELECT d.doc_id, r.lang AS language, round((r.log - o.log) / r.runs, 6) AS margin FROM documents d
    LEFT JOIN ranked r ON r.doc_id = d.doc_id AND r.place = 1 LEFT JOIN ranked o ON o.doc_id = d.doc_id AND o.place = 2"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BEFORE, _AFTER = PROMPT_TEMPLATE.replace("{language}", "English").split("{text}")

ORACLES = {
    "language_relevance": f"""SELECT doc_id, share, coalesce(share >= 0.8, false) AS is_relevant
        FROM ({oracle_shares(f"({MIXED_TEXT})")})""",
    "relevant_only": f"SELECT doc_id FROM ({oracle_shares(f'({MIXED_TEXT})')}) WHERE share >= 0.8",
    "detect_language": rf"""SELECT doc_id, CASE WHEN most = 0 THEN NULL
        {" ".join(f"WHEN {name}_words = most THEN '{name}'" for name in FUNCTION_WORDS)} END AS language
        FROM (SELECT *, greatest({", ".join(f"{name}_words" for name in FUNCTION_WORDS)}) AS most
          FROM (SELECT doc_id, {", ".join(f"{_hits(name, 'words')} AS {name}_words" for name in FUNCTION_WORDS)}
            FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+') AS words FROM documents)))""",
    "language_sections": f"{_SECTIONS} SELECT * FROM sections",
    "section_verdict": f"""{_SECTIONS}, summed AS (SELECT doc_id, coalesce(sum(letters) FILTER (target), 0) / sum(letters) AS share,
        coalesce(max(letters) FILTER (NOT target), 0) AS foreign_letters FROM sections GROUP BY doc_id)
        SELECT d.doc_id, share, foreign_letters AS "foreign", coalesce(share >= 0.8 AND foreign_letters <= {LONGEST}, false) AS is_relevant
        FROM documents d LEFT JOIN summed s ON s.doc_id = d.doc_id""",
    "predict_language": _LANGUAGES,
    "build_prompt": f"""SELECT doc_id, {_quoted(_BEFORE)} || text || {_quoted(_AFTER)} AS prompt
        FROM documents""",
    "parse_classifier_reply": f"""SELECT doc_id, CASE
        WHEN reply IS NULL THEN false
        WHEN NOT json_valid(reply) THEN contains(lower(reply), 'true')
        WHEN json_type(reply) <> 'OBJECT' THEN false
        WHEN json_type(reply, '$.answer') IS NULL THEN false
        WHEN json_type(reply, '$.answer') = 'BOOLEAN' THEN json_extract_string(reply, '$.answer') = 'true'
        END AS is_relevant FROM ({REPLIES})""",
    "extract_tagged_output": rf"""SELECT doc_id, CASE WHEN regexp_matches(reply, '(?s)<output>.*?</output>')
        THEN regexp_replace(regexp_extract(reply, '(?s)<output>(.*?)</output>', 1), '^\s+|\s+$', '', 'g')
        ELSE reply END AS output FROM ({_TAGGED})""",
}

"""Cleaning rules, each by itself and all together."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.functions.cleaning import Rule, apply_rule, clean_text, rules
from papyrine.workload.inputs import MARKED_TEXT, Query, table

# The rules in the oracle's dialect, in order: name -> (pattern, replacement, flags).
ORACLE_RULES = {
    "front_matter": (r"(?s)^---.*?---", "''", ""),
    "title": (r"^#\s*(.*?)\n", r"'\1' || chr(10)", ""),
    "h4": (r"(?m)^####\s*(.*?)\n", r"'\1' || chr(10)", "g"),
    "h2": (r"(?m)^##\s*(.*?)\n", r"'\1' || chr(10)", "g"),
    "bold": (r"\*\*.*?\*\*", "''", "g"),
    "math": (r"\$.*?\$", "''", "g"),
    "brackets": (r"\[.*?\]", "''", "g"),
    "parens": (r"\(.*?\)", "''", "g"),
    "captions": (r"Gambar \d+\..*", "''", "g"),
    "tables": (r"\|[^\n]*\|(\n\|[-:| ]+\|)?(\n\|[^\n]*\|)*", "''", "g"),
    "keywords": (r"(?s)Keywords:.*?\n\n", "chr(10) || chr(10)", "g"),
    "whitespace": (r"\s+", "' '", "g"),
}


def oracle_rule(name: str, text: str) -> str:
    pattern, replacement, flags = ORACLE_RULES[name]
    return f"regexp_replace({text}, '{pattern}', {replacement}, '{flags}')"


def oracle_clean(text: str) -> str:
    for name in ORACLE_RULES:
        text = oracle_rule(name, text)
    return f"trim({text})"


def _marked(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(MARKED_TEXT).alias("text"))


def _rule_query(rule: Rule) -> Query:
    def query(spark, sf_dir):
        return _marked(spark, sf_dir).select("doc_id", apply_rule(F.col("text"), rule).alias("cleaned"))

    return query


def clean_document_text(spark, sf_dir):
    return _marked(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("cleaned"))


QUERIES = {f"clean_{rule.name}": _rule_query(rule) for rule in rules()} | {"clean_document_text": clean_document_text}

ORACLES = {
    f"clean_{name}": f"SELECT doc_id, {oracle_rule(name, MARKED_TEXT)} AS cleaned FROM documents" for name in ORACLE_RULES
} | {"clean_document_text": f"SELECT doc_id, {oracle_clean(MARKED_TEXT)} AS cleaned FROM documents"}

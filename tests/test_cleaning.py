"""The cleaner against worked examples and against the same rules in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from papyrine.functions.cleaning import apply_rule, clean_text, rules

GOLDEN = [
    ("---\na: b\n---\n# Judul\nisi", "# Judul isi"),
    ("# T\nx\n# U\n", "T x # U"),
    ("## Abstrak\nx\n### H3\ny\n#### H4\nz\n", "# Abstrak x # H3 y H4 z"),
    ("##\n\nA\n", "# A"),
    ("**b** c **d\ne**", "c **d e**"),
    ("$x$ y $$z$$ $5", "y z $5"),
    ("a [1] b (c (d) e) ![](i.png)", "a b e) !"),
    ("Gambar 1. cap\nnext Gambar 2.a", "next"),
    ("t\n|a|b|\n|--|:-:|\n|1|2|\nz | w", "t z | w"),
    ("|a|\n|-|foo|\n|2|", "foo|"),
    ("Keywords: a,\nb\n\nIntro Keywords: tail", "Intro Keywords: tail"),
    ("Keywords: x\n\nKeywords: y\n\nz", "z"),
    (" \t a\n\n\nb \n", "a b"),
    ("a\u00a0\u2003b\x1cc\u0085d\x0be\u2028f", "a b c d e f"),
    ("**a\rb** **c\u0085d**", ""),
    ("", ""),
    ("Error: Failed to process PDF /x (1).pdf", "Error: Failed to process PDF /x .pdf"),
    ("a (b\nc) d", "a (b c) d"),
    ("Gambar ٣. arab", ""),
    ("# only", "# only"),
    ("-----", "-----"),
    ("a\r\n## H\r\nb\r\n", "a H b"),
    ("x\u2028## H\ny", "x ## H y"),
]

# The rules as Python patterns, in order, to compare with.
PYTHON_RULES = {
    "front_matter": (r"(?s)^---.*?---", ""),
    "title": (r"^#\s*(.*?)\n", "\\1\n"),
    "h4": (r"(?m)^####\s*(.*?)\n", "\\1\n"),
    "h2": (r"(?m)^##\s*(.*?)\n", "\\1\n"),
    "bold": (r"\*\*.*?\*\*", ""),
    "math": (r"\$.*?\$", ""),
    "brackets": (r"\[.*?\]", ""),
    "parens": (r"\(.*?\)", ""),
    "captions": (r"Gambar \d+\..*", ""),
    "tables": (r"\|[^\n]*\|(\n\|[-:| ]+\|)?(\n\|[^\n]*\|)*", ""),
    "keywords": (r"(?s)Keywords:.*?(?=\n\n)", ""),
    "whitespace": (r"\s+", " "),
}


def in_python(text):
    for pattern, replacement in PYTHON_RULES.values():
        text = re.sub(pattern, replacement, text)
    return text.strip()


def random_markdown(seed):
    pick = random.Random(seed)
    pieces = [
        "#", "##", "####", "---", "\n", "\n\n", " ", "\t", "**", "$", "[", "]", "(", ")", "|", "|-|", "| a |", "Gambar 1.",
        "Gambar ٣.", "Keywords:", "kata", "é", "\u00a0", "\u2028", "\x1d", "\u0085", "\r\n", "\x0b", ":", "x y", "😀",
    ]
    return "".join(pick.choice(pieces) for _ in range(pick.randint(0, 60)))


@pytest.fixture(scope="module")
def texts():
    return [text for text, _ in GOLDEN] + [random_markdown(seed) for seed in range(3_000)]


def as_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(8)


def test_golden_cases(spark):
    df = as_frame(spark, [text for text, _ in GOLDEN])
    got = dict(df.select("id", clean_text(F.col("text"))).collect())
    assert [got[i] for i in range(len(GOLDEN))] == [want for _, want in GOLDEN]


def test_chain_equals_python(spark, texts):
    df = as_frame(spark, texts).withColumn("got", clean_text(F.col("text")))
    for row in df.collect():
        assert row.got == in_python(row.text), repr(row.text)


@pytest.mark.parametrize("rule", rules(), ids=lambda rule: rule.name)
def test_rule_equals_python(spark, texts, rule):
    df = as_frame(spark, texts).withColumn("got", F.regexp_replace("text", rule.pattern, rule.replacement))
    pattern, replacement = PYTHON_RULES[rule.name]
    for row in df.collect():
        want = re.sub(pattern, replacement, row.text)
        assert row.got == want, repr(row.text)
        if want != row.text:
            assert rule.needs in row.text


def test_long_table_does_not_overflow_the_stack(spark):
    df = as_frame(spark, ["| a | b |\n" * 40_000])
    assert df.select(clean_text(F.col("text"))).first()[0] == ""


def test_null_stays_null(spark):
    df = as_frame(spark, [None, "a"]).withColumn("cleaned", clean_text(F.col("text")))
    assert {row.id: row.cleaned for row in df.collect()} == {0: None, 1: "a"}


def test_filters_on_cleaned_text_keep_plans_small(spark):
    df = as_frame(spark, ["Error (1)", "b"])
    for _ in range(3):
        df = df.withColumn("text", clean_text(F.col("text"))).filter(~F.startswith("text", F.lit("Error")))
    assert [row.text for row in df.collect()] == ["b"]
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 100_000


def test_caption_word_is_a_parameter(spark):
    df = as_frame(spark, ["Figure 1. x\nGambar 2. y"])
    assert df.select(clean_text(F.col("text"), "Figure")).first()[0] == "Gambar 2. y"


WORST = {
    "brackets": "[" * 1_000_000, "parens": "(" * 1_000_000, "keywords": "Keywords:\n" * 100_000, "bold": "**a" * 333_333,
    "h2": "##" + " " * 1_000_000, "h4": "####" + "\t" * 1_000_000, "title": "#" + " " * 1_000_000, "math": "$a" * 500_000,
    "tables": "|a" * 500_000, "captions": "Gambar 1" * 125_000, "whitespace": " " * 1_000_000, "front_matter": "-" * 1_000_000,
}


@pytest.mark.parametrize("rule", rules(), ids=lambda rule: rule.name)
def test_worst_cases_take_linear_time(spark, rule):
    import time

    df = spark.createDataFrame([(WORST[rule.name],)], "text string")
    start = time.perf_counter()
    df.select(F.sum(F.length(apply_rule(F.col("text"), rule)))).collect()
    df.select(F.sum(F.length(clean_text(F.col("text"))))).collect()
    assert time.perf_counter() - start < 6

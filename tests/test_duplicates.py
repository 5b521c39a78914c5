"""Exact duplicates, scores and page texts."""

import html
import html.entities
import math
import random

from pyspark.sql import functions as F

from papyrine.functions.html import decode_references, html_main_text
from papyrine.operators.duplicates import drop_exact_duplicates
from papyrine.operators.scoring import quality_score, unigram_model


def test_one_row_of_each_text_stays(many_partitions):
    rows = [(i, "same" if i % 2 else f"own {i}", i % 7) for i in range(1_000)] + [(-1, "", 0), (-2, "", 1), (-3, None, 2), (-4, None, 3)]
    df = many_partitions.createDataFrame(rows, "id int, body string, more int").repartition(5)
    kept = drop_exact_duplicates(df, "id", "body")
    assert kept.columns == df.columns
    want = {i for i, _, _ in rows if i >= 0 and i % 2 == 0} | {1, -2, -3, -4}
    assert {row.id for row in kept.collect()} == want
    assert drop_exact_duplicates(df.filter("false"), "id", "body").count() == 0


def test_rows_without_or_with_repeated_keys(many_partitions):
    rows = [(None, "x", 1), (None, "x", 2), ("a", "y", 3), ("b", "y", 4), ("b", "z", 5), ("b", "z", 5), ("c", "z", 6), (None, "z", 7)]
    rows += [("h", "hot", n) for n in range(500)] + [(None, None, 8), (None, None, 8)]
    df = many_partitions.createDataFrame(rows, "id string, body string, more int").repartition(5)
    got = drop_exact_duplicates(df, "id", "body")
    assert got.columns == df.columns
    kept = sorted(((row.id, row.body) for row in got.collect()), key=repr)
    assert kept == sorted([(None, "x"), ("a", "y"), ("b", "z"), ("h", "hot"), (None, None), (None, None)], key=repr)


def test_a_hot_text_is_in_no_single_task(many_partitions):
    df = many_partitions.range(20_000).select("id", F.lit("the same").alias("body"))
    kept = drop_exact_duplicates(df, "id", "body")
    assert [tuple(row) for row in kept.collect()] == [(0, "the same")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan


def test_scores_follow_word_frequencies(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "A c"), (3, "zz"), (4, "?"), (5, None)], "id int, body string")
    model = unigram_model(df, "body", 2)
    listed = {row.word: row.log_p for row in model.collect()}
    assert set(listed) == {"a", "b", None}
    assert math.isclose(listed["a"], math.log(3 / 6)) and math.isclose(listed[None], math.log(3 / (6 * 3)))
    got = {row.id: row.score for row in quality_score(df, model, "id", "body").collect()}
    assert math.isclose(got[1], (2 * math.log(3 / 6) + math.log(1 / 6)) / 3)
    assert math.isclose(got[3], listed[None]) and got[4] is None and got[5] is None


def test_text_of_pages(spark):
    pages = {
        "<head><title>t</title></head><NAV>menu</Nav ><p>one&amp;lt; two</p><!-- <p>no --><script>if (a</script>b": "one&lt; two b",
        "<header>h</header><headers>kept</headers> <style>": "kept",
        "a < b &nbsp; <p": "a < b", "": "", None: None,
        # without an end
        "<p>x</p><script>var a = 1; write('<p>')": "x", "<head><title>T</title><body><p>text</p>": "text", "<head><title>T<body>u": "u",
        "<div><nav>menu<div>x</div></div><p>after</p>": "after", "<aside>1<aside>2</aside>3</aside>4": "4", "x</nav>y": "x y", "<form>f": "",
        # signs that are no tags, and tags with signs
        "if a<b then": "if a<b then", "a<b c<i>e": "a<b c e", "1 <2 and 3> 2": "1 <2 and 3> 2", "x<2<<y>": "x<2<", '<p title="a>b">q</p>': "q",
        "<!doctype html>d<?php x ?>e</>f": "d e f", "t<br/>u<div/>v": "t u v",
        # references
        "caf&eacute; it&#8217;s &mdash; &#x2014; &#150;": "café it’s — — –", "&bogus; &amp &copy2024 &notit; &amp;amp;": "&bogus; & ©2024 ¬it; &amp;",
        "&#0; &#xD800; &#99999999; &#; & &#x1F600;&ThickSpace;": "\ufffd \ufffd \ufffd &#; & 😀",
    }
    df = spark.createDataFrame([(page,) for page in pages], "html string")
    got = {row.html: row.text for row in df.select("html", html_main_text(F.col("html")).alias("text")).collect()}
    assert got == pages


def test_broken_pages_take_linear_time(spark):
    import time

    start = time.perf_counter()
    df = spark.createDataFrame([("<script>" * 100_000,), ("<!--" * 200_000,), ("<" * 1_000_000,), ("<p " * 200_000,)], "html string")
    assert df.select(F.length(html_main_text(F.col("html")))).count() == 4
    df.agg(F.sum(F.length(html_main_text(F.col("html"))))).collect()
    assert time.perf_counter() - start < 15


def test_scores_tell_all_words_apart_by_default(spark):
    rare = spark.range(50_010).select((F.col("id") + 10).alias("id"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij").alias("body"))
    common = spark.createDataFrame([(1, "often " * 100), (2, "seldom " * 2)], "id long, body string")
    df = rare.union(common)
    model = unigram_model(df, "body")
    assert model.count() == 50_013
    got = {row.id: row.score for row in quality_score(df, model, "id", "body").collect()}
    total = 50_010 + 102
    want = {1: 100 / total, 2: 2 / total, 10: 1 / total, 50_019: 1 / total}
    assert all(abs(got[i] - math.log(p)) < 1e-9 for i, p in want.items())


SOUP = ["<div>", "</div>", "<nav>", "</nav>", "<p>", "</p>", "<aside class='a>b'>", "</aside>", "<form>", "</form>", "</table>", "<td>", "<header>", "</header>"]
SOUP += ["a b", "c", "<b>", "</b>", "<!-- x -->", "<script>n</p></script>", "<br>", "&amp;", "</section>", "<section>"]


def plain_text(tokens):
    """Texts that stand in no side element, with a stack of open elements."""
    stack, out = [], []
    for token in tokens:
        name = token.strip("</>").split()[0] if token.startswith("<") else ""
        if not token.startswith("<"):
            if not any(x in ("nav", "aside", "form", "header") for x in stack):
                out.append(token.replace("&amp;", "&"))
        elif token.startswith("</") and name in stack:
            while stack.pop() != name:
                pass
        elif not token.startswith("</") and name in ("div", "nav", "aside", "form", "td", "header", "section"):
            stack.append(name)
    return " ".join(out)


def test_text_of_tag_soup_equals_a_plain_stack(spark):
    pick = random.Random(6)
    pages = [pick.choices(SOUP, k=pick.randrange(1, 60)) for _ in range(400)]
    df = spark.createDataFrame([(i, "\n".join(page)) for i, page in enumerate(pages)], "id int, html string")
    got = {row.id: row.text for row in df.select("id", html_main_text(F.col("html")).alias("text")).collect()}
    assert got == {i: plain_text(page) for i, page in enumerate(pages)}


def test_all_references_by_name_equal_pythons(spark):
    names = sorted(html.entities.html5)
    texts = [f"x &{name} y" for name in names] + [f"x &{name}z" for name in names if name.endswith(";")]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    for row in df.select("t", decode_references(F.col("t")).alias("d")).collect():
        assert row.d == html.unescape(row.t)
    numbers = [*range(1, 400), 8217, 0xD7FF, 0xE000, 0x10FFFF, 0x110000, 0xDFFF]
    df = spark.createDataFrame([(f"a&#{n};b &#x{n:x}; &#{n} c",) for n in numbers], "t string")
    for n, row in zip(numbers, df.select("t", decode_references(F.col("t")).alias("d")).collect(), strict=True):
        if chr(n).isprintable() if n < 0x110000 else True:  # control characters stay what they are
            assert row.d == html.unescape(row.t)

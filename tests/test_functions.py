"""Paths, replies, language and small text functions."""

import os
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from papyrine.functions import language, paths, replies, texts

REPLIES = [
    ('{"reasoning":"a","answer":true}', True),
    ('{"answer":false}', False),
    ('{"answer":false}\n', False),
    ('{"answer": "true"}', None),
    ('{"answer":1}', None),
    ('{"answer":null}', None),
    ("{}", False),
    ("[true]", False),
    ("true", False),
    ("null", False),
    ('"true"', False),
    (None, False),
    ("not json but True", True),
    ('<output>{"answer":true}</output>', True),
    ("nope", False),
    ("", False),
    ('{"answer":false} trailing', False),
    ('{"answer":false, "reasoning":"it is true"', True),
    ('{"answer":false} {"answer":true}', True),
    ('{"answer":false},{"answer":false}', False),
    (' \n{"answer": true, "more": [1, {"answer": false}]} ', True),
    ("  ", False),
    ('{"answer":true,"answer":false}', False),
    ('{"answer":false,"answer":true}', True),
    ('{"answer":false,"answer":"x"}', None),
    ('{"reasoning":"true","reasoning":"b"}', False),
    ('{"answer":true,"answer":false} x', True),
    ('{"answer":false}] it is true', True),
    ('{"answer":false}} it is true', True),
    ('{"answer":false}, it is true', True),
    ("{'answer':false} true", True),
]


def column(spark, values, function):
    df = spark.createDataFrame(list(enumerate(values)), "id int, value string")
    got = dict(df.select("id", function(F.col("value"))).collect())
    return [got[i] for i in range(len(values))]


def test_reply_truth_table(spark):
    assert column(spark, [reply for reply, _ in REPLIES], replies.parse_reply) == [want for _, want in REPLIES]


def test_tagged_output(spark):
    values = ["a <output>\n x </output> <output>y</output>", "plain", "<output>open", "<output>\u00a0\x1d</output>", None]
    assert column(spark, values, replies.extract_tagged) == ["x", "plain", "<output>open", "", None]


def test_prompt_holds_the_whole_text(spark):
    [prompt] = column(spark, ["é" * 20_000], replies.build_prompt)
    assert prompt.count("é") == 20_000 and "<ocr_output>\né" in prompt and "Indonesian" in prompt
    [own] = column(spark, ["abc"], lambda c: replies.build_prompt(c, template="<{text}|{language}>"))
    assert own == "<abc|Indonesian>"


def test_pieces_hold_every_character(spark):
    values = ["é😀\n" * 7, "abc", "", None]
    assert column(spark, values, lambda c: replies.pieces(c, 4)) == [
        [values[0][i : i + 4] for i in range(0, 21, 4)], ["abc"], [], None,
    ]


def test_decoding_equals_unquote(spark):
    pick = random.Random(1)
    pieces = ["%20", "%C3%A9", "%zz", "%", "+", "/", "é", "a", "%4", "%2B", "%25", "%E2%82%AC", " "]
    values = ["file:/a%20b+c.pdf", "/x%zz.pdf", "/100%.pdf", "/plain.pdf", "/a%2Fb%zz", "file:/é%C3%A9.pdf"]
    values += ["".join(pick.choice(pieces) for _ in range(8)) for _ in range(500)]
    want = [unquote(value.removeprefix("file:")) for value in values]
    assert column(spark, values, paths.normalize_path) == want
    want = [unquote(value[5:]) if value.startswith("file:") else value for value in values]
    assert column(spark, values, lambda c: paths.normalize_path(c, always_decode=False)) == want


def test_name_parts_equal_splitext(spark):
    values = ["a.pdf", "a.b.pdf", ".pdf", "..pdf", "...", "a.", "a..b", "a", "", ".a.b", "x\ny.pdf", "a.tar.gz", "..a.b"]
    assert column(spark, values, paths.stem) == [os.path.splitext(value)[0] for value in values]
    assert column(spark, values, paths.extension) == [os.path.splitext(value)[1] for value in values]


def test_small_path_functions(spark):
    assert column(spark, ["/a/b.PDF", "b.pdf", "/a/b.pdf.txt", None], lambda c: paths.has_extension(c, ".pdf")) == [
        True, True, False, None,
    ]
    assert column(spark, ["/a/b.pdf", "b", "/a/"], paths.basename) == ["b.pdf", "b", ""]
    assert column(spark, ["a.pdf", "a"], lambda c: paths.numbered_name(c, F.lit(2))) == ["a_2.pdf", "a_2"]
    rebased = column(spark, ["file:/old/x/old/y", None], lambda c: paths.rebase_path(c, "/old", "/new"))
    assert rebased == ["file:/new/x/new/y", None]


def test_strip_and_blank_equal_python(spark):
    values = ["", " \n", "\u00a0\x1c\u2003", " a ", "\x0b\u0085b c\u3000", "\u200b", "x"]
    assert column(spark, values, texts.strip) == [value.strip() for value in values]
    assert column(spark, values, texts.is_blank) == [not value.strip() for value in values]


def test_truncate_counts_code_points(spark):
    assert column(spark, ["😀é" * 10], lambda c: texts.truncate(c, 3)) == ["😀é😀"]


def share_in_python(text, target):
    import regex

    words = regex.findall(r"\p{L}+", text.lower())
    windows = max(len(words) // language.WINDOW, 1)
    mine = total = 0
    for number in range(windows):
        end = None if number == windows - 1 else (number + 1) * language.WINDOW
        own = words[number * language.WINDOW : end]
        hits = {name: sum(word in listed for word in own) for name, listed in language.FUNCTION_WORDS.items()}
        letters = sum(map(len, own))
        total += letters
        mine += letters if hits[target] > max(count for name, count in hits.items() if name != target) else 0
    return mine / total if total else None


@pytest.mark.parametrize("target", ["id", "en", "de"])
def test_language_share_equals_python(spark, target):
    pick = random.Random(2)
    words = ["yang", "dan", "The", "of", "und", "Der", "le", "los", "x", "über", "más", "dengan,", "ini.", "a1b", "\n"]
    values = [" ".join(pick.choice(words) for _ in range(pick.randint(0, 90))) for _ in range(300)]
    got = column(spark, values, lambda c: language.language_share(c, target))
    assert got == [share_in_python(value, target) for value in values]


def test_function_words_tell_languages_apart():
    listed = [word for words in language.FUNCTION_WORDS.values() for word in words]
    assert len(listed) == len(set(listed)) and min(map(len, listed)) > 1


INDONESIAN = "Penelitian yang kami lakukan pada tahun ini tidak dapat dipisahkan dari karya untuk kota itu dan desa di dalam negeri. "


def test_language_share_follows_the_criterion(spark):
    """At least four fifths of the letters, whatever the rest is and wherever it stands."""
    russian = "Этот текст написан совсем другими буквами и на другом языке для проверки. "
    dutch = "Deze tekst werd in een andere taal geschreven zonder woorden uit de lijst. "
    english = "Six of the words and that is all for this page. " + "Plain content words follow here without any help. " * 20
    formulas = "x | y | z\n"
    values = [
        INDONESIAN + "\n" + (russian + "\n") * 500,
        INDONESIAN + "\n" + (dutch + "\n") * 500,
        INDONESIAN + english,
        INDONESIAN * 40 + formulas * 20,
        INDONESIAN * 9 + russian,
        INDONESIAN.replace(" ", "\n") * 5,
        formulas * 100,
    ]
    marked = column(spark, values, lambda c: language.is_mainly_in(c, "id"))
    assert marked == [False, False, False, True, True, True, False]


def test_language_threshold_and_missing_evidence(spark):
    values = ["yang dan ini itu untuk " * 8 + "the and of " * 6, "the of and", "12345", "", None]
    assert column(spark, values, lambda c: language.is_mainly_in(c, "id", 0.7)) == [True, False, False, False, False]


def test_detected_language(spark):
    values = [INDONESIAN, "the and der", "der the und", "12345", "", None]
    assert column(spark, values, language.detect_language) == ["id", "en", "de", None, None, None]


def test_languages_agree_with_the_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 200")
    found = docs.select("lang", language.detect_language(F.col("text")).alias("found"))
    assert found.agg(F.avg((F.col("lang") == F.col("found")).cast("int"))).first()[0] > 0.97


def test_long_blanks_are_stripped_in_linear_time(spark):
    import time

    text = "a" + " " * 1_000_000 + "b"
    start = time.perf_counter()
    assert column(spark, [text], texts.strip) == [text]
    assert time.perf_counter() - start < 5

"""Sections in other languages, and languages by learned profiles."""

import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from papyrine.functions.language import FUNCTION_WORDS, WINDOW
from papyrine.functions.sections import BORDER, is_mainly_in_sections, language_sections, longest_foreign, target_share
from papyrine.operators import language_profiles as profiles
from papyrine.operators.relevance import mark_by_sections

OWN = "yang dan untuk dengan pada kertas panjang rumah besar tulis baca kata lain sama orang kota jalan air hari bulan".split()
ENGLISH = "the and of to is paper length house great write read word other same people town street water days months".split()


def windows_of(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    count = max(len(words) // WINDOW, 1) if words else 0
    out = []
    for i in range(count):
        part = words[i * WINDOW : len(words) if i == count - 1 else (i + 1) * WINDOW]
        hits = {name: sum(word in listed for word in part) for name, listed in FUNCTION_WORDS.items()}
        out.append((sum(map(len, part)), hits["id"] > max(n for name, n in hits.items() if name != "id")))
    return out


def value(windows, kinds):
    fits = sum(letters if kind == fit else -letters for (letters, fit), kind in zip(windows, kinds, strict=True))
    return fits - BORDER * sum(a != b for a, b in itertools.pairwise(kinds))


def found(spark, texts):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, body string")
    sections = language_sections(F.col("body"), "id")
    df = df.select("id", sections.alias("sections"))
    df = df.select("*", target_share(F.col("sections")).alias("share"), longest_foreign(F.col("sections")).alias("longest"), is_mainly_in_sections(F.col("sections")).alias("mainly"))
    return {row.id: row for row in df.collect()}


def test_sections_are_the_best_division(spark):
    pick = random.Random(2)
    texts = []
    for _ in range(40):
        parts = [pick.choices(pick.choice((OWN, ENGLISH, ["xyz"])), k=WINDOW) for _ in range(pick.randrange(1, 11))]
        texts.append(" ".join(word for part in parts for word in part) + " yang" * pick.randrange(3))
    for i, row in found(spark, texts).items():
        windows = windows_of(texts[i])
        kinds = [section.target for section in row.sections for _ in range(section.windows)]
        best = max(value(windows, kinds) for kinds in itertools.product((True, False), repeat=len(windows)))
        assert value(windows, kinds) == best
        assert [s.first_window for s in row.sections] == [0, *itertools.accumulate(s.windows for s in row.sections)][:-1]
        assert all(a.target != b.target for a, b in itertools.pairwise(row.sections))
        assert sum(s.letters for s in row.sections) == sum(letters for letters, _ in windows)
        assert sum(s.target_letters for s in row.sections) == sum(letters for letters, fit in windows if fit)


def test_a_foreign_chapter_is_told_from_scattered_terms(spark):
    own, other = OWN * 1, ENGLISH * 1  # a window each
    scattered = (own * 3 + other + own * 2) * 10
    chapter = own * 50 + other * 10
    rows = found(spark, [" ".join(own * 60), " ".join(scattered), " ".join(chapter), " ".join(other * 5), "yang dan", "", None, "12 !"])
    assert [[(s.target, s.windows) for s in rows[i].sections] for i in range(4)] == [[(True, 60)], [(True, 60)], [(True, 50), (False, 10)], [(False, 5)]]
    assert rows[1].share == 1.0 and rows[2].share == pytest.approx(5 / 6, abs=0.02)
    assert rows[0].mainly and rows[1].mainly and rows[4].mainly and not rows[3].mainly
    assert not rows[2].mainly or rows[2].longest <= 1_000
    assert all(rows[i].sections is None and rows[i].share is None and not rows[i].mainly for i in (5, 6, 7))
    long = found(spark, [" ".join(own * 200 + other * 30)])[0]
    assert long.share > 0.8 and long.longest > 1_000 and not long.mainly


def test_rows_are_marked_by_sections(spark):
    texts = [" ".join(OWN * 60), " ".join(OWN * 200 + ENGLISH * 30), None]
    df = spark.createDataFrame([(t, e) for t in texts for e in (None, "bad")], "ocr_text string, error string")
    marked = mark_by_sections(df)
    assert marked.columns == ["ocr_text", "error", "is_relevant"]
    assert [row.is_relevant for row in marked.collect()] == [True, False, False, False, False, False]


def test_sections_of_long_texts(spark):
    text = " ".join((OWN * 40 + ENGLISH * 40) * 60)
    row = found(spark, [text])[0]
    assert [s.windows for s in row.sections] == [40] * 120


SAMPLES = {
    "nl": "de kat zit op het dak en kijkt naar de vogels die over het huis vliegen terwijl wij samen koffie drinken in de tuin van onze buren",
    "en": "the cat sits on the roof and looks at the birds that fly over the house while we drink coffee together in the garden of our neighbours",
    "id": "kucing itu duduk di atas atap dan melihat burung yang terbang di atas rumah sementara kami minum kopi bersama di kebun tetangga karena bisa",
    "ms": "kucing itu duduk di atas bumbung dan melihat burung yang terbang di atas rumah manakala kami minum kopi bersama di taman jiran kerana boleh",
    "ru": "кошка сидит на крыше и смотрит на птиц которые летают над домом пока мы вместе пьём кофе в саду наших соседей",
    "zh": "猫坐在屋顶上看着飞过房子的鸟 我们一起在邻居的花园里喝咖啡",
    "it": "il gatto siede sul tetto e guarda gli uccelli che volano sopra la casa mentre noi beviamo insieme un caffè nel giardino dei nostri vicini",
}


def runs(word):
    marked = f" {word} "
    return [marked[i : i + n] for n in (1, 2, 3) for i in range(len(marked) - n + 1) if marked[i : i + n] != " "]


def plain_language(text, rows):
    """The likeliest label and by how much a run is likelier, by the textbook."""
    counts = {}
    for label, body in rows:
        counts.setdefault(label, Counter()).update(run for word in re.findall(r"[^\W\d_]+", body.lower()) for run in runs(word))
    kinds = Counter(len(run) for run in set().union(*counts.values()))
    totals = {label: Counter() for label in counts}
    for label, own in counts.items():
        for run, n in own.items():
            totals[label][len(run)] += n
    asked = [run for word in re.findall(r"[^\W\d_]+", text.lower()) for run in runs(word)]
    logs = sorted((-sum(math.log((counts[x][r] + 0.5) / (totals[x][len(r)] + 0.5 * (kinds[len(r)] + 1))) for r in asked), x) for x in counts)
    return logs[0][1], (logs[1][0] - logs[0][0]) / len(asked)


def test_profiles_tell_neighbours_apart(spark):
    rows = [(label, text) for label, text in SAMPLES.items() for _ in range(3)]
    labelled = spark.createDataFrame([*rows, ("dirty", "x y"), (None, "the cat"), ("en", None)], "lang string, text string")
    model = profiles.train(labelled)
    assert model.labels == sorted(SAMPLES)
    asked = {
        "nl": "wij drinken koffie in het huis", "en": "we drink coffee in the house", "id": "kami bisa minum kopi karena itu", "ms": "kami boleh minum kopi kerana itu",
        "ru": "мы пьём кофе", "zh": "我们喝咖啡", "it": "noi beviamo il caffè nella casa",
    }
    df = spark.createDataFrame([(k, t) for k, t in asked.items()] + [("none", "12 !"), ("null", None), ("greek", "γάτα")], "id string, body string")
    got = {row.id: row for row in profiles.predict_language(df, model, "id", "body").collect()}
    assert {k: got[k].language for k in asked} == {k: k for k in asked}
    for k, text in asked.items():
        assert math.isclose(got[k].margin, plain_language(text, rows)[1], rel_tol=1e-9)
    assert got["none"].language is None and got["null"].language is None and got["greek"].language is not None


def test_profiles_of_nothing_and_of_one_label(spark):
    df = spark.createDataFrame([(1, "some text"), (None, "more"), (2, None)], "id int, body string")
    none = profiles.train(spark.createDataFrame([], "lang string, text string"))
    assert {row.language for row in profiles.predict_language(df, none, "id", "body").collect()} == {None}
    one = profiles.train(spark.createDataFrame([("en", "the cat")] * 3, "lang string, text string"))
    got = {row.id: tuple(row)[1:] for row in profiles.predict_language(df, one, "id", "body").collect()}
    assert got == {1: ("en", None), None: ("en", None), 2: (None, None)}

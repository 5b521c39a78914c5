"""The pipeline's language stage on tables of one and of many languages."""

import random

import numpy as np
import pytest

import corpus_pipeline
from papyrine.llm import language_id
from tests.llm.conftest import SF

EIGHT_FAMILIES = "en fr ru lt fa tr fi id".split()
MANY_IN_ONE = "en de nl sv da fr ru".split()


def _made_up(pick, number, rows, letters="bcdfghjklmnprstvwz"):
    """Documents of a language of its own syllables."""
    syllables = [pick.choice(letters) + pick.choice("aeiouy") for _ in range(12)]
    words = ["".join(pick.choice(syllables) for _ in range(pick.randint(1, 4))) for _ in range(80)]
    return [(1000 * number + i, " ".join(pick.choice(words) for _ in range(60))) for i in range(rows)]


def test_stray_labels_are_not_learned_and_rare_ones_are(spark):
    pick = random.Random(32)
    rows = [(*row, "en") for row in _made_up(pick, 1, 300)] + [(*row, "fr") for row in _made_up(pick, 2, 300)]
    rows += [(*row, "el") for row in _made_up(pick, 3, 30, "βγδζθκλμνξπρ")]
    rows += [(9000 + i, text, f"slip{i}") for i, (_, text) in enumerate(_made_up(pick, 4, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert sorted(label for m in model.languages.values() for label in m.labels) == ["el", "en", "fr"]
    found = {row.doc_id: row.lang_pred for row in language_id.identify(docs, model).collect()}
    assert all(found[doc_id] == lang for doc_id, _, lang in rows if doc_id < 9000)


def test_machine_equals_a_plain_solver():
    made = np.random.default_rng(33)
    x = np.where(made.random((60, 25)) < 0.4, made.normal(size=(60, 25)), 0.0)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + 0.6 * made.normal(size=60) > 0.3, 1.0, -1.0)
    rows = [(np.flatnonzero(row), row[np.flatnonzero(row)]) for row in x]
    weights, bias, _ = language_id._train_pair(rows, y, 25, rounds=3000, gap=1e-6)
    cost = np.where(y > 0, 60 / (2 * (y > 0).sum()), 60 / (2 * (y < 0).sum()))
    signed = np.column_stack([x, np.ones(60)]) * y[:, None]
    alpha, step = np.zeros(60), 1 / np.linalg.norm(signed @ signed.T, 2)
    for _ in range(100_000):  # projected gradient ascent of the dual, all coordinates at once
        alpha = np.clip(alpha + step * (1 - signed @ (signed.T @ alpha)), 0, cost)
    assert np.abs(signed.T @ alpha - np.append(weights, bias)).max() < 1e-3


@pytest.mark.parametrize("langs", [["en"], ["en", "fr"], EIGHT_FAMILIES, MANY_IN_ONE])
def test_clear_texts_stay_however_many_languages_there_are(spark, langs):
    pick, rows = random.Random(31), []
    for number, lang in enumerate(langs):
        letters = [pick.choice("bcdfghjklmnprstvwz") + pick.choice("aeiouy") for _ in range(12)]
        words = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 4))) for _ in range(80)]
        rows += [(1000 * number + i, " ".join(pick.choice(words) for _ in range(60)), lang) for i in range(60)]
    rows += [(90_000, "12345 !!!", "en"), (90_001, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {row.doc_id for row in corpus_pipeline.identify_language(spark, docs, SF).collect()}
    assert kept == {doc_id for doc_id, _, _ in rows if doc_id < 90_000}

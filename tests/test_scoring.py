"""The n-gram model and exact percentiles against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrine.operators import language_model as L
from papyrine.operators.percentiles import percentiles, values_at


def runs(text, order):
    marked = ["<s>"] * (order - 1) + re.findall(r"[^\W\d_]+", text.lower()) + ["</s>"]
    return [tuple(marked[i : i + order]) for i in range(len(marked) - order + 1)]


class PlainModel:
    """Modified Kneser-Ney by the textbook."""

    def __init__(self, texts, order):
        self.order, self.counts, self.lost = order, {}, {}
        self.counts[order] = Counter(run for text in texts for run in runs(text, order))
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(run[1:] for run in self.counts[k + 1])
        for k, counts in self.counts.items():
            of = Counter(counts.values())
            self.lost[k] = L.discounts(of[1], of[2], of[3], of[4])
        self.after = {k: defaultdict(list) for k in self.counts}
        for k, counts in self.counts.items():
            for run, n in counts.items():
                self.after[k][run[:-1]].append(n)

    def p(self, run):
        k = len(run)
        if k == 0:
            return 1 / (len(self.counts[1]) + 1)
        counts = self.after[k].get(run[:-1])
        if not counts:
            return self.p(run[1:])
        taken = sum(self.lost[k][min(n, 3) - 1] for n in counts)
        own = self.counts[k].get(run, 0)
        left = own - self.lost[k][min(own, 3) - 1] if own else 0
        return left / sum(counts) + taken / sum(counts) * self.p(run[1:])

    def perplexity(self, text):
        asked = runs(text, self.order)
        return math.exp(-sum(math.log(self.p(run)) for run in asked) / len(asked))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_perplexity_equals_the_textbook(spark, order):
    pick = random.Random(order)
    texts = [" ".join(pick.choices("a b c d e f g h".split(), weights=[9, 7, 5, 4, 3, 2, 1, 1], k=pick.randrange(0, 30))) for _ in range(60)]
    asked = texts[:5] + ["a b unheard c", "nothing known here", "", "12 !"]
    model = L.train(spark.createDataFrame([(t,) for t in texts], "body string"), "body", order)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(asked)] + [(99, None)], "id int, body string")
    got = {row.id: row for row in L.perplexity(df, model, "id", "body").collect()}
    plain = PlainModel(texts, order)
    for i, text in enumerate(asked):
        assert got[i].words == len(runs(text, order)) and math.isclose(got[i].perplexity, plain.perplexity(text), rel_tol=1e-9)
    assert got[99].words is None and got[99].perplexity is None


def test_probabilities_of_a_context_add_up(spark):
    pick = random.Random(8)
    texts = [" ".join(pick.choices("a b c d e".split(), weights=[9, 5, 3, 2, 1], k=20)) for _ in range(40)]
    model = L.train(spark.createDataFrame([(t,) for t in texts], "body string"), "body", 3)
    for context in (("a", "b"), ("e", "e"), ("zz", "a"), ("<s>", "<s>")):
        asked = [(*context, w) for w in ("a", "b", "c", "d", "e", "</s>", "unheard")]
        logs = L.log_probabilities(spark.createDataFrame(asked, "w1 string, w2 string, w3 string"), model).collect()
        assert math.isclose(sum(math.exp(row.log_p) for row in logs), 1, rel_tol=1e-9)


def test_models_of_nothing_and_null_keys(spark):
    none = spark.createDataFrame([], "id int, body string")
    model = L.train(none, "body")
    df = spark.createDataFrame([(1, "a b"), (None, "c"), (None, "d"), (2, None)], "id int, body string")
    got = {row.id: (row.words, row.perplexity) for row in L.perplexity(df, model, "id", "body").collect()}
    assert got == {1: (3, 1.0), None: (4, 1.0), 2: (None, None)}
    assert L.perplexity(none, L.train(df, "body"), "id", "body").collect() == []


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_perplexity_over_many_buckets_slices_and_parts(spark, monkeypatch, order):
    monkeypatch.setattr(L, "BLOCK", 64)
    monkeypatch.setattr(L, "COMMON", 3)
    pick = random.Random(order)
    texts = [" ".join(pick.choices("a b c d e f g h".split(), weights=[29, 7, 5, 4, 3, 2, 1, 1], k=pick.randrange(0, 30))) for _ in range(60)]
    model = L.train(spark.createDataFrame([(t,) for t in texts], "body string"), "body", order)
    assert model.buckets > L.PARTS and len(model.splits) and len(model.common) == 3
    asked = texts[:9] + ["a a unheard a", "nothing known here here", "", "12 !", "h"]
    df = spark.createDataFrame([(f"{i}", t) for i, t in enumerate(asked)] + [("none", None)], "id string, body string")
    got = {row.id: row for row in L.perplexity(df, model, "id", "body").collect()}
    plain = PlainModel(texts, order)
    for i, text in enumerate(asked):
        assert got[f"{i}"].words == len(runs(text, order)) and math.isclose(got[f"{i}"].perplexity, plain.perplexity(text), rel_tol=1e-9)
    assert len(got) == len(asked) + 1 and got["none"].words is None


def test_different_ngrams_take_little_disk(spark):
    pick = np.random.default_rng(3)
    words = np.array([f"{a}{b}{c}" for a in "bcdfghklmn" for b in "aeiou" for c in ("ra", "len", "tos", "min", "kit", "dar")])
    texts = [" ".join(words[pick.integers(0, len(words), 400)]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").repartition(2)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("*.parquet"))
    assert L.perplexity(df, L.train(df, "body"), "id", "body").count() == 300
    kept = sum(file.stat().st_size for file in set(shared.rglob("*.parquet")) - before)
    assert kept < 8 * 300 * 400  # bytes for each of the n-grams, which are nearly all different


def test_discounts_stay_within_the_counts():
    assert L.discounts(0, 1, 1, 1) == L.discounts(5, 0, 1, 1) == (0.5, 1.0, 1.5)
    one, two, three = L.discounts(100, 40, 20, 12)
    assert 0 < one < 1 and 0 < two < 2 and 0 < three < 3
    assert L.discounts(10, 1, 50, 900) == (0.5, 1.0, 1.5)  # the third would be below 0


FRACTIONS = (0, 0.001, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 0.999, 1)


def sorted_percentiles(values):
    values, n, out = sorted(values), len(values), []
    for f in FRACTIONS:
        h = (n - 1) * f
        low, high = values[math.floor(h)], values[math.ceil(h)]
        out.append((values[max(1, n - math.floor(n - f * n)) - 1], low if low == high else low + (high - low) * (h - math.floor(h))))
    return out


@pytest.mark.parametrize("name", ["few", "many", "wide", "skewed", "doubles", "tiny", "one"])
def test_percentiles_equal_sorting(many_partitions, name):
    pick = np.random.default_rng(1)
    values = {
        "few": pick.integers(0, 9, 3_000).tolist(),
        "many": pick.integers(-(10**6), 10**6, 3_001).tolist(),
        "wide": [int(x) for x in pick.integers(-(2**63), 2**63 - 1, 2_000)] + [2**63 - 1, -(2**63), 2**62, 2**62 + 1],
        "skewed": [7] * 2_000 + [10**15 + i for i in range(500)] + [-(10**17)],
        "doubles": pick.normal(size=2_000).tolist() + [1e300, -1e300, 1e-300, 0.0] * 5,
        "tiny": (5e-324 * pick.integers(0, 50, 500)).tolist() + [1.0],
        "one": [3],
    }[name]
    kind = "double" if isinstance(values[0], float) else "long"
    df = many_partitions.createDataFrame([(v,) for v in [*values, None]], f"v {kind}").repartition(5)
    got = percentiles(df, "v", FRACTIONS).orderBy("fraction").collect()
    for row, (discrete, continuous) in zip(got, sorted_percentiles(values), strict=True):
        assert row.discrete == discrete and math.isclose(row.continuous, continuous, rel_tol=1e-12, abs_tol=1e-300)


def test_values_at_ranks_with_few_bins_and_infinities(many_partitions):
    values = [float("-inf")] * 3 + [float(i * i) for i in range(400)] + [float("inf")] * 2
    df = many_partitions.createDataFrame([(v,) for v in [*values, float("nan"), None]], "v double")
    ranks = [0, 2, 3, 4, 100, 402, 403, 404]
    assert values_at(df, "v", ranks, bins=8) == {rank: values[rank] for rank in ranks}


def test_percentiles_of_nothing_and_of_other_types(spark):
    none = spark.createDataFrame([], "v int")
    assert [tuple(row) for row in percentiles(none, "v", [0.5]).collect()] == [(0.5, None, None)]
    exact = spark.sql("SELECT CAST(id AS DECIMAL(10,2)) / 4 AS v FROM range(9)")
    assert [float(x) for x in percentiles(exact, "v", [0.5]).first()] == [0.5, 1.0, 1.0]
    assert percentiles(spark.range(9).select(F.col("id").cast("tinyint").alias("v")), "v", [0.5]).first().discrete == 4
    with pytest.raises(ValueError):
        percentiles(none, "v", [1.5])


def test_words_beyond_the_common_ones_count_as_well(spark, monkeypatch):
    from papyrine.operators import language_profiles as L
    from papyrine.operators import scoring as S

    rows = [(i, " ".join(f"{'abcdefgh'[(i * k) % 8]}x" for k in range(1, 9)), "ab"[i % 2]) for i in range(40)] + [(50, None, None), (51, "", "a"), (None, "ax zz", "b"), (3, "yy", "b")]
    df = spark.createDataFrame(rows, "id int, body string, lang string")

    def both():
        scored = S.quality_score(df, S.unigram_model(df, "body"), "id", "body")
        predicted = L.predict_language(df, L.train(df, "lang", "body"), "id", "body")
        return [{row[0]: tuple(x if x is None or isinstance(x, str) else round(x, 9) for x in row[1:]) for row in part.collect()} for part in (scored, predicted)]

    whole = both()
    monkeypatch.setattr(S, "COMMON", 2)
    assert both() == whole and len(whole[0]) == len(whole[1]) == 43
    model = spark.createDataFrame([("ax", -1.0), ("bx", -2.0), (None, -9.0)], "word string, log_p double")
    df = spark.createDataFrame([(1, "ax bx cx cx")], "id int, body string")
    assert S.quality_score(df, model, "id", "body").first().score == -5.25

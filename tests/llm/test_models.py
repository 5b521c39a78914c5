"""Language ID, toxicity, HTML text, decontamination and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from papyrine.llm import arrays, decontaminate, html_text, language_id, queries, toxicity
from tests.llm import brute
from tests.llm.conftest import SF

TRAIN = "/root/testdata/sf0.01"


def test_language_id_on_held_out_rows(spark):
    truth = spark.read.parquet(f"{TRAIN}/documents.parquet").select("doc_id", "lang")
    found = queries.op5_language_id(spark, TRAIN).join(truth, "doc_id")
    held = found.filter("held_out").collect()
    assert len(held) > 150 and np.mean([row.lang == row.lang_pred for row in held]) > 0.97
    assert all(0 <= row.score <= 1 for row in found.collect())

    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in found.collect())


def test_language_id_of_odd_rows(odd, odd_rows, none, docs):
    model = language_id.train(docs)
    got = language_id.identify(odd, model)
    assert got.columns == [*(c for c in odd.columns if c not in ("lang_pred", "score")), "lang_pred", "score"]
    for row in got.collect():
        lettered = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not lettered) and (row.score == 0) == (not lettered)
    assert language_id.identify(none, model).collect() == []
    nothing = language_id.train(none)
    assert {row.lang_pred for row in language_id.identify(odd, nothing).collect()} == {"und"}
    single = language_id.train(odd)
    assert {row.lang_pred for row in language_id.identify(odd, single).collect()} == {"und", "en"}


def test_prediction_does_not_depend_on_other_columns(docs):
    model = language_id.train(docs)
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)).withColumn("doc_id", F.col("doc_id") + 1000)
    one, two = ({(r.text, r.lang_pred, r.score) for r in language_id.identify(d, model).collect()} for d in (docs, changed))
    assert one == two


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = queries.op2_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    y, p = np.array([row.toxic for row in found]), np.array([row.predicted for row in found])
    assert (y == p).mean() > 0.95 and p[y == 1].mean() > 0.85 and y[p == 1].mean() > 0.8
    score = np.array([row.score for row in found])
    for low, high in ((0, 0.2), (0.7, 1.01)):  # calibrated
        some = (score >= low) & (score < high)
        assert abs(score[some].mean() - y[some].mean()) < 0.1


def test_scores_equal_plain_tf_idf_neighbours(spark):
    """Neighbours, cosines and scores of whole texts against dictionaries over all words."""
    docs, labels = (spark.read.parquet(f"{TRAIN}/{name}.parquet") for name in ("documents", "labels"))
    examples = toxicity.train(docs, labels)
    rows = {row.doc_id: row.text for row in docs.collect()}
    tokens = {i: Counter(re.findall(r"[^\W\d_]+", text.lower())) for i, text in rows.items()}
    label = {row.doc_id: row.toxic for row in labels.collect() if zlib.crc32(str(row.doc_id).encode()) % 5 and len(rows[row.doc_id]) <= toxicity.SAMPLE_CHARS}
    frequency = Counter(word for words in tokens.values() for word in words)
    heard = set().union(*(tokens[i] for i in label))
    with_word = {w: [sum(w in tokens[i] for i in label if label[i] == y) for y in (0, 1)] for w in heard if frequency[w] > 2}
    totals = [sum(y == k for y in label.values()) for k in (0, 1)]

    def factor(word):
        idf = math.log((len(rows) + 1) / (frequency[word] + 1)) + 1 if word in heard else math.log(len(rows) + 1) + 1
        if word not in heard:
            return idf * 0.1
        held = with_word.get(word) or [sum(word in tokens[i] for i in label if label[i] == y) for y in (0, 1)]
        n, own = sum(totals), sum(held)
        chi2 = n * (held[1] * totals[0] - held[0] * totals[1]) ** 2 / max(own * (n - own) * totals[0] * totals[1], 1)
        return idf * math.sqrt(min(max(chi2, 1), 100) / 100)

    known = {word: factor(word) for word in set().union(*tokens.values())}

    def vector(words):
        weights = {w: (1 + math.log(n)) * known[w] for w, n in words.items()}
        length = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / length for w, x in weights.items()}

    index = {i: vector(tokens[i]) for i in label if tokens[i]}
    number = {word: i for i, word in enumerate(examples.words)}
    assert set(number) == heard
    for i in list(rows)[::23]:
        own = vector(tokens[i])
        best = sorted((sum(x * own.get(w, 0) for w, x in v.items()) for v in {tuple(sorted(tokens[j].items())): index[j] for j in index}.values()), reverse=True)
        words = sorted((number.get(w, len(number) + k), n) for k, (w, n) in enumerate(tokens[i].items()))
        _, asked, weights = examples.vectors(np.zeros(len(words), int), *np.array(words).T, 1)
        places, cosines = examples.nearest(asked, weights)
        assert np.allclose(cosines, best[: toxicity.NEIGHBOURS], atol=1e-7)
        near = 1 / (1.05 - np.minimum(cosines, 1)) ** 2
        prior = examples.base[0] / examples.base[1]
        mean = examples.weight.mean()
        vote = ((near * examples.toxic[places]).sum() + prior * mean) / ((near * examples.weight[places]).sum() + mean)
        got = toxicity.score(docs.filter(docs.doc_id == i), examples).first() if i % 5 == 0 else None
        assert got is None or abs(got.score - np.interp(vote, *examples.curve)) < 1e-9


def test_nearest_entries_equal_brute_force():
    pick = np.random.default_rng(11)
    vectors = pick.random((700, 40)) * (pick.random((700, 40)) < 0.1)
    vectors[300:310] = vectors[300]  # ties
    vectors = vectors[vectors.any(axis=1)]
    vectors /= np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    zeros = np.zeros(len(vectors))
    word, entry = np.nonzero(vectors.T)
    postings = word, entry, vectors[entry, word]
    index = toxicity.Examples([str(i) for i in range(40)], np.ones(40), 1.0, postings, zeros, zeros + 1, [0] * len(zeros), (0.0, 1.0), (zeros, zeros))
    for _ in range(300):
        words = np.sort(pick.choice(40, pick.integers(1, 8), replace=False))
        query = pick.random(len(words))
        query /= np.sqrt(query @ query)
        places, cosines = index.nearest(words, query)
        exact = vectors[:, words] @ query
        best = np.lexsort((np.arange(len(exact)), -np.round(exact, 9)))[: toxicity.NEIGHBOURS]
        best = best[exact[best] > 1e-9]
        assert np.allclose(cosines, exact[best]) and places.tolist() == best.tolist()


def test_toxicity_of_odd_rows(spark, odd, odd_rows, none, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd_labels = labels.unionByName(spark.createDataFrame([(3, 1, None), (None, 0, 1), (4, 0, 1), (4, 0, 0)], labels.schema))
    examples = toxicity.train(docs.select("doc_id", "text"), odd_labels)
    got = toxicity.score(odd, examples).collect()
    assert len(got) == len(odd_rows) and all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in got)
    assert len({row.score for row in got if row.doc_id in (1, 2)}) == 1
    assert toxicity.score(none, examples).collect() == []
    untaught = toxicity.train(docs, labels.filter("false"))
    assert {row.score for row in toxicity.score(odd, untaught).collect()} == {0.0}
    assert toxicity.score(odd, toxicity.train(none, labels)).count() == len(odd_rows)


PAGES = {
    """<html><head><title>T</title></head><body><header class="site-header"><a href="/">Home</a> My Site</header>
    <div class="cookie-notice">We use cookies to make this better for you and all of your friends <button>OK</button></div>
    <div id="content"><h1>The title of it</h1><p>First paragraph of the text which is long enough to be taken for text, with
    several words.</p><p>Short&nbsp;one.</p><p>Second paragraph &amp; more of the text which is long enough to be taken for
    text.</p><form><label>Name</label><input></form></div><div class="comments"><p>I like this article very much and would
    like to read more of it soon, thanks a lot to all.</p></div><div class="sidebar"><ul><li><a href=x>One</a></li></ul></div>
    <footer>(c) me</footer></body></html>""":
    "The title of it First paragraph of the text which is long enough to be taken for text, with several words. Short one. "
    "Second paragraph & more of the text which is long enough to be taken for text.",
    '<nav><a href="/">A</a></nav><div class="ad">Buy this thing now, it is cheap.</div><article><h1>Head</h1><p><b>One<br>two'
    '<p>Three &lt;b&gt;</p><section class="comments"><p>Nice article I liked it</p></section></article><footer>f</footer>':
    "Head One two Three <b>",
    '<script>var t="</p><article>no</article>";</script><style>p{}</style><article>Text <!-- <p>no --> goes on': "Text goes on",
    "": "", "<": "", "<p": "", "<article>" * 1000 + "deep": "deep",
    '<article><a href="a>b" title=\'x>y\'>Link</a> in a sentence of words</article>': "Link in a sentence of words",
}


def test_html_text():
    tree = html_text.train()
    for page, want in PAGES.items():
        assert html_text.main_text(page, tree) == want


def test_html_text_of_the_pages(spark):
    import html
    import re

    got = {row.page_id: row for row in queries.op8_html_text(spark, TRAIN).collect()}
    for page in spark.read.parquet(f"{TRAIN}/pages.parquet").collect():
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", page.html)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>?", " ", inner[1])).split()) if inner else ""
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)


def test_html_text_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, ""), (1, "u", "<p>" + "word " * 300_000), (1, "u", None)], "page_id long, url string, html string")
    got = html_text.extract_main_text(pages.withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(1))).collect()
    assert sorted(row.n_chars for row in got) == [0, 0, 0, 1_499_999]
    assert html_text.extract_main_text(pages.filter("false")).collect() == []


def test_tag_pattern_takes_linear_time():
    import time

    start = time.perf_counter()
    tree = html_text.train()
    for page in ("<a '" * 50_000, '<a "' * 50_000, "<" * 200_000, "<!--" * 50_000, "<script>" * 20_000, "<div " * 50_000):
        html_text.main_text(page, tree)
    assert time.perf_counter() - start < 20


def test_overlaps_of_planted_items(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    pick = random.Random(12)
    first, second, third = (row.text.split() for row in items.orderBy("item_id").take(3))
    noise = lambda n: [f"w{pick.randrange(10**6)}" for _ in range(n)]
    half = len(second) // 2
    texts = {
        0: noise(50) + first + noise(50), 1: noise(20) + second[half:] + noise(30) + second[:half], 2: noise(300),
        3: first[: len(first) // 4] + noise(10), 4: [w.upper() + "!" for w in third], 5: first + second, 6: [],
    }
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()] + [(7, None)], "doc_id long, text string")
    got = {(row.doc_id, row.item_id): row for row in decontaminate.find_overlaps(docs, items).collect()}
    assert set(got) == {(0, 0), (1, 1), (4, 2), (5, 0), (5, 1)}
    assert got[1, 1].n_tiles == 2 and got[1, 1].coverage == 1
    in_parts = decontaminate.find_overlaps(docs, items, part_chars=500).collect()
    assert {(row.doc_id, row.item_id) for row in in_parts} == set(got)
    assert sorted(row.doc_id for row in decontaminate.drop_contaminated(docs, items).collect()) == [2, 3, 6, 7]


def test_verbatim_items_are_found_and_others_left(spark):
    docs, items = (spark.read.parquet(f"{TRAIN}/{name}.parquet").collect() for name in ("documents", "benchmark"))
    got = {(row.doc_id, row.item_id) for row in queries.op4_decontaminate(spark, TRAIN).collect()}
    assert got == {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}


def test_tiling_equals_brute_force():
    pick = random.Random(13)
    for _ in range(60):
        item = [pick.randrange(6) for _ in range(pick.randint(3, 25))]
        text = [pick.randrange(6) for _ in range(pick.randint(0, 40))]
        for _ in range(2):
            at = pick.randint(0, len(text))
            begin = pick.randrange(len(item))
            text[at:at] = item[begin : begin + 10]
        words, own = np.array(text, np.uint64), np.array(item, np.uint64)
        pairs = [(i, j) for i in range(len(text) - 2) for j in range(len(item) - 2) if text[i : i + 3] == item[j : j + 3]]
        at, place = np.array(pairs, int).reshape(-1, 2).T
        got = [(n, b, a) for a, b, n in decontaminate.tile(words, own, at, place, 3)]
        assert got == brute.tiles(text, item, 3)


def test_overlaps_equal_brute_force_tiles():
    pick = random.Random(14)
    for _ in range(150):
        texts = [" ".join(f"w{pick.randrange(4)}" for _ in range(pick.randint(3, 20))) for _ in range(4)]
        text = " ".join([f"w{pick.randrange(4)}" for _ in range(40)] + texts[0].split())
        items = decontaminate.Items.of(list(range(4)), texts, 3)
        words, _ = decontaminate.WordHashes()(*arrays.flat(pa.array([text])))
        want = []
        for number, own in enumerate(texts):
            tiles = brute.tiles(text.split(), own.split(), 3)
            coverage = sum(n for n, _, _ in tiles) / len(own.split())
            if coverage >= 0.5:
                want.append((number, coverage, len(tiles), tiles[0][0]))
        assert decontaminate._overlaps(words, items, 0.5) == want


def test_repeated_words_and_templates_take_linear_time():
    import time

    question = " ".join(f"q{i}" for i in range(30))
    templates = [f"{question} " + " ".join(f"r{j}x{i}" for i in range(10 + 25 * (j % 2))) for j in range(5000)]
    cases = [
        (" ".join(["x"] * 40_000), [" ".join(["x"] * 200)], 1),
        (" ".join(["x", "y"] * 20_000 + ["z"]), [" ".join(["x", "y"] * 100), " ".join(["y"] * 200)], 1),
        (question + " other" * 300, templates, 2500),
    ]
    for text, texts, found in cases:
        items = decontaminate.Items.of(list(range(len(texts))), texts, decontaminate.SEED_WORDS)
        words, _ = decontaminate.WordHashes()(*arrays.flat(pa.array([text])))
        start = time.perf_counter()
        assert len(decontaminate._overlaps(words, items, 0.5)) == found
        assert time.perf_counter() - start < 2


def test_overlaps_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (None, "no id"), (5, "!!!"), (6, "alpha " * 50), (6, "alpha " * 50)], "item_id long, text string")
    got = {(row.doc_id, row.item_id) for row in decontaminate.find_overlaps(odd, items).collect()}
    assert got == {(4, 3), (None, None)}  # items of fewer words than a seed occur as a whole
    assert decontaminate.find_overlaps(none, items).collect() == []
    assert decontaminate.find_overlaps(odd, items.filter("false")).collect() == []
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontaminate.drop_contaminated(odd, items.filter("false")).count() == odd.count()


def test_word_hashes_do_not_depend_on_neighbours():
    texts = ["One, two-three", "", " one\ttwo three ", "…", "ONE TWO THREE"]
    words, begins = decontaminate.WordHashes()(*arrays.flat(pa.array(texts)))
    parts = [words[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)]
    assert parts[0] == parts[2] == parts[4] and parts[1] == parts[3] == []


@pytest.mark.parametrize("source", ["docs", "odd"])
def test_pipeline_equals_plain_stages(spark, docs, odd, tmp_path, source):
    table = {"docs": docs, "odd": odd.unionByName(docs, allowMissingColumns=True)}[source]
    table = table.select("doc_id", "text", "lang", "source", "n_chars")
    folder = str(tmp_path)
    table.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    benchmark = [row.text for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept, names = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = [(row.doc_id, row.text) for row in kept.collect()]
        out = stage(spark, kept, folder)
        names.append(name)
        if name == "packing":
            assert {row.doc_id for row in out.collect()} == {i for i, _ in before}
            continue
        assert out.columns == kept.columns
        after = [(row.doc_id, row.text) for row in out.collect()]
        if name == "language_id":
            assert {(i, t) for i, t in before if not any(c.isalpha() for c in t or "")}.isdisjoint(after)
            assert len(after) >= len([1 for _, t in before if any(c.isalpha() for c in t or "")]) - 2
        if name == "line_dedup":
            want = [(i, text) for (i, _), (text, _, _) in zip(before, brute.deduplicated_lines(before), strict=True)]
            assert sorted(after, key=repr) == sorted(want, key=repr)
            assert all(row.n_chars == len(row.text) for row in out.collect())
        if name == "simhash_dedup":
            groups = set(brute.clusters([brute.simhash(t) for _, t in before], lambda a, b: (a ^ b).bit_count() <= 3))
            assert len(after) == len(groups)
        if name == "decontaminate":
            assert {i for i, _ in before} - {i for i, _ in after} == {i for i, t in before if any(b in t for b in benchmark)}
        kept = spark.createDataFrame(out.collect(), kept.schema)
    assert names == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "packing"]
    assert corpus_pipeline.run(spark, folder).count() > 0

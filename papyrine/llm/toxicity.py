"""Toxicity of texts by their nearest labelled examples.

Texts and examples are TF-IDF vectors over all words. Document frequencies are counted over all documents, and a word's weight
also grows with how well its presence tells the labels apart (chi-squared over the examples). A word that no example holds
can't add to a product, but it counts in the length of a text's vector, as a word that no document holds.

Examples with equal words are one entry of an inverted index, and entries stand in blocks, like beside like. For each word
the index lists the blocks that hold it with the largest weight there, and within them the entries. From the former follows
the best possible cosine of each block; blocks are looked into from the most promising on, until none can hold a nearer
example. The result is exact.

Neighbours vote with a weight that falls with their distance. A monotone curve, fitted on examples that vote without
themselves, turns votes into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm.arrays import distinct, flat, ragged, text_slices
from papyrine.llm.language_id import held_out

SAMPLE_PER_LABEL = 1000  # labelled rows used as examples, in expectation
SAMPLE_CHARS = 20_000  # longer texts are no examples, which bounds the sample in bytes
CHI2_RANGE = 1.0, 100.0  # beyond, chi-squared makes no difference to a word's weight
NEIGHBOURS = 15
BLOCK = 32
DENSE = 8  # a word in one of so many entries is frequent
TEXTS_AT_ONCE = 256
CACHED_PIECES = 600_000  # kept by a worker process
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def chi_squared(with_word: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Of word x label tables; `with_word` is n x 2, texts of each label that hold the word."""
    n, row = totals.sum(), with_word.sum(axis=1)
    cross = with_word[:, 1] * totals[0] - with_word[:, 0] * totals[1]
    return n * cross**2 / np.maximum(row * (n - row) * totals[0] * totals[1], 1)


def told_apart(tokens: list[Counter], labels: np.ndarray, number: dict[str, int]) -> np.ndarray:
    """A factor for each word, from 0.1 to 1: the root of its chi-squared, as far as that makes a difference."""
    table = np.zeros((len(number), 2))
    for words, label in zip(tokens, labels, strict=True):
        table[[number[w] for w in words], label] += 1
    found = chi_squared(table, np.array([(labels == 0).sum(), (labels == 1).sum()], float))
    return np.sqrt(np.clip(found, *CHI2_RANGE) / CHI2_RANGE[1])


class WordCounter:
    """Counts of all words in texts; those of the list have its numbers, others higher ones that hold for one call."""

    def __init__(self, words: list[str]):
        self.listed = len(words)
        self._words = {word: i for i, word in enumerate(words)}
        self._known: dict[bytes, tuple[int, ...]] = {}
        self._others: dict[str, int] = {}

    def _learn(self, piece: bytes) -> tuple[int, ...]:
        text = piece.decode().lower().strip(" \n.,;:!?()")
        numbers = []
        for word in (text,) if text.isalpha() else _WORD.findall(text):
            number = self._words.get(word)
            numbers.append(self._others.setdefault(word, self.listed + len(self._others)) if number is None else number)
        found = self._known[piece] = tuple(numbers)
        return found

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, word and number of occurrences, sorted by text and word."""
        if len(self._known) > CACHED_PIECES:
            self._known, self._others = {}, {}
        spaces = np.flatnonzero((data == 32) | (data == 10))
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts = np.union1d(spaces, heads)
        pieces, codes = distinct(data, starts)
        found = [known if known is not None else self._learn(piece) for piece, known in zip(pieces, map(self._known.get, pieces), strict=True)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))
        if not len(numbers):
            return numbers, numbers, numbers
        begins = np.cumsum(size) - size
        words = numbers[ragged(begins[codes], size[codes])]
        text = np.repeat(np.searchsorted(offsets, starts, side="right") - 1, size[codes])
        most = self.listed + len(self._others)
        keys, count = np.unique(text * most + words, return_counts=True)
        return keys // most, keys % most, count


@dataclass
class Examples:
    """Entries of the index: unit vectors, the weight of label 1 and of all examples there, and one doc_id of each.

    `factors` weigh the words, `unheard` those that are not listed. `postings` are (word, entry, weight) in order.
    """

    words: list[str]
    factors: np.ndarray
    unheard: float
    postings: tuple[np.ndarray, np.ndarray, np.ndarray]
    toxic: np.ndarray
    weight: np.ndarray
    doc_ids: list[int | None]
    base: tuple[float, float]  # label 1 and all among all examples
    curve: tuple[np.ndarray, np.ndarray]

    def __post_init__(self) -> None:
        word, entry, weight = self.postings
        n = len(self.toxic)
        # Words that many entries hold have a weight for every entry; their part of all products is one multiplication.
        frequent = np.bincount(word, minlength=len(self.words)) * DENSE >= max(n, 1)
        self._row = np.where(frequent, np.cumsum(frequent) - 1, -1)
        self._rows = np.zeros((int(frequent.sum()), n))
        self._rows[self._row[word[frequent[word]]], entry[frequent[word]]] = weight[frequent[word]]
        word, entry, weight = (x[~frequent[self.postings[0]]] for x in self.postings)
        block = entry // BLOCK
        heads = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (block[1:] != block[:-1]))) if len(word) else np.zeros(0, int)
        self._entry, self._weight, self._block, self._begin = entry, weight, block[heads], heads
        self._size = np.diff(np.append(heads, len(word)))
        self._most = np.maximum.reduceat(weight, heads) if len(heads) else np.zeros(0)
        self._of_word = np.searchsorted(word[heads], np.arange(len(self.words) + 1))
        self._blocks = -(-n // BLOCK)
        self._block_of = np.arange(n) // BLOCK

    def vectors(self, text: np.ndarray, words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, word and weight of the listed words in the unit vectors of n texts, to which all their words belong."""
        listed = words < len(self.words)
        weights = (1 + np.log(counts)) * np.append(self.factors, self.unheard)[np.minimum(words, len(self.words))]
        lengths = np.sqrt(np.bincount(text, weights**2, minlength=n))
        return text[listed], words[listed], weights[listed] / lengths[text[listed]]

    def frequent_parts(self, text: np.ndarray, words: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        """text x entry: what frequent words add to the cosines."""
        row = self._row[words]
        asked = np.zeros((n, len(self._rows)))
        asked[text[row >= 0], row[row >= 0]] = weights[row >= 0]
        return asked @ self._rows

    def nearest(self, words: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of highest cosine and their cosines; of equal ones the first entries. Cosines are above 0.

        `part`: what frequent words add, if that is known already.
        """
        if part is None:
            part = self.frequent_parts(np.zeros(len(words), int), words, weights, 1)[0]
        rare = self._row[words] < 0
        words, weights = words[rare], weights[rare]
        first_list = self._of_word[words]
        sizes = self._of_word[words + 1] - first_list
        lists = ragged(first_list, sizes)  # of each word the blocks that hold it
        own, block = np.repeat(weights, sizes), self._block[lists]
        bound = np.bincount(block, own * self._most[lists], minlength=self._blocks)
        if len(part):
            bound = bound + np.maximum.reduceat(part, np.arange(0, len(part), BLOCK))
        order = np.argsort(-bound, kind="stable")
        places, cosines, worst, first, some = np.zeros(0, int), np.zeros(0), 1e-9, 0, 16
        rank = np.empty(self._blocks, np.int64)
        rank[order] = np.arange(len(order))
        while first < len(order) and bound[order[first]] >= worst - 1e-8:
            last = np.count_nonzero(bound >= worst - 1e-8) if first else some  # then all that may hold a nearer one
            here = np.flatnonzero((rank[block] >= first) & (rank[block] < last))
            size = self._size[lists[here]]
            at = ragged(self._begin[lists[here]], size)
            found = part + np.bincount(self._entry[at], np.repeat(own[here], size) * self._weight[at], minlength=len(part))
            found[(rank[self._block_of] < first) | (rank[self._block_of] >= last)] = 0
            if len(found) > k:
                worst = max(worst, np.partition(found, -k)[-k])
            reached = np.flatnonzero(found > max(worst - 1e-8, 1e-9))
            places, cosines = np.append(places, reached), np.append(cosines, found[reached])
            first = last
        keep = np.lexsort((places, -np.round(cosines, 9)))[:k]
        return places[keep], cosines[keep]

    def votes(
        self, text: np.ndarray, words: np.ndarray, counts: np.ndarray, n: int, without: list[tuple[int, float, float]] | None = None
    ) -> Iterator[tuple[float, np.ndarray]]:
        """For each of n texts the share of label 1 among the neighbours' votes, and the neighbours.

        `without`: for each text an entry and what one example adds to it, which does not count.
        """
        prior = self.base[0] / self.base[1] if self.base[1] else 0.0
        mean = self.weight.mean() if len(self.weight) else 1.0
        text, words, weights = self.vectors(text, words, counts, n)
        cuts = np.searchsorted(text, np.arange(n + 1))
        for first in range(0, n, TEXTS_AT_ONCE):
            last = min(first + TEXTS_AT_ONCE, n)
            some = slice(cuts[first], cuts[last])
            parts = self.frequent_parts(text[some] - first, words[some], weights[some], last - first)
            for i in range(first, last):
                own = slice(cuts[i], cuts[i + 1])
                if not len(words[own]):
                    yield prior, words[own]
                    continue
                places, cosines = self.nearest(words[own], weights[own], part=parts[i - first])
                toxic, total = self.toxic[places].copy(), self.weight[places].copy()
                if without is not None:
                    mine = places == without[i][0]
                    toxic[mine] -= without[i][1]
                    total[mine] -= without[i][2]
                near = 1 / (1.05 - np.minimum(cosines, 1)) ** 2
                yield float(((near * toxic).sum() + prior * mean) / ((near * total).sum() + mean)), places

    def probability(self, votes: np.ndarray) -> np.ndarray:
        return np.interp(votes, *self.curve)


def monotone_curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of labels on votes by pooling neighbours that violate the order; as points to interpolate."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # vote sum, label sum, weight
    for v, y, w in zip(votes[order], labels[order], weights[order], strict=True):
        pools.append([v * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x = np.array([p[0] / p[2] for p in pools])
    return np.concatenate([[0.0], x, [1.0]]), np.concatenate([[min(p[1] / p[2] for p in pools)], [p[1] / p[2] for p in pools], [max(p[1] / p[2] for p in pools)]])


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, longest: int = SAMPLE_CHARS) -> Examples:
    """Examples from rows with a label that are not held out, and idf over all of `docs`.

    The sample of examples is bounded: about `per_label` of each label, chosen by a hash of doc_id, with texts of at most
    `longest` code points. A doc_id labelled both ways counts as label 1. Votes are weighted back to the labels' true shares.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["n"] for row in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    scale = 1 << 30
    limits = [min(scale, scale * per_label // max(counts.get(label, 0), 1)) for label in (0, 1)]
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < F.when(F.col("toxic") == 1, F.lit(limits[1])).otherwise(F.lit(limits[0])))
    texts = docs.select("doc_id", "text").filter(F.char_length("text") <= longest)
    sample = texts.join(F.broadcast(chosen), "doc_id").toPandas().sort_values(["doc_id", "text"])  # bounded as above
    y = (sample["toxic"].to_numpy() == 1).astype(int)
    tokens = [Counter(_words(text)) for text in sample["text"]]
    words = sorted(set().union(*tokens))
    idf, unheard = _idf(docs, words)
    share = [counts.get(label, 0) / max((y == label).sum(), 1) for label in (0, 1)]
    weight = np.where(y == 1, share[1], share[0]) / max(sum(counts.values()), 1)
    return _indexed(docs.sparkSession, sample["doc_id"].tolist(), tokens, y, weight, words, idf, unheard)


def _idf(docs: DataFrame, words: list[str]) -> tuple[np.ndarray, float]:
    """Over all documents, of the listed words and of a word that no document holds; each task sends a row per word it saw."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, total, seen = WordCounter(words), np.zeros(len(words), np.int64), 0
        for batch in text_slices(batches):
            _, found, _ = counter.counts(*flat(batch.column("text")))
            total += np.bincount(found[found < len(words)], minlength=len(words))
            seen += batch.num_rows
        there = np.flatnonzero(total)
        columns = [pa.array(np.append(there, -1), pa.int32()), pa.array(np.append(total[there], seen), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(len(words) + 1)
    found[rows.column("word").to_numpy()] = rows.column("n").to_numpy()  # the last one is the number of documents
    return np.log((found[-1] + 1) / (found[:-1] + 1)) + 1, float(np.log(found[-1] + 1) + 1)


def _indexed(
    spark: SparkSession, doc_ids: list, tokens: list[Counter], y: np.ndarray, weight: np.ndarray, words: list[str], idf: np.ndarray, unheard: float
) -> Examples:
    number = {word: i for i, word in enumerate(words)}
    apart = told_apart(tokens, y, number) if len(y) else np.zeros(0)
    factors = idf * apart
    unheard *= np.sqrt(CHI2_RANGE[0] / CHI2_RANGE[1])
    counted = [tuple(sorted((number[w], n) for w, n in text.items())) for text in tokens]
    entries: dict[tuple, list[int]] = {}
    for i, counts in enumerate(counted):
        if counts:
            entries.setdefault(counts, []).append(i)
    vectors = {}
    for key in entries:
        found, n = np.array(key).T
        vectors[key] = found, (1 + np.log(n)) * factors[found]
    # Entries whose heaviest word is the same stand together, so that few blocks hold much of it.
    keys = sorted(entries, key=lambda key: (int(vectors[key][0][vectors[key][1].argmax()]), key))
    toxic, total, names, parts = np.zeros(len(keys)), np.zeros(len(keys)), [], []
    for place, key in enumerate(keys):
        found, weights = vectors[key]
        parts.append((found, np.full(len(found), place), weights / np.sqrt(weights @ weights)))
        own = entries[key]
        toxic[place], total[place] = (y[own] * weight[own]).sum(), weight[own].sum()
        names.append(doc_ids[max(own, key=lambda i: y[i])])
    word, entry, value = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    order = np.lexsort((entry, word))
    postings = word[order], entry[order], value[order]
    flat_curve = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    base = float((y * weight).sum()), float(weight.sum())
    examples = Examples(words, factors, unheard, postings, toxic, total, names, base, flat_curve)
    if len(y):
        place_of = {key: place for place, key in enumerate(keys)}
        votes = _votes(spark, examples, counted, [(place_of.get(c, -1), y[i] * weight[i], weight[i]) for i, c in enumerate(counted)])
        examples.curve = monotone_curve(votes, y.astype(float), weight)
    return examples


def _votes(spark: SparkSession, examples: Examples, counted: list[tuple], without: list[tuple]) -> np.ndarray:
    """The votes of all examples, each without itself, found in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("id").to_pylist()
            rows = [(k, word, n) for k, i in enumerate(places) for word, n in counted[i]]
            text, words, counts = np.array(rows, int).reshape(-1, 3).T
            found = [vote for vote, _ in examples.votes(text, words, counts, len(places), [without[i] for i in places])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], names=["id", "vote"])

    rows = spark.range(len(counted)).mapInArrow(run, "id long, vote double").toArrow()
    votes = np.zeros(len(counted))
    votes[rows.column("id").to_numpy()] = rows.column("vote").to_numpy()
    return votes


def score(docs: DataFrame, examples: Examples) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 from 0.5 on) and evidence: doc_ids of the nearest
    examples, nearest first, at most five.

    Only the text counts; null and empty texts and those without any word of an example get the share of label 1 among all
    examples, and no evidence. Equal texts get equal scores, repeated rows and ids are done each by itself, of equally near
    examples the first in the index are taken, an empty table gives no rows and other columns are not looked at. One pass
    without a shuffle; the examples have a bounded size.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(examples.words)
        for batch in text_slices(batches):
            found = list(examples.votes(*counter.counts(*flat(batch.column("text"))), batch.num_rows))
            votes = np.array([vote for vote, _ in found])
            evidence = [[examples.doc_ids[p] for p in places[:5]] for _, places in found]
            scores = np.clip(examples.probability(votes), 0, 1)
            predicted = pa.array((scores >= 0.5).astype(np.int32))
            columns = [batch.column("doc_id"), pa.array(scores), predicted, pa.array(evidence, pa.list_(batch.schema.field("doc_id").type))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted", "evidence"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int, evidence array<{kind}>")

"""The language of texts: family first, then one-versus-one linear support vector machines within the family.

Features are relative frequencies of hashed three- and four-byte strings of the folded text, so a machine's decision is the
mean of its weights over all places of a text, whatever its length. Machines are trained on a bounded sample of labelled
rows, each pair of labels in a task of its own and with all features of its rows; prediction is one pass over the texts without
a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.llm.arrays import flat, text_slices
from papyrine.llm.scratch import write_and_read

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (3, 4)
SAMPLE_PER_LANGUAGE = 1000  # labelled rows used for training, in expectation
SAMPLE_ROWS = 10_000  # the same over all languages, which then share them evenly
SAMPLE_CHARS = 20_000  # longer texts are not trained on, which bounds the sample in bytes
LEAST_ROWS = 20  # a label of fewer rows is not learned, unless a hundredth of the labelled rows have it
_TASKS = 2048  # that machines are dealt over at most

# Families of languages by code. A language that is not here is a family by itself.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "indo-iranian": "bn fa gu hi ku mr ne pa ps ur",
    "turkic": "az kk ky tr tt uz",
    "uralic": "et fi hu",
    "austronesian": "id jv mg ms su tl",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def _folding() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    letters = ((table >= 97) & (table <= 122)) | (table >= 128)
    table[65:91] += 32
    letters[65:91] = True
    table[~letters] = 32
    return table


_FOLD = _folding()


def _places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the strings at all places of texts in lower case with a space on either side, and where texts begin."""
    sizes = np.diff(offsets) + 2
    begins = np.append(0, np.cumsum(sizes))
    folded = np.full(begins[-1], 32, np.uint8)
    inner = np.ones(len(folded), bool)
    inner[begins[:-1]] = inner[begins[1:] - 1] = False
    folded[inner] = _FOLD[data]
    accented = (folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (folded[:-1] == 0xC3)
    folded[1:][accented] += 32  # capital letters of Latin-1
    codes = folded.astype(np.uint32)
    buckets = []
    for order in ORDERS:
        value = np.zeros(len(codes), np.uint32)
        for step in range(min(order, len(codes))):
            value[: len(codes) - step] = value[: len(codes) - step] * np.uint32(0x01000193) + codes[step:]
        value = (value + np.uint32(order)) * np.uint32(0x9E3779B1) >> np.uint32(16)
        buckets.append(value)
    return np.stack(buckets), begins


def _mean_weights(data: np.ndarray, offsets: np.ndarray, place: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """Mean of each machine's weights (by the place of a bucket) over the places of each text."""
    buckets, begins = _places(data, offsets)
    total = np.zeros((len(offsets) - 1, len(weights)))
    count = np.zeros(len(offsets) - 1)
    for order, row in zip(ORDERS, place[buckets], strict=True):
        ends = np.maximum(begins[1:] - order + 1, begins[:-1])  # strings do not reach into the next text
        for machine, own in enumerate(weights):
            running = np.append(0.0, np.cumsum(own[row], dtype=np.float64))
            total[:, machine] += running[ends] - running[begins[:-1]]
        count += ends - begins[:-1]
    return total / np.maximum(count, 1)[:, None]


@dataclass
class Machines:
    """Linear machines of all pairs of some labels; margins above 0 speak for a pair's first label."""

    labels: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # machine x place of a bucket; the last place is that of buckets never seen
    bias: np.ndarray
    slope: np.ndarray

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        """Label probabilities: each machine's say, turned into a probability, averaged over a label's machines."""
        result = np.zeros((len(means), len(self.labels)))
        if not self.pairs:
            return np.ones_like(result)
        for machine, (first, second) in enumerate(self.pairs):
            say = 1 / (1 + np.exp(-np.clip(self.slope[machine] * (means[:, machine] + self.bias[machine]), -30, 30)))
            result[:, first] += say
            result[:, second] += 1 - say
        return result / result.sum(axis=1, keepdims=True) if len(self.pairs) > 1 else result

    def certainties(self, means: np.ndarray) -> np.ndarray:
        """The least that any of a label's machines says for it: its probability against its closest rival, 1 if it has none.

        Shares of all votes shrink with the number of labels, this does not."""
        result = np.ones((len(means), len(self.labels)))
        for machine, (first, second) in enumerate(self.pairs):
            say = 1 / (1 + np.exp(-np.clip(self.slope[machine] * (means[:, machine] + self.bias[machine]), -30, 30)))
            result[:, first] = np.minimum(result[:, first], say)
            result[:, second] = np.minimum(result[:, second], 1 - say)
        return result


def _train_pair(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, rounds: int = 30, gap: float = 0.01) -> tuple[np.ndarray, float, float]:
    """Weights, bias and slope of one machine: dual coordinate descent for the L2-regularised hinge loss, until no coordinate
    is off by more than `gap`, then a logistic curve through its margins. Classes weigh the same in both.

    Each row is the numbers of its features, below `size`, and their values."""
    balance = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    alpha, w, bias = np.zeros(len(y)), np.zeros(size), 0.0
    norms = np.array([values @ values + 1 for _, values in rows])
    order = np.random.default_rng(5)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(y)):
            at, values = rows[i]
            gradient = y[i] * (values @ w[at] + bias) - 1
            fresh = min(max(alpha[i] - gradient / norms[i], 0.0), balance[i])
            step = fresh - alpha[i]
            if step:
                worst = max(worst, abs(step) * norms[i])
                w[at] += step * y[i] * values
                bias += step * y[i]
                alpha[i] = fresh
        if worst <= gap:
            break
    margin, slope = np.array([values @ w[at] for at, values in rows]) + bias, 1.0
    target = np.where(y > 0, 0.98, 0.02)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))
        curve = (balance * p * (1 - p) * margin**2).sum() + 1e-6
        slope = min(max(slope + (balance * (target - p) * margin).sum() / curve, 0.1), 20.0)
    return w, float(bias), slope


def _train_machine(rows: pd.DataFrame) -> pd.DataFrame:
    """One machine from the texts of its two sides: its buckets with their weights, its bias and slope."""
    rows = rows.sort_values(["side", "text"])
    counted = [_relative_counts(text) for text in rows["text"]]
    buckets, number = np.unique(np.concatenate([found for found, _ in counted]), return_inverse=True)
    mean = np.bincount(number, np.concatenate([part for _, part in counted]), len(buckets)) / len(counted)
    scale = 1 / np.sqrt(mean + 1 / BUCKETS)  # frequent strings count less; those in hardly any text do not count more
    ends = np.cumsum([len(found) for found, _ in counted])
    vectors = [(number[end - len(part) : end], part * scale[number[end - len(part) : end]]) for (_, part), end in zip(counted, ends, strict=True)]
    weights, bias, slope = _train_pair(vectors, rows["side"].to_numpy(float), len(buckets))
    result = [(int(rows["machine"].iloc[0]), buckets.astype(np.int32), (weights * scale).astype(np.float32), bias, slope)]
    return pd.DataFrame(result, columns=["machine", "buckets", "weights", "bias", "slope"])


@dataclass
class LanguageModel:
    """Machines between families, and those within each family, with the place of each bucket in their weights."""

    families: Machines
    languages: dict[str, Machines]
    place: np.ndarray

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str | None], np.ndarray]:
        """The language of each text and how certain it is; UNDETERMINED and 0 for texts without a letter.

        The certainty is that of the family times that of the language within it, each against the closest rival."""
        groups = [self.families, *self.languages.values()]
        means = _mean_weights(data, offsets, self.place, [row for g in groups for row in g.weights])
        cuts = np.cumsum([0, *(len(g.weights) for g in groups)])
        parts = [g.probabilities(means[:, a:b]) for g, a, b in zip(groups, cuts[:-1], cuts[1:], strict=True)]
        sure = [g.certainties(means[:, a:b]) for g, a, b in zip(groups, cuts[:-1], cuts[1:], strict=True)]
        top = parts[0].argmax(axis=1)
        names, scores = [], np.zeros(len(means))
        lettered = _has_letter(data, offsets)
        for i, family in enumerate(top):
            if not lettered[i]:
                names.append(UNDETERMINED)
                continue
            group = 1 + list(self.languages).index(self.families.labels[family])
            inner = int(parts[group][i].argmax())
            names.append(self.languages[self.families.labels[family]].labels[inner])
            scores[i] = sure[0][i, family] * sure[group][i, inner]
        return names, scores


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letters = np.append(0, np.cumsum((_FOLD[data] != 32) & (data < 128)))
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return found


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: the crc32 of the doc_id as text is divisible by 5. Null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _relative_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    buckets, _ = _places(data, np.array([0, len(data)]))
    rows = [row[: max(len(row) - order + 1, 0)] for order, row in zip(ORDERS, buckets, strict=True)]
    found, count = np.unique(np.concatenate(rows), return_counts=True)
    return found, count / max(count.sum(), 1)


def _labels(usable: DataFrame, least_rows: int) -> dict[str, int]:
    """Rows of each label that has at least `least_rows`, or a hundredth of all."""
    counts = write_and_read(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language_rows")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {row["lang"]: row["n"] for row in counts.filter((F.col("n") >= least_rows) | (F.col("n") * 100 >= total)).collect()}


def train(
    docs: DataFrame,
    per_language: int = SAMPLE_PER_LANGUAGE,
    longest: int = SAMPLE_CHARS,
    sample_rows: int = SAMPLE_ROWS,
    least_rows: int = LEAST_ROWS,
) -> LanguageModel:
    """Train on the text and lang of rows that have both, and a doc_id that is not held out.

    The sample is bounded: about `per_language` rows of each language, and `sample_rows` of all, chosen by a hash of doc_id,
    with texts of at most `longest` code points. A label of fewer than `least_rows` rows and less than a hundredth of the
    labelled ones is taken for a slip and not learned. A table without labelled rows gives a model that knows no language
    but UNDETERMINED. Each pair of labels is a Spark task; the driver gets a weight for each bucket that a pair has met,
    65,536 at most.
    """
    spark = docs.sparkSession
    usable = docs.select("doc_id", "text", "lang").filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.char_length("text") <= longest)
    )
    counts = _labels(usable, least_rows)
    groups: dict[str | None, list[str]] = {None: sorted({family_of(lang) for lang in counts})}  # None: the families themselves
    for family in groups[None]:
        groups[family] = sorted(lang for lang in counts if family_of(lang) == family)
    machines = [(group, *pair) for group, labels in groups.items() for pair in combinations(labels, 2)]
    sides = [  # (lang, machine, side): whose rows a machine learns from
        (lang, number, side)
        for number, (group, *pair) in enumerate(machines)
        for label, side in zip(pair, (1, -1), strict=True)
        for lang in (groups[label] if group is None else [label])
    ]
    found, place, used = {}, np.zeros(BUCKETS, np.int32), np.zeros(0, int)
    if machines:
        scale, quota = 1 << 30, max(min(per_language, sample_rows // len(counts)), 1)
        shares = F.create_map([F.lit(x) for lang, n in counts.items() for x in (lang, min(scale, scale * quota // n))])
        chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < shares[F.col("lang")])  # null where a label is not learned
        sample = write_and_read(chosen.select("lang", "text"), "language_sample")
        dealt = sample.join(spark.createDataFrame(sides, "lang string, machine int, side int"), "lang").drop("lang")
        dealt = dealt.repartition(min(8 * len(machines), _TASKS), "machine")
        schema = "machine int, buckets array<int>, weights array<float>, bias double, slope double"
        trained = dealt.groupBy("machine").applyInPandas(_train_machine, schema).toPandas()  # bounded by the number of pairs
        found = {row.machine: row for row in trained.itertuples()}
        used = np.unique(np.concatenate([row.buckets for row in found.values()])).astype(int)
        place[:] = len(used)
        place[used] = np.arange(len(used))

    def machines_of(group: str | None) -> Machines:
        own = [found.get(number) for number, machine in enumerate(machines) if machine[0] == group]
        weights = np.zeros((len(own), len(used) + 1), np.float32)
        for row, machine in zip(weights, own, strict=True):
            if machine is not None:
                row[place[machine.buckets]] = machine.weights
        bias, slope = ([getattr(x, name) if x is not None else 0.0 for x in own] for name in ("bias", "slope"))
        pairs = list(combinations(range(len(groups[group])), 2))
        return Machines(groups[group], pairs, weights, np.array(bias), np.array(slope))

    if not counts:
        groups = {None: [UNDETERMINED], UNDETERMINED: [UNDETERMINED]}
    return LanguageModel(machines_of(None), {family: machines_of(family) for family in groups[None]}, place)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of `docs` with lang_pred and score (0 to 1).

    Null texts and those without a letter are UNDETERMINED with score 0. Only the text is looked at; equal texts get equal
    results. Columns named lang_pred or score are replaced; an empty table stays empty.
    """
    kept = docs.drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*kept.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            names, scores = model.predict(*flat(batch.column("text")))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)

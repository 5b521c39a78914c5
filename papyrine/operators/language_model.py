"""An n-gram language model of a collection: modified Kneser-Ney smoothing, interpolated, in packed tables.

A text is its words, `order` - 1 begin marks before them and an end mark after them. The longest n-grams are counted by how
often they occur, shorter ones by the number of different words that come before them. From each count a discount is
taken, which depends on whether the count is 1, 2 or more and is estimated from how many n-grams have counts 1 to 4; what
a context's discounts leave goes to the next shorter n-grams, and at last in equal parts to all words and an unknown one.

n-grams are dealt into buckets by their last word but one. All their contexts end with it and all shorter n-grams but single
words hold it, so a bucket knows what its n-grams need except the probabilities of single words. n-grams of a word that is
too frequent for one task are sliced by the word before it; the counts of its pairs of words are kept for all slices.

Nearly all n-grams of a collection are different, so tables of them are larger than the texts. They move and are stored in packed
form: words are 64-bit hashes, the `COMMON` most frequent ones numbers of two bytes, the n-grams of a block are sorted and
compressed. Two of ten million different words share a hash (63 bits count) with a chance of 1 in 180,000. Documents are scored in parts of
the buckets, one after the other, and each part's shuffle files are given up before the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.operators.scoring import WORD
from papyrine.sources.tables import materialize

ORDER = 3
# No word is written like these.
BEGIN, END = "<s>", "</s>"
COMMON = 65_535  # most frequent words, which have numbers and whose probabilities go to all tasks
BLOCK = 1 << 20  # words or n-grams that a task works on at once
# Scoring keeps the n-grams of one part of the buckets on disk at a time. Of many buckets, a block's n-grams are short runs, which
# compress less and share fewer documents, so there are more parts; not in proportion, as each part reads all packed texts.
PARTS, MANY, PARTS_OF_MANY = 4, 256, 6

_RARE = np.int64(-(2**63))  # codes of words without a number have this bit, so they are negative
_PACKED = "bucket int, slice int, kind int, payload binary"
_COUNTS, _PAIRS, _GRAMS, _RUNS, _WORDS, _TEXTS = range(6)  # kinds of packed rows


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What counts of 1, 2, and 3 or more lose, from the numbers of n-grams that occur 1 to 4 times.

    Where too few n-grams tell, or one would not lie between 0 and its count, they are 0.5, 1 and 1.5.
    """
    if n1 and n2 and n3:
        share = n1 / (n1 + 2 * n2)
        found = 1 - 2 * share * n2 / n1, 2 - 3 * share * n3 / n2, 3 - 4 * share * n4 / n3
        if all(0 < d < k for k, d in enumerate(found, 1)):
            return found
    return 0.5, 1.0, 1.5


@dataclass
class Model:
    """`grams`: packed n-grams with their counts; `words`: code, p of the words without a number."""

    order: int
    common: np.ndarray  # hashes of the most frequent words, by their numbers
    splits: np.ndarray  # slices of the words that have several, by their numbers
    buckets: int
    grams: DataFrame
    words: DataFrame
    likely: np.ndarray  # p of the words with numbers
    lost: dict[int, tuple[float, float, float]]  # by length
    unknown: float  # probability of a word that does not occur


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _marked(df: DataFrame, text: str, order: int, doc: Column) -> DataFrame:
    """_doc and _words, the hashes of a text's words and marks; a null text has no row."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    begin, end = F.array(*[F.xxhash64(F.lit(BEGIN))] * (order - 1)).cast("array<long>"), F.array(F.xxhash64(F.lit(END)))
    return df.filter(F.col(text).isNotNull()).select(doc.alias("_doc"), F.concat(begin, _hashes(words), end).alias("_words"))


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Whole numbers, compressed: of each array its length, least value and the bytes of the differences to it, in planes."""
    parts = []
    for values in arrays:
        least = values.min() if len(values) else 0
        above = values.astype(np.uint64) - np.array(least).astype(np.uint64)
        width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(above) or int(above.max()) < 1 << 8 * w)
        planes = above.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
        parts += [np.array([len(values), least, width], "<i8").tobytes(), planes.tobytes()]
    data = b"".join(parts)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(payload: pa.Buffer) -> list[np.ndarray]:
    size = int.from_bytes(payload[:8].to_pybytes(), "little")
    data, at, arrays = pa.decompress(payload[8:], size, codec="zstd"), 0, []
    while at < size:
        rows, least, width = (int(x) for x in np.frombuffer(data, "<i8", 3, at))
        planes = np.frombuffer(data, np.uint8, rows * width, at + 24).reshape(width, rows)
        above = np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(rows).astype(np.uint64)
        arrays.append((above + np.array(least).astype(np.uint64)).astype(np.int64))
        at += 24 + rows * width
    return arrays


def _pack_words(columns: list[np.ndarray], *others: np.ndarray) -> bytes:
    """Columns of codes, each as numbers and the codes of words without one."""
    split = [part for codes in columns for part in (np.where(codes < 0, COMMON, codes), codes[codes < 0])]
    return _pack([*split, *others])


def _unpack_words(payload: pa.Buffer, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    arrays, columns = _unpack(payload), []
    for i in range(order):
        codes, rare = arrays[2 * i], arrays[2 * i + 1]
        codes[codes == COMMON] = rare
        columns.append(codes)
    return columns, arrays[2 * order :]


def _mixed(codes: np.ndarray, among: np.ndarray | int) -> np.ndarray:
    """A number below `among` for each code, by nothing but the code."""
    spread = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    spread = (spread ^ (spread >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((spread >> np.uint64(32)).astype(np.int64)) % among


class _Coder:
    """Words as codes: the number of a common word, else its hash."""

    def __init__(self, common: np.ndarray):
        self.number = np.argsort(common, kind="stable")
        self.known = common[self.number]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        codes = hashes | _RARE
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
            codes = np.where(self.known[at] == hashes, self.number[at], codes)
        return codes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(_doc, _words) in blocks of at least `BLOCK` words but the last: documents, their lengths, all words."""
    held, size = [], 0
    for batch in batches:
        docs, lists, first = batch.column("_doc").to_numpy(zero_copy_only=False), batch.column("_words"), 0
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        words, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
        while first < len(docs):
            begin = ends[first - 1] if first else 0
            last = min(int(np.searchsorted(ends, begin + BLOCK - size)) + 1, len(docs))
            held.append((docs[first:last], lengths[first:last], words[begin : ends[last - 1]]))
            size += int(ends[last - 1] - begin)
            first = last
            if size >= BLOCK:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _same_as_before(columns: list[np.ndarray]) -> np.ndarray:
    """For rows in order, whether each equals the one before it."""
    same = np.zeros(len(columns[0]), bool)
    if len(same):
        same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return same


def _different(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, and how often each occurs."""
    values = np.sort(values)
    heads = np.flatnonzero(~_same_as_before([values]))
    return values[heads], np.diff(np.append(heads, len(values)))


def _order(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """The order of rows by columns of numbers below `sizes`; as many columns as fit are sorted as one number."""
    keys, room = [], 0
    for column, size in zip(columns, sizes, strict=True):
        bits = max(int(size) - 1, 1).bit_length()
        if bits <= room:
            keys[-1] = keys[-1] << bits | column
            room -= bits
        else:
            keys.append(column.astype(np.int64))
            room = 63 - bits
    return np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])


def _find(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The place of each value in an array in order without repeats, or -1."""
    if not len(among):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


def _rare(columns: list[np.ndarray]) -> np.ndarray:
    return _different(np.concatenate([c[c < 0] for c in columns]))[0]


def _ids(codes: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Numbers of words: those of common ones, after them places among `rare`, or -1. They are in the order of the codes without sign."""
    ids = codes.copy()
    at = np.flatnonzero(codes < 0)
    found = _find(codes[at], rare)
    ids[at] = np.where(found >= 0, found + COMMON, -1)
    return ids


def _codes(rare: np.ndarray) -> np.ndarray:
    """The words that have the numbers of `_ids`."""
    return np.concatenate([np.arange(COMMON), rare])


def _merged(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Different n-grams in order of their last context, and the sums of their counts."""
    rare = _rare(columns)
    ids = [_ids(c, rare) for c in columns]
    order = _order([*ids[-2::-1], ids[-1]], [COMMON + len(rare)] * len(ids))
    columns, n = [c[order] for c in columns], n[order]
    heads = np.flatnonzero(~_same_as_before(columns))
    return [c[heads] for c in columns], np.add.reduceat(n, heads) if len(heads) else n


def _coded(coder: _Coder):
    """A function for mapInArrow: from (_doc, _words), packed blocks of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, lengths, hashes in _blocks(batches):
            yield _rows([(-1, -1, _TEXTS, _pack_words([coder(hashes)], lengths, docs))])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for *_, payload in _groups(batches):
        (words,), (lengths, docs) = _unpack_words(payload, 1)
        yield docs, lengths, words


def _dealt(coder: _Coder | None, splits: np.ndarray, order: int, buckets: int, part: int, parts: int, counted: bool):
    """A function for mapInArrow: from (_doc, _words), or packed texts without a coder, packed n-grams of the buckets of a part.

    If `counted`, they are the different n-grams of a block with their counts, else all, with their documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _texts(batches) if coder is None else ((docs, lengths, coder(hashes)) for docs, lengths, hashes in _blocks(batches))
        for docs, lengths, words in coded:
            rare = _rare([words])
            ids, codes = _ids(words, rare), _codes(rare)
            bucket_of, size = _mixed(codes, buckets), len(codes)
            place = np.empty(size, np.int64)
            place[np.argsort(bucket_of * 2 + (np.arange(size) < len(splits)), kind="stable")] = np.arange(size)  # by buckets, words with slices last
            last = np.ones(len(words), bool)
            begins = np.cumsum(lengths) - lengths
            for i in range(order - 1):
                last[(begins + i)[lengths > i]] = False
            last = np.flatnonzero(last)
            by = ids[last - min(order - 1, 1)]
            if parts > 1:
                mine = np.flatnonzero((bucket_of % parts == part)[by])
                last, by = last[mine], by[mine]
            number = np.zeros(len(last), np.int64)
            if order > 2 and len(splits):
                often = np.flatnonzero(by < len(splits))
                number[often] = 1 + _mixed(words[last[often] - 2], splits[by[often]])
            context = [ids[last - i] for i in range(2, order)]
            sort = _order([place[by], number, *context, ids[last]], [size, int(splits.max(initial=0)) + 1, *[size] * max(order - 1, 1)])
            last = last[sort]
            target = bucket_of[by[sort]] << 32 | number[sort]
            columns = [words[last - i] for i in range(order - 1, -1, -1)]
            if counted:
                heads = np.flatnonzero(~_same_as_before([target, *columns]))
                others = [np.diff(np.append(heads, len(target)))]
                target, columns = target[heads], [c[heads] for c in columns]
            else:
                others = [np.searchsorted(begins, last, "right") - 1]
            ends = np.append(np.flatnonzero(target[1:] != target[:-1]) + 1, len(target)) if len(target) else []
            rows, first = [], 0
            for end in ends:
                kept = [x[first:end] for x in others]
                if not counted:
                    kept = _documents(docs[kept[0]])
                payload = _pack_words([c[first:end] for c in columns], *kept)
                rows.append((int(target[first]) >> 32, int(target[first]) & 0xFFFFFFFF, _GRAMS if counted else _RUNS, payload))
                first = end
            yield _rows(rows)

    return run


def _documents(docs: np.ndarray) -> list[np.ndarray]:
    """Documents as the steps between the different ones, and the place of each among them."""
    different, place = np.unique(docs, return_inverse=True)
    return [np.diff(different, prepend=np.int64(0)), place]


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = [("bucket", pa.int32()), ("slice", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, pa.Buffer]]:
    for batch in batches:
        bucket, part, kind, payload = (batch.column(name) for name in ("bucket", "slice", "kind", "payload"))
        for i in range(batch.num_rows):
            yield bucket[i].as_py(), part[i].as_py(), kind[i].as_py(), payload[i].as_buffer()


def _firsts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values in order, a place of each, and how often it occurs."""
    order = np.argsort(values)
    values = values[order]
    heads = np.flatnonzero(~_same_as_before([values]))
    return values[heads], order[heads], np.diff(np.append(heads, len(values)))


class _Counted:
    """Different n-grams, as `_merged` has them, and all shorter ones down to pairs: contexts, and counts by length.

    `pairs` (word, next word, count) replaces the counts of pairs where the n-grams are only a slice of those that hold them.
    """

    def __init__(self, columns: list[np.ndarray], n: np.ndarray, pairs: list[np.ndarray] | None = None):
        order, more = len(columns), pairs[:2] if pairs else []
        self.rare = _rare([*columns, *more])
        self.size = COMMON + len(self.rare)
        ids, more = [_ids(c, self.rare) for c in columns], [_ids(c, self.rare) for c in more]
        self.contexts, self.grams, self.n, self.context_of, context = {}, {}, {}, {}, {}
        new = np.zeros(len(n), bool)
        for length in range(2, order + 1):
            new |= ~_same_as_before([columns[-length]])
            if length == 2:
                self.contexts[2] = _different(np.concatenate([ids[-2][new], *more[:1]]))[0]
                self.place = np.full(self.size, -1)
                self.place[self.contexts[2]] = np.arange(len(self.contexts[2]))
                context[2] = self.place[ids[-2]]
            else:
                self.contexts[length] = (context[length - 1] * self.size + ids[-length])[new]
                context[length] = np.cumsum(new) - 1
        rows = np.arange(len(n))
        for length in range(order, 1, -1):
            if length == 2 and pairs:
                at, n = self.place[more[0]], pairs[2]
                self.grams[2], sort, _ = _firsts(at * self.size + more[1])
                self.context_of[2], self.n[2] = at[sort], n[sort]
                continue
            self.grams[length], heads, counts = _firsts((context[length] * self.size + ids[-1])[rows])
            self.n[length] = n[rows][heads] if length == order else counts
            rows = rows[heads]
            self.context_of[length] = context[length][rows]

    def pairs(self) -> list[np.ndarray]:
        """Word, next word and count."""
        codes = _codes(self.rare)
        return [codes[self.contexts[2][self.context_of[2]]], codes[self.grams[2] % self.size], self.n[2]]

    def shares(self, lost: dict[int, tuple[float, float, float]]) -> None:
        """What each n-gram keeps, and each context hands on, as shares of the context's total."""
        self.kept, self.handed = {}, {}
        for length, n in self.n.items():
            taken = np.array(lost[length])[np.minimum(n, 3) - 1] if len(n) else np.zeros(0)
            at, contexts = self.context_of[length], len(self.contexts[length])
            total = np.bincount(at, n, contexts)
            self.kept[length] = (n - taken) / total[at]
            with np.errstate(invalid="ignore"):
                self.handed[length] = np.where(total > 0, np.bincount(at, taken, contexts) / total, 1.0)

    def weights(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For n-grams: what longer ones than single words give, and the share of the last word's own probability."""
        order, rows = len(columns), len(columns[0])
        given, share = np.zeros(rows), np.ones(rows)
        if order == 1:
            return given, share
        ids = [_ids(c, self.rare) for c in columns]
        found = {2: np.where(ids[-2] >= 0, self.place[ids[-2]], -1)}
        for length in range(3, order + 1):
            valid = (ids[-length] >= 0) & (found[length - 1] >= 0)
            found[length] = np.where(valid, _find(found[length - 1] * self.size + ids[-length], self.contexts[length]), -1)
        for length in range(order, 1, -1):
            context = found[length]
            at = np.where((context >= 0) & (ids[-1] >= 0), _find(context * self.size + ids[-1], self.grams[length]), -1)
            if len(self.kept[length]):
                given += share * np.where(at >= 0, self.kept[length][at], 0.0)
            if len(self.handed[length]):
                share = share * np.where(context >= 0, self.handed[length][context], 1.0)
        return given, share


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, hashes in _blocks(batches):
        words, n = _different(hashes)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n, pa.int64())], ["word", "n"])


def _counting(order: int):
    """A function for mapInArrow: packed n-grams of whole buckets, counted, and what their shorter ones add up to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_counts = np.zeros((order + 1, 4), np.int64)
        held, size, at, sliced = [], 0, None, []

        def collapse():
            nonlocal held, size
            columns, n = _merged([np.concatenate(c) for c in zip(*(x for x, _ in held), strict=True)], np.concatenate([n for _, n in held]))
            held, size = [(columns, n)], len(n)
            return columns, n

        def tally(length: int, n: np.ndarray):
            of_counts[length] += np.bincount(np.minimum(n, 5), minlength=6)[1:5]

        def singles(pairs: list[np.ndarray]) -> tuple:
            words, n = _different(pairs[1])
            return at[0], -1, _WORDS, _pack_words([words], n)

        def end_of_slice() -> list[tuple]:
            nonlocal held, size, sliced
            columns, n = collapse()
            held, size = [], 0
            counted = _Counted(columns, n)
            for length in range(2 if at[1] == 0 else 3, order + 1):
                tally(length, counted.n[length])
            rows = [(*at, _GRAMS, _pack_words(columns, n))]
            if at[1] == 0:
                return [*rows, singles(counted.pairs())]
            word, following, times = counted.pairs()
            found, times = _merged([word, following], times) if not sliced else _merged([np.concatenate(x) for x in zip(sliced[:2], (word, following), strict=True)], np.concatenate([sliced[2], times]))
            sliced = [*found, times]
            return rows

        def end_of_bucket() -> list[tuple]:
            nonlocal sliced
            if not sliced:
                return []
            pairs, sliced = sliced, []
            tally(2, pairs[2])
            return [(at[0], -1, _PAIRS, _pack_words(pairs[:2], pairs[2])), singles(pairs)]

        for bucket, part, _, payload in _groups(batches):
            if at is not None and at != (bucket, part):
                rows = end_of_slice()
                yield _rows(rows + end_of_bucket() if at[0] != bucket else rows)
            at = bucket, part
            columns, (n,) = _unpack_words(payload, order)
            held.append((columns, n))
            size += len(n)
            if size > 2 * BLOCK and len(held) > 1:
                collapse()
        if at is not None:
            yield _rows(end_of_slice() + end_of_bucket())
            yield _rows([(-1, -1, _COUNTS, _pack([of_counts.ravel()]))])

    return run


def _unpacked_singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for *_, payload in _groups(batches):
        (words,), (n,) = _unpack_words(payload, 1)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], ["word", "n"])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.to_numpy(), np.int64) if len(column) else np.zeros(0, np.int64)


def train(df: DataFrame, text: str = "ocr_text", order: int = ORDER) -> Model:
    """The model of all texts of `df`. The longest n-grams are dealt into buckets once, and all shorter ones counted there."""
    marked = _marked(df, text, order, F.lit(0).cast("long"))
    words = marked.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(words, "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    top = words.orderBy(F.desc("n"), "word").limit(COMMON).toArrow()
    common, times = _numbers(top["word"]), _numbers(top["n"])
    buckets = max(1, -(-total // BLOCK))
    splits = -(-times[times > BLOCK] // BLOCK)
    coder = _Coder(common)

    lost: dict[int, tuple[float, float, float]] = {}
    if order == 1:
        grams = df.sparkSession.createDataFrame([], _PACKED)
        recoded = words.mapInArrow(_recoded(coder), "word long, n long")
    else:
        dealt = marked.mapInArrow(_dealt(coder, splits, order, buckets, 0, 1, True), _PACKED)
        grams = materialize(_by_bucket(dealt, buckets).mapInArrow(_counting(order), _PACKED), "ngrams")
        counts = [_unpack(pa.py_buffer(row.payload))[0] for row in grams.filter(F.col("kind") == _COUNTS).select("payload").toLocalIterator()]
        of_counts = sum(counts, np.zeros(4 * (order + 1), np.int64)).reshape(-1, 4)
        lost = {k: discounts(*(int(x) for x in of_counts[k])) for k in range(2, order + 1)}
        recoded = grams.filter(F.col("kind") == _WORDS).mapInArrow(_unpacked_singles, "word long, n long")
    singles = materialize(recoded.groupBy("word").agg(F.sum("n").alias("n")), "words")

    counts = singles.agg(F.count(F.lit(1)), F.sum("n"), *(F.count_if(F.col("n") == i) for i in (1, 2, 3, 4))).first()
    kinds, total = counts[0], counts[1]
    none = singles.select("word", F.lit(0.0).alias("p"))
    if not kinds:
        return Model(order, common, splits, buckets, grams, none, np.ones(len(common)), lost, 1.0)
    lost[1] = discounts(*counts[2:])
    taken = F.when(F.col("n") == 1, lost[1][0]).when(F.col("n") == 2, lost[1][1]).otherwise(lost[1][2])
    unknown = singles.agg(F.sum(taken)).first()[0] / total / (kinds + 1)
    known = singles.select("word", ((F.col("n") - taken) / total + unknown).alias("p"))
    numbered = known.filter("word >= 0").toArrow()
    likely = np.full(len(common), unknown)
    likely[_numbers(numbered["word"])] = numbered["p"].to_numpy()
    return Model(order, common, splits, buckets, grams, known.filter("word < 0"), likely, lost, unknown)


def _recoded(coder: _Coder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(coder(batch.column("word").to_numpy())), batch.column("n")], ["word", "n"])

    return run


def _by_bucket(packed: DataFrame, buckets: int) -> DataFrame:
    """Each bucket in one task, slice by slice, and in a slice the model's rows first."""
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "slice", "kind")


_SCORED = "word long, doc long, n long, given double, share double"


def _scoring(order: int, lost: dict[int, tuple[float, float, float]], likely: np.ndarray):
    """A function for mapInArrow: from a model's and documents' packed n-grams, sums of logarithms by document.

    They are in `given`, without a word. n-grams that end with a word without a number have a row each: its probability comes later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, size, at, pairs, held, counted = [], 0, None, None, [], None

        def summed() -> pa.RecordBatch:
            docs, place = np.unique(np.concatenate([s[0] for s in sums]), return_inverse=True)
            n = np.bincount(place, np.concatenate([s[1] for s in sums])).astype(np.int64)
            logs = np.bincount(place, np.concatenate([s[2] for s in sums]))
            return _scored(None, docs, n, logs, None)

        for bucket, part, kind, payload in _groups(batches):
            if at != (bucket, part):
                if at is None or at[0] != bucket:
                    pairs = None
                at, held, counted = (bucket, part), [], None
            if kind == _PAIRS:
                following, (times,) = _unpack_words(payload, 2)
                pairs = [*following, times]
            elif kind == _GRAMS:
                held.append(_unpack_words(payload, order))
            elif kind == _RUNS:
                columns, (steps, place) = _unpack_words(payload, order)
                if counted is None:
                    model = [np.concatenate(c) for c in zip(*(x for x, _ in held), strict=True)] if held else [np.zeros(0, np.int64)] * order
                    n = np.concatenate([n for _, (n,) in held]) if held else np.zeros(0, np.int64)
                    held, counted = [], _Counted(model, n, pairs if part else None)
                    counted.shares(lost)
                docs = np.cumsum(steps)
                given, share = counted.weights(columns)
                rare = np.flatnonzero(columns[-1] < 0)
                if len(rare):
                    yield _scored(columns[-1][rare], docs[place[rare]], np.ones(len(rare), np.int64), given[rare], share[rare])
                often = np.flatnonzero(columns[-1] >= 0)
                if len(often):
                    logs = np.log(given[often] + share[often] * likely[columns[-1][often]])
                    n = np.bincount(place[often], minlength=len(docs))
                    some = np.flatnonzero(n)
                    sums.append((docs[some], n[some], np.bincount(place[often], logs, len(docs))[some]))
                    size += len(some)
                    if size > BLOCK:
                        yield summed()
                        sums, size = [], 0
        if sums:
            yield summed()

    return run


def _scored(words, docs, n, given, share) -> pa.RecordBatch:
    rows = len(docs)
    words = pa.nulls(rows, pa.int64()) if words is None else pa.array(words)
    share = pa.nulls(rows, pa.float64()) if share is None else pa.array(share)
    return pa.RecordBatch.from_arrays([words, pa.array(docs), pa.array(n), pa.array(given), share], ["word", "doc", "n", "given", "share"])


def _log_sums(marked: DataFrame, model: Model) -> DataFrame:
    """doc, n and log_p, the sum over the n-grams of (_doc, _words). Packed texts stay on disk, and of a part one row for each document."""
    texts = materialize(marked.mapInArrow(_coded(_Coder(model.common)), _PACKED), "texts")
    parts, done = min(PARTS if model.buckets < MANY else PARTS_OF_MANY, model.buckets), []
    for part in range(parts):
        runs = texts.mapInArrow(_dealt(None, model.splits, model.order, model.buckets, part, parts, False), _PACKED)
        grams = model.grams.filter(F.col("kind").isin(_PAIRS, _GRAMS) & (F.col("bucket") % parts == part))
        both = _by_bucket(grams.unionByName(runs), -(-model.buckets // parts))
        scored = both.mapInArrow(_scoring(model.order, model.lost, model.likely), _SCORED)
        # Rows without a word are dealt by their documents, so that they do not meet in one task.
        scored = scored.withColumn("_at", F.coalesce("word", "doc"))
        known = model.words.select(F.col("word").alias("_word"), "p")
        joined = scored.join(known, (F.col("_at") == F.col("_word")) & F.col("word").isNotNull(), "left")
        log_p = F.when(F.col("word").isNull(), F.col("given")).otherwise(F.ln(F.col("given") + F.col("share") * F.coalesce("p", F.lit(model.unknown))))
        sums = joined.groupBy("doc").agg(F.sum("n").alias("n"), F.sum(log_p).alias("log_p"))
        done.append(materialize(sums, "scored"))
    return reduce(DataFrame.unionByName, done).groupBy("doc").agg(F.sum("n").alias("n"), F.sum("log_p").alias("log_p"))


def log_probabilities(runs: DataFrame, model: Model) -> DataFrame:
    """w1 to w`order` and `log_p` of the different n-grams of `runs`.

    The probability is that of the longest n-gram that occurs, times what the contexts above it hand on.
    """
    words = [f"w{i + 1}" for i in range(model.order)]
    different = materialize(runs.select(*words).distinct().withColumn("_doc", F.monotonically_increasing_id()), "runs")
    sums = _log_sums(different.select("_doc", _hashes(F.array(*words)).alias("_words")), model)
    return different.join(sums, different["_doc"] == sums["doc"]).select(*words, "log_p")


def _numbered(df: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """The different keys of `df` with `_doc`, a number of their own each, and that number as a column of `df`."""
    kind, ways = df.schema[key].dataType, [F.xxhash64(F.lit(seed), F.col(key)) for seed in range(8)]
    if isinstance(kind, T.IntegralType):
        ways.insert(0, F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))))
    keys = materialize(df.select(key).distinct(), "keys")
    for way in ways:
        numbered = keys.withColumn("_doc", way)
        if numbered.groupBy("_doc").count().filter("count > 1").isEmpty():
            return numbered, way
    raise ValueError(f"values of {key} share numbers")


def perplexity(df: DataFrame, model: Model, key: str = "pdf_path", text: str = "ocr_text") -> DataFrame:
    """`key`, `words` (with the end mark) and `perplexity` of each document; nulls for a null text.

    The perplexity is the inverse of the geometric mean of the words' probabilities: the lower, the more the text is like
    those of the collection. Packed n-grams of documents are shuffled to the buckets of the model, where they are summed per
    document; only those that end with a word beyond the common ones move once more, to its probability. Rows that share a key
    are one document.
    """
    keys, doc = _numbered(df, key)
    sums = _log_sums(_marked(df, text, model.order, doc), model)
    sums = sums.select("doc", F.col("n").alias("words"), F.exp(-F.col("log_p") / F.col("n")).alias("perplexity"))
    return keys.join(sums, keys["_doc"] == sums["doc"], "left").select(keys[key], "words", "perplexity")

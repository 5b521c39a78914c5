"""Documents that hold test items, also with their sentences in another order: greedy string tiling.

Documents and items meet at seeds, equal runs of a few words found by a rolling Karp-Rabin hash. For each document and item
that share enough seeds, the longest common run of words not yet covered is covered again and again, and the share of the item
that ends up covered decides. Runs of any length are compared by hashes from running sums, so the time follows the words on both
sides and not the pairs of places where a seed is repeated. Items are read in parts of bounded size, each of which goes to all tasks, so a test set of any
size takes one pass over the documents per part and no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.arrays import distinct, flat, is_space, text_slices

SEED_WORDS = 5  # shortest tile
THRESHOLD = 0.5  # share of an item's words that must be covered
PART_CHARS = 8_000_000  # of items that go to the tasks at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NOT_WORD = re.compile(r"[\W_]+")


def _piece_hashes(piece: bytes) -> list[int]:
    """Of the words in a piece between white space: lower case, without signs."""
    return [xxhash.xxh64_intdigest(word) for word in _NOT_WORD.split(piece.decode().lower()) if word]


class WordHashes:
    """Numbers for the words of texts; every different piece is looked at once while it is known."""

    def __init__(self) -> None:
        self._known: dict[bytes, list[int]] = {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts = np.union1d(np.flatnonzero(is_space(data)), heads)
        pieces, codes = distinct(data, starts)
        if len(self._known) > 300_000:
            self._known = {}
        for piece in pieces:
            if piece not in self._known:
                self._known[piece] = _piece_hashes(piece)
        found = [self._known[piece] for piece in pieces]
        size = np.array([len(x) for x in found], int)
        if not size.sum():
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        flat_hashes = np.array([h for x in found for h in x], np.uint64)
        place, each = np.cumsum(size) - size, size[codes]
        before = np.append(0, np.cumsum(each))
        order = np.repeat(place[codes] - before[:-1], each) + np.arange(before[-1])
        return flat_hashes[order], before[np.searchsorted(starts, offsets)]


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of the run of `width` words at each place."""
    n = len(words) - width + 1
    value = np.zeros(max(n, 0), np.uint64)
    for step in range(width if n > 0 else 0):
        value = value * _BASE + words[step : step + n]
    return value


class Runs:
    """Words with Karp-Rabin hashes of their runs of any length, each from two running sums.

    A run's hash is the sum of its words times rising powers of an odd base, modulo 2^64."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.append(np.uint64(1), np.full(len(words), _BASE)))
            self._sums = np.append(np.uint64(0), np.cumsum(words * powers[:-1]))
            self._back = np.cumprod(np.append(np.uint64(1), np.full(len(words), _INVERSE)))

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        return (self._sums[at + length] - self._sums[at]) * self._back[at]


@dataclass
class Items:
    """Words of test items end to end, and the places of each different seed in order of its hash."""

    ids: list
    runs: Runs
    begins: np.ndarray
    seeds: np.ndarray  # different hashes in order
    first: np.ndarray  # where the places of each seed begin, and their end
    places: np.ndarray
    seed_at: np.ndarray  # number of the seed at each place
    width: int

    @staticmethod
    def of(ids: list, texts: list[str | None], width: int) -> Items:
        words, begins = WordHashes()(*flat(pa.array(texts, pa.string())))
        width = min([width, *np.diff(begins)[np.diff(begins) > 0].tolist()]) if len(words) else width
        found = rolling(words, width)
        place = np.arange(len(found))
        item = np.searchsorted(begins, place, side="right") - 1
        place = place[place + width <= begins[item + 1]]
        seeds, number = np.unique(found[place], return_inverse=True)
        order = np.argsort(number, kind="stable")
        seed_at = np.full(len(words), -1)
        seed_at[place] = number
        first = np.append(0, np.cumsum(np.bincount(number, minlength=len(seeds))))
        return Items(ids, Runs(words), begins, seeds, first, place[order], seed_at, width)

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `words` where a seed of some item begins, and the number of that seed."""
        found = rolling(words, self.width)
        number = np.minimum(np.searchsorted(self.seeds, found), max(len(self.seeds) - 1, 0))
        here = np.flatnonzero(self.seeds[number] == found) if len(self.seeds) else np.zeros(0, int)
        return here, number[here]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each low to below its high, one range after the other."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


class _Open:
    """Places where seeds begin, in order, each with the end of the run of uncovered words that it is in."""

    def __init__(self, at: np.ndarray, end: int) -> None:
        self.at, self.stop = at, np.full(len(at), end)

    def keep(self, least: int) -> None:
        kept = self.stop - self.at >= least
        self.at, self.stop = self.at[kept], self.stop[kept]

    def longest(self) -> int:
        return int((self.stop - self.at).max(initial=0))

    def of_length(self, length: int) -> np.ndarray:
        return self.at[self.stop - self.at >= length]

    def is_free(self, begin: int, length: int) -> bool:
        i = np.searchsorted(self.at, begin)
        return bool(self.stop[i] - begin >= length)

    def cover(self, begin: int, length: int) -> None:
        before, inside, after = np.searchsorted(self.at, [begin, begin, begin + length])
        cut = np.searchsorted(self.stop[:before], begin, side="right")  # stops rise with their places
        self.stop[cut:before] = begin
        self.stop[inside:after] = self.at[inside:after]


def _meet(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether an element of `b` is in `a`."""
    few = np.sort(b)
    found = few[np.minimum(np.searchsorted(few, a), len(few) - 1)] if len(few) else few
    return bool(len(few) and len(a) and (found == a).any())


def _tile(text: Runs, own: _Open, item: Runs, other: _Open, least: int) -> list[tuple[int, int, int]]:
    """Tiles from the open places of both sides; what is covered is taken off them.

    Each round finds the greatest length at which open runs of both sides have an equal hash, by bisection, as the beginnings
    of equal runs are equal. It then covers the runs of that length, which are compared word by word. A round takes
    time in proportion to the places on both sides, never to their product, and lengths fall from round to round."""
    tiles = []
    most = min(own.longest(), other.longest())
    while most >= least:
        low, high, probe = least - 1, most, most  # the longest first: whole items are what is found most
        while low < high:
            a, b = own.of_length(probe), other.of_length(probe)
            if _meet(text.hashes(a, probe), item.hashes(b, probe)):
                low = probe
            else:
                high = probe - 1
            probe = (low + high + 1) // 2
        if low < least:
            break
        tiles += _cover(text, own, item, other, low)
        own.keep(least)
        other.keep(least)
        most = min(low - 1, own.longest(), other.longest())
    return tiles


def _cover(text: Runs, own: _Open, item: Runs, other: _Open, length: int) -> list[tuple[int, int, int]]:
    """Cover equal runs of a length, the first in the item and then in the text first."""
    at, item_at = own.of_length(length), other.of_length(length)
    found, wanted = text.hashes(at, length), item.hashes(item_at, length)
    order = np.argsort(found, kind="stable")
    found, at = found[order], at[order]
    tiles, tried = [], {}  # what is covered once stays covered: places of a hash are passed over once
    low, high = np.searchsorted(found, wanted, side="left"), np.searchsorted(found, wanted, side="right")
    for i in np.flatnonzero(low < high):
        b, i_low, i_high = int(item_at[i]), int(low[i]), int(high[i])
        if not other.is_free(b, length):
            continue
        begin = tried.get(i_low, i_low)
        while begin < i_high and not own.is_free(int(at[begin]), length):
            begin += 1
        tried[i_low] = begin
        for a in map(int, at[begin:i_high]):
            equal = own.is_free(a, length) and np.array_equal(text.words[a : a + length], item.words[b : b + length])
            if equal:
                own.cover(a, length)
                other.cover(b, length)
                tiles.append((a, b, length))
                break
    return tiles


def tile(text: np.ndarray, item: np.ndarray, at: np.ndarray, item_at: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seeds: (place in text, place in item, length) of tiles, longest first.

    `at` and `item_at` are the places where a run of `least` words begins that the other side holds. Tiles overlap
    neither in the text nor in the item; of equally long ones the first in the item, then in the text, goes in.
    """
    own, other = _Open(np.unique(at), len(text)), _Open(np.unique(item_at), len(item))
    return _tile(Runs(text), own, Runs(item), other, least)


def _overlaps(words: np.ndarray, items: Items, threshold: float) -> list[tuple[int, float, int, int]]:
    """Items covered by a text: number, coverage, tiles, longest tile.

    A seed's places are kept once for the text and once for the items. Items whose words under seeds of the text are
    less than the threshold are out before any tile is looked for, as tiles cover no other words."""
    at, seed = items.hits(words)
    if not len(at):
        return []
    order = np.argsort(seed, kind="stable")
    at, seed = at[order], seed[order]
    shared = seed[np.append(True, seed[1:] != seed[:-1])]
    place = np.sort(items.places[_ranges(items.first[shared], items.first[shared + 1])])
    number = np.searchsorted(items.begins, place, side="right") - 1
    heads = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    ends = np.append(heads[1:], len(place))
    step = np.append(np.minimum(np.diff(place), items.width), items.width)
    step[ends - 1] = items.width  # the last seed of an item is whole
    reach = np.add.reduceat(step, heads)
    numbers = number[heads]
    sizes = items.begins[numbers + 1] - items.begins[numbers]
    result, text = [], None
    for i in np.flatnonzero(reach / sizes >= threshold):
        text = text or Runs(words)
        item_at = place[heads[i] : ends[i]]
        seeds = np.unique(items.seed_at[item_at])
        low, high = np.searchsorted(seed, seeds, side="left"), np.searchsorted(seed, seeds, side="right")
        own = _Open(np.sort(at[_ranges(low, high)]), len(words))
        tiles = _tile(text, own, items.runs, _Open(item_at, items.begins[numbers[i] + 1]), items.width)
        coverage = sum(length for _, _, length in tiles) / sizes[i]
        if tiles and coverage >= threshold:
            result.append((int(numbers[i]), float(coverage), len(tiles), tiles[0][2]))
    return result


def _parts(items: DataFrame, seed_words: int, part_chars: int) -> Iterator[Items]:
    """The items in parts of about `part_chars` characters; the parts are read one after the other."""
    texts = items.select("item_id", "text").filter(F.length("text") > 0)
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // part_chars)
    for part in range(count):
        rows = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == part).toArrow()  # bounded
        ids, own = rows.column("item_id").to_pylist(), rows.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, own[i]))
        yield from _by_length([ids[i] for i in order], [own[i] for i in order], seed_words)


def _by_length(ids: list, texts: list[str], seed_words: int) -> Iterator[Items]:
    """Items shorter than a seed are looked for as a whole, so those of each such length go by themselves."""
    length = np.array([len(WordHashes()(*flat(pa.array([text])))[0]) for text in texts], int)
    for width in sorted({min(int(n), seed_words) for n in length if n}):
        own = [i for i, n in enumerate(length) if n and min(n, seed_words) == width]
        yield Items.of([ids[i] for i in own], [texts[i] for i in own], width)


def find_overlaps(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, seed_words: int = SEED_WORDS, part_chars: int = PART_CHARS) -> DataFrame:
    """Pairs of documents and test items of which the document covers at least `threshold`.

    Returns doc_id, item_id, coverage (share of the item's words in tiles of at least `seed_words` words), n_tiles and
    longest. Words are runs of letters and digits in lower case. Items of fewer words than a seed count if they occur as a
    whole. Null and empty texts on either side give no pairs; repeated rows give repeated pairs; ties are broken by place.
    """
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (items, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, coverage double, n_tiles int, longest int"
    result = docs.sparkSession.createDataFrame([], schema)
    for part in _parts(items, seed_words, part_chars):
        shared = docs.sparkSession.sparkContext.broadcast(part)  # of bounded size
        item_type = pa.array(part.ids).type if any(x is not None for x in part.ids) else pa.int64()

        def run(batches: Iterator[pa.RecordBatch], shared=shared, item_type=item_type) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in text_slices(batches):
                words, begins = hashes(*flat(batch.column("text")))
                rows = [
                    (row, shared.value.ids[number], *rest)
                    for row in range(batch.num_rows)
                    for number, *rest in _overlaps(words[begins[row] : begins[row + 1]], shared.value, threshold)
                ]
                if rows:
                    row, ids, coverage, tiles, longest = zip(*rows, strict=True)
                    columns = [batch.column("doc_id").take(pa.array(row)), pa.array(ids, item_type), pa.array(coverage)]
                    columns += [pa.array(tiles, pa.int32()), pa.array(longest, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "coverage", "n_tiles", "longest"])

        result = result.union(docs.select("doc_id", "text").mapInArrow(run, schema))
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, seed_words: int = SEED_WORDS, part_chars: int = PART_CHARS) -> DataFrame:
    """The rows of `docs`, all columns, that cover `threshold` of no item. See `find_overlaps`."""
    for part in _parts(items, seed_words, part_chars):
        shared = docs.sparkSession.sparkContext.broadcast(part)  # of bounded size

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in text_slices(batches):
                words, begins = hashes(*flat(batch.column("text")))
                clean = [not _overlaps(words[a:b], shared.value, threshold) for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

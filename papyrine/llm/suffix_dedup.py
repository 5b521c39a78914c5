"""Byte strings that occur more than once in a corpus, found through longest-previous-factor arrays.

A suffix array of all texts would be sorted on one machine. Here suffixes are first dealt into buckets: the smallest hash
of the 32-byte strings in a window of `length` bytes is its anchor, so equal windows have equal anchors at the same place.
Consecutive windows with one anchor form a context, the anchor's surroundings, of which a text has about one per 85 bytes.

1. Contexts are counted by anchor. An anchor that occurs once has nothing to offer, which most do not survive.
2. Equal contexts are one class, whatever their number. An anchor with one class is settled: all its windows repeat.
3. The suffixes of the other anchors' classes are sorted within each anchor. In suffix order, the previous and the next
   suffix with a smaller position share the longest prefixes that begin earlier; the longer is the longest previous factor.
   A window with a factor of `length` bytes has an earlier copy, and that copy a later one.
   An anchor with very many classes is not sorted in one task: parts of its contexts are grouped by hash instead.
4. What a class has found goes back to all its contexts, and runs of bytes are cut from the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.arrays import flat, text_slices, with_row_key
from papyrine.llm.scratch import write_and_read

ANCHOR = 32
LONGEST = 4096  # largest `length`
LARGE_BUCKET = 1500  # classes of one anchor that are sorted in one task
CHUNK = 8  # windows of larger buckets that are compared at once
BLOCK = 1 << 19  # bytes hashed at once
_RANDOM = np.random.default_rng(1)
_SEEDS = _RANDOM.integers(0, 1 << 63, 256, np.int64).astype(np.uint64)
_BASE = np.uint64(int(_RANDOM.integers(1 << 62, 1 << 63)) | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE_BITS = np.uint64(20)  # a block's positions fit in so many bits


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]), dtype=np.uint64)


class _Hashes:
    """Hashes of any byte ranges of a block, from sums over its beginning parts."""

    def __init__(self, data: np.ndarray, powers: np.ndarray, inverse: np.ndarray):
        self._sums = np.append(np.uint64(0), np.cumsum(_SEEDS[data] * powers[: len(data)], dtype=np.uint64))
        self._inverse = inverse

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def of_width(self, width: int) -> np.ndarray:
        sums = self._sums
        return _mixed((sums[width:] - sums[:-width]) * self._inverse[: len(sums) - width])


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(31))
    value = value * np.uint64(0x9E3779B97F4A7C15)
    return value ^ (value >> np.uint64(29))


@lru_cache(maxsize=1)
def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    size = BLOCK + 4 * LONGEST
    return _powers(_BASE, size), _powers(_INVERSE, size)


def contexts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts in texts end to end: hash of the anchor, hash of the context, first window, windows.

    A context of n windows that begins at s covers the bytes from s to s + n + length - 1. Blocks overlap, and a context is
    cut where a block ends only if that does not depend on the block: blocks are cut between contexts.
    """
    powers, inverses = _power_tables()
    span = length - ANCHOR + 1
    first = 0
    while first + length <= len(data):
        block = data[first : first + BLOCK + 2 * length]
        if len(block) < length:
            return
        hashes = _Hashes(block, powers, inverses)
        keys = (hashes.of_width(ANCHOR) >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(block) - ANCHOR + 1, dtype=np.uint64)
        reach, smallest = 1, keys
        while 2 * reach <= span:
            smallest = np.minimum(smallest[:-reach], smallest[reach:])
            reach *= 2
        if reach < span:
            smallest = np.minimum(smallest[: len(smallest) - (span - reach)], smallest[span - reach :])
        anchors = (smallest & np.uint64((1 << 20) - 1)).astype(np.int64)  # of the window at each place
        place = np.arange(len(anchors))
        text = np.searchsorted(offsets, place + first, side="right") - 1
        fits = place + first + length <= offsets[text + 1]
        head = np.ones(len(anchors), bool)
        head[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]) | (fits[1:] != fits[:-1])
        begins = np.flatnonzero(head)
        ends = np.append(begins[1:], len(anchors))
        final = first + len(block) == len(data)
        if not final:  # the last context may go on; it is found again in the next block
            begins, ends = begins[:-1], ends[:-1]
        kept = fits[begins]
        b, e = begins[kept], ends[kept]
        if len(b):
            anchor = anchors[b]
            yield hashes(anchor, anchor + ANCHOR), hashes(b, e + length - 1), b + first, e - b
        if final:
            return
        first += int(ends[-1]) if len(ends) else 1


def _count_contexts(docs: DataFrame, length: int) -> DataFrame:
    """Anchors that occur more than once: anchor, and `mixed` if their contexts differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for anchor, context, *_ in contexts(*flat(batch.column("text")), length):
                anchor, context = anchor.view(np.int64), context.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(context)], names=["anchor", "context"])

    found = docs.select("text").mapInArrow(run, "anchor long, context long")
    totals = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.min("context").alias("_low"), F.max("context").alias("_high"))
    return totals.filter("_n > 1").select("anchor", (F.col("_low") != F.col("_high")).alias("mixed"))


def _place_contexts(keyed: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            data, offsets = flat(batch.column("text"))
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for anchor, context, start, windows in contexts(data, offsets, length):
                text = np.searchsorted(offsets, start, side="right") - 1
                arrays = [anchor.view(np.int64), context.view(np.int64), keys[text], start - offsets[text]]
                arrays = [pa.array(x, pa.int64()) for x in arrays]
                arrays.append(pa.array(windows, pa.int16()))
                yield pa.RecordBatch.from_arrays(arrays, names=_PLACED)

    return keyed.select("row_key", "text").mapInArrow(run, "anchor long, context long, row_key long, start long, windows short")


_PLACED = ["anchor", "context", "row_key", "start", "windows"]


def _context_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As in `contexts`; a stretch of the text at a time, as the tables of powers end."""
    powers, inverses = _power_tables()
    result = np.zeros(len(starts), np.int64)
    stretch = starts // BLOCK
    for part in np.unique(stretch):
        here, first = stretch == part, part * BLOCK
        hashes = _Hashes(text[first : first + len(powers)], powers, inverses)
        result[here] = hashes(starts[here] - first, ends[here] - first).view(np.int64)
    return result


def _held(text: bytes, rows: list[dict], length: int) -> list[dict]:
    """Those of the wanted contexts that this text holds; texts may share a row_key."""
    starts = np.array([row["start"] for row in rows], np.int64)
    ends = starts + [row["windows"] + length - 1 for row in rows]
    own = ends <= len(text)
    if own.any():
        own[own] = _context_hashes(np.frombuffer(text, np.uint8), starts[own], ends[own]) == np.array([row["context"] for row in rows])[own]
    return [row for row, held in zip(rows, own, strict=True) if held]


def longest_previous_factors(suffixes: list[bytes]) -> tuple[list[int], list[int]]:
    """For suffixes in order of position: the longest prefix each shares with an earlier one, and with a later one.

    Suffixes are given up to the length that matters, and prefixes shorter than that count as 0."""
    n = len(suffixes)
    order = sorted(range(n), key=suffixes.__getitem__)  # equal ones stay in order of position
    ordered = [suffixes[i] for i in order]
    shared = [0, *(len(left) if left == right else 0 for left, right in zip(ordered, ordered[1:]))]
    backwards = sorted(range(n), key=lambda i: suffixes[n - 1 - i])
    return _factors(order, shared), _factors(backwards, shared)[::-1]


def _factors(order: list[int], shared: list[int]) -> list[int]:
    """Longest common prefix with a smaller position, from the nearest smaller values on both sides in suffix order."""
    n = len(order)
    best = [0] * n
    stack: list[tuple[int, int]] = []  # positions with the prefix shared from each to the one above it
    for place in range(n + 1):
        position, reach = (order[place], shared[place]) if place < n else (-1, 0)
        while stack and stack[-1][0] > position:
            top, below = stack.pop()
            best[top] = max(best[top], reach, below)  # next smaller value, previous smaller value
            reach = min(reach, below)
        stack.append((position, reach))
    return best


def _settle_bucket(rows: list[dict], length: int) -> list[tuple[int, int, bytes, bytes]]:
    """anchor, context, and bits for each window of each class: occurs in another class; begins earlier in another class."""
    rows.sort(key=lambda row: (row["row_key"], row["start"]))
    windows = [row["bytes"][i : i + length] for row in rows for i in range(row["windows"])]
    earlier, later = longest_previous_factors(windows)
    result, place = [], 0
    for row in rows:
        own = slice(place, place + row["windows"])
        old = np.array(earlier[own]) >= length
        both = old | (np.array(later[own]) >= length)
        result.append((row["anchor"], row["context"], np.packbits(both).tobytes(), np.packbits(old).tobytes()))
        place += row["windows"]
    return result


_SETTLED = "anchor long, context long, repeats binary, follows binary"


def _settle_small(classes: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: list[dict] = []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if bucket and bucket[0]["anchor"] != row["anchor"]:
                    found += _settle_bucket(bucket, length)
                    bucket = []
                bucket.append(row)
            yield _settled(found)
        if bucket:
            yield _settled(_settle_bucket(bucket, length))

    return classes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _SETTLED)


def _settled(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["anchor", "context", "repeats", "follows"])


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _anchor_place(data: bytes, length: int) -> int:
    """Where the anchor begins in a context; as in `contexts`."""
    hashes = _Hashes(np.frombuffer(data[:length], np.uint8), *_power_tables()).of_width(ANCHOR)
    return int(np.argmin(hashes >> _PLACE_BITS))


def _rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


_CHUNK_ROW = pa.schema(
    [("anchor", pa.int64()), ("context", pa.int64()), ("row_key", pa.int64()), ("at", pa.int64()), ("window", pa.int32())]
    + [("n", pa.int32()), ("place", pa.int32()), ("core", pa.binary()), ("full", pa.binary()), ("part", pa.binary())]
)
_WINDOW_ROW = pa.schema([*list(_CHUNK_ROW)[:5], ("place", pa.int32()), ("hash", pa.binary())])


def _settle_large(classes: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many classes, dealt out by parts of contexts instead of by anchor.

    Windows can only be equal at the same distance from the anchor. CHUNK windows at fixed distances have a core in common:
    if no other class has the core, none of them repeats. If another class has the whole chunk, all of them do, and all but
    the first such class need no closer look. What is left, mostly where a passage ends, is compared window by window.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                data, n, before = row["bytes"], row["windows"], _anchor_place(row["bytes"], length)
                for place in range(-before // CHUNK, (n - 1 - before) // CHUNK + 1):
                    head = place * CHUNK + before  # the chunk's first window, if the context has it
                    first, last = max(head, 0), min(head + CHUNK, n)
                    core = _digest(data[head + CHUNK - 1 : head + length])
                    full = _digest(data[head : head + CHUNK + length - 1]) if last - first == CHUNK else None
                    key = (row["anchor"], row["context"], row["row_key"], row["start"] + first, first, last - first, place)
                    rows.append((*key, core, full, data[first : last + length - 1]))
            yield _rows_to_batch(rows, _CHUNK_ROW)

    schema = "anchor long, context long, row_key long, at long, window int, n int, place int, core binary, full binary, part binary"
    chunks = write_and_read(classes.mapInArrow(cut, schema), "chunks")
    here, same = F.struct("row_key", "at"), ["anchor", "place"]
    cores = chunks.groupBy(*same, "core").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    fulls = chunks.filter("full IS NOT NULL").groupBy(*same, "full").agg(F.min(here).alias("_first"), F.count(F.lit(1)).alias("_holders"))
    live = write_and_read(chunks.join(cores, [*same, "core"]).join(fulls, [*same, "full"], "left"), "chunks")
    copied = F.coalesce(F.col("_first") < here, F.lit(False))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                key = row["anchor"], row["context"], row["row_key"]
                for i in range(row["n"]):
                    rows.append((*key, row["at"] + i, row["window"] + i, row["place"], _digest(row["part"][i : i + length])))
            yield _rows_to_batch(rows, _WINDOW_ROW)

    schema = "anchor long, context long, row_key long, at long, window int, place int, hash binary"
    single = write_and_read(live.filter(~copied).drop("core", "full", "_first", "_holders").mapInArrow(windows, schema), "windows")
    groups = single.groupBy(*same, "hash").agg(F.count(F.lit(1)).alias("_n"), F.min(here).alias("_first")).filter("_n > 1")
    repeated = single.join(groups, [*same, "hash"]).select("anchor", "context", "window", F.lit(1).alias("n"), (F.col("_first") < here).alias("follows"))
    whole = live.filter("_holders > 1").select("anchor", "context", "window", "n", copied.alias("follows"))
    mark = F.struct("window", "n", "follows")
    listed = repeated.union(whole).groupBy("anchor", "context").agg(F.collect_list(mark).alias("marks"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                bits = np.zeros((2, length), bool)
                for mark in row["marks"]:
                    own = slice(mark["window"], mark["window"] + mark["n"])
                    bits[0, own] = True
                    bits[1, own] |= mark["follows"]
                rows.append((row["anchor"], row["context"], np.packbits(bits[0]).tobytes(), np.packbits(bits[1]).tobytes()))
            yield _settled(rows)

    return listed.mapInArrow(pack, _SETTLED)


def _settle(keyed: DataFrame, placed: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Classes with their first place and number, and the bits of those whose anchor has several classes."""
    place = F.struct("row_key", "start")
    classes = write_and_read(
        placed.groupBy("anchor", "context")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.first("windows").alias("windows"), F.first("mixed").alias("mixed"))
        .select("anchor", "context", "n", "first.row_key", "first.start", "windows", "mixed"),
        "classes",
    )
    mixed = classes.filter("mixed").select("anchor", "context", "row_key", "start", "windows")
    wanted = mixed.groupBy("row_key").agg(F.collect_list(F.struct("anchor", "context", "start", "windows")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for text, key, wanted in zip(*(batch.column(x) for x in ("text", "row_key", "wanted")), strict=True):
                text = (text.as_py() or "").encode()
                rows = _held(text, wanted.as_py(), length)
                cut = [text[row["start"] : row["start"] + row["windows"] + length - 1] for row in rows]
                columns = [[row[x] for row in rows] for x in ("anchor", "context", "start", "windows")]
                arrays = [pa.array(x, t) for x, t in zip(columns, [*[pa.int64()] * 3, pa.int16()], strict=True)]
                arrays += [pa.array([key.as_py()] * len(rows), pa.int64()), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "start", "windows", "row_key", "bytes"])

    schema = "anchor long, context long, start long, windows short, row_key long, bytes binary"
    texts = keyed.select("row_key", "text").join(wanted, "row_key").mapInArrow(fetch, schema)
    sizes = mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("_classes"))
    sized = write_and_read(texts.dropDuplicates(["anchor", "context"]).join(sizes, "anchor"), "contexts")
    small = _settle_small(sized.filter(F.col("_classes") <= LARGE_BUCKET).drop("_classes"), length)
    large = _settle_large(sized.filter(F.col("_classes") > LARGE_BUCKET).drop("_classes"), length)
    return classes, write_and_read(small.union(large), "factors")


def remove_repeated(docs: DataFrame, length: int = 200, keep_first: bool = False) -> DataFrame:
    """Texts less the bytes that strings of `length` bytes cover which also begin anywhere else.

    Texts are UTF-8 bytes (null: empty), strings do not cross rows, overlaps count, and all is judged on the input. With
    `keep_first` the first copy of each string stays: only strings with an earlier copy are removed, where order is that of
    doc_id (rows without one: a hash of their text) and place. Returns doc_id, kept (binary), n_bytes, n_removed and n_spans
    (runs removed). Repeated rows are copies like any other; of rows that share a doc_id, `keep_first` takes the first text
    it meets. An empty table gives no rows; columns besides doc_id and text are not looked at.
    """
    keyed = with_row_key(docs).withColumn("row_key", F.col("row_key").cast("long"))
    if not ANCHOR < length <= LONGEST:
        raise ValueError(f"length must be above {ANCHOR} and at most {LONGEST}")
    anchors = _count_contexts(keyed, length)
    placed = write_and_read(_place_contexts(keyed, length).join(anchors, "anchor"), "repeats")
    classes, factors = _settle(keyed, placed, length)
    first = F.struct(F.col("_c.row_key"), F.col("_c.start"))
    found = (
        placed.alias("_p")
        .join(classes.alias("_c"), ["anchor", "context"])
        .join(factors, ["anchor", "context"], "left")
        .select(
            F.col("_p.row_key").alias("row_key"),
            F.struct(
                F.col("_p.start").alias("start"),
                F.col("_p.windows").alias("windows"),
                F.col("context"),
                (F.col("n") > 1).alias("again"),
                (first < F.struct(F.col("_p.row_key"), F.col("_p.start"))).alias("copy"),
                "repeats",
                "follows",
            ).alias("mark"),
        )
    )
    useful = F.expr("mark.again OR mark.repeats IS NOT NULL")
    marks = found.filter(useful).groupBy("row_key").agg(F.collect_set("mark").alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            data, offsets = flat(batch.column("text"))
            lists = batch.column("marks")
            values, begins = lists.values, lists.offsets.to_numpy()
            rows = []
            for i, (a, b) in enumerate(zip(begins[:-1], begins[1:], strict=True)):
                rows.append(_cut(data[offsets[i] : offsets[i + 1]], values.slice(a, b - a), length, keep_first))
            columns = list(zip(*rows, strict=True))
            arrays = [batch.column("doc_id"), pa.array(columns[0], pa.binary()), *(pa.array(x, pa.int64()) for x in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = keyed.join(marks, "row_key", "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(cut, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long")


def _cut(text: np.ndarray, marks: pa.StructArray, length: int, keep_first: bool) -> tuple[bytes, int, int, int]:
    change = np.zeros(len(text) + 1, np.int32)
    start, windows, context, again, copy = (
        marks.field(name).to_numpy(zero_copy_only=False) for name in ("start", "windows", "context", "again", "copy")
    )
    end = start + windows + length - 1
    own = end <= len(text)  # else, or with another hash, it belongs to another text of the same doc_id
    own[own] = _context_hashes(text, start[own], end[own]) == context[own]
    whole = own & (copy | (again & (not keep_first)))
    np.add.at(change, start[whole], 1)
    np.add.at(change, end[whole], -1)
    bits = marks.field("follows" if keep_first else "repeats")
    for i in np.flatnonzero(own & ~whole & bits.is_valid().to_numpy(zero_copy_only=False)):
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bits[i].as_py(), np.uint8))[: windows[i]])
        np.add.at(change, start[i] + found, 1)
        np.add.at(change, start[i] + found + length, -1)
    gone = np.cumsum(change)[:-1] > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return text[~gone].tobytes(), len(text), int(gone.sum()), runs

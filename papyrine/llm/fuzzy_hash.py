"""Fingerprints of documents that change little when part of a text changes: context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a chunk wherever it falls below a threshold, so chunk borders depend on what
stands around them and not on the position. Each chunk leaves one of 64 characters. The threshold halves from level to
level; a document takes the first level with at most 64 borders, and its fingerprint `level:signature:signature` holds the
signatures of this level and the next. Two fingerprints are compared by the edit distance of signatures of one level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm.arrays import flat, text_slices
from papyrine.llm.scratch import write_and_read

SEEN_BYTES = 7
MOST_BORDERS = 64
FIRST_SHARE = 4  # at level 0 one byte in four ends a chunk
BLOCK = 4 << 20
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_TABLES = np.random.default_rng(10).integers(0, 1 << 32, (SEEN_BYTES, 256), np.uint64).astype(np.uint32)


def _rolling(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Hash of the bytes up to SEEN_BYTES back, each position; bytes before a head in `heads` do not count.

    `data` must begin at a head or with SEEN_BYTES - 1 bytes of context."""
    value = np.zeros(len(data), np.uint32)
    for back, table in enumerate(_TABLES[: len(data)]):
        value[back:] += table[data[: len(data) - back]]
    for after in range(SEEN_BYTES - 1):  # the first bytes of a text have seen less
        at = heads + after
        at = at[at < len(data)]
        part = np.zeros(len(at), np.uint32)
        for back in range(after + 1):
            part += _TABLES[back][data[at - back]]
        next_head = np.searchsorted(heads, at, side="right") - 1
        own = heads[next_head] == at - after  # else a shorter text ended before
        value[at[own]] = part[own]
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x2C1B3C6D)
    value ^= value >> np.uint32(12)
    return value


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Fingerprints of texts given as bytes end to end. Works on whole texts, a block of bytes at a time."""
    sizes = np.diff(offsets)
    first_level = np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / (2 * FIRST_SHARE * MOST_BORDERS)))).astype(np.int64)
    limit = ((1 << 32) // FIRST_SHARE) >> first_level
    heads = offsets[:-1][sizes > 0]
    places, hashes, sums, total = [], [], [], np.uint64(0)
    end_sums = np.zeros(len(offsets), np.uint64)  # sum of all hashes before each text begins
    for first in range(0, len(data), BLOCK):
        last, context = min(first + BLOCK, len(data)), min(first, SEEN_BYTES - 1)
        inside = heads[(heads >= first - 2 * SEEN_BYTES) & (heads < last)] - (first - context)
        rolled = _rolling(data[first - context : last], inside[inside >= 0])[context:]
        a, b = np.searchsorted(offsets, [first, last], side="right")
        edges = np.clip(offsets[a - 1 : b + 1], first, last)
        limits = np.repeat(limit[a - 1 : a - 1 + len(edges) - 1], np.diff(edges))
        found = np.flatnonzero(rolled < limits)
        running = np.cumsum(rolled, dtype=np.uint64) + total
        places.append(found + first)
        hashes.append(rolled[found])
        sums.append(running[found])
        here = np.flatnonzero((offsets > first) & (offsets <= last))
        end_sums[here] = running[offsets[here] - 1 - first]
        total = running[-1]
    empty = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint64)]
    place, value, running = (np.concatenate(x or y) for x, y in zip((places, hashes, sums), empty, strict=True))
    slices = np.searchsorted(place, offsets)
    return [
        _one(value[a:b], running[a:b], end_sums[i], end_sums[i + 1], int(first_level[i]), bool(b > a and place[b - 1] + 1 == offsets[i + 1]), sizes[i] > 0)
        for i, (a, b) in enumerate(zip(slices[:-1], slices[1:], strict=True))
    ]


def _one(value: np.ndarray, running: np.ndarray, start: np.uint64, end: np.uint64, level: int, closed: bool, some: bool) -> str:
    """`closed`: the text ends with a border, so nothing is left for a last chunk."""
    limit = ((1 << 32) // FIRST_SHARE) >> level
    keep = value < limit
    while keep.sum() > MOST_BORDERS:
        level, limit = level + 1, limit >> 1
        keep = value < limit
    parts = []
    for bound in (limit, limit >> 1):
        keep = value < bound
        sums = np.concatenate([[start], running[keep], [] if not some or (closed and keep[-1]) else [end]]).astype(np.uint64)
        chunks = (np.diff(sums) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
        parts.append(_LETTERS[chunks.astype(np.int64)].tobytes().decode())
    return f"{level}:{parts[0]}:{parts[1]}"


def edit_distances(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Levenshtein distances of many short pairs, all at once."""
    rows, columns = max(map(len, left), default=0), max(map(len, right), default=0)
    a, b = np.zeros((len(left), rows), np.uint8), np.zeros((len(right), columns), np.uint8)
    for table, texts in ((a, left), (b, right)):
        for i, text in enumerate(texts):
            table[i, : len(text)] = np.frombuffer(text, np.uint8)
    a_size, b_size = np.array([*map(len, left)], int), np.array([*map(len, right)], int)
    steps = np.arange(columns + 1, dtype=np.int16)
    line = np.tile(steps, (len(left), 1))
    result = line[np.arange(len(left)), b_size].copy()
    for i in range(rows):
        fresh = np.empty_like(line)
        fresh[:, 0] = i + 1
        fresh[:, 1:] = np.minimum(line[:, 1:] + 1, line[:, :-1] + (b != a[:, i : i + 1]))
        line = np.minimum.accumulate(fresh - steps, axis=1) + steps
        done = np.flatnonzero(a_size == i + 1)
        result[done] = line[done, b_size[done]]
    return result.astype(np.int64)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: 1 less the edit distance over the longer length, at a level both have.

    Without a common level it is 0; equal fingerprints give 1."""
    pairs, places = [], []
    result = np.zeros(len(left))
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        (p, p0, p1), (q, q0, q1) = x.split(":"), y.split(":")
        step = int(p) - int(q)
        if abs(step) <= 1:
            pairs.append((p0, q0) if step == 0 else (p0, q1) if step == 1 else (p1, q0))
            places.append(i)
    a, b = [x.encode() for x, _ in pairs], [y.encode() for _, y in pairs]
    longest = np.array([max(len(x), len(y), 1) for x, y in pairs], float)
    if pairs:
        result[places] = 1 - edit_distances(a, b) / longest
    return result


def add_fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of each text (null: empty), row by row and without a shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            prints = pa.array(fingerprints(*flat(batch.column("text"))), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FIRST, _LAST, _DONE = 0, 1, 2


def _compare(texts: list[str], following: list[str]) -> list[list]:
    """Columns of the result for texts and the text that follows each."""
    cut = [len(text) // 3 for text in texts]
    edited = [text[: len(text) - n] + after[:n] for text, after, n in zip(texts, following, cut, strict=True)]
    own, new, nxt = (fingerprints(*flat(pa.array(x, pa.string()))) for x in (texts, edited, following))
    digests = [hashlib.sha256(text.encode()).hexdigest() for text in edited]
    return [[len(text) for text in texts], digests, own, new, likeness(own, new), likeness(own, nxt)]


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of an edited version of it, and how alike they are.

    The edit replaces the last third of the code points by as many of the next document's, in descending order of doc_id
    (after the last comes the first; a document alone follows itself). Ties are ordered by a hash of the text, rows without
    a doc_id come last, null texts are empty, other columns are not looked at, an empty table gives no rows. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    Texts are range-partitioned once. Only the last row of each range needs a text from elsewhere, so the first and last
    rows of the ranges, two for each, are joined afterwards.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.col("_hash")]
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = (
        chosen.withColumn("_hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carry = TaskContext.get().partitionId(), None
        for batch in text_slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            kept_type = batch.schema.field("doc_id").type
            if carry is None:
                yield _batch(kept_type, part, _FIRST, ids[:1], None, texts[:1])
            else:
                ids, texts = [carry[0], *ids], [carry[1], *texts]
            if len(ids) > 1:
                yield _batch(kept_type, part, _DONE, ids[:-1], _compare(texts[:-1], texts[1:]), None)
            carry = ids[-1], texts[-1]
        if carry is not None:
            yield _batch(kept_type, part, _LAST, [carry[0]], None, [carry[1]])

    found = write_and_read(ranged.mapInArrow(pairs, f"part int, row int, doc_id {kind}, {_RESULT}, text string"), "fingerprints")
    ends = found.filter(F.col("row") != _DONE)
    firsts, lasts = ends.filter(F.col("row") == _FIRST), ends.filter(F.col("row") == _LAST)
    parts = firsts.select("part")
    everywhere = Window.orderBy("part")  # one row per range
    follows = F.coalesce(F.lead("part").over(everywhere), F.min("part").over(Window.partitionBy(F.lit(1))))
    joined = (
        lasts.select("doc_id", "text", "part")
        .join(parts.select("part", follows.alias("_next")), "part")
        .join(firsts.select(F.col("part").alias("_next"), F.col("text").alias("_after")), "_next")
        .select("doc_id", "text", "_after")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            columns = _compare(batch.column("text").to_pylist(), batch.column("_after").to_pylist())
            yield _batch(batch.schema.field("doc_id").type, 0, _DONE, batch.column("doc_id").to_pylist(), columns, None).drop_columns(["part", "row", "text"])

    rest = joined.mapInArrow(finish, f"doc_id {kind}, {_RESULT}")
    return found.filter(F.col("row") == _DONE).drop("part", "row", "text").unionByName(rest)


def _batch(kind: pa.DataType, part: int, row: int, ids: list, columns: list | None, texts: list | None) -> pa.RecordBatch:
    n = len(ids)
    columns = columns or [[None] * n] * 6
    texts = texts or [None] * n
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    arrays = [pa.array([part] * n, pa.int32()), pa.array([row] * n, pa.int32()), pa.array(ids, kind)]
    arrays += [pa.array(x, t) for x, t in zip(columns, types, strict=True)] + [pa.array(texts, pa.string())]
    names = ["part", "row", "doc_id", *(x.split()[0] for x in _RESULT.split(", ")), "text"]
    return pa.RecordBatch.from_arrays(arrays, names=names)

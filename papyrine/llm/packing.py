"""Packing of documents into training sequences.

Every task packs what it reads, a block of about `BLOCK_TOKENS` at a time, so there is no shuffle, memory is bounded, and
a block still fills thousands of windows. Within a block, documents longer than a window are first cut into full windows.
The rests are placed by best-fit decreasing: a segment tree over remaining capacities finds the tightest open window. At
the end the emptiest windows give pieces to fill the gaps of the others, and the last one falls into parts of a power of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.arrays import flat, text_slices
from papyrine.llm.tokens import SLICE_BYTES, TokenEncoder, loaded, with_end

BLOCK_TOKENS = 4_000_000
_TASK_BITS = 40  # sequence ids count upwards below this bit, tasks above it

Piece = tuple[int, int, int]  # document, first id, number of ids


class _Capacities:
    """Open windows by remaining capacity: a segment tree whose nodes count the windows below them."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, window: int) -> None:
        self._open[capacity].append(window)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self._leaves
        while node:
            self._count[node] += by
            node >>= 1

    def take_tightest(self, least: int) -> tuple[int, int] | None:
        """The window with the smallest capacity of at least `least`, taken out; None if there is none."""
        count, node = self._count, least + self._leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node + (not count[2 * node])
        capacity = node - self._leaves
        self._change(capacity, -1)
        return capacity, self._open[capacity].pop()


def best_fit(lengths: list[int], window: int, least_gap: int = 32) -> list[list[Piece]]:
    """Sequences of pieces for documents of these lengths; gaps below `least_gap` are left as padding."""
    done: list[list[Piece]] = []
    rests: list[Piece] = []
    for doc, length in enumerate(lengths):
        full = length - length % window
        done += [[(doc, start, window)] for start in range(0, full, window)]
        if length > full:
            rests.append((doc, full, length - full))
    rests.sort(key=lambda piece: -piece[2])
    windows: list[list[Piece]] = []
    free: list[int] = []
    tree = _Capacities(window)
    for piece in rests:
        found = tree.take_tightest(piece[2])
        if found is None:
            found = window, len(windows)
            windows.append([])
            free.append(window)
        capacity, place = found
        windows[place].append(piece)
        free[place] = capacity - piece[2]
        if free[place]:
            tree.put(free[place], place)
    done += [pieces for pieces, gap in zip(windows, free, strict=True) if gap < least_gap]
    return done + _top_up(sorted((gap, pieces) for gap, pieces in zip(free, windows, strict=True) if gap >= least_gap), window)


def _top_up(gaps: list[tuple[int, list[Piece]]], window: int) -> list[list[Piece]]:
    """Fill the fullest windows with pieces of the emptiest, cutting where needed."""
    done: list[list[Piece]] = []
    pool: list[Piece] = []  # pieces of the windows that were given up
    first, last = 0, len(gaps) - 1
    while first <= last:
        gap, pieces = gaps[first]
        while first < last and sum(piece[2] for piece in pool) < gap:
            pool += gaps[last][1]
            last -= 1
        if first == last and sum(piece[2] for piece in pool) < gap:
            pool += pieces
            break
        done.append(pieces + _take(pool, gap))
        first += 1
    while pool:
        left = sum(piece[2] for piece in pool)
        done.append(_take(pool, min(window, 1 << (left.bit_length() - 1))))
    return done


def _take(pool: list[Piece], length: int) -> list[Piece]:
    """Pieces of `length` ids from the end of the pool."""
    taken: list[Piece] = []
    while length:
        doc, start, size = pool.pop()
        part = min(size, length)
        taken.append((doc, start, part))
        if size > part:
            pool.append((doc, start + part, size - part))
        length -= part
    return taken


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, keep_ids: bool = True) -> DataFrame:
    """Pieces of documents with their place in sequences of at most `window` ids.

    A document's ids are those of its text under the tokenizer file (null: none) and then `end_id`. Returns one row per
    piece: doc_id, start (the document's ids before it), length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), doc_tokens, sequence_id, offset, and with `keep_ids` the ids. A sequence shorter than `window` is to be
    padded unless its length is a power of two. `assemble` joins the pieces of a sequence.

    Rows are packed as they come, so repeated ids or rows are packed as often as they occur, a null doc_id stays null,
    and an empty table gives no rows. `window` must be a power of two. Columns besides doc_id and text are not looked at.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")
    chosen = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if keep_ids else ""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, made = loaded(tokenizer), TaskContext.get().partitionId(), 0
        for doc_ids, ids, begins in _blocks(batches, encoder, end_id):
            sequences = best_fit(np.diff(begins).tolist(), window)
            for part in range(0, len(sequences), 256):
                first_id = (task << _TASK_BITS) + made + part
                yield _rows(sequences[part : part + 256], first_id, doc_ids, ids, begins, keep_ids)
            made += len(sequences)

    return chosen.mapInArrow(pack, schema)


def _blocks(batches: Iterator[pa.RecordBatch], encoder: TokenEncoder, end_id: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
    size = 0

    def block() -> tuple[pa.Array, np.ndarray, np.ndarray]:
        lengths = np.concatenate([np.diff(begins) for _, _, begins in held])
        return pa.concat_arrays([x for x, _, _ in held]), np.concatenate([x for _, x, _ in held]), np.append(0, np.cumsum(lengths))

    for batch in text_slices(batches, size=SLICE_BYTES):
        ids, begins = with_end(*encoder.encode(*flat(batch.column("text"))), end_id)
        held.append((batch.column("doc_id"), ids, begins))
        size += len(ids)
        if size >= BLOCK_TOKENS:
            yield block()
            held, size = [], 0
    if held:
        yield block()


def _rows(
    sequences: list[list[Piece]], first_id: int, doc_ids: pa.Array, ids: np.ndarray, begins: np.ndarray, keep_ids: bool
) -> pa.RecordBatch:
    doc, start, length = np.array([piece for sequence in sequences for piece in sequence], np.int64).reshape(-1, 3).T
    per_sequence = np.array([len(sequence) for sequence in sequences])
    before = np.cumsum(length) - length
    heads = np.cumsum(per_sequence) - per_sequence
    spans = [ids[a:b] for a, b in zip(begins[doc] + start, begins[doc] + start + length, strict=True)]
    columns = {
        "doc_id": doc_ids.take(pa.array(doc)),
        "start": pa.array(start),
        "length": pa.array(length),
        "ids_crc32": pa.array([zlib.crc32(span.astype("<u4")) for span in spans], pa.int64()),
        "doc_tokens": pa.array(np.diff(begins)[doc]),
        "sequence_id": pa.array(first_id + np.repeat(np.arange(len(sequences)), per_sequence)),
        "offset": pa.array(before - np.repeat(before[heads], per_sequence)),
    }
    if keep_ids:
        ends = np.append(before, length.sum()).astype(np.int32)
        columns["ids"] = pa.ListArray.from_arrays(ends, np.concatenate(spans).astype(np.int32))
    return pa.RecordBatch.from_pydict(columns)


def assemble(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id and its ids in order. A sequence has few pieces, as its length is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x.ids)).alias("ids"))

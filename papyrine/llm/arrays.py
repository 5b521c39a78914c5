"""Texts as flat byte arrays, so that numpy can work on thousands of documents in one call."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # texts worked on at once in a task; a longer text is a slice by itself


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece hold about `size` bytes."""
    for batch in batches:
        _, offsets = flat(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and where each begins; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    texts = texts.cast(pa.large_string() if pa.types.is_string(texts.type) else pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes 0x20 and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def _changes(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True where `flags` holds and does not hold just before, or a text begins."""
    begins = flags.copy()
    begins[1:] &= ~flags[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = flags[heads]
    return begins


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run without white space, and how many runs lie before each text."""
    solid = ~is_space(data)
    starts = np.flatnonzero(_changes(solid, offsets))
    backwards = (len(data) - offsets)[::-1]
    ends = len(data) - np.flatnonzero(_changes(solid[::-1], backwards))[::-1]
    return starts, ends, np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different pieces among those that begin at `starts` and reach to the next, and which one each is.

    `starts` begins with 0; the last piece reaches to the end of the data.
    """
    if not len(starts):
        return [], np.zeros(0, np.int32)
    ends = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = pieces.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each of many ranges, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def with_row_key(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and `row_key`: the doc_id, or for rows without one a hash of the text."""
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.xxhash64("text")).alias("row_key"))

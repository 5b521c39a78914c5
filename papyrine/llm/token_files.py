"""Token ids of a corpus in a compressed binary layout, written and read by Spark.

A data set is one stream of unsigned 32-bit ids, in ascending order of doc_id, cut into shards (one per writing task) and
those into chunks of a fixed number of ids. Each row of the Parquet table holds one chunk:

    shard, chunk   place of the chunk
    first_id       ids of the shard before it
    n_ids          ids in it
    plane_ends     chunk index: where each compressed plane ends in the payload
    payload        the planes, each compressed with zstandard
    documents      doc_id, first_id (within the shard) and n_tokens of the documents that begin in the chunk

A chunk is seen as a matrix with one row per id and turned by 90 degrees: plane k holds byte k (or bit k) of every id. The
high planes of small ids are nearly constant and the low ones compress better on their own. Parquet is only the
container, so a lost executor's shard is simply written again and files are never half there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrine.llm.arrays import flat, text_slices
from papyrine.llm.tokens import SLICE_BYTES, loaded, with_end

CHUNK_IDS = 1 << 17
BITS, BYTES = "bits", "bytes"


def encode_planes(ids: np.ndarray, planes: str = BYTES) -> tuple[bytes, list[int]]:
    """Payload of one chunk and the ends of its planes."""
    matrix = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == BITS:
        matrix = np.unpackbits(matrix, axis=1, bitorder="little")
    turned = np.ascontiguousarray(matrix.T)
    rows = [np.packbits(row) if planes == BITS else row for row in turned]
    packer = zstandard.ZstdCompressor(level=3)
    packed = [packer.compress(row.tobytes()) for row in rows]
    return b"".join(packed), np.cumsum([len(x) for x in packed]).tolist()


def decode_planes(payload: bytes, plane_ends: list[int], n_ids: int) -> np.ndarray:
    """The ids of a chunk; four planes are bytes, thirty-two are bits."""
    reader = zstandard.ZstdDecompressor()
    parts = [reader.decompress(payload[a:b]) for a, b in zip([0, *plane_ends[:-1]], plane_ends, strict=True)]
    turned = np.stack([np.frombuffer(part, np.uint8) for part in parts])
    if len(plane_ends) == 32:
        bits = np.unpackbits(turned, axis=1, count=n_ids)
        turned = np.packbits(bits.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(turned.T).view("<u4").reshape(-1)


def _chunk_type(kind: pa.DataType) -> pa.Schema:
    document = pa.struct([("doc_id", kind), ("first_id", pa.int64()), ("n_tokens", pa.int64())])
    return pa.schema(
        [
            ("shard", pa.int32()),
            ("chunk", pa.int32()),
            ("first_id", pa.int64()),
            ("n_ids", pa.int32()),
            ("plane_ends", pa.list_(pa.int32())),
            ("payload", pa.binary()),
            ("documents", pa.list_(document)),
        ]
    )


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, planes: str = BYTES, chunk_ids: int = CHUNK_IDS
) -> None:
    """Encode all texts (null: empty), each followed by `end_id`, in ascending order of doc_id, and write them.

    Rows without a doc_id come first; rows with the same doc_id are ordered by a hash of their text, so that even an id
    that holds much of the table falls into several shards. An empty table gives an empty data set. One shuffle of the
    texts; a task holds one chunk of ids and one slice of texts. Columns besides doc_id and text are not looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        "shard int, chunk int, first_id long, n_ids int, plane_ends array<int>, payload binary, "
        f"documents array<struct<doc_id: {kind}, first_id: bigint, n_tokens: bigint>>"
    )
    order = ["doc_id", "_hash"]
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, out = loaded(tokenizer), TaskContext.get().partitionId(), None
        held, index, chunk, seen = np.zeros(0, np.uint32), [], 0, 0

        def row(ids: np.ndarray, documents: list) -> pa.RecordBatch:
            payload, ends = encode_planes(ids, planes)
            values = [shard, chunk, chunk * chunk_ids, len(ids), ends, payload, documents]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, out, strict=True)], schema=out)

        for batch in text_slices(batches, size=SLICE_BYTES):
            out = out or _chunk_type(batch.schema.field("doc_id").type)
            ids, begins = with_end(*encoder.encode(*flat(batch.column("text"))), end_id)
            names = batch.column("doc_id").to_pylist()
            index += [
                {"doc_id": name, "first_id": seen + int(begin), "n_tokens": int(size)}
                for name, begin, size in zip(names, begins, np.diff(begins), strict=False)
            ]
            seen += len(ids)
            held = np.concatenate([held, ids])
            place = listed = 0
            while len(held) - place >= chunk_ids:
                end = listed
                while end < len(index) and index[end]["first_id"] < (chunk + 1) * chunk_ids:
                    end += 1
                yield row(held[place : place + chunk_ids], index[listed:end])
                place, listed, chunk = place + chunk_ids, end, chunk + 1
            held, index = held[place:], index[listed:]
        if len(held):
            yield row(held, index)

    ordered.mapInArrow(encode, schema).write.mode("errorifexists").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks with their ids: shard, chunk, start (ids of the data set before the chunk), ids, documents."""
    chunks = _with_shard_start(spark.read.parquet(folder))
    documents = chunks.schema["documents"].dataType.simpleString()
    columns = ["shard", "chunk", "start", "documents"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = decode_planes(*(one.column(name)[0].as_py() for name in ("payload", "plane_ends", "n_ids")))
                ids = pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in columns), ids], names=[*columns, "ids"])

    rows = chunks.withColumn("start", F.col("shard_start") + F.col("first_id"))
    schema = f"shard int, chunk int, start long, documents {documents}, ids array<long>"
    return rows.select(*columns, "payload", "plane_ends", "n_ids").mapInArrow(decode, schema)


def _with_shard_start(chunks: DataFrame) -> DataFrame:
    """Add shard_start. There are as many shards as there were writing tasks, so their table is small."""
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("shard_start"))
    return chunks.join(F.broadcast(starts), "shard")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Chunks of a shard are read in order by one task, which holds one chunk at a time; a document may span any number.
    """
    chunks = _with_shard_start(spark.read.parquet(folder))
    kind = chunks.schema["documents"].dataType.elementType["doc_id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, doc, rows, doc_type = None, None, [], None

        def emit() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = [doc_type, pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])

        for batch in batches:
            doc_type = batch.schema.field("documents").type.value_type.field("doc_id").type
            for i in range(batch.num_rows):
                one = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if one["shard"] != shard:
                    shard, waiting = one["shard"], []
                waiting += one["documents"]
                ids = decode_planes(one["payload"], one["plane_ends"], one["n_ids"])
                place, end = one["first_id"], one["first_id"] + one["n_ids"]
                finished = 0
                for item in waiting:
                    doc = item.setdefault("crc", 0)
                    first, last = max(item["first_id"], place), item["first_id"] + item["n_tokens"]
                    item["crc"] = zlib.crc32(ids[first - place : min(last, end) - place], doc)
                    if last > end:
                        break
                    rows.append((item["doc_id"], one["shard_start"] + item["first_id"], item["n_tokens"], item["crc"]))
                    finished += 1
                waiting = waiting[finished:]
                if len(rows) >= 10_000:
                    yield emit()
                    rows = []
        if rows:
            yield emit()

    ordered = chunks.repartition("shard").sortWithinPartitions("shard", "chunk")
    return ordered.mapInArrow(check, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")

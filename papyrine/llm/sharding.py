"""Sharding of documents: bytes, tokens and rows balanced together, copies of a text in one shard.

Equal texts form a group, whose vector is its share of all bytes, tokens and rows. A group goes to the shard with the
largest dot product of that vector and the shard's residual capacities, large groups first. Groups above a `HEAVY`-th of
the collection in some measure, of which there can be no more than three times HEAVY, are placed first, in one go. What
they leave of each shard is dealt out among tasks in proportion to the groups that each has, and every task places its own
groups against its part, a block at a time; what a block leaves over or takes too much is carried on to the next. So nothing
but the few heavy groups meets in one place, and no group is seen by more than one task.

A group larger than a shard's fair share can't stay together: it is cut into as few equal pieces as fit, its rows being
numbered by ranges, so that no task sees the whole of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.llm.scratch import write_and_read
from papyrine.operators.ordering import rank_in_groups

HEAVY = 1024
BLOCK_GROUPS = 1 << 16  # groups a task sorts and places at a time
MEASURES = ("size", "tokens", "rows")
PRIORITY = np.array([16.0, 1.0, 1.0])  # bytes first, as their law is the one to hold


def token_estimate(text: Column) -> Column:
    """Words and single signs, roughly the pieces that tokenizers start from."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")), F.lit(0)).cast("long")


def place_groups(vectors: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The shard of each group: large groups first, each where its dot product with what is left is the highest.

    `vectors` and `residual` (shard x measure, lowered here) are in units of a shard's fair share.
    """
    shards = np.zeros(len(vectors), np.int32)
    for group in np.argsort(-vectors.max(axis=1), kind="stable"):
        vector = vectors[group]
        shard = int(np.argmax(residual @ (vector * PRIORITY)))
        residual[shard] -= vector
        shards[group] = shard
    return shards


def shard_documents(docs: DataFrame, shards: int = 16, tokens: Column | None = None) -> DataFrame:
    """All rows of (doc_id, text) with their place: doc_id, size, text_crc32, tokens, law, shard, slot, grown_shard.

    The size is the text's UTF-8 bytes (null: none) and one more. Shards are numbered from 0 and their sizes are near equal
    (law `bytes`), tokens and row counts as nearly as that allows. Equal texts are in the same shard, null and empty ones
    being equal, unless their group has more than a shard's fair share of bytes, tokens or rows. Slots count a shard's rows
    from 0 in the order of doc_id. grown_shard is null, as another number of shards may move any row.

    `tokens` counts the tokens of a row; `token_estimate` by default. Null and repeated ids and repeated rows are rows like
    others. One text cannot be cut, so a shard is as large as its largest text at least. An empty table gives an empty one.
    Columns besides doc_id and text are not looked at unless `tokens` does.
    """
    tokens = token_estimate(F.col("text")) if tokens is None else tokens
    encoded = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    measured = docs.select(
        "doc_id",
        (F.octet_length(encoded) + 1).cast("long").alias("size"),
        F.crc32(encoded).alias("text_crc32"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"),
        F.unhex(F.sha2(encoded, 256)).alias("_text"),
    )
    measured = write_and_read(measured, "measured")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = measured.agg(*sums).first()
    share = np.array([max(total[m] or 0, 1) / shards for m in MEASURES])  # a shard's fair share
    groups = write_and_read(measured.groupBy("_text").agg(*sums), "groups")
    limits = [F.col(m) >= float(share[i] * shards / HEAVY) for i, m in enumerate(MEASURES)]
    heavy = groups.filter(limits[0] | limits[1] | limits[2]).orderBy("_text").collect()  # 3 x HEAVY at most

    # Pieces of heavy groups, placed here.
    vectors = np.array([[row[m] for m in MEASURES] for row in heavy], float).reshape(-1, 3) / share
    pieces = [min(row["rows"], max(1, int(np.ceil(vector.max())))) for row, vector in zip(heavy, vectors, strict=True)]
    residual = np.ones((shards, 3))
    placed = place_groups(np.repeat(vectors / np.array(pieces).reshape(-1, 1), pieces, axis=0), residual).tolist()
    ends = np.cumsum([0, *pieces]).tolist()
    known = [(bytes(row["_text"]), placed[a:b]) for row, a, b in zip(heavy, ends[:-1], ends[1:], strict=True)]
    known = docs.sparkSession.createDataFrame(known, "_text binary, _shards array<int>")

    left = np.maximum(residual, 0)
    left /= np.maximum(left.sum(axis=0), 1e-300)  # each shard's part of what is still to come

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.roll(np.arange(shards), TaskContext.get().partitionId())  # else all tasks begin with the same shard
        carried = np.zeros((shards, 3))
        for batch in _blocks(batches, BLOCK_GROUPS):
            vectors = np.column_stack([batch.column(m).to_numpy(zero_copy_only=False) for m in MEASURES]) / share
            carried += left[order] * vectors.sum(axis=0)
            names = pa.array(order[place_groups(vectors, carried)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("_text"), names], names=["_text", "shard"])

    light = groups.join(F.broadcast(known), "_text", "left_anti").mapInArrow(place, "_text binary, shard int")
    marked = measured.join(F.broadcast(known), "_text", "left")
    whole = marked.filter("size(_shards) = 1").withColumn("shard", F.col("_shards")[0])
    cut = rank_in_groups(marked.filter("size(_shards) > 1"), "_text", ["doc_id"], "_rank")
    cut = cut.withColumn("shard", F.element_at("_shards", (F.col("_rank") % F.size("_shards") + 1).cast("int"))).drop("_rank")
    rest = marked.filter("_shards IS NULL").join(light, "_text")
    columns = ["doc_id", "size", "text_crc32", "tokens", "shard"]
    dealt = whole.select(columns).unionByName(cut.select(columns)).unionByName(rest.select(columns))
    numbered = rank_in_groups(dealt, "shard", ["doc_id"], "_rank")
    return numbered.select(
        *columns[:-1],
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in blocks of about `size`."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

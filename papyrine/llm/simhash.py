"""Near-duplicates by SimHash, found with the generalised pigeonhole principle.

Two fingerprints that differ in at most d bits, cut into m parts, must differ in at most t_i bits in some part i wherever the
t_i add up to d - m + 1 (t_i = -1: the part is not looked at). Bits that go together are put into one part, so that the
other parts tell fingerprints apart better, and the t_i are chosen by dynamic programming on the numbers of candidates,
which are counted exactly over all fingerprints: a part has so few bits that a histogram of its values has a fixed size.

Equal fingerprints are one vertex. Buckets of candidates are compared in blocks; a bucket of any size falls into pairs
of blocks, and very large ones are first cut by the same principle on the bits that are still free. Only links that join
something new within a pair of blocks leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.llm.arrays import flat, is_space, text_slices, words
from papyrine.llm.components import components
from papyrine.llm.scratch import write_and_read

BITS = 64
PARTS = 4
SHINGLES = 1 << 16  # hashes of a task at once
BLOCK = 800  # fingerprints of a bucket that are compared at once
LARGE_BUCKET = 16 * BLOCK
ROW_COST = 20  # sending a row to a bucket, in comparisons


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Where each text's hashes begin, and the hashes of all texts, SHINGLES at a time.

    They are XXH64 of each run of `width` words, A-Z in lower case, joined by single spaces. A text of fewer words gives one
    hash of all of them, a text without words none."""
    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    space = is_space(data)
    data[space] = 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    data, offsets = data[keep], np.append(0, np.cumsum(keep))[offsets]
    starts, ends, before = words(data, offsets)
    counts = np.diff(before)
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    begins = np.append(0, np.cumsum(shingles))
    first = np.repeat(before[:-1] - begins[:-1], shingles) + np.arange(begins[-1])
    last = np.minimum(first + width, np.repeat(before[1:], shingles)) - 1

    def blocks() -> Iterator[np.ndarray]:
        text, digest = data.tobytes(), xxhash.xxh64_intdigest
        for i in range(0, len(first), SHINGLES):
            spans = zip(starts[first[i : i + SHINGLES]].tolist(), ends[last[i : i + SHINGLES]].tolist(), strict=True)
            yield np.array([digest(text[a:b], seed) for a, b in spans], np.uint64)

    return begins, blocks()


def fingerprints(data: np.ndarray, offsets: np.ndarray, width: int = 3, seed: int = 42) -> np.ndarray:
    """A bit is 1 where it is set in over half of a text's shingle hashes; without words all are 0."""
    begins, blocks = shingle_hashes(data, offsets, width, seed)
    ones = np.zeros((len(begins) - 1, BITS), np.int64)
    for number, hashes in enumerate(blocks):
        first = number * SHINGLES
        heads = np.append(first, begins[(begins > first) & (begins < first + len(hashes))])
        heads = np.unique(heads)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[np.searchsorted(begins, heads, side="right") - 1] += np.add.reduceat(bits, heads - first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > np.diff(begins)[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def add_fingerprint(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, a hash of each text (null: empty) and its fingerprint as a signed number, without a shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            prints = fingerprints(*flat(batch.column("text")), width, seed).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(prints)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fingerprint"])

    hashed = docs.select("doc_id", text_hash().alias("text_hash"), "text")
    return hashed.mapInArrow(run, f"doc_id {kind}, text_hash long, fingerprint long")


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _part_values(bits: np.ndarray, members: list[int]) -> np.ndarray:
    return bits[:, members].astype(np.int64) @ (1 << np.arange(len(members)))


def _bit_correlations(prints: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all fingerprints; 64 rows per task are added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, total = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
            both, total = both + bits.T @ bits, total + len(bits)
        rows = pa.array(both.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS), pa.int32()), rows, pa.array([float(total)] * BITS)], names=["bit", "both", "n"])

    tables = prints.mapInArrow(count, "bit int, both array<double>, n double")
    sums = [F.sum(F.get("both", F.lit(i))).alias(str(i)) for i in range(BITS)]
    rows = tables.groupBy("bit").agg(F.sum("n").alias("n"), *sums).orderBy("bit").collect()  # 64 rows
    total = max(rows[0]["n"], 1.0) if rows else 1.0
    both = np.array([[row[str(i)] for i in range(BITS)] for row in rows]) / total if rows else np.eye(BITS)
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(np.outer(mean * (1 - mean), mean * (1 - mean)), 1e-12))
    return np.abs(both - np.outer(mean, mean)) / spread


def group_bits(correlation: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Parts of equal size, each begun with the closest pair left and filled with the bits closest to its members."""
    left, groups = set(range(len(correlation))), []
    for _ in range(parts):
        group = list(max(combinations(sorted(left), 2), key=lambda pair: correlation[pair]))
        left -= set(group)
        while len(group) < len(correlation) // parts:
            best = max(sorted(left), key=lambda bit: correlation[bit, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def candidate_counts(histogram: np.ndarray, most: int) -> list[float]:
    """Pairs of fingerprints that differ in at most 0, 1, ... `most` bits of a part, from the counts of its values."""
    table = histogram.astype(float)
    for bit in range(len(table).bit_length() - 1):  # Walsh-Hadamard transform
        pairs = table.reshape(-1, 2, 1 << bit)
        table = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(-1)
    table = table**2 / len(table)
    for bit in range(len(table).bit_length() - 1):
        pairs = table.reshape(-1, 2, 1 << bit)
        table = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(-1)
    apart = np.bitwise_count(np.arange(len(table), dtype=np.uint64))
    return [float(table[apart <= distance].sum()) for distance in range(most + 1)]


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds, one for each part and -1 or more, that add up to `total` at the least cost; `costs[i][t]` for t >= 0."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        fresh: dict[int, tuple[float, list[int]]] = {}
        for reached, (cost, chosen) in best.items():
            for threshold in range(-1, len(options)):
                price = cost + (options[threshold] if threshold >= 0 else 0.0)
                if reached + threshold not in fresh or price < fresh[reached + threshold][0]:
                    fresh[reached + threshold] = price, [*chosen, threshold]
        best = fresh
    return best[total][1]


def _flips(width: int, distance: int) -> np.ndarray:
    """All masks of `width` bits with at most `distance` set."""
    return np.array([sum(1 << bit for bit in some) for n in range(distance + 1) for some in combinations(range(width), n)], np.int64)


def _plan(prints: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Parts and their thresholds. Reads two aggregates of fixed size: 64 x 64 and 4 x 65,536 numbers."""
    groups = group_bits(_bit_correlations(prints))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy())
            for part, members in enumerate(groups):
                value, count = np.unique(_part_values(bits, members), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(value), pa.int32()), pa.array(value), pa.array(count)], names=["part", "value", "n"])

    histograms = np.zeros((PARTS, 1 << (BITS // PARTS)))
    counted = prints.mapInArrow(values, "part int, value long, n long").groupBy("part", "value").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # at most 4 x 65,536 rows
    histograms[found["part"], found["value"]] = found["n"]
    costs = []
    for histogram in histograms:
        pairs = candidate_counts(histogram, distance)
        costs.append([pairs[t] + ROW_COST * histogram.sum() * len(_flips(BITS // PARTS, t)) for t in range(distance + 1)])
    return list(zip(groups, allocate(costs, distance - PARTS + 1), strict=True))


_BUCKETS = "path string, value long, fingerprint long"
_NAMES = ["path", "value", "fingerprint"]


def _members(path: str, groups: list[list[int]]) -> list[int]:
    """Bits whose values name the buckets at `path`: a part, then quarters of the bits left so far, as `2.0.3`."""
    first, *quarters = map(int, path.split("."))
    members = groups[first]
    left = [bit for bit in range(BITS) if bit not in members]
    for quarter in quarters:
        members = left[quarter::4]
        left = [bit for bit in left if bit not in members]
    return members


def _first_buckets(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Fingerprints under the values of each part, and the values near them where a part's threshold is above 0."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, bits = batch.column(0), _bits(batch.column(0).to_numpy())
            for part, (members, threshold) in enumerate(plan):
                if threshold >= 0:
                    value, path = _part_values(bits, members), pa.array([str(part)] * len(prints))
                    for flip in _flips(len(members), threshold):
                        yield pa.RecordBatch.from_arrays([path, pa.array(value ^ flip), prints], names=_NAMES)

    return prints.mapInArrow(deal, _BUCKETS)


def _quartered(rows: DataFrame, groups: list[list[int]]) -> DataFrame:
    """Rows of large buckets under the quarters of the bits that are free there; the value holds what came before too.

    Two fingerprints of one bucket that differ in at most 3 bits agree in one of four quarters of the others."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, values, prints = (batch.column(name).to_pandas() for name in _NAMES)
            for path in paths.unique():
                here = (paths == path).to_numpy()
                own, bits = pa.array(prints[here]), _bits(prints[here].to_numpy())
                for quarter in range(4):
                    deeper = f"{path}.{quarter}"
                    inner = _part_values(bits, _members(deeper, groups))
                    value = (values[here].to_numpy() * np.int64(0x5851F42D4C957F2D)) ^ inner  # buckets may meet by chance
                    yield pa.RecordBatch.from_arrays([pa.array([deeper] * len(own)), pa.array(value), own], names=_NAMES)

    return rows.select(*_NAMES).mapInArrow(deal, _BUCKETS)


def _sized_buckets(prints: DataFrame, plan: list[tuple[list[int], int]], distance: int) -> DataFrame:
    """Rows of all buckets of two or more, with the bucket's size n; none is much larger than LARGE_BUCKET."""
    groups, ready = [members for members, _ in plan], None
    current = write_and_read(_first_buckets(prints, plan), "buckets")
    for depth in range(8):  # after that, six bits are free and a bucket holds 64 fingerprints at most
        sizes = write_and_read(current.groupBy("path", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
        large = sizes.filter(F.col("n") > LARGE_BUCKET)
        last = depth == 7 or distance > 3 or large.isEmpty()
        fitting = current.join(sizes if last else sizes.filter(F.col("n") <= LARGE_BUCKET), ["path", "value"])
        ready = fitting if ready is None else ready.union(fitting)
        if last:
            return ready
        current = write_and_read(_quartered(current.join(large.drop("n"), ["path", "value"]), groups), "buckets")
    raise AssertionError


def find_links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) that connect all fingerprints at most `distance` bits apart. `prints`: one column of distinct numbers."""
    plan = _plan(prints, distance)
    key = ["path", "value", "_p", "_q"]
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), blocks).cast("int")
    rows = _sized_buckets(prints, plan, distance).select(
        *_NAMES, own.alias("_own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other")
    )
    pairs = rows.select(
        "path", "value", F.least("_own", "_other").alias("_p"), F.greatest("_own", "_other").alias("_q"), "fingerprint"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = batch.to_pandas()
            table = table if held is None else pd.concat([held, table], ignore_index=True)
            change = (table[key] != table[key].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(change)
            held = table.iloc[starts[-1] :] if len(starts) else None
            yield _links(table["fingerprint"].to_numpy(), starts, distance)
        if held is not None:
            yield _links(held["fingerprint"].to_numpy(), np.array([0, len(held)]), distance)

    dealt = pairs.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(link, "a long, b long")


def _links(prints: np.ndarray, starts: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links within the groups that begin at all but the last of `starts` and end at the next."""
    sizes = np.diff(starts)
    two = starts[:-1][sizes == 2]
    near = two[np.bitwise_count((prints[two] ^ prints[two + 1]).view(np.uint64)) <= distance]
    a, b = [prints[near]], [prints[near + 1]]
    for start, size in zip(starts[:-1][sizes > 2], sizes[sizes > 2], strict=True):
        own = np.unique(prints[start : start + size])
        close = np.bitwise_count((own[:, None] ^ own[None, :]).view(np.uint64)) <= distance
        busy = np.flatnonzero(close.sum(axis=1) > 1)
        if len(busy):
            own, close = own[busy], close[np.ix_(busy, busy)]
            label, before = np.arange(len(own)), None
            while before is None or (label != before).any():
                before, label = label, np.where(close, label, len(own)).min(axis=1)
            a.append(own[label != np.arange(len(own))])
            b.append(own[label[label != np.arange(len(own))]])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])


def _rooted(vertices: DataFrame, distance: int) -> DataFrame:
    """Different fingerprints with what is known of them and `_root`, which linked ones have in common."""
    if distance > 3:
        raise ValueError("four parts and quarters are exact up to 3 bits")
    vertices = write_and_read(vertices, "vertices")
    links = write_and_read(find_links(vertices.select("fingerprint"), distance), "links")
    roots = components(links).select(F.col("node").alias("fingerprint"), F.col("root").alias("_root"))
    return vertices.join(roots, "fingerprint", "left").withColumn("_root", F.coalesce("_root", "fingerprint"))


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (a signed number) and component_id of every row.

    Rows are linked if their fingerprints differ in at most `distance` bits, and component_id is the smallest doc_id that
    can be reached over links. Null and empty texts have fingerprint 0 and are linked like others; of rows without a
    doc_id the others' smallest counts (null if there is none); repeated rows are one vertex. An empty table gives no rows.
    """
    prints = write_and_read(add_fingerprint(docs, width, seed), "simhash")
    rooted = _rooted(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("_least")), distance)
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    members = rooted.join(named, "_root").select("fingerprint", "component_id")
    return prints.join(members, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one_of_each(docs: DataFrame, width: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """The row of the smallest doc_id of each group of linked rows, with all its columns.

    Rows with a doc_id go before rows without; ties are broken by a hash of the text, and of equal rows one stays. Texts are
    shuffled once, and only the group's key decides where a row goes, so groups of any size spread.
    """
    prints = write_and_read(add_fingerprint(docs, width, seed), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("_unnamed"), "doc_id", "text_hash")
    rooted = _rooted(prints.groupBy("fingerprint").agg(F.min(first).alias("_first")), distance)
    chosen = rooted.groupBy("_root").agg(F.min("_first").alias("_first")).select("_first.doc_id", "_first.text_hash")
    return rows_chosen(docs, chosen)


def rows_chosen(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of `docs` that `chosen` names by doc_id (null: none) and text_hash; of equal rows one."""
    key = ["key", "unnamed", "hash"]
    chosen = chosen.select(F.coalesce("doc_id", "text_hash").alias("key"), F.col("doc_id").isNull().alias("unnamed"), F.col("text_hash").alias("hash"))
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),  # no column of theirs is taken for one of ours
        F.coalesce("doc_id", text_hash()).alias("key"),
        F.col("doc_id").isNull().alias("unnamed"),
        text_hash().alias("hash"),
    )
    return rows.join(chosen, key, "left_semi").dropDuplicates(key).select("row.*")

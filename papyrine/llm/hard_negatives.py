"""Hard negatives: for an anchor and a positive, the rows of other labels whose score is highest within a window.

Scores are inner products of whole vectors. With the lengths of vectors known, a window of scores is a ring of distances
around the anchor, and rings are sought in a multiway hyperplane tree (GNAT): every node has some split points, each vector
lies below the split point nearest to it, and each split point knows the least and the greatest distance to the vectors
below each of its siblings. A subtree goes when, seen from some split point, its distances can't meet the ring. What is
left in the leaves is scored exactly.

The top of the tree is fitted on a bounded sample and all rows lie below it. Subtrees are cut into blocks of rows, anchors
into blocks of anchors, and each pair of blocks that can hold a result is one group: it grows the rest of the tree over
its rows and searches it. As results come in, a window's lower limit rises to the last of the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm.scratch import write_and_read
from papyrine.llm.vectors import matrix, whole_vectors

SAMPLE_ROWS = 4096  # rows on which split points and first limits are chosen
SPLITS = 16
LEAF = 512
ROW_BLOCK = 4096  # rows of a subtree in one group, about
ANCHOR_BLOCK = 2048
_PAIRS_AT_ONCE = 1 << 21  # scores of windows and rows held at a time
_SLACK = 1e-6  # of distances, far above their rounding

_WINDOW = pa.struct([("positive_id", pa.int64()), ("positive_score", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_WINDOWS = "array<struct<positive_id: long, positive_score: long, low: long, high: long>>"
_FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"
NO_LIMIT = 1 << 62


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: in floating point while they fit into 53 bits."""
    if a.size and b.size and a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max()) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = _squares(x)[:, None] + _squares(points) - 2 * products(x, points)
    return np.sqrt(np.maximum(square, 0).astype(np.float64))


def choose_splits(x: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` different vectors far from each other: each is the farthest from those before it."""
    if not len(x):
        return x
    chosen = [0]
    away = _distances(x, x[:1])[:, 0]
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


@dataclass
class Ranges:
    """Split points, and for the vectors below each: distances to all split points, and squared lengths."""

    points: np.ndarray
    least: np.ndarray  # split point x subtree
    greatest: np.ndarray
    shortest: np.ndarray  # per subtree
    longest: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, away: np.ndarray, home: np.ndarray, squares: np.ndarray) -> Ranges:
        """From the distances of vectors to the split points; a subtree without a vector has an empty range."""
        m = len(points)
        least, greatest = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        shortest, longest = np.full(m, NO_LIMIT, np.int64), np.full(m, -1, np.int64)
        for subtree in np.unique(home):
            own = away[home == subtree]
            least[:, subtree], greatest[:, subtree] = own.min(axis=0), own.max(axis=0)
            shortest[subtree], longest[subtree] = squares[home == subtree].min(), squares[home == subtree].max()
        return cls(points, least, greatest, shortest, longest)

    def possible(self, away: np.ndarray, squares: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Window x subtree: whether the ring of a window can meet a subtree.

        `away`: distances of the windows' anchors to the split points, `squares` the anchors' squared lengths.
        """
        # Squared distance = both squared lengths - 2 x score.
        inner = squares[:, None] + self.shortest - 2.0 * high[:, None]
        outer = squares[:, None] + self.longest - 2.0 * low[:, None]
        ring = np.sqrt(np.maximum(inner, 0)) * (1 - _SLACK) - _SLACK, np.sqrt(np.maximum(outer, 0)) * (1 + _SLACK) + _SLACK
        meets = (outer >= 0) & (self.longest >= 0)
        for point in range(len(self.points)):
            far = away[:, point, None]
            nearest = np.maximum(np.maximum(self.least[point] - far, far - self.greatest[point]), 0)
            meets &= (nearest <= ring[1]) & (far + self.greatest[point] >= ring[0])
        return meets


class Tree:
    """Vectors of one block, ordered by id within each leaf."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ranges, self.below = None, []
        if len(x) > LEAF:
            points = choose_splits(x[:: max(1, len(x) // (4 * SPLITS))], SPLITS)
            away = _distances(x, points)
            home = away.argmin(axis=1)
            if len(np.unique(home)) > 1:
                self.ranges = Ranges.of(points, away, home, _squares(x))
                parts = (home == subtree for subtree in range(len(points)))
                self.below = [Tree(ids[part], labels[part], x[part]) if part.any() else None for part in parts]
                return
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]


class Search:
    """Windows of anchors in search of their `most` best rows, of the anchor's label or of others."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, same: bool):
        self.ids, self.labels, self.x, self.squares = ids, labels, x, _squares(x)
        self.anchor, self.low, self.high, self.most, self.same = anchor, low.copy(), high, most, same
        self.found = tuple(np.zeros(0, np.int64) for _ in range(3))  # window, score, id

    def run(self, tree: Tree | None, live: np.ndarray) -> None:
        if tree is None or not len(live):
            return
        if tree.ranges is None:
            self._leaf(tree, live)
            return
        anchors, place = np.unique(self.anchor[live], return_inverse=True)
        away = _distances(self.x[anchors], tree.ranges.points)
        order = np.argsort(away.mean(axis=0))
        for subtree in order:  # limits have risen since the last one
            squares = self.squares[self.anchor[live]]
            meets = tree.ranges.possible(away[place], squares, self.low[live].astype(float), self.high[live].astype(float))
            self.run(tree.below[subtree], live[meets[:, subtree]])

    def _leaf(self, tree: Tree, live: np.ndarray) -> None:
        step = max(1, _PAIRS_AT_ONCE // max(len(tree.ids), 1))
        for first in range(0, len(live), step):
            windows = live[first : first + step]
            anchors, place = np.unique(self.anchor[windows], return_inverse=True)
            scores = products(self.x[anchors], tree.x)
            fits = (self.labels[anchors][:, None] == tree.labels) == self.same
            fits &= self.ids[anchors][:, None] != tree.ids
            scores, fits = scores[place], fits[place]
            fits &= (scores >= self.low[windows][:, None]) & (scores <= self.high[windows][:, None])
            window, row = np.nonzero(fits)
            if len(window):
                self._keep(windows[window], scores[window, row], tree.ids[row])

    def _keep(self, window: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        window, score, row = (np.concatenate(pair) for pair in zip(self.found, (window, score, row), strict=True))
        order = np.lexsort((row, -score, window))
        window, score, row = window[order], score[order], row[order]
        begins = np.searchsorted(window, window)
        best = np.arange(len(window)) - begins < self.most
        self.found = window[best], score[best], row[best]
        full = np.arange(len(window)) - begins == self.most - 1
        self.low[window[full]] = np.maximum(self.low[window[full]], score[full])


class Index:
    """The top of the tree: split points from a bounded sample, ranges over all rows, and subtrees cut into blocks."""

    def __init__(self, rows: DataFrame, size: int):
        self.size = size
        taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow()
        x = matrix(taken.column("x").combine_chunks(), size)
        self.sample = taken.column("vec_id").to_numpy(), taken.column("label").to_numpy(), x
        self.points = choose_splits(x, SPLITS)
        cells = self._cells(rows)
        self.ranges = self._ranges(cells)
        counts = {r["cell"]: r["count"] for r in cells.groupBy("cell").count().collect()}  # at most SPLITS
        self.blocks = [-(-counts.get(cell, 0) // ROW_BLOCK) for cell in range(len(self.points))]
        block = F.pmod(F.xxhash64("vec_id"), self._blocks_of(F.col("cell")))
        self.rows = cells.withColumn("block", F.coalesce(block, F.lit(0)).cast("int"))

    def _blocks_of(self, cell: Column) -> Column:
        return F.element_at(F.array(*(F.lit(blocks) for blocks in self.blocks)), cell + 1)

    def _cells(self, rows: DataFrame) -> DataFrame:
        size, points = self.size, self.points

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                home = _distances(matrix(batch.column("x"), size), points).argmin(axis=1)
                yield batch.append_column("cell", pa.array(home, pa.int32()))

        return rows.mapInArrow(assign, "vec_id long, label long, x array<long>, cell int")

    def _ranges(self, cells: DataFrame) -> Ranges:
        size, points = self.size, self.points
        names = ["cell", "point", "least", "greatest", "shortest", "longest"]

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("x"), size)
                r = Ranges.of(points, _distances(x, points), batch.column("cell").to_numpy(), _squares(x))
                cell, point = (a.ravel() for a in np.meshgrid(np.arange(len(points)), np.arange(len(points))))
                used = r.longest[cell] >= 0
                columns = cell, point, r.least.ravel(), r.greatest.ravel(), r.shortest[cell], r.longest[cell]
                yield pa.RecordBatch.from_arrays([pa.array(column[used]) for column in columns], names=names)

        parts = cells.mapInArrow(measure, "cell long, point long, least double, greatest double, shortest long, longest long")
        ends = [F.min("least"), F.max("greatest"), F.min("shortest"), F.max("longest")]
        m = len(points)
        total = Ranges(points, np.full((m, m), np.inf), np.full((m, m), -np.inf), np.full(m, NO_LIMIT), np.full(m, -1))
        for cell, point, *four in parts.groupBy("cell", "point").agg(*ends).collect():  # SPLITS x SPLITS at most
            total.least[point, cell], total.greatest[point, cell], total.shortest[cell], total.longest[cell] = four
        return total

    def search(self, anchors: DataFrame, most: int, same: bool, n_anchors: int) -> DataFrame:
        """The best rows for each window of the anchors (vec_id, label, x, windows): _FOUND, best first by `score`, `other_id`."""
        size, ranges, points = self.size, self.ranges, self.points

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("x"), size)
                windows = batch.column("windows")
                one = windows.flatten()
                anchor = np.repeat(np.arange(len(x)), np.diff(windows.offsets.to_numpy()))
                low, high = (one.field(name).to_numpy(zero_copy_only=False).astype(float) for name in ("low", "high"))
                meets = ranges.possible(_distances(x, points)[anchor], _squares(x)[anchor], low, high)
                for cell in range(len(points)):
                    kept = np.flatnonzero(meets[:, cell])
                    named, begins = np.unique(anchor[kept], return_index=True)
                    offsets = pa.array(np.append(begins, len(kept)), pa.int32())
                    there = batch.select(["vec_id", "label", "x"]).take(pa.array(named, pa.int64()))
                    lists = pa.ListArray.from_arrays(offsets, one.take(pa.array(kept, pa.int64())))
                    yield there.append_column("windows", lists).append_column("cell", pa.array(np.full(len(named), cell, np.int32)))

        def seek(rows: pa.Table, asked: pa.Table) -> pa.Table:
            names = [field.split()[0] for field in _FOUND.split(", ")]
            if not rows.num_rows or not asked.num_rows:
                return pa.table({name: pa.array([], pa.int64()) for name in names})
            ids, labels, x = _arrays(rows, size)
            lists = asked.column("windows").combine_chunks()
            one = lists.flatten()
            anchor = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            low, high = (one.field(name).to_numpy(zero_copy_only=False) for name in ("low", "high"))
            search = Search(*_arrays(asked, size), anchor, low, high, most, same)
            search.run(Tree(ids, labels, x), np.arange(len(anchor)))
            window, score, other = search.found
            chosen = one.take(pa.array(window, pa.int64()))
            columns = [pa.array(search.ids[anchor[window]]), chosen.field("positive_id"), chosen.field("positive_score"), pa.array(other), pa.array(score)]
            return pa.table(dict(zip(names, columns, strict=True)))

        chunks = max(1, -(-n_anchors // ANCHOR_BLOCK))
        key = ["cell", "block", "chunk"]
        routed = anchors.mapInArrow(route, f"vec_id long, label long, x array<long>, windows {_WINDOWS}, cell int")
        in_blocks = F.explode(F.sequence(F.lit(0), F.greatest(self._blocks_of(F.col("cell")) - 1, F.lit(0))))
        asked = routed.select("*", in_blocks.alias("block"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"))
        copies = self.rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        found = copies.groupBy(key).cogroup(asked.groupBy(key)).applyInArrow(seek, _FOUND)
        best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "other_id")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def _arrays(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), matrix(table.column("x").combine_chunks(), size)


def _with_first_limits(anchors: DataFrame, index: Index, most: int) -> DataFrame:
    """Anchors with one window open upwards: its lower limit is the score of the last of the best within the sample."""
    size, (ids, labels, x) = index.size, index.sample

    def limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, group, vectors = _arrays(pa.Table.from_batches([batch]), size)
            lows = np.full(len(own), -NO_LIMIT, np.int64)
            for first in range(0, len(own), 256):
                part = slice(first, first + 256)
                fits = (group[part, None] == labels) & (own[part, None] != ids)
                scores = np.where(fits, products(vectors[part], x), -NO_LIMIT)
                if len(ids) >= most:
                    lows[part] = np.partition(scores, len(ids) - most, axis=1)[:, len(ids) - most]
            windows = [[{"positive_id": None, "positive_score": None, "low": low, "high": NO_LIMIT}] for low in lows.tolist()]
            yield batch.append_column("windows", pa.array(windows, pa.list_(_WINDOW)))

    return anchors.mapInArrow(limit, f"vec_id long, label long, x array<long>, windows {_WINDOWS}")


def _hundredths(number: Column) -> Column:
    """A hundredth of a whole number, rounded down."""
    return ((number - F.pmod(number, F.lit(100))) / 100).cast("long")


def mine(
    vectors: DataFrame,
    anchor: Column,
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of the rows for which `anchor` holds, from (vec_id, label, `vector`).

    Entries are taken times 256 and rounded down; a score is the inner product of two vectors, the higher the better, and
    of equal scores the smaller vec_id comes first. For each anchor and each of its first `positives` other rows of the same
    label: the first `negatives` rows of other labels whose score is from `low` to `high` percent of the positive's, as
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Where there are fewer, all of them.

    Rows without vec_id or label take no part, nor do those whose vector is null, empty, of an unusual length, or holds a
    null or non-finite entry. Of rows with the same vec_id one counts, that with the smallest label and vector. No negative has a
    score in the window of a positive below 0. An empty table gives an empty one. Entries so large that 64-bit products
    would not be exact (millions) are an error. Other columns are not looked at.
    """
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    named = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long").alias("label"), vector, anchor.alias("_anchor"))
    rows, size = whole_vectors(named.filter("vec_id IS NOT NULL AND label IS NOT NULL"), vector, "vec_id", "label", "_anchor")
    if not size:
        return vectors.sparkSession.createDataFrame([], result)
    marked = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x", "_anchor")).alias("_row"))
    marked = write_and_read(marked.select("vec_id", "_row.label", "_row.x", "_row._anchor"), "vectors")
    anchors = marked.filter("_anchor").drop("_anchor")
    n_anchors = anchors.count()
    index = Index(marked.drop("_anchor"), size)
    nearest = index.search(_with_first_limits(anchors, index, positives), positives, True, n_anchors)
    chosen = nearest.select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score")
    limits = chosen.select("*", (-_hundredths(-score * low)).alias("low"), _hundredths(score * high).alias("high")).filter("low <= high")
    windows = limits.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score", "low", "high")).alias("windows"))
    asked = write_and_read(anchors.join(windows, anchors["vec_id"] == windows["anchor_id"]).drop("anchor_id"), "windows")
    found = index.search(asked, negatives, False, n_anchors)
    return found.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

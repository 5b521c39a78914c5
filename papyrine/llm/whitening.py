"""Whitening of embeddings by principal components of a collection of any size.

Each partition keeps the eigenvalues and eigenvectors of its scatter matrix and adds one vector at a time: a centred
rank-one update, whose new eigenvalues are the roots of the secular equation and lie between the old ones. What an update
cannot move is deflated beforehand. Spectra of partitions are combined in groups of `FAN_IN`, a level at a time, by updates
with the eigenvectors of one and with the difference of the means. Rounding has crept into this basis, so in the end
every partition projects its centred vectors on it, the projected covariances are added up, and the small eigenproblem of
their sum turns the basis into eigenvectors to double precision (Rayleigh-Ritz).

Spectra are matrices of a fixed size; nothing else meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.scratch import write_and_read
from papyrine.llm.vectors import bytes_column, matrix, whole_vectors

FAN_IN = 8  # spectra combined by one task
_EPS = np.finfo(float).eps
_LIMB = 24  # sums are cut here so that products with them stay exact


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum of weights / (poles - root), for ascending poles and positive weights.

    There is one root above each pole. Returns the pole nearest to each root (by number) and the root's distance from it,
    which keeps its digits even where the root all but touches the pole.
    """
    k = len(poles)
    width = np.append(np.diff(poles), weights.sum())
    middle = poles + width / 2
    at_middle = 1 + (weights / (poles - middle[:, None])).sum(axis=1)
    near = np.arange(k) + ((at_middle < 0) & (np.arange(k) < k - 1))
    shift = poles - poles[near][:, None]  # poles as seen from the nearest one
    low, high = shift[np.arange(k), np.arange(k)], np.append(shift[np.arange(k - 1), np.arange(1, k)], width[-1:])
    first, last = low.copy(), high.copy()
    root = (low + high) / 2
    below = np.tri(k)  # poles up to each root's own
    for _ in range(60):
        gap = shift - root[:, None]
        parts = weights / gap
        slopes = parts / gap
        value = 1 + parts.sum(axis=1)
        low, high = np.where(value <= 0, root, low), np.where(value >= 0, root, high)
        # The poles below and above the root are each stood in for by one pole with the same value and slope.
        slope = np.einsum("ij,ij->i", slopes, below)
        rest = slopes.sum(axis=1) - slope
        from_first, to_last = first - root, last - root
        q, s = slope * from_first**2, rest * to_last**2
        c = value - slope * from_first - rest * to_last
        with np.errstate(all="ignore"):
            b, e = c * (from_first + to_last) + q + s, from_first * to_last * value
            wide = np.sqrt(np.maximum(b * b - 4 * c * e, 0))
            step = np.where(b > 0, 2 * e / (b + wide), (b - wide) / (2 * c))
            only = value - slope * from_first  # above the last pole there is nothing
            step[-1] = (from_first + q / only)[-1] if only[-1] > 0 else np.nan
            new = root + step
        exact = np.abs(value) <= 8 * _EPS * (1 + np.abs(parts).sum(axis=1))  # as near to 0 as rounding lets it be
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        new = np.where(exact, root, new)
        close = np.abs(new - root) <= 2 * _EPS * np.abs(new)
        root = new
        if close.all():
            break
    return near, root


def add_rank_one(values: np.ndarray, vectors: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues, and eigenvectors in columns, of a matrix known by them plus weight * vector * vector'."""
    z = vectors.T @ vector
    size = float(z @ z)
    if not weight * size > 0:
        return values, vectors
    z, rho = z / np.sqrt(size), weight * size
    tiny = 8 * _EPS * max(abs(values[-1]), rho)
    # Equal eigenvalues: turn their eigenvectors so that the update meets one of them only.
    equal = np.flatnonzero(np.diff(values) <= tiny)
    if len(equal):
        vectors = vectors.copy()
        for run in np.split(equal, np.flatnonzero(np.diff(equal) > 1) + 1):
            part = slice(run[0], run[-1] + 2)
            norm = np.linalg.norm(z[part])
            if norm <= tiny / rho:
                continue
            mirror = z[part].copy()
            mirror[-1] += np.copysign(norm, mirror[-1])
            mirror /= np.linalg.norm(mirror)
            vectors[:, part] -= 2 * np.outer(vectors[:, part] @ mirror, mirror)
            turned = np.zeros(len(mirror))
            turned[-1] = -np.copysign(norm, z[part][-1])
            z[part] = turned
    moved = np.flatnonzero(rho * np.abs(z) > tiny)
    if not len(moved):
        return values, vectors
    poles, z = values[moved], z[moved]
    near, root = secular_roots(poles, rho * z * z)
    # Distances of roots and poles give the update for which these roots are exact, hence orthogonal eigenvectors.
    gap = (poles[near] - poles[:, None]).T + root[:, None]  # root i - pole j
    between = poles[:, None] - poles
    np.fill_diagonal(between, 1)
    exact = np.copysign(np.sqrt(np.abs(np.prod(gap / between, axis=0))), z)
    turn = exact / -gap
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    values, vectors = values.copy(), vectors.copy()
    values[moved], vectors[:, moved] = poles[near] + root, vectors[:, moved] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number of vectors, their mean, and eigenvalues and eigenvectors of the sum of their centred squares."""

    count: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.count += 1
        self.mean = self.mean + away / self.count
        self.values, self.vectors = add_rank_one(self.values, self.vectors, away, (self.count - 1) / self.count)

    def merge(self, other: Spectrum) -> None:
        if not other.count:
            return
        away, total = other.mean - self.mean, self.count + other.count
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = add_rank_one(self.values, self.vectors, vector, value)
        self.values, self.vectors = add_rank_one(self.values, self.vectors, away, self.count * other.count / total)
        self.mean, self.count = self.mean + away * (other.count / total), total

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.count], self.mean, self.values, self.vectors.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray, size: int) -> Spectrum:
        mean, values = flat[1 : size + 1].copy(), flat[size + 1 : 2 * size + 1].copy()
        return cls(int(flat[0]), mean, values, flat[2 * size + 1 :].reshape(size, size).copy())


def _combined(parts: DataFrame, together: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One array from the arrays of all partitions (`part`, `data`), in groups of FAN_IN, a level at a time."""
    levels = parts.agg(F.max("part")).first()[0]

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        made = together([np.frombuffer(x.as_py(), np.float64) for x in table.column("data").combine_chunks()])
        part = table.column("part")[0].as_py() // FAN_IN
        return pa.table({"part": pa.array([part], pa.int64()), "data": bytes_column([made])})

    if levels is None:
        return None
    while True:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("_group"))
        parts, levels = grouped.applyInArrow(join, "part long, data binary"), levels // FAN_IN
        if levels == 0:
            return np.frombuffer(parts.first()["data"], np.float64)


def _spectra(fit: DataFrame, size: int) -> DataFrame:
    """A row for each partition that holds vectors: its spectrum, and exact sums of the entries in two parts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, high, low = Spectrum.empty(size), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            rows = matrix(batch.column("x"), size)
            high += (rows >> _LIMB).sum(axis=0)
            low += (rows & ((1 << _LIMB) - 1)).sum(axis=0)
            for row in rows.astype(np.float64):
                spectrum.add(row)
        if spectrum.count:
            columns = [pa.array([TaskContext.get().partitionId()], pa.int64()), bytes_column([spectrum.flat()])]
            limbs = [pa.array([limb.tolist()], pa.list_(pa.int64())) for limb in (high, low)]
            count = pa.array([spectrum.count], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, *limbs, count], names=["part", "data", "high", "low", "n"])

    return fit.mapInArrow(build, "part long, data binary, high array<long>, low array<long>, n long")


def _added(fit: DataFrame, size: int, project: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of p p', for p = [project(x), 1]."""

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = project(matrix(batch.column("x"), size).astype(np.float64))
            rows = np.column_stack([rows, np.ones(len(rows))])
            total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            part = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([part, bytes_column([total])], names=["part", "data"])

    parts = write_and_read(fit.mapInArrow(square, "part long, data binary"), "squares")
    flat = _combined(parts, lambda arrays: np.sum(arrays, axis=0))
    side = int(np.sqrt(len(flat)))
    return flat.reshape(side, side)


@dataclass
class Whitening:
    """Principal components of a fit list of `n` vectors with entry sums `sums`, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray  # components in columns
    trace: float
    identity_error: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def used(self, components: int) -> np.ndarray:
        """Which of the first components vary at all."""
        values = self.values[:components]
        return values > len(self.values) * _EPS * max(self.trace, 0.0)


def fit_whitening(fit: DataFrame, size: int, components: int) -> Whitening | None:
    """The whitening of a table of whole vectors `x`, each of which counts once; None for an empty table."""
    spectra = write_and_read(_spectra(fit, size), "spectra")

    def merged(arrays: list[np.ndarray]) -> np.ndarray:
        total = Spectrum.of(arrays[0], size)
        for array in arrays[1:]:
            total.merge(Spectrum.of(array, size))
        return total.flat()

    flat = _combined(spectra, merged)
    if flat is None:
        return None
    limbs = spectra.select(F.posexplode(F.arrays_zip("high", "low")).alias("place", "limb"))
    exact = [F.sum(F.col(f"limb.{name}").cast("decimal(38,0)")).alias(name) for name in ("high", "low")]
    sums = [(int(r["high"]) << _LIMB) + int(r["low"]) for r in limbs.groupBy("place").agg(*exact).orderBy("place").collect()]
    n = spectra.agg(F.sum("n")).first()[0]
    found = Whitening(n, sums, np.zeros(size), np.linalg.qr(Spectrum.of(flat, size).vectors)[0], 0.0, 0.0)
    mean, basis = found.mean(), found.vectors
    square = _added(fit, size, lambda rows: (rows - mean) @ basis)[:-1, :-1] / n
    values, turn = np.linalg.eigh((square + square.T) / 2)
    found.values, found.vectors, found.trace = values[::-1], (basis @ turn)[:, ::-1], float(np.trace(square))
    used = np.flatnonzero(found.used(components))
    if len(used):
        scaled = found.vectors[:, used] / np.sqrt(found.values[used])
        white = _added(fit, size, lambda rows: (rows - mean) @ scaled) / n
        covariance = white[:-1, :-1] - np.outer(white[-1, :-1], white[-1, :-1])
        found.identity_error = float(np.abs(covariance - np.eye(len(used))).max())
    return found


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """Coordinates of all vectors on the first principal components, scaled to variance 1.

    Entries are taken times 256 and rounded down. The components are those of the covariance of all different vectors. One
    row for each row of `df` and component: `key`, component (from 1), n (different vectors), deviation (squared length of
    n times the centred vector, exact), whitened, explained (share of the variance) and identity_error (of the covariance
    of the coordinates). Components are as many as dimensions at most.

    Rows whose vector is null, empty, of an unusual length, or holds a null or non-finite entry are left out. Rows with
    equal vectors or equal, null or missing keys are rows like others, and count once in the fit. A component without variance has
    no coordinates (null). Equal eigenvalues leave their components free; one choice holds for all rows. An empty table
    gives an empty one. Entries so large that 64-bit products would not be exact (millions) are an error. Other columns are not
    looked at.
    """
    rows, size = whole_vectors(df, vector, key)
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fit = write_and_read(rows.select("x").distinct(), "fit") if size else None
    found = fit_whitening(fit, size, components) if size else None
    if found is None:
        return df.sparkSession.createDataFrame([], schema)
    shown = min(components, size)
    used, mean = found.used(shown), found.mean()
    scaled = found.vectors[:, :shown] / np.sqrt(np.where(used, found.values[:shown], np.inf))
    explained = found.values[:shown] / found.trace if found.trace > 0 else np.zeros(shown)
    n, sums, error = found.n, found.sums, found.identity_error
    limbs = [np.array([s >> _LIMB for s in sums], np.int64), np.array([s & ((1 << _LIMB) - 1) for s in sums], np.int64)]
    squares = sum(s * s for s in sums)

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), size)
            own, high, low = ((x * x).sum(axis=1).tolist(), (x @ limbs[0]).tolist(), (x @ limbs[1]).tolist())
            deviation = [
                Decimal(n * (n * q - 2 * ((h << _LIMB) + lo)) + squares) for q, h, lo in zip(own, high, low, strict=True)
            ]
            white = (x - mean) @ scaled
            repeat = np.repeat(np.arange(len(x)), shown)
            count = len(repeat)
            arrays = [
                batch.column(key).take(pa.array(repeat)),
                pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x))),
                pa.array(np.full(count, n)),
                pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(repeat)),
                pa.array(white.ravel(), mask=np.tile(~used, len(x))),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(count, error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(coordinates, schema)

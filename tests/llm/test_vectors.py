"""Hard negatives and whitening against plain versions over all rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrine.llm import hard_negatives, queries, whitening
from tests.llm.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, x string, size string, `cell` string, n string, part string"
CLASH = ("a",) * 5


def vectors(spark, rows):
    made = [(i, v and [c if c is None else float(c) for c in v], label, *CLASH) for i, v, label in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def odd_rows():
    pick = np.random.default_rng(5)
    rows = [(i, (pick.normal(size=6) * (1 + i % 3)).tolist(), int(pick.integers(3))) for i in range(400)]
    same = [1.5, -2.0, 0.25, 0.0, -0.0, 3.0]
    rows += [(1000 + i, same, i % 2) for i in range(300)]  # equal vectors: ties
    rows += [(2000, None, 1), (2001, [1.0, None, 0, 0, 0, 0], 1), (2002, [float("nan")] * 6, 0), (2003, [float("inf")] * 6, 0)]
    rows += [(2004, [0.0] * 6, None), (2005, [], 1), (2006, [1.0, 2.0], 2), (None, same, 1), (2007, [0.0] * 6, 2)]
    return rows


def whole(vector):
    return np.floor(256 * np.array(vector, np.float32).astype(float)).astype(np.int64)


def usable(vector):
    return vector is not None and len(vector) == 6 and all(c is not None and np.isfinite(c) for c in vector)


def plain_mining(rows, every, positives=5, negatives=10):
    rows = [(i, whole(v), label) for i, v, label in rows if i is not None and label is not None and usable(v)]
    found = []
    for a, x, label in (row for row in rows if row[0] % every == 0):
        scored = sorted((-int(x @ y), i, group) for i, y, group in rows if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(i, -ns) for ns, i, group in scored if group != label and -30 * ps <= -100 * ns <= -90 * ps]
            found += [(a, p, k, i, -ps, ns) for k, (i, ns) in enumerate(fits[:negatives], 1)]
    return sorted(found)


@pytest.mark.parametrize(("block", "chunk", "sample"), [(4096, 2048, 4096), (60, 5, 30), (1000, 1, 1)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block, chunk, sample):
    for name, value in (("ROW_BLOCK", block), ("ANCHOR_BLOCK", chunk), ("SAMPLE_ROWS", sample)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = odd_rows()
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 20 == 0)
    want = plain_mining(rows, 20)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 500


def test_hard_negatives_of_few_and_repeated_rows(spark):
    rows = odd_rows()
    assert hard_negatives.mine(vectors(spark, rows).filter("false"), F.col("vec_id") % 20 == 0).collect() == []
    assert hard_negatives.mine(vectors(spark, [(0, [1.0], 1)]), F.col("vec_id") % 20 == 0).collect() == []
    assert hard_negatives.mine(vectors(spark, rows), F.col("vec_id") < 0).collect() == []
    twice = hard_negatives.mine(vectors(spark, rows + rows[::-1]), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, twice.collect())) == plain_mining(rows, 20)


def test_hard_negatives_of_clusters_skip_subtrees(monkeypatch):
    pick = np.random.default_rng(1)
    centres = pick.integers(-4000, 4000, (40, 8))
    x = centres[np.arange(4000) % 40] + pick.integers(-20, 20, (4000, 8))
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    tree = hard_negatives.Tree(np.arange(4000), np.arange(4000) % 7, x)
    seen = []
    leaf = hard_negatives.Search._leaf
    monkeypatch.setattr(hard_negatives.Search, "_leaf", lambda self, part, live: (seen.append(len(part.ids) * len(live)), leaf(self, part, live)))
    own = (x[:50] * x[:50]).sum(axis=1)
    search = hard_negatives.Search(np.arange(50), np.arange(50) % 7, x[:50], np.arange(50), own - 5000, own + 5000, 5, True)
    search.run(tree, np.arange(50))
    assert sum(seen) < 0.5 * 50 * 4000
    scores = x[:50] @ x.T
    for a in range(50):
        fits = [(-s, i) for i, s in enumerate(scores[a].tolist()) if i % 7 == a % 7 and i != a and abs(s - own[a]) <= 5000]
        window, score, row = search.found
        assert list(zip(-score[window == a], row[window == a], strict=True)) == sorted(fits)[:5]


def test_registered_hard_negatives_equal_their_sql(spark):
    got = queries.op11_hard_negatives(spark, SF)
    want = duckdb.sql(queries.HARD_NEGATIVES_SQL.replace("FROM embeddings", f"FROM '{SF}/embeddings.parquet'"))
    assert got.columns == list(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) and got.count() > 200


def test_rank_one_updates_keep_eigenvalues_and_orthogonality():
    pick = np.random.default_rng(2)
    for d in (1, 2, 7, 30):
        x = np.floor(pick.normal(size=(120, d)) * 40)
        x[:40] = x[0]  # equal vectors, and fewer than dimensions at first
        if d > 2:
            x[:, 2] = x[:, 1]  # a dimension without variance of its own
        one, two = whitening.Spectrum.empty(d), whitening.Spectrum.empty(d)
        for row in x[:50]:
            one.add(row)
        for row in x[50:]:
            two.add(row)
        one.merge(two)
        centred = x - x.mean(axis=0)
        scatter = centred.T @ centred
        assert np.allclose((one.vectors * one.values) @ one.vectors.T, scatter, atol=1e-10 * max(1, scatter.max()))
        assert np.allclose(one.vectors.T @ one.vectors, np.eye(d), atol=1e-12)
        assert np.allclose(one.values, np.linalg.eigvalsh(scatter), atol=1e-10 * max(1, scatter.max()))


def test_secular_roots_lie_between_the_poles():
    pick = np.random.default_rng(3)
    for k in (1, 2, 3, 50):
        poles = np.sort(pick.random(k)) * 10.0 ** pick.integers(-3, 4)
        weights = pick.random(k) ** 8 + 1e-14
        near, root = whitening.secular_roots(poles, weights)
        want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
        assert np.allclose(poles[near] + root, want, rtol=1e-12, atol=1e-13 * max(poles[-1], 1))


@pytest.mark.parametrize("fan_in", [8, 2])
def test_whitening_equals_a_plain_eigendecomposition(many_partitions, monkeypatch, fan_in):
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    rows = odd_rows()
    got = whitening.whiten(vectors(many_partitions, rows)).collect()
    kept = [(i, whole(v)) for i, v, _ in rows if usable(v)]
    assert len(got) == 4 * len(kept)
    x = np.array([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    white = (x - sums / n) @ components[:, :4] / np.sqrt(values[:4])
    by_id = {(row.vec_id, row.component): row for row in got}
    mine = np.array([[by_id[i, c].whitened for c in range(1, 5)] for i, _ in kept])
    assert np.allclose(mine * np.sign((mine * white).sum(axis=0)), white, atol=1e-9)
    for i, v in kept:
        row = by_id[i, 2]
        assert (row.n, int(row.deviation)) == (n, int(((n * v - sums) ** 2).sum()))
        assert abs(row.explained - values[1] / values.sum()) < 1e-12 and row.identity_error < 1e-10


def test_whitening_of_odd_tables(spark):
    rows = odd_rows()
    assert whitening.whiten(vectors(spark, rows).filter("false")).collect() == []
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)])).collect()
    assert [(r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in one] == [
        (1, c, 1, 0, None, 0.0) for c in (1, 2, 1, 2)
    ]
    line = whitening.whiten(vectors(spark, [(k, [k / 4, k / 2, 0.0], 0) for k in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line)
    first = [r for r in line if r.component == 1]
    assert abs(sum(r.whitened**2 for r in first) / 9 - 1) < 1e-12 and abs(first[0].explained - 1) < 1e-12
    large = [[4e5 * (k + 1), -4e5 * k] for k in range(3)]
    got = whitening.whiten(vectors(spark, [(k, v, 0) for k, v in enumerate(large)])).filter("component = 1").collect()
    x = [[int(c) * 256 for c in np.array(v, np.float32)] for v in large]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert {r.vec_id: int(r.deviation) for r in got} == {k: sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for k, v in enumerate(x)}


def test_registered_whitening_has_whole_columns(spark):
    got = queries.op12_whitening(spark, SF)
    assert dict(got.dtypes)["deviation"] == "bigint" and got.count() == 4 * 500

"""Suffix dedup, line dedup and SimHash against plain versions."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrine.llm import components, line_dedup, queries, simhash, suffix_dedup
from tests.llm import brute
from tests.llm.conftest import SF


def removed(df, length=200):
    kept = suffix_dedup.remove_repeated(df, length)
    rows = kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("large", [1500, 1])
def test_suffix_dedup_equals_brute_force(spark, rows, monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE_BUCKET", large)  # both ways of settling a bucket
    got = sorted(map(tuple, queries.op1_suffix_dedup(spark, SF).collect()), key=repr)
    assert got == sorted(brute.repeated_bytes(rows), key=repr)


def test_suffix_dedup_of_odd_rows(odd, odd_rows, none):
    few = [(i, t) for i, t in odd_rows if len(t or "") < 10_000 or i == 5]  # the long one is in the table twice
    got = removed(odd.filter("doc_id IS NULL OR doc_id <> 6"))
    assert got == sorted(brute.repeated_bytes(few), key=repr)
    twice = {row[0]: row for row in removed(odd)}
    assert twice[5][2] == twice[6][2] == twice[5][1]
    assert removed(none) == []


@pytest.mark.parametrize("large", [1500, 1])
def test_suffix_dedup_can_keep_the_first(spark, monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE_BUCKET", large)
    pick = random.Random(1)
    passages = ["".join(pick.choice("abcdef ") for _ in range(pick.randint(30, 200))) for _ in range(6)]
    texts = ["".join(pick.choice([*passages, f"unique {n} {pick.random()}"]) for _ in range(8)) for n in range(60)]
    texts += ["ab" * 300, texts[0], ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {row.doc_id: bytes(row.kept) for row in suffix_dedup.remove_repeated(df, 50, keep_first=True).collect()}
    assert got == brute.later_copies(list(enumerate(texts)), 50)


def test_longest_previous_factors():
    pick = random.Random(2)
    for _ in range(50):
        suffixes = [bytes(pick.choice(b"ab") for _ in range(4)) for _ in range(pick.randint(1, 30))]
        earlier, later = suffix_dedup.longest_previous_factors(suffixes)
        assert earlier == [4 if s in suffixes[:i] else 0 for i, s in enumerate(suffixes)]
        assert later == [4 if s in suffixes[i + 1 :] else 0 for i, s in enumerate(suffixes)]


def test_contexts_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(random.Random(3).randbytes(60_000), np.uint8) % 7
    offsets = np.array([0, 100, 30_000, 30_000, 60_000])

    def found():
        return [np.concatenate(x).tolist() for x in zip(*suffix_dedup.contexts(data, offsets, 200), strict=True)]

    whole = found()
    monkeypatch.setattr(suffix_dedup, "BLOCK", 5_000)
    assert found() == whole
    assert sum(whole[3]) == 2 * (30_000 - 199) - 100


def test_line_dedup_equals_sql(spark):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = connection.sql(queries.ORACLES["op7_line_dedup"])
    got = queries.op7_line_dedup(spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup_of_odd_rows(odd, odd_rows, none):
    got = line_dedup.drop_repeated_lines(odd)
    assert sorted(got.columns) == sorted(odd.columns)
    want = [(i, *rest) for (i, _), rest in zip(odd_rows, brute.deduplicated_lines(odd_rows), strict=True)]
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr) == sorted(want, key=repr)
    assert line_dedup.drop_repeated_lines(none).collect() == []


def test_first_lines_come_from_sorted_ranges(many_partitions):
    rows = [(h, h * 7, i % 4, True, i // 3, 0, i % 3) for h in range(50) for i in range(60)]
    found = many_partitions.createDataFrame(rows, "_h1 long, _h2 long, _stream int, named boolean, row_key long, text_hash long, _place int").repartition(5)
    streams = line_dedup._streams(found)
    got = {(r._h1, r._stream): (r._docs, r._any, r._last) for r in streams.collect()}
    for h in range(50):
        for stream in range(4):
            docs = {i // 3 for i in range(60) if i % 4 == stream}
            assert got[h, stream] == (len(docs), max(docs), max(docs))
    plan = streams._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    steps = re.findall(r"Window|Sort |rangepartitioning|hashpartitioning", final)
    assert steps == ["Window", "Sort ", "rangepartitioning"], final  # one sort and one shuffle, and both are used


def test_line_dedup_with_a_hot_line(many_partitions):
    hot = "this line stands in each and every document of the table"
    texts = [f"{hot.upper() if n % 2 else hot}\nrow {n}\n {hot} " for n in range(2_000)]
    df = many_partitions.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {row.doc_id: row for row in line_dedup.drop_repeated_lines(df).collect()}
    assert all(got[n].text == (f"row {n}" if n < 1_999 else texts[n]) for n in range(2_000))
    runs = {row.row_key: row.dropped for row in line_dedup.repeated_lines(df).collect()}
    assert [tuple(run) for run in runs[0]] == [(0, 0), (2, 2)] and 1_999 not in runs


def test_simhash_equals_brute_force(spark, rows):
    prints = [brute.simhash(text) for _, text in rows]
    roots = brute.clusters(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    want = [(doc_id, f"{own:016x}", rows[root][0]) for (doc_id, _), own, root in zip(rows, prints, roots, strict=True)]
    got = queries.op6_simhash(spark, SF).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("block, large", [(800, 12_800), (10, 40)])
def test_links_equal_brute_force(spark, monkeypatch, block, large):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "LARGE_BUCKET", large)
    pick = random.Random(5)
    prints = {0, 2**64 - 1}
    for _ in range(12):  # chains, and balls that are dense in a few bits
        value = pick.getrandbits(64)
        for _ in range(30):
            prints.add(value)
            for _ in range(pick.randint(1, 4)):
                value ^= 1 << pick.choice([pick.randrange(64), pick.randrange(8)])
    prints = sorted(prints)
    signed = [value - (value >> 63 << 64) for value in prints]
    df = spark.createDataFrame([(value,) for value in signed], "fingerprint long")
    links = simhash.find_links(df)
    root = {row.node: row.root for row in components.components(links).collect()}
    groups = brute.clusters(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    got, want = {}, {}
    for value, group in zip(signed, groups, strict=True):
        got.setdefault(root.get(value, value), set()).add(value)
        want.setdefault(group, set()).add(value)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_simhash_of_odd_rows(odd, odd_rows, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    blank = {row.component_id for row in got if row.fingerprint == 0}
    assert blank == {1}  # null, empty and blank texts are alike
    assert all(row.component_id is not None for row in got if row.doc_id is not None)
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    prints = [brute.simhash(text) for _, text in odd_rows]
    groups = len(set(brute.clusters(prints, lambda a, b: (a ^ b).bit_count() <= 3)))
    assert kept.count() == groups
    assert sorted(row.doc_id for row in kept.collect() if row.doc_id in (1, 2, 3, 5, 6)) == [1, 5]
    assert simhash.near_duplicates(none).collect() == [] and simhash.keep_one_of_each(none).collect() == []


def test_thresholds_are_allocated_at_least_cost():
    from itertools import product

    pick = random.Random(6)
    for _ in range(20):
        costs = [sorted(pick.randint(1, 1000) for _ in range(4)) for _ in range(4)]
        chosen = simhash.allocate(costs, 0)
        price = lambda some: sum(c[t] for c, t in zip(costs, some, strict=True) if t >= 0)  # noqa: B023, E731
        assert sum(chosen) == 0 and price(chosen) == min(price(x) for x in product(range(-1, 4), repeat=4) if sum(x) == 0)


def test_candidate_counts_are_exact():
    values = np.random.default_rng(7).integers(0, 64, 300)
    got = simhash.candidate_counts(np.bincount(values, minlength=64), 2)
    apart = np.bitwise_count((values[:, None] ^ values[None, :]).astype(np.uint64))
    assert np.allclose(got, [(apart <= t).sum() for t in range(3)])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, n) for n in range(200, 260)] + [(3, 3), (250, 130)]
    got = {row.node: row.root for row in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 7 for n in [*range(100, 161), *range(200, 260)]}

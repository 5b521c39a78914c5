"""Near-duplicates and components against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from papyrine.operators import near_duplicates as N
from papyrine.operators.components import connected

SCHEMA = "id long, body string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingle_set(text, width=5):
    found = words(text)
    return {tuple(found[i : i + width]) for i in range(max(len(found) - width + 1, 1))} if found else set()


def components_of(rows, least=0.8):
    """The smallest id that each row can reach, over all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            shared = len(one & sets[j])
            if shared and shared >= least * (len(one) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    smallest = {}
    for i, (row_id, _) in enumerate(rows):
        if row_id is not None:
            smallest[find(i)] = min(row_id, smallest.get(find(i), row_id))
    return sorted(((row_id, smallest.get(find(i))) for i, (row_id, _) in enumerate(rows)), key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = N.near_duplicates(df, "id", "body")
    assert got.columns == ["id", "component"]
    return sorted(map(tuple, got.collect()), key=repr)


def changed(text, pick, share):
    out = text.split()
    for place in pick.sample(range(len(out)), max(1, int(len(out) * share))):
        out[place] = f"other{pick.randrange(10**6)}"
    return " ".join(out)


def test_groups_equal_all_pairs(spark):
    pick = random.Random(3)
    vocabulary = [f"word{i}" for i in range(400)]
    texts = [" ".join(pick.choices(vocabulary, k=pick.randrange(30, 200))) for _ in range(40)]
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(100 + i, changed(texts[i % 40], pick, pick.choice((0.01, 0.02, 0.03, 0.05)))) for i in range(120)]
    rows += [(300, texts[0].upper() + " !"), (301, ""), (302, None), (303, "?"), (304, "two words"), (305, "Two  words\n"), (None, texts[0])]
    rows += [(None, "nobody's text"), (306, texts[1]), (306, texts[1])]
    assert found(spark, rows) == components_of(rows)


def test_a_large_group_of_near_copies_and_a_shared_footer(many_partitions):
    pick = random.Random(5)
    footer = " ".join(f"foot{i}" for i in range(60))
    base = " ".join(f"base{i}" for i in range(80))
    rows = [(i, changed(base, pick, 0.01)) for i in range(300)]
    rows += [(1_000 + i, " ".join(f"own{i}x{j}" for j in range(40)) + " " + footer) for i in range(200)]
    rows += [(2_000 + i, rows[300 + i][1] + " end") for i in range(50)]  # pairs within the hot buckets of the footer
    assert found(many_partitions, rows) == components_of(rows)


def test_buckets_that_stay_apart_get_further_pivots(spark, monkeypatch):
    pick = random.Random(9)
    base = " ".join(f"base{i}" for i in range(150))
    rows, text = [], base
    for i in range(25):  # a chain: neighbours are alike, the ends are not
        rows.append((i, text))
        text = changed(text, pick, 0.014)
    want = components_of(rows)
    monkeypatch.setattr(N, "DEPTH", 1)
    assert found(spark, rows) == want


def test_a_small_bucket_is_settled_at_once(spark):
    names = [f"v{i}" for i in range(8)]  # pairs are alike, the first two are known to be
    sets = spark.createDataFrame([(name, [i // 2 * 10 + j for j in range(9)] + [1000 + i // 7]) for i, name in enumerate(names)], "vertex string, shingles array<long>")
    rows = [("x", name, 10, 8, "v0" if i < 2 else name) for i, name in enumerate(names)]
    apart = spark.createDataFrame(rows, "bucket string, vertex string, n int, size long, root string")
    links = N._by_pivots(apart, sets, 0.8, N.WHOLE)
    assert sorted(map(tuple, links.collect())) == [("v2", "v3"), ("v4", "v5"), ("v6", "v7")]


def test_nothing_and_one(spark):
    assert found(spark, [(1, "one text only")]) == [(1, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert N.near_duplicates(none, "id", "body").collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], SCHEMA)
    plan = df.select(N.shingles(F.col("body")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("length", [1, 2, 50])
def test_components_of_chains_stars_and_rings(spark, length):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(length)]
    star = [("s000", f"s{i:03}") for i in range(1, length + 1)]
    ring = [(f"r{i:03}", f"r{(i + 1) % (length + 1):03}") for i in range(length + 1)]
    links = spark.createDataFrame(chain + star + ring + [("x", "x")], "a string, b string").repartition(3)
    got = {row.node: row.root for row in connected(links).collect()}
    assert got == {name: f"{name[0]}000" for pair in chain + star + ring for name in pair}
    assert connected(links.filter("false")).collect() == []

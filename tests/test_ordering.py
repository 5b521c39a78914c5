"""Row numbers, ranks, names and subsets against plain Python, with work really divided over partitions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from papyrine.operators.naming import cap_candidates, collision_safe_names
from papyrine.operators.ordering import PARTITION, _sorted_and_placed, number_rows, rank_in_groups
from papyrine.operators.subsets import assign_subsets, subset_count, subset_manifest


@pytest.fixture(scope="module")
def keyed():
    pick = random.Random(3)
    names = ["hot"] * 10 + [f"n{i}" for i in range(20)]
    rows = [(pick.choice(names), pick.randint(0, 10**6), i) for i in range(4_000)]
    pick.shuffle(rows)
    return rows


def test_number_rows(many_partitions, keyed):
    df = many_partitions.createDataFrame(keyed, "name string, value int, id int").repartition(5)
    got = {row.id: row.row_index for row in number_rows(df, ["name", "value", "id"]).collect()}
    want = {row[2]: index for index, row in enumerate(sorted(keyed))}
    assert got == want


def test_rank_in_groups_divides_a_hot_group(many_partitions, keyed):
    df = many_partitions.createDataFrame(keyed, "name string, value int, id int").repartition(5)
    got = {row.id: row["rank"] for row in rank_in_groups(df, "name", ["value", "id"]).collect()}
    want, seen = {}, {}
    for name, _, row_id in sorted(keyed):
        seen[name] = seen.get(name, 0) + 1
        want[row_id] = seen[name]
    assert got == want


def test_one_group_over_all_partitions(many_partitions):
    df = many_partitions.range(1_000).select(F.lit("same").alias("name"), "id")
    got = {row.id: row["rank"] for row in rank_in_groups(df, "name", ["id"]).collect()}
    assert got == {i: i + 1 for i in range(1_000)}


@pytest.mark.parametrize("columns", [["key"], ["key", "id"]])
def test_one_key_for_all_rows_is_divided_too(many_partitions, columns):
    df = many_partitions.range(0, 4_000, 1, 4).select(F.lit("same").alias("key"), "id").select(*columns)
    sizes = [row["count"] for row in _sorted_and_placed(df, ["key"]).groupBy(PARTITION).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1_000
    assert sorted(row.row_index for row in number_rows(df, ["key"]).collect()) == list(range(4_000))


def names_one_by_one(paths):
    """Give every first file of a name its own name, then try numbers for the others, one file after the other."""
    paths = sorted(paths)
    named, rest = {}, []
    for path in paths:
        base = path.rsplit("/", 1)[-1]
        if base in named:
            rest.append((path, base))
        else:
            named[base] = path
    for path, base in rest:
        stem, ext = os.path.splitext(base)
        number = 1
        while f"{stem}_{number}{ext}" in named:
            number += 1
        named[f"{stem}_{number}{ext}"] = path
    return {path: name for name, path in named.items()}


def test_names_equal_one_by_one(many_partitions):
    pick = random.Random(4)
    bases = ["a.pdf", "a_1.pdf", "a_1_1.pdf", "a_2.pdf", "a_7.pdf", "a_01.pdf", "b", "b_1", ".pdf", "_1.pdf", ".pdf_1"]
    bases += ["..pdf", "._1.pdf", "a.PDF", "c.d.pdf", "c.d_3.pdf", "a_0.pdf"] + [f"a_{n}.pdf" for n in range(20, 60)]
    paths = [f"/{i:05d}/{'a.pdf' if i % 3 == 0 else pick.choice(bases)}" for i in range(900)]
    df = many_partitions.createDataFrame([(path,) for path in paths], "path string").repartition(4)
    got = {row.path: row.name for row in collision_safe_names(df).collect()}
    assert got == names_one_by_one(paths)
    assert len(set(got.values())) == len(paths)


def test_names_without_any_collision(spark):
    df = spark.createDataFrame([("/x/a.pdf", 1), ("/y/b.pdf", 2)], "path string, size int")
    got = {row.path: (row.name, row["size"]) for row in collision_safe_names(df).collect()}
    assert got == {"/x/a.pdf": ("a.pdf", 1), "/y/b.pdf": ("b.pdf", 2)}


def test_candidate_cap(many_partitions):
    df = many_partitions.range(500).select(F.format_string("/p/%05d.pdf", "id").alias("path"))
    got = [row.path for row in cap_candidates(df, 123).orderBy("path").collect()]
    assert got == [f"/p/{i:05d}.pdf" for i in range(123)]
    assert cap_candidates(df, None).count() == 500
    assert cap_candidates(df, 0).count() == 500


def test_subsets_partition_the_input(many_partitions):
    df = many_partitions.range(1_000).select(F.format_string("/p/%05d.pdf", "id").alias("path")).repartition(7)
    assigned = assign_subsets(df, 300)
    rows = sorted(assigned.collect())
    assert [row.subset_id for row in rows] == [i // 300 + 1 for i in range(1_000)]
    manifest = sorted(subset_manifest(assigned).collect())
    assert [(row.folder, row.files) for row in manifest] == [
        ("subset_1", 300), ("subset_2", 300), ("subset_3", 300), ("subset_4", 100),
    ]
    assert manifest[3].first_path == "/p/00900.pdf" and manifest[3].last_path == "/p/00999.pdf"
    assert tuple(subset_count(df, 300).first()) == (1_000, 4)


def test_no_files(spark):
    none = spark.createDataFrame([], "path string")
    assert assign_subsets(none, 10).count() == 0
    assert collision_safe_names(none).count() == 0
    assert tuple(subset_count(none, 10).first()) == (0, 0)


def test_rows_without_a_path_stay_without_a_name(many_partitions):
    rows = [("/a/x.pdf", 1), (None, 2), ("/b/x.pdf", 3), (None, 2)]
    df = many_partitions.createDataFrame(rows, "path string, id int")
    got = collision_safe_names(df)
    assert got.columns == ["path", "id", "name"]
    assert sorted((tuple(row) for row in got.collect()), key=repr) == sorted(
        [("/a/x.pdf", 1, "x.pdf"), (None, 2, None), ("/b/x.pdf", 3, "x_1.pdf"), (None, 2, None)], key=repr
    )
    assert [row.name for row in collision_safe_names(df.filter("path IS NULL")).collect()] == [None, None]

"""Shards against what must hold for them, whatever the placing."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from papyrine.llm import queries, sharding
from tests.llm.conftest import SF


def check(rows, got, shards):
    """Every row once with its size and checksum, gapless slots, copies together; returns bytes and rows of each shard."""
    raw = [(i, (text or "").encode()) for i, text in rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in raw)
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in got)
    slots, loads = defaultdict(list), np.zeros((shards, 2))
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size, 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


@pytest.mark.parametrize("heavy", [1024, 300])
@pytest.mark.parametrize("block", [1 << 16, 50])
def test_shards_are_near_equal_and_keep_copies_together(many_partitions, rows, monkeypatch, heavy, block):
    monkeypatch.setattr(sharding, "HEAVY", heavy)
    monkeypatch.setattr(sharding, "BLOCK_GROUPS", block)
    pick = np.random.default_rng(4)
    short = [(10_000 + i, " ".join(["word"] * int(pick.integers(1, 40))) + f" {i // 3}") for i in range(3_000)]
    table = rows + short
    docs = many_partitions.createDataFrame(table, "doc_id long, text string").repartition(4)
    got = sharding.shard_documents(docs).collect()
    loads = check(table, got, 16)
    assert (np.abs(loads / loads.mean(axis=0) - 1).max(axis=0) < (0.03, 0.05)).all()
    place, text = defaultdict(set), dict(table)
    for r in got:
        place[text[r.doc_id]].add(r.shard)
    assert all(len(shards) == 1 for shards in place.values())


def test_a_hot_text_is_cut_into_few_equal_pieces(many_partitions):
    table = [(i, "the same text again and again") for i in range(1_000)] + [(1_000 + i, f"own text number {i} of many") for i in range(2_000)]
    docs = many_partitions.createDataFrame(table, "doc_id long, text string").repartition(4)
    got = sharding.shard_documents(docs).collect()
    loads = check(table, got, 16)
    assert np.abs(loads / loads.mean(axis=0) - 1).max() < 0.04
    pieces = Counter(r.shard for r in got if r.doc_id < 1_000)
    assert len(pieces) <= 7 and max(pieces.values()) - min(pieces.values()) <= 1


def test_shards_of_odd_rows(spark, odd, odd_rows, none):
    check(odd_rows, sharding.shard_documents(odd, shards=3).collect(), 3)
    check(odd_rows, sharding.shard_documents(odd, shards=200).collect(), 200)
    alone = sharding.shard_documents(odd, shards=1)
    assert [r.slot for r in alone.orderBy("slot").collect()] == list(range(len(odd_rows)))
    ids = [r.doc_id for r in alone.orderBy("slot").collect()]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert sharding.shard_documents(none).collect() == [] and sharding.shard_documents(none).columns == alone.columns


def test_registered_sharding(spark, rows):
    got = queries.op13_sharding(spark, SF).collect()
    loads = check(rows, got, 16)
    assert np.abs(loads[:, 0] / loads[:, 0].mean() - 1).max() < 0.06

"""Tokens, packing, token files and fingerprints."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from papyrine.llm import arrays, fuzzy_hash, packing, queries, token_files, tokens
from tests.llm import brute
from tests.llm.conftest import SF

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aZé's’ \n\t  　́.,-_1٣😀#Σß\x1c\x85", max_size=40), max_size=5))
def test_pieces_give_the_tokens_of_the_text(name, texts):
    ids, begins = tokens.loaded(public_tokenizers.path(name)).encode(*arrays.flat(pa.array(texts, pa.string())))
    direct = plain(name)
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)] == [direct(text) for text in texts]


OWN = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "a", "Z ", " ", "é", "\n", "'s", "1"]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(OWN), max_size=12).map("".join), max_size=5))
def test_strings_of_tokens_are_those_tokens(name, texts):
    ids, begins = tokens.loaded(public_tokenizers.path(name)).encode(*arrays.flat(pa.array(texts, pa.string())))
    direct = plain(name)
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)] == [direct(text) for text in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n\té\x0b", max_size=30), max_size=6))
def test_words(texts):
    data, offsets = arrays.flat(pa.array(texts, pa.string()))
    starts, ends, before = arrays.words(data, offsets)
    want = [text.encode().split() for text in texts]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == [w for text in want for w in text]
    assert np.diff(before).tolist() == [len(text) for text in want]


def check_pieces(rows, pieces, window=4096):
    """Every id of every document once, in gapless sequences."""
    encode = plain(FILES[0])
    wanted = sorted((doc_id, ids) for doc_id, ids in ((i, [*encode(t), 2]) for i, t in rows) if doc_id is not None)
    sequences, documents = defaultdict(list), defaultdict(list)
    for piece in pieces:
        sequences[piece.sequence_id].append((piece.offset, piece.length))
        documents[piece.doc_id].append(piece)
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place and length > 0
            place += length
        assert place <= window
    by_id = defaultdict(list)
    for doc_id, ids in wanted:
        by_id[doc_id].append(ids)
    for doc_id, texts in by_id.items():
        if len(texts) == 1:
            [ids], place = texts, 0
            for piece in sorted(documents[doc_id], key=lambda x: x.start):
                assert piece.start == place and piece.doc_tokens == len(ids)
                assert piece.ids_crc32 == zlib.crc32(np.array(ids[place : place + piece.length], "<u4"))
                place += piece.length
            assert place == len(ids)
        assert sum(piece.length for piece in documents[doc_id]) == sum(map(len, texts))
    return [sum(length for _, length in parts) for parts in sequences.values()]


def test_packing(spark, rows):
    filled = check_pieces(rows, queries.op3_packing(spark, SF).collect())
    padding = sum(4096 - n for n in filled if n & (n - 1))
    assert padding < 0.002 * sum(filled)


def test_packing_of_odd_rows(odd, odd_rows, none):
    pieces = packing.pack_documents(odd, public_tokenizers.path(FILES[0]))
    check_pieces(odd_rows, pieces.collect())
    sequences = {row.sequence_id: row.ids for row in packing.assemble(pieces).collect()}
    for piece in pieces.collect():
        assert sequences[piece.sequence_id][piece.offset : piece.offset + piece.length] == piece.ids
    assert packing.pack_documents(none, public_tokenizers.path(FILES[0])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60))
def test_best_fit_loses_nothing_and_pads_little(lengths):
    sequences = packing.best_fit(lengths, 64, least_gap=8)
    covered = defaultdict(list)
    for sequence in sequences:
        assert sum(n for _, _, n in sequence) <= 64
        for doc, start, n in sequence:
            covered[doc] += range(start, start + n)
    assert {doc: sorted(ids) for doc, ids in covered.items()} == {doc: list(range(n)) for doc, n in enumerate(lengths)}
    filled = [sum(n for _, _, n in sequence) for sequence in sequences]
    assert all(64 - n < 8 or n & (n - 1) == 0 for n in filled)


def test_tightest_window():
    pick = random.Random(8)
    tree, opened = packing._Capacities(64), []
    for number in range(500):
        if pick.random() < 0.5:
            opened.append(pick.randint(1, 64))
            tree.put(opened[-1], number)
        least = pick.randint(1, 64)
        want = min((c for c in opened if c >= least), default=None)
        found = tree.take_tightest(least)
        assert (found[0] if found else None) == want
        if found:
            opened.remove(want)


def test_token_files(spark, rows):
    encode, start, want = plain(FILES[1]), 0, []
    for doc_id, text in sorted(rows):
        ids = np.array([*encode(text), 0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert sorted(map(tuple, queries.op9_token_files(spark, SF).collect())) == want


@pytest.mark.parametrize("planes", [token_files.BITS, token_files.BYTES])
def test_token_files_of_odd_rows(spark, odd, odd_rows, none, tmp_path, planes):
    path = public_tokenizers.path(FILES[1])
    token_files.write_token_files(odd, str(tmp_path / planes), path, planes=planes, chunk_ids=1_000)
    encode = plain(FILES[1])
    got = token_files.read_documents(spark, str(tmp_path / planes)).orderBy("start").collect()
    assert [row.doc_id for row in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    want = sorted((repr(i), zlib.crc32(np.array([*encode(t), 0], "<u4"))) for i, t in odd_rows)
    assert sorted((repr(row.doc_id), row.ids_crc32) for row in got) == want
    assert [row.start for row in got] == np.cumsum([0, *(row.n_tokens for row in got)])[:-1].tolist()
    chunks = token_files.read_token_files(spark, str(tmp_path / planes)).orderBy("start").collect()
    stream = [x for chunk in chunks for x in chunk.ids]
    assert len(stream) == sum(row.n_tokens for row in got)
    assert all(zlib.crc32(np.array(stream[r.start : r.start + r.n_tokens], "<u4")) == r.ids_crc32 for r in got)
    token_files.write_token_files(none, str(tmp_path / "none"), path)
    assert token_files.read_documents(spark, str(tmp_path / "none")).collect() == []


@given(st.lists(st.integers(0, 2**32 - 1), max_size=200), st.sampled_from([token_files.BITS, token_files.BYTES]))
def test_planes_round_trip(ids, planes):
    ids = np.array(ids, np.uint32)
    assert token_files.decode_planes(*token_files.encode_planes(ids, planes), len(ids)).tolist() == ids.tolist()


def test_fuzzy_hash(spark, rows):
    got = {row.doc_id: row for row in queries.op10_fuzzy_hash(spark, SF).collect()}
    ordered = sorted(rows, reverse=True)
    for place, (doc_id, text) in enumerate(ordered):
        following, cut = ordered[(place + 1) % len(ordered)], len(text) // 3
        edited = text[: len(text) - cut] + following[1][:cut]
        own = got[doc_id]
        assert (own.n_chars, own.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints = fuzzy_hash.fingerprints(*arrays.flat(pa.array([text, edited, following[1]])))
        assert [own.fingerprint, own.edited_fingerprint, got[following[0]].fingerprint] == prints
        assert own.near_edited == fuzzy_hash.likeness(prints[:1], prints[1:2])[0]
        assert own.near_next == fuzzy_hash.likeness(prints[:1], prints[2:])[0]
    different = [row for row in got.values() if row.near_next < 1]
    assert np.median([row.near_edited for row in different]) > 0.5 > 0.2 > np.median([row.near_next for row in different])


def test_fuzzy_hash_of_odd_rows(spark, odd, odd_rows, none):
    got = fuzzy_hash.compare_with_edit(odd).collect()
    assert sorted((repr(row.doc_id), row.n_chars) for row in got) == sorted((repr(i), len(t or "")) for i, t in odd_rows)
    assert fuzzy_hash.compare_with_edit(none).collect() == []
    [alone] = fuzzy_hash.compare_with_edit(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1
    prints = {row.fingerprint for row in fuzzy_hash.add_fingerprint(odd).filter("doc_id IN (5, 6)").collect()}
    assert len(prints) == 1


def test_fingerprints_do_not_depend_on_neighbours_or_blocks(monkeypatch):
    pick = random.Random(9)
    texts = ["".join(pick.choice("abcdefgh ") for _ in range(pick.choice([0, 1, 3, 6, 7, 50, 5_000, 40_000]))) for _ in range(40)]
    together = fuzzy_hash.fingerprints(*arrays.flat(pa.array(texts)))
    assert together == [fuzzy_hash.fingerprints(*arrays.flat(pa.array([text])))[0] for text in texts]
    monkeypatch.setattr(fuzzy_hash, "BLOCK", 1_000)
    assert together == fuzzy_hash.fingerprints(*arrays.flat(pa.array(texts)))
    assert all(len(x.split(":")[1]) <= fuzzy_hash.MOST_BORDERS + 1 for x in together)


def test_edit_distances():
    pick = random.Random(10)
    words = [bytes(pick.choice(b"abc") for _ in range(pick.randint(0, 12))) for _ in range(400)]
    got = fuzzy_hash.edit_distances(words[:200], words[200:]).tolist()
    assert got == [brute.levenshtein(a, b) for a, b in zip(words[:200], words[200:], strict=True)]

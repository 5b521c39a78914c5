"""Token ids of many texts at once.

The public tokenizers used here cut a text into words before they look for tokens, and no word reaches over the places
at which we cut. So a text's ids are those of its pieces, and each different piece goes through the tokenizer once. The
strings of a tokenizer's own tokens, such as <|endoftext|>, are looked for in the text as it is and are pieces by themselves.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from papyrine.llm.arrays import distinct, is_space, ragged

SLICE_BYTES = 3 << 20  # larger slices hold a piece more often
CACHED_PIECES = 600_000  # kept by a worker process, some 100 MB; then the cache starts anew
_BYTES = np.arange(256)
_ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~_ALNUM & (_BYTES != ord("'"))  # an apostrophe can begin a word such as 's


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at a text, at a single space between two characters that are none, and at an ASCII sign after
    an ASCII letter or digit.

    Byte-level tokenizers join such a space to the word after it; others drop it. Bytes C2, E1, E2 and E3 begin the
    white space outside ASCII, so there is no cut at a space beside characters that begin with them.
    """
    space = is_space(data)
    odd = space | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
    cut = data == 32
    cut[:-1] &= ~odd[1:]
    cut[-1:] = False
    cut[1:] &= ~space[:-1]
    cut[2:] &= ~(data[:-2] == 0xC2)
    cut[3:] &= ~((data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
    cut[1:] |= _ALNUM[data[:-1]] & _SIGN[data[1:]]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


class TokenEncoder:
    """Ids of texts under one tokenizer file. `loaded` keeps one for each file in a worker process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        if any(token.normalized or token.lstrip or token.rstrip or token.single_word for token in added):
            raise ValueError(f"{path}: tokens that are not looked for in the text as it is")
        names = sorted((token.content.encode() for token in added), key=len, reverse=True)
        self._own = re.compile(b"|".join(map(re.escape, names))) if names else None
        self._lower = "Lowercase" in repr(self._tokenizer.normalizer)
        self._forget()

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.uint32)
        self._ends = [0]

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """Number of each piece among the known ones, after learning the new ones."""
        if len(self._place) > CACHED_PIECES:
            self._forget()
        new = [piece for piece in pieces if piece not in self._place]
        for first in range(0, len(new), 5000):
            part = new[first : first + 5000]
            texts = [piece.decode() for piece in part]
            found = [code.ids for code in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            used, ids = self._ends[-1], np.array([x for one in found for x in one], np.uint32)
            if used + len(ids) > len(self._ids):
                self._ids = np.concatenate([self._ids[:used], np.zeros(used + len(ids), np.uint32)])
            self._ids[used : used + len(ids)] = ids
            for piece, one in zip(part, found, strict=True):
                self._place[piece] = len(self._ends) - 1
                self._ends.append(self._ends[-1] + len(one))
        return np.fromiter(map(self._place.__getitem__, pieces), np.int64, len(pieces))

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin: at the cuts, but for those within the string of a token, and around such strings."""
        starts, text, place, edges = cuts(data, offsets), data.tobytes(), 0, []
        while self._own and (found := self._own.search(text, place)):
            begin, end = found.span()
            whole = end <= offsets[np.searchsorted(offsets, begin, side="right")]  # not half in the next text
            place = end if whole else begin + 1
            edges += [(begin, end)] * bool(whole)
        if not edges:
            return starts
        begins, ends = np.array(edges).T
        before = np.searchsorted(begins, starts, side="right") - 1
        inside = (before >= 0) & (starts < ends[before])
        return np.union1d(starts[~inside], np.concatenate([begins, ends[ends < len(data)]]))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = self._starts(data, offsets)
        if self._lower:
            data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
        pieces, codes = distinct(data, starts)
        places = self._places(pieces)
        ends = np.array(self._ends)
        lengths = (ends[places + 1] - ends[places])[codes]
        before = np.append(0, np.cumsum(lengths))
        return self._ids[ragged(ends[places][codes], lengths)], before[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def loaded(path: str) -> TokenEncoder:
    return TokenEncoder(path)


def with_end(ids: np.ndarray, begins: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with `end_id` after each text's ids."""
    return np.insert(ids, begins[1:], np.uint32(end_id)), begins + np.arange(len(begins))

"""Plain, slow versions of the operators, written from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash


def repeated_bytes(rows, length=200):
    """doc_id -> bytes, removed, runs, hash of the rest."""
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(data[i : i + length] for _, data in texts for i in range(len(data) - length + 1))
    result = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(data, gone, strict=True) if not y)
        result.append((doc_id, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return result


def later_copies(rows, length):
    """Bytes kept if only strings with an earlier copy go; rows in order of doc_id."""
    seen, result = set(), {}
    for doc_id, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(data[i : i + length])
        result[doc_id] = bytes(x for x, y in zip(data, gone, strict=True) if not y)
    return result


def simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def clusters(values, near):
    """Index of the smallest member of each value's component under `near`."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def deduplicated_lines(rows, least_chars=40, least_docs=5):
    """(text, lines, dropped) of each row. Rows without a doc_id are documents of their own, before all others."""
    name = [(1, doc_id) if doc_id is not None else (0, text or "") for doc_id, text in rows]
    holders = defaultdict(set)
    for own, (_, text) in zip(name, rows, strict=True):
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(own)
    result = []
    for own, (_, text) in zip(name, rows, strict=True):
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if len(line_key(line)) < least_chars or len(holders[line_key(line)]) < least_docs or own == max(holders[line_key(line)])
        ]
        result.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return result


def levenshtein(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a):
        fresh = [i + 1]
        for j, y in enumerate(b):
            fresh.append(min(line[j] + (x != y), line[j + 1] + 1, fresh[j] + 1))
        line = fresh
    return line[-1]


def tiles(text, item, least):
    """Greedy string tiling by trying everything: (length, place in item, place in text) in order."""
    used_text, used_item, result = set(), set(), []
    while True:
        found = []
        for j in range(len(item)):
            for i in range(len(text)):
                n = 0
                while (
                    i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]
                    and i + n not in used_text and j + n not in used_item
                ):
                    n += 1
                found.append((n, j, i))
        longest = max(found, default=(0,))[0]
        if longest < least:
            return result
        for n, j, i in sorted(found, key=lambda x: (x[1], x[2])):
            if n == longest and not used_text & {*range(i, i + n)} and not used_item & {*range(j, j + n)}:
                used_text |= {*range(i, i + n)}
                used_item |= {*range(j, j + n)}
                result.append((n, j, i))

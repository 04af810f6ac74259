"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile("[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def solid(text: str | None) -> list[str]:
    return SOLID.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def decontamination(docs, items, size=10):
    """{doc_id: (n_words, n_hit, sorted item ids as strings)}"""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    lengths = {len(x) for x in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out[doc] = (len(w), len(hit), sorted(str(i) for i in found if i is not None))
    return out


def byte_repeats(docs, size=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept)}"""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            piece = data[k:k + size]
            if piece in seen:
                gone[k:k + size] = b"\1" * size
            seen.add(piece)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[doc] = (len(data), sum(gone), spans, bytes(c for c, g in zip(data, gone) if not g))
    return out


def word_repeats(docs, size=20):
    """{doc_id: (n_words, n_removed, kept)}"""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        w = solid(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            piece = tuple(w[k:k + size])
            if piece in seen:
                gone[k:k + size] = [True] * size
            seen.add(piece)
        out[doc] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g).encode())
    return out


def simhash(text: str | None) -> int:
    w = solid(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def simhash_groups(docs, bits=2):
    """{doc_id: (fingerprint, smallest doc_id reachable)}"""
    prints = {doc: simhash(text) for doc, text in docs}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}

"""Scanning of UTF-8 text columns inside Arrow tasks, many documents at a time.

A text column arrives as one byte buffer with offsets. ``slices`` cuts it into
pieces of a few megabytes (whole documents only), so the memory of a task is
bounded by ``SLICE_BYTES`` or by its longest document. ``runs`` finds words
as maximal runs of member bytes, ``Prefix`` gives the 64-bit polynomial hash of
any byte or word range in constant time.

``Prefix`` works modulo 2^64, where some long sequences of two values (Thue-Morse
words of 1,024 letters) meet whatever the values. Where equal hashes decide a
result, words are told by ``word_keys`` (their very bytes, or a cryptographic
digest of long ones) and sequences also by ``Ring``, modulo the prime 2^61 - 1.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 5          # odd, 5 modulo 8
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    cut = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, cut


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive whole documents."""
    raw, cut = utf8(column)
    row, n = 0, len(cut) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(cut, cut[row] + limit, side="right")) - 1)
        stop = min(stop, n)
        yield row, stop, raw[cut[row]:cut[stop]], cut[row:stop + 1] - cut[row]
        row = stop


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 booleans, true inside the given closed ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: ASCII letters and digits and every byte of a non-ASCII character.
WORD_BYTES = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but the space and the five ASCII white-space controls.
SOLID_BYTES = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Byte to byte: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def runs(member: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true that stay inside a document."""
    n = member.size
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = member[:-1]
    before[cut[:-1][cut[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[cut[1:][cut[1:] > 0] - 1] = False
    return np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def byte_values(seed: int) -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _grow(n: int) -> None:
    global _POWERS, _INVERSES
    if _POWERS.size < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("_POWERS", _BASE), ("_INVERSES", _BASE_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            globals()[name] = np.cumprod(factors, dtype=np.uint64)


class Prefix:
    """Polynomial hashes of any range of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = values.size
        _grow(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _POWERS[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each range; equal content gives equal hashes wherever it stands."""
        return mix((self.sums[end] - self.sums[start]) * _INVERSES[start] + (end - start).astype(np.uint64))


# ---------------------------------------------------------------- words told exactly

PACKED = 16                                # longest word whose bytes fit two 64-bit numbers


def packed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each word as two 64-bit numbers; shorter words are filled up with zeros."""
    room = np.concatenate([data, np.zeros(PACKED, np.uint8)])
    eight = np.ndarray((room.size - 7,), "<u8", room, strides=(1,))      # the 8 bytes from every place on
    keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    size = end - start
    return eight[start] & keep[np.minimum(size, 8)], eight[np.minimum(start + 8, room.size - 8)] & keep[np.clip(size - 8, 0, 8)]


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each word: mixed bytes of short words, digests of longer ones."""
    one, two = packed(data, start, end)
    size = (end - start).astype(np.uint64)
    first = mix(one ^ mix(two + size * np.uint64(_BASE)))
    second = mix(two ^ mix(one * np.uint64(0xD6E8FEB86659FD93) + ~size))
    raw = None
    for k in np.flatnonzero(end - start > PACKED).tolist():
        raw = data.tobytes() if raw is None else raw
        digest = hashlib.blake2b(raw[start[k]:end[k]], digest_size=16).digest()
        first[k], second[k] = np.frombuffer(digest, "<u8")
    return first, second


# ---------------------------------------------------------------- sequences modulo 2**61 - 1

_PRIME = (1 << 61) - 1
_RING_BASE = 0x0B4E13F7A9C26D58
_RING_INVERSE = pow(_RING_BASE, _PRIME - 2, _PRIME)
_RING_POWERS = np.ones(1, np.uint64)
_RING_INVERSES = np.ones(1, np.uint64)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x >> np.uint64(61)) + (x & np.uint64(_PRIME))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def ring_product(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """a * b modulo 2**61 - 1 of numbers below it, by halves of 31 bits."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a0 * b1 + a1 * b0
    return _reduced(a1 * b1 * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def _ring_grow(n: int) -> None:
    while _RING_POWERS.size < n:
        for name, base in (("_RING_POWERS", _RING_BASE), ("_RING_INVERSES", _RING_INVERSE)):
            have = globals()[name]
            globals()[name] = np.concatenate([have, ring_product(have, np.uint64(pow(base, have.size, _PRIME)))])


class Ring:
    """Polynomial hashes of any range of a sequence of 64-bit values, modulo 2**61 - 1."""

    def __init__(self, values: np.ndarray):
        n = values.size
        _ring_grow(n + 1)
        terms = ring_product(_reduced(values), _RING_POWERS[:n])
        low = np.cumsum(terms & np.uint64(0xFFFFFFFF), dtype=np.uint64)
        high = np.cumsum(terms >> np.uint64(32), dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        self.sums[1:] = _reduced(ring_product(_reduced(high), np.uint64(1 << 32)) + _reduced(low))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each range; equal content gives equal hashes wherever it stands."""
        own = _reduced(self.sums[end] + np.uint64(_PRIME) - self.sums[start])
        return mix(ring_product(own, _RING_INVERSES[start]) + (end - start).astype(np.uint64) * np.uint64(_BASE))


# ---------------------------------------------------------------- memory between tasks

def released(run):
    """An Arrow function that gives freed memory back to the system when its task ends, so
    that idle workers stay small while other stages need the executor's memory."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):        # another C library
                pass
    return task


_VALUES = {s: byte_values(s) for s in (1, 2)}


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of the bytes of each word."""
    return Prefix(_VALUES[seed][data]).of(start, end)


def hash_of(text: str, seed: int = 1) -> int:
    """The hash that ``word_hashes`` gives to this text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return int(word_hashes(data, np.zeros(1, np.int64), np.full(1, data.size), seed)[0])


def owners(cut: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Index of the document that holds each position."""
    return np.searchsorted(cut, start, side="right") - 1

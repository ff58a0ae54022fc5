"""Counting quotient filters that lose nothing: exact counters of packed numbers, in numpy.

A packed number of ``2 * half`` bits goes through a permutation that can be inverted (a Feistel network), so
that its quotient, the upper bits, is spread evenly, and quotient with full remainder still name the number.
A filter keeps its entries in order of quotient and remainder: one bit for each quotient that occurs, one bit
for each entry that ends a quotient's run, the remainders in as few bytes as hold them, one bit for each count
above 1 and a byte for each of those (larger counts apart).  Filters of the same shard are merged as sorted runs.
"""

from __future__ import annotations

import struct

import numpy as np

ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_HEAD = struct.Struct("<QQBBI")


def _mixed(x: np.ndarray, key: int, half: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x >> np.uint64(64 - half)


def permute(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves (``half`` bits each, 64 at most) of the permuted numbers."""
    for key in ROUNDS:
        high, low = low, high ^ _mixed(low, key, half)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(ROUNDS):
        high, low = low ^ _mixed(high, key, half), high
    return high, low


def pack(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Three ids of ``bits`` bits each as halves of one number, and the bits of a half."""
    half = (3 * bits + 1) // 2
    a, b, c = (i.astype(np.uint64) for i in ids)
    spare = np.uint64(2 * bits - half)  # bits of b in the lower half
    high = (a << np.uint64(half - bits)) | (b >> spare)
    low = ((b & ((np.uint64(1) << spare) - np.uint64(1))) << np.uint64(bits)) | c
    return high, low, half


def unpack(high: np.ndarray, low: np.ndarray, bits: int) -> list[np.ndarray]:
    half = (3 * bits + 1) // 2
    spare, ones = np.uint64(2 * bits - half), lambda n: (np.uint64(1) << np.uint64(n)) - np.uint64(1)
    a = high >> np.uint64(half - bits)
    b = ((high & ones(half - bits)) << spare) | ((low >> np.uint64(bits)) & ones(spare))
    return [i.astype(np.int64) for i in (a, b, low & ones(bits))]


def counted(high: np.ndarray, low: np.ndarray, half: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers in order, with the sums of their counts (of 1 each if not given)."""
    if not len(high):
        return high, low, np.zeros(0, np.int64)
    if 2 * half <= 64:
        whole = (high << np.uint64(half)) | low
        if counts is None:  # no order is needed, so the numbers themselves are sorted
            whole = np.sort(whole)
        else:
            order = np.argsort(whole, kind="stable")  # merges runs that are sorted already
            whole, counts = whole[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
        high, low = whole[first] >> np.uint64(half), whole[first] & ((np.uint64(1) << np.uint64(half)) - np.uint64(1))
        n = len(whole)
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        counts, n = None if counts is None else counts[order], len(high)
        high, low = high[first], low[first]
    total = np.diff(np.append(first, n)) if counts is None else np.add.reduceat(counts, first)
    return high, low, total.astype(np.int64)


def _low_bytes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_low_bytes(data: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8")[:, 0]


def encode(high: np.ndarray, low: np.ndarray, counts: np.ndarray, half: int, shard_bits: int) -> bytes:
    """The filter of distinct numbers, in order, of one shard: all share the upper ``shard_bits``."""
    n = len(high)
    quotient_bits = min(max(0, n - 1).bit_length(), half - shard_bits)
    rest = half - shard_bits - quotient_bits  # bits of the upper half that stay in the remainder
    below = high & ((np.uint64(1) << np.uint64(half - shard_bits)) - np.uint64(1))
    quotient = (below >> np.uint64(rest)).astype(np.int64)
    remainder = below & ((np.uint64(1) << np.uint64(rest)) - np.uint64(1))
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
    large = np.flatnonzero(counts > 255)
    shard = int(high[0]) >> (half - shard_bits) if n else 0
    return b"".join([
        _HEAD.pack(n, shard, half, shard_bits, len(large)), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        _low_bytes(remainder, -(-rest // 8)), _low_bytes(low, -(-half // 8)),
        np.packbits(counts > 1).tobytes(), np.where(counts > 255, 0, counts)[counts > 1].astype(np.uint8).tobytes(),
        counts[large].astype("<i8").tobytes(),
    ])


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, shard, half, shard_bits, large = _HEAD.unpack_from(data)
    at = _HEAD.size
    quotient_bits = min(max(0, n - 1).bit_length(), half - shard_bits)
    rest = half - shard_bits - quotient_bits
    size = (1 << quotient_bits) + 7 >> 3
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=1 << quotient_bits))
    at += size
    ends = np.unpackbits(np.frombuffer(data, np.uint8, n + 7 >> 3, at), count=n)
    at += n + 7 >> 3
    run = np.cumsum(ends) - ends  # which of the occupied quotients an entry belongs to
    width, low_width = -(-rest // 8), -(-half // 8)
    quotient = occupied[run].astype(np.uint64)
    remainder = _from_low_bytes(data, at, n, width)
    at += n * width
    low = _from_low_bytes(data, at, n, low_width)
    at += n * low_width
    several = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, n + 7 >> 3, at), count=n))
    at += n + 7 >> 3
    counts = np.ones(n, np.int64)
    counts[several] = np.frombuffer(data, np.uint8, len(several), at)
    counts[counts == 0] = np.frombuffer(data, "<i8", large, at + len(several))
    # one shift at a time: without shards it would be by all 64 bits
    top = np.uint64(0) if shard_bits == 0 else np.uint64(shard) << np.uint64(half - shard_bits)
    return top | (quotient << np.uint64(rest)) | remainder, low, counts


def split(high: np.ndarray, half: int, shard_bits: int) -> list[tuple[int, slice]]:
    """Shard and place of its entries, for numbers in order."""
    if not len(high):
        return []
    shard = (high >> np.uint64(half - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(high), np.int64)
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    return [(int(shard[a]), slice(a, b)) for a, b in zip(first, np.append(first[1:], len(shard)))]


def merged(filters: list[bytes]) -> bytes:
    """One filter with the sums of the counts of filters of the same shard."""
    if len(filters) == 1:
        return filters[0]
    _, _, half, shard_bits, _ = _HEAD.unpack_from(filters[0])
    parts = [decode(f) for f in filters]
    high, low, counts = (np.concatenate(column) for column in zip(*parts))
    return encode(*counted(high, low, half, counts), half, shard_bits)

"""Cutting byte strings into phrases at rolling-hash triggers, in numpy.

Every string of ``LENGTH`` bytes has one trigger: the ``WINDOW``-byte window in it with the smallest upper
half of its rolling hash, the leftmost if several.  Strings that start one after another and share their trigger are a
run, and the bytes they cover a phrase.  So equal strings lie in phrases with equal triggers, each at the
same distance from it, and every string lies in exactly one phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

LENGTH = 100
WINDOW = 32
#: arrays over a chunk stay in a core's cache
CHUNK_BYTES = 1 << 17
SEED = 20_267
_PLACES = LENGTH - WINDOW + 1
_UPPER = np.uint64(0xFFFFFFFF00000000)
_RNG = np.random.default_rng(SEED)
_BASES = [int(b) * 8 + 3 for b in _RNG.integers(1 << 50, 1 << 60, 3)]
_LETTERS = _RNG.integers(0, 1 << 63, (3, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(base: int, exponent: int) -> np.uint64:
    return np.uint64(pow(base, exponent, 1 << 64))


def window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the window at each byte, by doubling; spread so that any of them may be the smallest."""
    h, size = _LETTERS[0][data], 1
    while size < WINDOW:
        later = h[size:]
        h = h[:-size] * _power(_BASES[0], size)
        h += later
        size *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def triggers(hashes: np.ndarray) -> np.ndarray:
    """Place of the trigger of the string at each byte.

    The upper 32 bits of the hashes are compared; the place stands in the lower ones, so the leftmost of equals wins.
    """
    least, size = (hashes & _UPPER) | np.arange(len(hashes), dtype=np.uint64), 1
    while size < _PLACES:
        step = min(size, _PLACES - size)
        least = np.minimum(least[step:], least[:-step])
        size += step
    least &= ~_UPPER
    return least.view(np.int64)


@lru_cache(4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2 ** 64."""
    out = []
    for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        with np.errstate(over="ignore"):
            out.append(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]).cumprod(dtype=np.uint64))
    return out[0], out[1]


class Digests:
    """128-bit hashes of any substrings of ``data``: two of 64 bits each."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums, size = [], 1 << max(18, len(data).bit_length())
        for which in (1, 2):
            powers, inverse = _powers(which, size)
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_LETTERS[which][data] * powers[: len(data)], out=total[1:])
            self.sums.append((total, inverse))

    def of(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = (((total[end] - total[start]) * inverse[start]).view(np.int64) for total, inverse in self.sums)
        return first, second


def chunks(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``CHUNK_BYTES``: position of the first, their bytes, where each begins (and the end)."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_BYTES or at == len(texts) - 1:
            held = texts[first : at + 1]
            yield first, np.frombuffer(b"".join(held), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in held])])
            first, size = at + 1, 0


def runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first start (in ``data``), number of starts and trigger hash of each run of strings inside one text."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    hashes = window_hashes(data)
    trigger = triggers(hashes)
    begins = np.ones(len(trigger), bool)
    begins[1:] = trigger[1:] != trigger[:-1]
    begins[bounds[:-1][bounds[:-1] < len(trigger)]] = True
    start = np.flatnonzero(begins)
    owner = np.searchsorted(bounds, start, side="right") - 1
    # strings lie inside one text, so a text's last run may begin too late
    inside = start + LENGTH <= bounds[1:][owner]
    start, owner = start[inside], owner[inside]
    if not len(start):
        return none, none, none, none
    # a run ends where the next begins, or with the last string of its text
    last = bounds[1:][owner] - LENGTH + 1
    n = np.minimum(np.append(start[1:], len(trigger)), last) - start
    return owner, start, n, hashes[trigger[start]].view(np.int64)

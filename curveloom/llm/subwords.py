"""Hashed character n-grams of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np

CHUNK_BYTES = 1 << 20
#: the highest order of n-grams
MOST = 8
_FACTOR = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)
#: bytes inside a word: ASCII letters and digits and everything outside ASCII
_IN_WORD = np.array([chr(b).isalnum() or b > 127 for b in range(256)])


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``CHUNK_BYTES``: first and last + 1 position, bytes, start of each text.

    Bytes are lower case, a blank stands for everything outside words, and blanks enclose each text.
    A word that is repeated at once counts once, so that stuttering does not outweigh a text.
    """
    first, size, held = 0, 0, []
    for at, text in enumerate(texts):
        words = [word for word, _ in groupby((text or "").lower().split())]
        held.append(" ".join(words).encode("utf-8", "surrogatepass"))
        size += len(held[-1]) + 2
        if size >= CHUNK_BYTES or at == len(texts) - 1:
            # blanks at the end give the last text, however short, an n-gram of every order
            data = np.frombuffer(b"".join(b"  " + t for t in held) + b" " * MOST, np.uint8)
            starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in held])[:-1]])
            yield first, at + 1, np.where(_IN_WORD[data], data, np.uint8(32)), starts
            first, size, held = at + 1, 0, []


def grams(data: np.ndarray, orders: range, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: slot (below ``2 ** bits``) of the n-gram at each byte, and whether it counts.

    It counts when it lies in one word, which may include the blank before or after it.
    """
    n_bytes = len(data)
    wide = data.astype(np.uint32)
    blank = np.zeros(n_bytes + 1, np.int32)
    np.cumsum(data == 32, out=blank[1:])
    rolled = wide.copy()
    for n in range(2, orders.stop):
        rolled = rolled[: n_bytes - n + 1] * _FACTOR + wide[n - 1 :]
        if n in orders:
            inner = blank[n - 1 : n_bytes] == blank[1 : n_bytes - n + 2]
            mixed = (rolled ^ (rolled >> np.uint32(15))) * _SPREAD + np.uint32(n)
            yield (mixed >> np.uint32(32 - bits)).astype(np.int64), inner

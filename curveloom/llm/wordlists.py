"""Words of texts as small numbers: each chunk of texts has its own list of words."""

from __future__ import annotations

import numpy as np

#: words of a chunk after which it ends (a text is never cut)
CHUNK_WORDS = 1 << 18


class Numbered(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Chunk:
    """Texts given as lists of words, held as numbers."""

    def __init__(self) -> None:
        self.numbers, self.parts, self.words = Numbered(), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), "<u4", len(words)))
        self.words += len(words)

    def ids(self) -> np.ndarray:
        """All numbers, in two bytes each if the list is short enough."""
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, "<u4")
        return ids.astype("<u2") if self.short(len(self.numbers)) else ids

    @staticmethod
    def short(words: int) -> bool:
        return words <= 1 << 16

    @classmethod
    def read(cls, data: bytes, words: int) -> np.ndarray:
        """The numbers in ``data``, written for a list of ``words``."""
        return np.frombuffer(data, "<u2" if cls.short(words) else "<u4").astype("<u4")

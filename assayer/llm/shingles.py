"""Words and word n-grams of texts as 64-bit numbers, inside Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordNumbers(dict):
    """Number of a word; remembers at most ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_READY = WordNumbers()


def word_numbers() -> WordNumbers:
    """The worker's own word numbers."""
    return _READY


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread numbers over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX[1])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(_MIX[2])
    return values ^ (values >> np.uint64(31))


def grams(numbers: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` consecutive words."""
    count = len(numbers) - width + 1
    total = np.zeros(max(0, count), np.uint64)
    for i in range(width if count > 0 else 0):
        total = total * np.uint64(_MIX[0]) + mixed(numbers[i : i + count] + np.uint64(i))
    return mixed(total)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct n-grams of the lower-cased words; a shorter text is one n-gram, an empty one none."""
    numbers = word_numbers().of(text.lower().split())
    return np.unique(grams(numbers, min(width, len(numbers)) or 1))

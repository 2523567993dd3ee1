"""Numpy kernels over whole texts: words, their hashes, n-grams; small slices bound the memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: bytes of text handled at once; a longer text makes a slice of its own
SLICE_BYTES = 1 << 18

IS_SEP = np.zeros(256, bool)
IS_SEP[[9, 10, 11, 12, 13, 32]] = True

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
PLACE = mix(np.arange(1, 65, dtype=U) * U(0xD1B54A32D192ED03)) | U(1)


def slices(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about SLICE_BYTES together."""
    at = total = 0
    for i, x in enumerate(texts):
        n = len(x or b"") + 1
        if i > at and total + n > SLICE_BYTES:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, len(texts)


class Words:
    """The words of some texts, one after the other."""

    def __init__(self, texts: list[bytes | None]):
        lengths = np.array([len(x or b"") + 1 for x in texts], np.int64)
        self.buf = np.frombuffer(b" ".join(x or b"" for x in texts) + b" ", np.uint8)
        self.text_start = np.cumsum(lengths) - lengths
        sep = np.empty(len(self.buf) + 1, bool)
        sep[0] = True
        sep[1:] = IS_SEP[self.buf]
        turn = np.flatnonzero(sep[1:] != sep[:-1])
        self.start, end = turn[0::2], turn[1::2]
        self.length = end - self.start
        self.sep = sep[1:]
        #: words before each text, and of each text
        self.before = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(np.append(self.before, len(self.start)))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.empty(0, U)
        first = np.cumsum(self.length) - self.length
        at = np.arange(first[-1] + self.length[-1]) - np.repeat(first, self.length)
        power = np.multiply.accumulate(np.full(int(self.length.max()), 0x9FB21C651E98DF25, U))
        return mix(np.add.reduceat(BYTE_VALUE[self.buf[~self.sep]] * power[at], first))

    def grams(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each word on; those that leave their text are to be ignored."""
        total = np.zeros(len(hashes), U)
        for j in range(n):
            total[: len(hashes) - j or None] += hashes[j:] * PLACE[j] if j < len(hashes) else U(0)
        return mix(total + U(n))

    def shingles(self, n: int) -> Iterator[np.ndarray]:
        """Each text's sorted distinct n-word shingles; with fewer words, the whole sequence as one."""
        hashes = self.hashes()
        grams = self.grams(hashes, n)
        for at, many in zip(self.before.tolist(), self.count.tolist(), strict=True):
            if many >= n:
                found = np.sort(grams[at : at + many - n + 1])
                yield found[np.append(True, found[1:] != found[:-1])]
            elif many:
                yield mix(np.array([sum(int(hashes[at + j]) * int(PLACE[j]) for j in range(many)) + many & 0xFFFFFFFFFFFFFFFF], U))
            else:
                yield np.empty(0, U)

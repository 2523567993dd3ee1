"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classed as S (lesser than the next suffix) or L. Leftmost S suffixes (an L before them) cut the text into
substrings; these are sorted by one induced sort, named, and, where names repeat, the text of names is sorted recursively.
From the sorted leftmost S suffixes all L suffixes are induced in one scan upward and all S suffixes in one scan downward:
linear work. At the top, where the alphabet is small, a scan goes symbol by symbol and all suffixes of a symbol are induced
at once with numpy; texts of names have large alphabets and are scanned item by item.

Common prefixes are kept in text order (permuted): where the letters before a suffix and before its neighbour in the array
agree, the prefix is one shorter than that of the suffix before. So only the others are measured, four symbols at a time.
"""

from __future__ import annotations

import numpy as np


def is_s(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is lesser than the one after it; the last one, the end mark, is."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])  # a run has the class of its last letter
    of = np.searchsorted(differs, np.arange(n - 1))
    out = np.ones(n, bool)
    out[:-1] = (text[:-1] < text[1:])[differs[of]]
    return out


class Induced:
    """Induced sorting of a text with a small alphabet whose last symbol, 0, is the least and comes once."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.text, self.symbols = text, symbols
        self.is_s = is_s(text)
        sizes = np.bincount(text, minlength=symbols)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.leftmost = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1

    def dealt(self, array: np.ndarray, found: np.ndarray, edge: np.ndarray, step: int) -> None:
        """Put ``found``, in this order, behind the edges (step 1) or before them (step -1) of their symbols."""
        symbol = self.text[found]
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order]
        first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        many = np.diff(np.append(first, len(symbol)))
        rank = np.arange(len(symbol)) - np.repeat(first, many)
        array[edge[symbol] + step * rank] = found[order]
        edge[symbol[first]] += step * many

    def sort(self, seeds: np.ndarray) -> np.ndarray:
        """All suffixes, given the leftmost S suffixes in an order that is right within each symbol."""
        text, array = self.text, np.empty(len(self.text), np.int64)
        head, tail = self.start[:-1].copy(), self.start[1:] - 1
        of = text[seeds]
        order = np.argsort(of, kind="stable")
        seeds, bound = seeds[order], np.searchsorted(of[order], np.arange(self.symbols + 1))
        present = np.flatnonzero(self.start[1:] > self.start[:-1]).tolist()
        # upward: the suffix before a sorted suffix, if it is L, comes next among those of its symbol
        for c in present:
            at = int(self.start[c])
            while at < head[c]:  # those of the symbol itself follow in the same bucket
                here = array[at : head[c]]
                at = int(head[c])
                before = here - 1
                before = before[before >= 0]
                before = before[~self.is_s[before] & (text[before] == c)]
                array[at : at + len(before)] = before
                head[c] += len(before)
            before = np.concatenate([array[self.start[c] : head[c]], seeds[bound[c] : bound[c + 1]]]) - 1
            before = before[before >= 0]
            before = before[~self.is_s[before] & (text[before] != c)]
            if len(before):
                self.dealt(array, before, head, 1)
        # downward: the suffix before a sorted suffix, if it is S, comes next from the end of its symbol
        array[0] = len(text) - 1
        for c in present[:0:-1]:
            at = int(self.start[c + 1]) - 1
            while at > tail[c]:
                here = array[tail[c] + 1 : at + 1][::-1]
                at = int(tail[c])
                before = here - 1
                before = before[before >= 0]
                before = before[self.is_s[before] & (text[before] == c)]
                array[at - len(before) + 1 : at + 1] = before[::-1]
                tail[c] -= len(before)
            before = array[self.start[c] : self.start[c + 1]][::-1] - 1
            before = before[before >= 0]
            before = before[self.is_s[before] & (text[before] != c)]
            if len(before):
                self.dealt(array, before, tail, -1)
        return array

    def array(self) -> np.ndarray:
        names, many = named(self.text, self.leftmost, self.sort(self.leftmost))
        return self.sort(self.leftmost[in_names_order(names, many)])


def sorted_names(text: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array of a text with a large alphabet, by the same method; scans go item by item. The last symbol, 0, comes once."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    s = is_s(text)
    leftmost = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    ends = np.cumsum(np.bincount(text, minlength=symbols))
    heads, tails = np.append(0, ends[:-1]).tolist(), (ends - 1).tolist()
    # what precedes a suffix: its symbol if it is to be induced in the scan upward, or downward, else -1
    before = np.append(-1, text[:-1])
    upward, downward = np.where(np.append(True, s[:-1]), -1, before).tolist(), np.where(np.append(False, s[:-1]), before, -1).tolist()

    def induced(seeds: np.ndarray) -> np.ndarray:
        of = text[seeds]
        order = np.argsort(of, kind="stable")
        of = of[order]
        array = np.full(n, -1)
        rank = np.arange(len(of)) - np.searchsorted(of, of, "right")
        array[ends[of] + rank] = seeds[order]
        array, head, tail = array.tolist(), heads.copy(), tails.copy()
        for j in array:  # grows while it is read
            if j > 0:
                c = upward[j]
                if c >= 0:
                    at = head[c]
                    array[at] = j - 1
                    head[c] = at + 1
        for j in Backward(array):
            if j > 0:
                c = downward[j]
                if c >= 0:
                    at = tail[c]
                    array[at] = j - 1
                    tail[c] = at - 1
        return np.array(array, np.int64)

    names, many = named(text, leftmost, induced(leftmost))
    return induced(leftmost[in_names_order(names, many)])


class Backward:
    """A list from its end, read while it changes."""

    def __init__(self, items: list):
        self.items = items

    def __iter__(self):
        return map(self.items.__getitem__, range(len(self.items) - 1, -1, -1))


def named(text: np.ndarray, leftmost: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, int]:
    """The leftmost substrings, in text order, by rank; equal ones have one name."""
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    ordered = array[is_leftmost[array]]
    end = np.empty(len(text), np.int64)
    end[leftmost] = np.append(leftmost[1:], leftmost[-1:])  # a substring holds the start of the next
    size = end[ordered] - ordered + 1
    a, b = ordered[:-1], ordered[1:]
    alike = size[:-1] == size[1:]
    open_, off = np.flatnonzero(alike), 0
    while len(open_):
        same = text[a[open_] + off] == text[b[open_] + off]
        alike[open_[~same]] = False
        off += 1
        open_ = open_[same]
        open_ = open_[size[open_] > off]
    name = np.concatenate([[0], np.cumsum(~alike)])
    of = np.empty(len(text), np.int64)
    of[ordered] = name
    return of[leftmost], int(name[-1]) + 1


def in_names_order(names: np.ndarray, many: int) -> np.ndarray:
    """The leftmost suffixes in order: by their names, or, where names repeat, by the sorted text of names."""
    if many < len(names):
        return sorted_names(names, many)
    order = np.empty(many, np.int64)
    order[names] = np.arange(many)
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of ``text`` (uint16); its last symbol, 0, comes once."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    present = np.flatnonzero(np.bincount(text))
    dense = np.zeros(int(present[-1]) + 1, np.uint16)
    dense[present] = np.arange(len(present))
    return Induced(dense[text], len(present)).array()


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, in text order, its neighbour before it in the array and how long a prefix they share."""
    n = len(text)
    near = np.empty(n, np.int64)
    near[array[1:]] = array[:-1]
    near[array[0]] = -1
    i = np.arange(n)
    measured = (i == 0) | (near <= 0) | (text[i - 1] != text[np.maximum(near, 1) - 1])
    measured[1:] |= near[:-1] < 0  # after the least suffix, which has no neighbour
    padded = np.concatenate([text, np.zeros(4, np.uint16)]).astype(np.uint64)
    four = padded[:n] | padded[1 : n + 1] << np.uint64(16) | padded[2 : n + 2] << np.uint64(32) | padded[3 : n + 3] << np.uint64(48)
    at = np.flatnonzero(measured & (near >= 0))
    length, open_, off = np.zeros(n, np.int64), at, 0
    while len(open_):
        a, b = open_ + off, near[open_] + off
        inside = np.maximum(a, b) < n  # the end mark comes once, so prefixes end before it
        open_, a, b = open_[inside], a[inside], b[inside]
        apart = four[a] ^ four[b]
        stop = apart != 0
        low = apart[stop] & (~apart[stop] + np.uint64(1))
        length[open_[stop]] = off + (low > 0xFFFF).astype(np.int64) + (low > 0xFFFFFFFF) + (low > 0xFFFFFFFFFFFF)
        open_, off = open_[~stop], off + 4
    # the others are one shorter than the one before: the last measured one, less the way from there
    last = np.maximum.accumulate(np.where(measured, i, 0))
    return near, np.where(near < 0, 0, length[last] - (i - last))

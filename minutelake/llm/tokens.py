"""Token ids of whole texts by a word-end BPE of the ``tokenizers`` library, each distinct word encoded once.

The texts of a slice are split into pre-tokens with numpy, words not seen before are encoded together, and the ids of
all words are gathered. Texts with characters outside the tables, apostrophes or special tokens go through the
tokenizer as they are, so all ids equal those of the tokenizer itself.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from minutelake.llm.words import U, mix

#: code points below this are classed by table; from here on the tokenizer does all the work
PLAIN_BELOW = 0x250
#: words remembered by one task
CACHE_WORDS = 400_000

SPACE, LETTER, NUMBER, OTHER = range(4)


def char_class(c: int) -> int:
    if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)


CLASS = np.array([char_class(c) for c in range(PLAIN_BELOW)], np.int8)
CHAR_VALUE = mix(np.arange(1, PLAIN_BELOW + 1, dtype=U) * U(0x9E3779B97F4A7C15 >> 2))


class WordEncoder:
    """Ids of texts; ``tokenizer`` lower-cases and marks the ends of words in its vocabulary by ``</w>``."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known, self.first, self.many, self.store = np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens."""
        lowered = [x.lower() for x in texts]
        joined = "\n".join(lowered) + "\n"
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = np.array([len(x) + 1 for x in lowered], np.int64)
        start = np.cumsum(size) - size
        odd = np.add.reduceat((chars >= PLAIN_BELOW) | (chars == 39), start) > 0
        odd |= np.array(["<|" in x for x in texts], bool)
        if odd.any():
            kept = iter(self.encode([x for x, o in zip(texts, odd, strict=True) if not o]) if not odd.all() else [])
            return [np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32) if o else next(kept) for x, o in zip(texts, odd, strict=True)]
        kind = CLASS[chars]
        place = np.flatnonzero(kind)
        if not len(place):
            return [np.empty(0, np.uint32) for _ in texts]
        kind = kind[place]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1] + 1) | (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(place)))
        inside = np.arange(len(place)) - np.repeat(at, length)
        power = np.multiply.accumulate(np.full(int(length.max()), 0x9FB21C651E98DF25, U))
        words = mix(np.add.reduceat(CHAR_VALUE[chars[place]] * power[inside], at))
        distinct, first, which = np.unique(words, return_index=True, return_inverse=True)
        begin = place[at[first]]
        held = self.look_up(distinct, joined, begin, begin + length[first])
        many, where = self.many[held][which], self.first[held][which]
        before = np.cumsum(many) - many
        ids = self.store[np.repeat(where - before, many) + np.arange(before[-1] + many[-1])]
        cut = np.searchsorted(place[at], start)
        return np.split(ids, np.append(before, len(ids))[cut[1:]])

    def look_up(self, words: np.ndarray, text: str, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the words among those remembered; the rest are encoded first."""
        if len(self.known) + len(words) > CACHE_WORDS:
            self.clear()
        at = np.searchsorted(self.known, words)
        missing = np.ones(len(words), bool)
        if len(self.known):
            missing = self.known[np.minimum(at, len(self.known) - 1)] != words
        if missing.any():
            ids, many = self.encode_words([text[a:b] for a, b in zip(begin[missing].tolist(), end[missing].tolist(), strict=True)])
            known = np.concatenate([self.known, words[missing]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.first = np.concatenate([self.first, len(self.store) + np.cumsum(many) - many])[order]
            self.many = np.concatenate([self.many, many])[order]
            self.store = np.concatenate([self.store, ids])
            at = np.searchsorted(self.known, words)
        return at

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each word has."""
        out, many = [], []
        for a in range(0, len(words), 10_000):
            part = words[a : a + 10_000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            counts = np.diff(ends, prepend=-1)
            if len(ends) != len(part) or (len(ids) and ends[-1] != len(ids) - 1):
                each = [np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32) for x in part]
                ids, counts = np.concatenate(each), np.array([len(x) for x in each], np.int64)
            out.append(ids)
            many.append(counts)
        return np.concatenate(out), np.concatenate(many)

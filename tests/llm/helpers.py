"""Small documents with every edge case, and brute-force versions."""

import random
import re
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, words, of=200):
    return " ".join(f"w{rng.randrange(of)}" for _ in range(words))


def edited(rng, text, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def documents(seed=1, families=12, alone=20):
    """Rows (doc_id, text, lang, source, n_chars): near and exact copies, empty, short, long and repeated ones, nulls."""
    rng, texts = random.Random(seed), []
    for _ in range(families):
        base = sentence(rng, rng.choice([3, 4, 5, 8, 14, 16, 19, 25, 40, 120, 400]))
        texts += [base] * rng.choice([1, 1, 3]) + [edited(rng, base, rng.choice([0.005, 0.02, 0.05])) for _ in range(rng.choice([1, 3, 6]))]
    texts += [sentence(rng, rng.randint(1, 60), 50) for _ in range(alone)]
    texts += [None, "", " \n\t ", "a", "A b", "a B", "x " * 30_000, "é" * 50_000, "tab\tand\x0bnew\nlines\r\n", "no break space \x1c kept", None, "a"]
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "Z", "é", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[5], None, "s1", 1), (None, "null id alone " * 9, "en", None, None)]


def words_of(text):
    return WORD.findall(text or "")


def shingles(text, n):
    w = words_of((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)])


def is_linked(a, b, theta=Fraction(17, 20)):
    both = len(a & b)
    return bool(a) and bool(b) and both >= theta * (len(a) + len(b) - both)


def component_rows(rows, n, theta):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(r[1], n) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if is_linked(sets[i], sets[j], theta) and find(i) != find(j):
                group[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=repr)


def got(df, *cols):
    return ordered(tuple(r) for r in df.select(*cols).collect())

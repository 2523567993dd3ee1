"""The dynamic program of conversation repair: cheapest edits of a row of turns, ties by the least audit string.

Turns are read one by one by an automaton over role initials: an optional ``s``, then pairs of ``u`` and ``a``, or
nothing at all. For each state there is one best edit prefix. Prefixes are *persistent*: a prefix is a node that links to
the prefix it extends, so all prefixes of all states share what they have in common, and a step costs a node, not a copy.
A node knows its ancestors at distances of powers of two (binary lifting) and the rolling hash of its letters.

Two prefixes of one state and one cost are compared at their first different letter: both are lifted to where their hashes
still differ and their parents' agree. Agreeing parents are verified: the same node, or, letter by letter, the same
letters; if they aren't, the hashes collided and the letters found on the way decide.

A prefix's cost follows from its letters and the rows alone, so of two prefixes of equal cost over the same rows neither
begins with the other, and the lesser prefix stays lesser whatever follows. For the same reason a stretch of rows can be
summed up as a table of the best prefix from each state to each state, and stretches be put together in any grouping: a
conversation of any length is worked on in stretches (``Stretches``) by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

#: states: nothing read, after the system turn, after a user's turn, after an assistant's
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: the one initial that a rerolled or inserted turn can have in a state
MADE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}

#: of the rolling hash; a small prime in tests makes hashes collide
BASE, PRIME = 1_000_003, (1 << 61) - 1


class Prefix:
    """An edit prefix: the one it extends, a letter, its length and hash, and its ancestors at distances 1, 2, 4 ..."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Prefix | None, letter: str):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth, self.hash = parent.depth + 1, (parent.hash * BASE + ord(letter)) % PRIME
        up, far = [parent], parent
        while len(far.up) >= len(up):
            far = far.up[len(up) - 1]
            up.append(far)
        self.up = tuple(up)

    def above(self, depth: int) -> Prefix:
        """The ancestor of this length."""
        node, left = self, self.depth - depth
        while left:
            jump = left.bit_length() - 1
            node, left = node.up[jump], left - (1 << jump)
        return node

    def letters(self) -> str:
        found, node = [], self
        while node.depth:
            found.append(node.letter)
            node = node.up[0]
        return "".join(reversed(found))


def first_difference(a: Prefix, b: Prefix) -> tuple[Prefix, Prefix] | None:
    """Prefixes of a and b that end in their first different letters; None if one of them begins with the other."""
    both = min(a.depth, b.depth)
    a, b = a.above(both), b.above(both)
    if a.hash == b.hash:
        return verified(a, b)
    for jump in range(len(a.up) - 1, -1, -1):
        if jump < len(a.up) and a.up[jump].hash != b.up[jump].hash:
            a, b = a.up[jump], b.up[jump]
    return verified(a.up[0], b.up[0]) or (a, b)


def verified(a: Prefix, b: Prefix) -> tuple[Prefix, Prefix] | None:
    """The first difference of two prefixes of one length whose hashes agree: None, unless hashes collided."""
    found = None
    while a is not b:  # shared nodes are equal without a look
        if a.letter != b.letter:
            found = (a, b)
        a, b = a.up[0], b.up[0]
    return found


def lesser(a: Prefix, b: Prefix) -> bool:
    """Is a's audit string the lesser in ASCII order?"""
    apart = first_difference(a, b)
    return a.depth < b.depth if apart is None else apart[0].letter < apart[1].letter


Best = dict[int, tuple[int, Prefix]]


def offer(best: Best, state: int, cost: int, parent: Prefix, letter: str) -> bool:
    """Take ``parent`` and ``letter`` as the way to ``state`` if it is better than the one known."""
    known = best.get(state)
    if known is not None and cost > known[0]:
        return False
    node = Prefix(parent, letter)
    if known is not None and cost == known[0] and not lesser(node, known[1]):
        return False
    best[state] = (cost, node)
    return True


def with_inserts(best: Best) -> Best:
    """Ways that go on by inserted turns; more than three in a row only lead back."""
    for _ in range(3):
        if not any([offer(best, STEP[state, MADE[state]], cost + INSERT_COST, node, INSERT) for state, (cost, node) in list(best.items())]):
            break
    return best


def after_row(best: Best, initial: str, must_go: bool, truncated: bool) -> Best:
    """The best ways once one more row is read; ``initial`` is that of its role ('' for an empty role: it adds none)."""
    found: Best = {}
    stays = TRUNCATED_COST if truncated else 0
    for state, (cost, node) in best.items():
        offer(found, state, cost + DELETE_COST, node, DELETE)
        if not must_go:
            to = STEP.get((state, initial)) if initial else state
            if to is not None:
                offer(found, to, cost + stays, node, KEEP)
            offer(found, STEP[state, MADE[state]], cost + stays + REROLE_COST, node, REROLE)
    return with_inserts(found)


Row = tuple[str, bool, bool]
#: from state to state: cost and audit string
Table = dict[tuple[int, int], tuple[int, str]]


def table_of(rows: list[Row], first: bool) -> Table:
    """The best ways over ``rows`` (initial, must go, truncated): from the start alone if they begin a conversation."""
    found: Table = {}
    for begin in (START,) if first else range(4):
        best: Best = {begin: (0, Prefix(None, ""))}
        if first:
            best = with_inserts(best)
        for row in rows:
            best = after_row(best, *row)
        found |= {(begin, end): (cost, node.letters()) for end, (cost, node) in best.items()}
    return found


#: a way through several stretches: the way before, the last stretch's letters and the state it begins in
Way = tuple[tuple | None, str, int]


@dataclass
class Stretches:
    """The best ways from the start of a conversation over all stretches so far, put together one by one."""

    best: dict[int, tuple[int, Way | None]] = field(default_factory=lambda: {START: (0, None)})

    def add(self, ways: Table) -> None:
        found: dict[int, tuple[int, Way | None]] = {}
        for (begin, end), (cost, letters) in ways.items():
            if begin in self.best:
                total, way = self.best[begin][0] + cost, (self.best[begin][1], letters, begin)
                known = found.get(end)
                if known is None or total < known[0] or (total == known[0] and lesser_way(way, known[1])):
                    found[end] = (total, way)
        self.best = found

    def end(self) -> tuple[int, list[tuple[str, int]]]:
        """Cost of the repair, and of each stretch its audit letters and the state it begins in."""
        first, *others = [self.best[s] for s in ACCEPTING if s in self.best]
        for cost, way in others:
            if (cost, way) != first and (cost < first[0] or (cost == first[0] and lesser_way(way, first[1]))):
                first = (cost, way)
        found, way = [], first[1]
        while way is not None:
            way, letters, begin = way
            found.append((letters, begin))
        return first[0], found[::-1]


def lesser_way(a: Way | None, b: Way | None) -> bool:
    """Has a the lesser letters? Both lead through the same stretches; what they share isn't looked at."""
    tail = []
    while a is not b:
        tail.append((a[1], b[1]))
        a, b = a[0], b[0]
    return "".join(x for x, _ in reversed(tail)) < "".join(x for _, x in reversed(tail))


class Replay:
    """Reads the letters of a stretch along its rows: what becomes of each row."""

    def __init__(self, letters: str, state: int):
        self.letters, self.at, self.state = letters, 0, state

    def inserted(self) -> str:
        """Initials of the turns inserted here."""
        made = ""
        while self.at < len(self.letters) and self.letters[self.at] == INSERT:
            made += MADE[self.state]
            self.state, self.at = STEP[self.state, MADE[self.state]], self.at + 1
        return made

    def row(self, initial: str) -> tuple[str, str]:
        """The edit of the next row, and its new initial if it is rerolled."""
        letter, new = self.letters[self.at], ""
        self.at += 1
        if letter == KEEP and initial:
            self.state = STEP[self.state, initial]
        elif letter == REROLE:
            new = MADE[self.state]
            self.state = STEP[self.state, new]
        return letter, new

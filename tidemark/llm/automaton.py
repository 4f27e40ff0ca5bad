"""Regular expressions to one minimal byte automaton, and its batched scan.

``compile_rules`` turns byte regexes (literals, classes, groups, ``|``, ``?``,
``*``, ``+``, ``{m,n}``) into Thompson fragments, then by subset construction
over byte classes into one deterministic automaton that looks for all rules
from every position, and merges equivalent states.  ``scan`` runs it over a
flat buffer with many lanes in step, one transition lookup a byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Nfa:
    """States with byte-set edges and empty edges."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1


class _Parser:
    """Recursive descent; every part yields a function that adds a fragment
    between two states, so counted parts can be added again."""

    def __init__(self, pattern: str, fold: bool) -> None:
        self.p, self.i, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.p[self.i:self.i + 1]

    def parse(self):
        part = self.union()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.peek()!r} in {self.p!r}")
        return part

    def union(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            options.append(self.sequence())

        def add(n: _Nfa, a: int, b: int) -> None:
            for o in options:
                o(n, a, b)

        return options[0] if len(options) == 1 else add

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeat())

        def add(n: _Nfa, a: int, b: int) -> None:
            for part in parts:
                c = n.state()
                part(n, a, c)
                a = c
            n.empty[a].append(b)

        return add

    def repeat(self):
        part = self.atom()
        c = self.peek()
        if c and c in "?*+":
            self.i += 1
            lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        elif c == "{":
            end = self.p.index("}", self.i)
            lo_s, comma, hi_s = self.p[self.i + 1:end].partition(",")
            lo, hi = int(lo_s), (int(hi_s) if hi_s else None) if comma else int(lo_s)
            self.i = end + 1
        else:
            return part

        def add(n: _Nfa, a: int, b: int) -> None:
            for _ in range(lo):
                c = n.state()
                part(n, a, c)
                a = c
            if hi is None:
                loop = n.state()
                n.empty[a].append(loop)
                part(n, loop, loop)
                n.empty[loop].append(b)
                return
            for _ in range(hi - lo):
                n.empty[a].append(b)
                c = n.state()
                part(n, a, c)
                a = c
            n.empty[a].append(b)

        return add

    def atom(self):
        c = self.peek()
        if c == "(":
            self.i += 3 if self.p.startswith("(?:", self.i) else 1
            part = self.union()
            if self.peek() != ")":
                raise ValueError(f"open group in {self.p!r}")
            self.i += 1
            return part
        members = self.klass() if c == "[" else frozenset([self.char()])
        if self.fold:
            members |= {b ^ 32 for b in members if 65 <= b & 0xDF <= 90}
        return lambda n, a, b: n.edges[a].append((members, b))

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def klass(self) -> frozenset[int]:
        self.i += 1
        negate = self.peek() == "^"
        self.i += negate
        members: set[int] = set()
        while self.peek() != "]":
            lo = self.char()
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                members.update(range(lo, self.char() + 1))
            else:
                members.add(lo)
        self.i += 1
        return frozenset(range(256)) - members if negate else frozenset(members)


@dataclass(frozen=True)
class Automaton:
    """``table[state, class]`` is the next state, ``classes[byte]`` a byte's
    class, ``accepts[state]`` a bit mask of the rules that end there; accepting
    states have the highest numbers, state 0 is the start.  ``resets`` marks the
    pairs of byte classes that lead every state to the start: no match goes on
    past such a pair."""

    table: np.ndarray
    classes: np.ndarray
    accepts: np.ndarray
    first_accept: int
    resets: np.ndarray

    def reset_ends(self, buf: np.ndarray) -> np.ndarray:
        """Positions just after a reset pair, ascending."""
        c = self.classes[buf].astype(np.int16)
        n = self.table.shape[1]
        return np.flatnonzero(self.resets.ravel()[c[:-1] * n + c[1:]]) + 2


def inside_pairs(rules: list[tuple[str, bool]]) -> np.ndarray:
    """Which pairs of bytes (256 by 256) can follow each other in a match of a rule, or
    have a second byte that can begin one."""
    nfa = _Nfa()
    root = nfa.state()
    for pattern, fold in rules:
        _Parser(pattern, fold).parse()(nfa, root, nfa.state())

    def reached(state: int) -> np.ndarray:
        """Bytes that can be read next."""
        todo, seen, out = [state], {state}, np.zeros(256, dtype=bool)
        while todo:
            s = todo.pop()
            for members, _ in nfa.edges[s]:
                out[list(members)] = True
            for t in nfa.empty[s]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return out

    pairs = np.zeros((256, 256), dtype=bool)
    pairs[:, reached(root)] = True
    for edges in nfa.edges:
        for members, target in edges:
            pairs[np.ix_(list(members), reached(target))] = True
    return pairs


def compile_rules(rules: list[tuple[str, bool]], exact: list[tuple[str, bool]] | None = None) -> Automaton:
    """``rules``: (pattern, letters in either case).  ``exact``: full expressions that the
    patterns may be short forms of; no reset pair lies inside a match of one of those."""
    nfa = _Nfa()
    root, ends = nfa.state(), []
    for pattern, fold in rules:
        end = nfa.state()
        _Parser(pattern, fold).parse()(nfa, root, end)
        ends.append(end)
    signature = [tuple(b in m for es in nfa.edges for m, _ in es) for b in range(256)]
    ids: dict[tuple[bool, ...], int] = {}
    classes = np.array([ids.setdefault(s, len(ids)) for s in signature], dtype=np.uint8)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(len(ids))]

    def closure(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    step = [[closure({t for m, t in es if b in m}) for b in sample] for es in nfa.edges]
    start = closure({root})
    sets, order, table = {start: 0}, [start], []
    for s in order:  # grows while it is read
        live = [step[q] for q in s if nfa.edges[q]]
        row = []
        for c in range(len(sample)):
            t = start.union(*(x[c] for x in live))
            if t not in sets:
                sets[t] = len(order)
                order.append(t)
            row.append(sets[t])
        table.append(row)
    accepts = np.array([sum(1 << k for k, e in enumerate(ends) if e in s) for s in order], dtype=np.int64)
    inside = np.zeros((len(ids), len(ids)), dtype=bool)
    left, right = np.nonzero(inside_pairs(exact or rules))
    inside[classes[left], classes[right]] = True
    return _minimal(np.array(table, dtype=np.int64), accepts, classes, inside)


def _minimal(table: np.ndarray, accepts: np.ndarray, classes: np.ndarray, inside: np.ndarray) -> Automaton:
    """Refine the partition by accepted rules until successors agree."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        rows = np.column_stack([block, block[table]])
        finer = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    n = block.max() + 1
    member = np.zeros(n, dtype=np.int64)
    member[block[::-1]] = np.arange(len(block))[::-1]  # the first state of every block
    rank = np.lexsort((np.arange(n), np.arange(n) != block[0], accepts[member] != 0))
    number = np.empty(n, dtype=np.int64)
    number[rank] = np.arange(n)
    least = number[block[table[member[rank]]]].astype(np.int32)
    acc = accepts[member[rank]]
    resets = np.array([(least[least[:, c]] == 0).all(axis=0) for c in range(least.shape[1])]) & ~inside
    return Automaton(least, classes, acc, int((acc == 0).sum()), resets)


def scan(a: Automaton, buf: np.ndarray, lane: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Positions (index of the last byte, ascending) and rule masks of all
    accepting steps.  The buffer is cut after reset pairs into lanes of about
    ``lane`` bytes, which all take their next byte in the same numpy step; a
    stretch without a reset stays one lane, so nothing is lost."""
    none = np.zeros(0, dtype=np.int64)
    if not len(buf):
        return none, none
    cut = a.reset_ends(buf)
    marks = np.searchsorted(cut, np.arange(lane, len(buf), lane))
    begin = np.unique(np.concatenate([[0], cut[marks[marks < len(cut)]]]))
    begin = begin[begin < len(buf)]
    length = np.diff(np.append(begin, len(buf)))
    order = np.argsort(-length, kind="stable")
    pos, length = begin[order], length[order]
    width = a.table.shape[1]
    table = (a.table * width).astype(np.int32).ravel()
    classes = a.classes[buf].astype(np.int32)
    alive = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right")
    first = a.first_accept * width
    state = np.zeros(len(pos), dtype=np.int32)
    at, masks = [], []
    for t, k in enumerate(alive.tolist()):
        s = table[state[:k] + classes[pos[:k] + t]]
        state[:k] = s
        hit = np.flatnonzero(s >= first)
        if len(hit):
            at.append(pos[hit] + t)
            masks.append(a.accepts[s[hit] // width])
    if not at:
        return none, none
    where, mask = np.concatenate(at), np.concatenate(masks)
    o = np.argsort(where)
    return where[o], mask[o]

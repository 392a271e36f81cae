"""One deterministic automaton for many regular expressions, over bytes.

Each expression becomes a nondeterministic automaton that may start anywhere; subset construction and minimisation turn
it into a transition array over classes of bytes. The reachable combinations of the expressions' states are the states
of the combined automaton, which needs no further minimisation: two of them differ in some expression's own, minimal
part. A scan runs through a buffer once, many stretches side by side: a byte after which every state is the start (a
line feed, say) cuts the buffer, as no match can hold it. The combined automaton tells where matches end; the reversed
expression's automaton, run back from there, tells where they begin.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from re import _constants as op
from re import _parser

import numpy as np

SEPARATOR = 0xFF  # no byte of UTF-8; no expression reads it
MAX_STATES = 20_000
MAX_COMBINED = 500_000
_TEXT_BYTES = frozenset(range(0xF8))


class _Nfa:
    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _bytes(self, items, ignore_case: bool) -> frozenset[int]:
        found: set[int] = set()
        negated = False
        for kind, value in items:
            if kind is op.NEGATE:
                negated = True
            elif kind is op.LITERAL:
                found.add(value)
            elif kind is op.RANGE:
                found.update(range(value[0], value[1] + 1))
            elif kind is op.CATEGORY and value in (op.CATEGORY_DIGIT, op.CATEGORY_WORD, op.CATEGORY_SPACE):
                test = {op.CATEGORY_DIGIT: rb"\d", op.CATEGORY_WORD: rb"\w", op.CATEGORY_SPACE: rb"\s"}[value]
                found.update(b for b in range(128) if re.match(test, bytes([b])))
            else:
                raise ValueError(f"not supported in a class: {kind}")
        if ignore_case:
            found |= {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(_TEXT_BYTES - found if negated else found & _TEXT_BYTES)

    def add(self, tree, at: int, ignore_case: bool) -> int:
        """Append a parsed expression behind state ``at``; returns its last state."""
        for kind, value in tree:
            if kind in (op.LITERAL, op.NOT_LITERAL, op.IN, op.ANY):
                items = {op.LITERAL: lambda v: [(op.LITERAL, v)], op.NOT_LITERAL: lambda v: [(op.NEGATE, None), (op.LITERAL, v)], op.IN: lambda v: v, op.ANY: lambda v: [(op.NEGATE, None), (op.LITERAL, 10)]}[kind](value)
                end = self.state()
                self.steps[at].append((self._bytes(items, ignore_case), end))
                at = end
            elif kind is op.SUBPATTERN:
                at = self.add(value[3], at, ignore_case)
            elif kind is op.BRANCH:
                end = self.state()
                for branch in value[1]:
                    begin = self.state()
                    self.free[at].append(begin)
                    self.free[self.add(branch, begin, ignore_case)].append(end)
                at = end
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                least, most, inner = value
                for _ in range(least):
                    at = self.add(inner, at, ignore_case)
                if most is op.MAXREPEAT:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add(inner, loop, ignore_case)].append(loop)
                    at = loop
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.free[at].append(end)
                        at = self.add(inner, at, ignore_case)
                    self.free[at].append(end)
                    at = end
            else:
                raise ValueError(f"not supported: {kind}")
        return at

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``step[state * classes + class_of[byte]]``; state 0 is the start; bit i of ``accepts[state]``: expression i ends here."""

    class_of: np.ndarray
    classes: int
    step: np.ndarray
    accepts: np.ndarray
    resets: np.ndarray  # bytes after which every state is the start

    @cached_property
    def plain(self) -> tuple[int, list[int], int, list[int], list[int], int]:
        """The start, the arrays as lists (for single bytes) and the state that nothing leaves or accepts (-1: none)."""
        to = self.step.reshape(-1, self.classes)
        stays = np.flatnonzero((to == np.arange(len(to))[:, None]).all(axis=1) & (self.accepts == 0))
        return 0, self.step.tolist(), self.classes, self.class_of.tolist(), self.accepts.tolist(), int(stays[0]) if len(stays) else -1

    def states(self, buffer: np.ndarray, lane: int = 2048) -> np.ndarray:
        """The state behind each byte of the buffer, which must end with a byte that resets."""
        n = len(buffer)
        out = np.empty(n, self.step.dtype)
        if not n:
            return out
        code = self.class_of[buffer]
        resets = np.flatnonzero(self.resets[buffer])
        cuts = np.unique(resets[np.searchsorted(resets, np.arange(lane, n, lane)).clip(max=len(resets) - 1)]) + 1
        begins = np.concatenate([[0], cuts[cuts < n]])
        sizes = np.diff(np.append(begins, n))
        longest_first = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[longest_first], sizes[longest_first]
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        state = np.zeros(len(begins), np.int64)
        t = 0
        while t < sizes[0] and active[t] > 8:
            k = active[t]
            at = begins[:k] + t
            state = self.step[state[:k] * self.classes + code[at]]
            out[at] = state
            state = state.astype(np.int64)
            t += 1
        if t < sizes[0]:
            step, width = memoryview(self.step), self.classes
            for i in range(int(active[t])):
                s, row = int(state[i]), []
                for c in code[begins[i] + t : begins[i] + sizes[i]].tolist():
                    s = step[s * width + c]
                    row.append(s)
                out[begins[i] + t : begins[i] + sizes[i]] = row
        return out


def compiled(expressions: list[tuple[str, bool]]) -> Automaton:
    """The automaton of (expression, ignore case) pairs; at most 31 of them."""
    return _determined([(list(_parser.parse(text)), ignore_case) for text, ignore_case in expressions])


def _determined(trees: list[tuple[list, bool]], anywhere: bool = True) -> Automaton:
    """Subset construction and minimisation; ``anywhere``: a match may begin at every byte, not at the first only."""
    nfa = _Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    for i, (tree, ignore_case) in enumerate(trees):
        begin = nfa.state()
        nfa.free[start].append(begin)
        ends[nfa.add(tree, begin, ignore_case)] = 1 << i
    sets = {s for steps in nfa.steps for s, _ in steps}
    ordered = sorted(sets, key=sorted)
    signature: dict[tuple[bool, ...], int] = {}
    class_of = np.array([signature.setdefault(tuple(b in s for s in ordered), len(signature)) for b in range(256)])
    examples = [int(np.flatnonzero(class_of == c)[0]) for c in range(len(signature))]

    first = nfa.closure([start])
    again = first if anywhere else frozenset()
    number, order, rows = {first: 0}, [first], []
    for states in order:
        row = []
        for byte in examples:
            target = again | nfa.closure([t for s in states for on, t in nfa.steps[s] if byte in on])
            if target not in number:
                number[target] = len(order)
                order.append(target)
                if len(order) > MAX_STATES:
                    raise ValueError("the expressions need too many states; scan long counts without their number and check it behind")
            row.append(number[target])
        rows.append(row)
    step = np.array(rows)
    accepts = np.array([sum(bit for s, bit in ends.items() if s in states) for states in order])

    # minimisation by refinement; the start stays a block of its own, as it says that nothing has begun
    block = np.unique(accepts, return_inverse=True)[1] + 1
    block[0] = 0
    while True:
        refined = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    _, heads = np.unique(block, return_index=True)
    place = np.empty(len(heads), np.int64)
    by_head = np.argsort(heads)  # the start was met first
    place[by_head] = np.arange(len(heads))
    return _array(class_of, place[block[step[heads[by_head]]]], accepts[heads[by_head]])


def _array(class_of: np.ndarray, step: np.ndarray, accepts: np.ndarray) -> Automaton:
    kind = np.uint8 if len(step) <= 256 else np.uint16 if len(step) <= 65536 else np.uint32
    return Automaton(class_of, step.shape[1], step.astype(kind).ravel(), accepts, (step == 0).all(axis=0)[class_of])


def combined(automata: Sequence[Automaton]) -> Automaton:
    """One automaton that runs all of them at once; bit i of ``accepts``: automaton i accepts. At most 31 of them.

    A state is a number whose digits are the single automata's states; those that can be reached are found class by
    class, all states of a step at once.
    """
    signature: dict[tuple[int, ...], int] = {}
    class_of = np.array([signature.setdefault(tuple(int(m.class_of[b]) for m in automata), len(signature)) for b in range(256)])
    examples = [int(np.flatnonzero(class_of == c)[0]) for c in range(len(signature))]
    steps = [m.step.reshape(-1, m.classes)[:, m.class_of[examples]].astype(np.int64) for m in automata]
    digit = [1]
    for step in steps:
        digit.append(digit[-1] * len(step))
    if digit[-1] >= 1 << 62:
        raise ValueError("too many rules for one automaton")

    def targets(states: np.ndarray) -> np.ndarray:
        return sum(step[states // d % len(step)] * d for step, d in zip(steps, digit, strict=False))

    known = fresh = np.zeros(1, np.int64)
    while len(fresh):
        fresh = np.setdiff1d(targets(fresh), known)
        known = np.union1d(known, fresh)
        if len(known) > MAX_COMBINED:
            raise ValueError("the rules need too many states together")
    step = np.searchsorted(known, targets(known))  # the start, 0, stays the first
    accepts = sum((m.accepts[known // d % len(s)] != 0).astype(np.int64) << i for i, (m, s, d) in enumerate(zip(automata, steps, digit, strict=False)))
    return _array(class_of, step, accepts)


def _backwards(tree: list) -> list:
    """The parsed expression of the reversed texts."""
    out = []
    for kind, value in reversed(tree):
        if kind is op.SUBPATTERN:
            value = (*value[:3], _backwards(list(value[3])))
        elif kind is op.BRANCH:
            value = (value[0], [_backwards(list(branch)) for branch in value[1]])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            value = (*value[:2], _backwards(list(value[2])))
        out.append((kind, value))
    return out


def _accepted(machine: Automaton, data: bytes, places: range) -> Iterator[int]:
    """The places whose byte takes the machine to an accepting state, as long as it can still accept."""
    state, step, width, class_of, accepts, dead = machine.plain
    for i in places:
        state = step[state * width + class_of[data[i]]]
        if state == dead:
            return
        if accepts[state]:
            yield i


class Expression:
    """One expression: where its matches end, where they begin, how far they go, and where a group in them begins."""

    def __init__(self, pattern: str, ignore_case: bool = False, group: int = 0):
        tree = list(_parser.parse(pattern))
        self.ends = _determined([(tree, ignore_case)])
        if self.ends.accepts[0]:
            raise ValueError(f"matches the empty text: {pattern}")
        self._starts = _determined([(_backwards(tree), ignore_case)])
        self._whole = _determined([(tree, ignore_case)], anywhere=False)
        self._head = self._body = None
        if group:
            if not tree or tree[-1][0] is not op.SUBPATTERN or tree[-1][1][0] != group:
                raise ValueError(f"group {group} is not the last part of {pattern}")
            self._head = _determined([(tree[:-1], ignore_case)], anywhere=False)
            self._body = _determined([(_backwards(tree[-1:]), ignore_case)], anywhere=False)

    def matches(self, data: bytes, begin: int, until: int) -> Iterator[tuple[int, int, int]]:
        """(start, start of the group, end) of the matches within ``data[begin:until]``: the leftmost, as long as it can
        be, then the leftmost behind it, and so on. Time grows with the stretch, and what is read behind a match's end."""
        starts = list(_accepted(self._starts, data, range(until - 1, begin - 1, -1)))
        done = begin
        for start in reversed(starts):
            if start >= done:
                for last in _accepted(self._whole, data, range(start, until)):
                    done = last + 1
                yield start, self._group(data, start, done), done

    def _group(self, data: bytes, start: int, end: int) -> int:
        """Where the group begins: behind the longest head that leaves a body."""
        if self._head is None:
            return start
        bodies = set(_accepted(self._body, data, range(end - 1, start - 1, -1)))
        heads = [last + 1 for last in _accepted(self._head, data, range(start, end))]
        return max((h for h in heads if h in bodies), default=start)

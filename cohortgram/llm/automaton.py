"""Search rules compiled to one deterministic automaton over bytes.

A rule is a regular expression over bytes: literals, ``\\xHH`` and other escapes, classes, groups, ``|``, ``?``,
``*``, ``+``, ``{n}``, ``{n,m}``. Each becomes a nondeterministic automaton, then by subset construction a
deterministic one that searches: a state holds the sets of positions reached from the possible starts, the
leftmost first, so that a match in progress shuts out starts inside it. The searches of all rules are run side by side as one
product automaton, which is minimised by partition refinement and stored as transition arrays. One pass over the
bytes then tells, at each byte and for each rule, whether the byte begins the accepted part of a match (1), goes on with it
(2) or neither (0).

That gives the leftmost, longest, non-overlapping matches of every rule, provided that a rule never needs to look past the
end of a match: a match must either go on with every further byte or be over, and no start may complete a match while an
earlier one is undecided. Rules for which this does not hold are refused when they are compiled.

The start of a match is found from the byte at which it is first accepted, by the reversed rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

_ALL = (1 << 256) - 1
_DIGITS = sum(1 << b for b in b"0123456789")
_WORD = _DIGITS | sum(1 << b for b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")
_BLANK = sum(1 << b for b in b" \t\n\r\x0b\x0c")
#: Bytes of a stretch that is scanned beside others.
STRETCH = 256
#: With fewer stretches left than this, bytes are stepped through one by one.
FEW = 6


class _Parser:
    """Recursive descent over a rule; a node is ``(kind, children or byte mask)``."""

    def __init__(self, rule: str, any_case: bool):
        self.rule, self.at, self.any_case = rule, 0, any_case

    def parse(self):
        node = self.choice()
        if self.at < len(self.rule):
            raise ValueError(f"unexpected {self.rule[self.at]!r} at {self.at} of {self.rule}")
        return node

    def peek(self) -> str:
        return self.rule[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        if self.at > len(self.rule):
            raise ValueError(f"{self.rule} ends too early")
        return self.rule[self.at - 1]

    def choice(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated())
        return ("then", items)

    def repeated(self):
        node = self.single()
        while (sign := self.peek()) and sign in "?*+{":
            self.take()
            if sign == "{":
                end = self.rule.index("}", self.at)
                low, comma, high = self.rule[self.at : end].partition(",")
                self.at = end + 1
                least = [node] * int(low)
                if not comma:
                    node = ("then", least)
                elif high:
                    node = ("then", least + [("?", node)] * (int(high) - int(low)))
                else:
                    node = ("then", [*least, ("*", node)])
            else:
                node = ("then", [node, ("*", node)]) if sign == "+" else (sign, node)
        return node

    def single(self):
        sign = self.take()
        if sign == "(":
            node = self.choice()
            if self.take() != ")":
                raise ValueError(f"no ) at {self.at} of {self.rule}")
            return node
        if sign == "[":
            return ("bytes", self.members())
        if sign == ".":
            return ("bytes", _ALL & ~(1 << 10))
        return ("bytes", self.cased(self.escaped() if sign == "\\" else self.byte(sign)))

    @staticmethod
    def byte(sign: str) -> int:
        if ord(sign) > 127:
            raise ValueError(f"rules are written in ASCII: {sign!r}")
        return 1 << ord(sign)

    def escaped(self) -> int:
        sign = self.take()
        if sign == "x":
            return 1 << int(self.take() + self.take(), 16)
        known = {"d": _DIGITS, "w": _WORD, "s": _BLANK, "n": 1 << 10, "t": 1 << 9, "r": 1 << 13}
        return known[sign] if sign in known else self.byte(sign)

    def cased(self, mask: int) -> int:
        if self.any_case:
            for upper in range(65, 91):
                if mask >> upper & 1 or mask >> upper + 32 & 1:
                    mask |= 1 << upper | 1 << upper + 32
        return mask

    def members(self) -> int:
        mask, negated = 0, self.peek() == "^"
        if negated:
            self.take()
        while (sign := self.take()) != "]":
            one = self.escaped() if sign == "\\" else self.byte(sign)
            if self.peek() == "-" and self.rule[self.at + 1 : self.at + 2] != "]":
                self.take()
                sign = self.take()
                last = self.escaped() if sign == "\\" else self.byte(sign)
                one = sum(1 << b for b in range(one.bit_length() - 1, last.bit_length()))
            mask |= one
        mask = self.cased(mask)
        return _ALL & ~mask if negated else mask


class Positions:
    """A nondeterministic automaton: byte edges and empty edges between numbered positions."""

    def __init__(self, node, backwards: bool = False):
        self.edges: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []
        self.backwards = backwards
        self.first, self.last = self._new(), self._new()
        self._add(node, self.first, self.last)
        self.start = self.closed({self.first})

    def _new(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def _add(self, node, source: int, target: int) -> None:
        kind, inside = node
        if kind == "bytes":
            self.edges[source].append((inside, target))
        elif kind == "or":
            for option in inside:
                self._add(option, source, target)
        elif kind == "then":
            for item in reversed(inside) if self.backwards else inside:
                after = self._new()
                self._add(item, source, after)
                source = after
            self.empty[source].append(target)
        else:
            # Positions of its own, so that going round cannot be mixed up with what stands beside it.
            into, out = self._new(), self._new()
            self._add(inside, into, out)
            self.empty[source] += [into, target]
            self.empty[out] += [into, target] if kind == "*" else [target]

    def closed(self, positions: set[int]) -> frozenset[int]:
        found, open_ = set(positions), list(positions)
        while open_:
            for target in self.empty[open_.pop()]:
                if target not in found:
                    found.add(target)
                    open_.append(target)
        return frozenset(p for p in found if self.edges[p] or p == self.last)

    def moved(self, positions: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed({t for p in positions for mask, t in self.edges[p] if mask >> byte & 1})

    def masks(self) -> set[int]:
        return {mask for edges in self.edges for mask, _ in edges}


@dataclass(frozen=True)
class Rule:
    """A kind of match: its rule, and the fewest accepted bytes that make a match count.

    Accepted bytes are those from the first at which the match could end: of a rule that ends in a repeated class, the
    bytes of that class.
    """

    kind: str
    rule: str
    least: int = 1
    any_case: bool = False

    def tree(self):
        return _Parser(self.rule, self.any_case).parse()


class _Search:
    """The searching automaton of one rule; a state is its sets of positions by start, and the mark of its last byte."""

    def __init__(self, rule: Rule):
        self.rule, self.positions = rule.rule, Positions(rule.tree())
        if self.positions.last in self.positions.start:
            raise ValueError(f"{self.rule} matches nothing")
        self.start = ((), 0)

    def after(self, state, byte: int):
        threads, mark = state
        p = self.positions
        if mark:
            on = p.moved(threads[0], byte)
            if on:
                if p.last not in on:
                    raise ValueError(f"{self.rule} looks past the end of a match")
                return ((on,), 2)
            threads = ()
        new, seen = [], set()
        for thread in (*threads, p.start):
            on = p.moved(thread, byte) - seen
            if not on:
                continue
            if p.last in on:
                if new:
                    raise ValueError(f"{self.rule} completes a match while an earlier start is undecided")
                return ((on,), 1)
            new.append(on)
            seen |= on
        return (tuple(new), 0)


class Automaton:
    """Transition arrays of all rules together.

    ``table[state, class]`` is the next state, ``class_of`` the class of each byte, ``marks[state, rule]`` what the last
    byte means to a rule. ``steps`` is the table laid out in a row with states multiplied by the number of classes, so that a
    step is one addition and one look. ``meeting`` tells the bytes after which there is but one state, whatever the state
    before.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        searches = [_Search(r) for r in self.rules]
        masks = sorted(set().union(*(s.positions.masks() for s in searches)))
        signs = {b: tuple(m >> b & 1 for m in masks) for b in range(256)}
        kinds = {sign: i for i, sign in enumerate(dict.fromkeys(signs.values()))}
        one_of = {kinds[signs[b]]: b for b in range(256)}
        self.class_of = bytes(kinds[signs[b]] for b in range(256))
        self.classes = len(kinds)
        steps, marks = self._subsets(searches, [one_of[c] for c in range(self.classes)])
        self._minimise(steps, marks)
        meeting = (self.table == self.table[0]).all(axis=0)
        self.meeting = np.array([meeting[c] for c in self.class_of])
        self.listed = self.steps.tolist()
        self._back = [_Backwards(r) for r in self.rules]

    @staticmethod
    def _subsets(searches: list[_Search], bytes_: list[int]) -> tuple[np.ndarray, np.ndarray]:
        known: list[dict] = [{} for _ in searches]

        def after(i: int, state, byte: int):
            key = (state, byte)
            if key not in known[i]:
                known[i][key] = searches[i].after(state, byte)
            return known[i][key]

        first = tuple(s.start for s in searches)
        number, order, steps = {first: 0}, [first], []
        for state in order:
            row = []
            for byte in bytes_:
                target = tuple(after(i, own, byte) for i, own in enumerate(state))
                if target not in number:
                    number[target] = len(order)
                    order.append(target)
                row.append(number[target])
            steps.append(row)
        return np.array(steps, np.int64), np.array([[own[1] for own in state] for state in order], np.uint8)

    def _minimise(self, steps: np.ndarray, marks: np.ndarray) -> None:
        """Splits states by what they say until their successors agree; state 0 stays the first."""
        block = np.unique(marks, axis=0, return_inverse=True)[1].ravel()
        while True:
            _, finer = np.unique(np.column_stack([block, block[steps]]), axis=0, return_inverse=True)
            finer = finer.ravel()
            if finer.max() == block.max():
                break
            block = finer
        _, member = np.unique(block, return_index=True)
        number = np.empty(len(member), np.int64)
        number[block[np.sort(member)]] = np.arange(len(member))
        chosen = np.sort(member)
        self.table = number[block[steps[chosen]]]
        self.marks = marks[chosen]
        self.steps = (self.table * self.classes).ravel().astype(np.int32)

    def states(self, data: bytes, starts: np.ndarray) -> np.ndarray:
        """The state after each byte of texts laid end to end, times the number of classes.

        ``starts`` has the place of each text's first byte.

        Texts are cut into stretches behind bytes that lead every state to the same one, and all stretches are stepped through
        together; the longest ones are finished on their own.
        """
        kinds = np.frombuffer(data.translate(self.class_of), np.uint8)
        out = np.zeros(len(kinds), self.steps.dtype)
        raw = np.frombuffer(data, np.uint8)
        meets = np.flatnonzero(self.meeting[raw]) + 1
        # The first such place of each stretch of the data; a text begins one in any case.
        meets = meets[np.searchsorted(meets, np.arange(0, len(kinds) + STRETCH, STRETCH)[:-1]).clip(max=len(meets) - 1)] if len(meets) else meets
        begins = np.unique(np.concatenate([starts, meets]))
        begins = begins[begins < len(kinds)]
        if not len(begins):
            return out
        sizes = np.diff(np.append(begins, len(kinds)))
        order = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[order], sizes[order]
        state = self.steps[kinds[np.maximum(begins - 1, 0)]]
        state[np.isin(begins, starts)] = 0
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
        step = 0
        while step < len(active) and active[step] >= FEW:
            n = active[step]
            at = begins[:n] + step
            state = self.steps[state[:n] + kinds[at]]
            out[at] = state
            step += 1
        if step < len(active):
            listed = self.listed
            for i in range(active[step]):
                now, begin = int(state[i]), int(begins[i]) + step
                rest = []
                for kind in kinds[begin : int(begins[i] + sizes[i])].tolist():
                    now = listed[now + kind]
                    rest.append(now)
                out[begin : begin + len(rest)] = rest
        return out

    def matches(self, data: bytes, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """``(rule, start, end)`` of every match in texts laid end to end; the places are those of bytes in ``data``."""
        states = self.states(data, starts) // self.classes
        found = []
        for i, rule in enumerate(self.rules):
            if not self.marks[:, i].any():
                continue
            marks = self.marks[:, i][states]
            begins = np.flatnonzero(marks == 1)
            if not len(begins):
                continue
            goes_on = np.append(marks[1:] == 2, False)
            ends = np.flatnonzero((marks != 0) & ~goes_on) + 1
            floors = starts[np.searchsorted(starts, begins, "right") - 1]
            floors[1:] = np.maximum(floors[1:], ends[:-1])
            long = ends - begins >= rule.least
            for begin, end, floor in zip(begins[long].tolist(), ends[long].tolist(), floors[long].tolist()):
                found.append((i, self._back[i].first(data, begin, floor), end))
        return found


class _Backwards:
    """Finds where a match starts, by the reversed rule; its states are made as they are met."""

    def __init__(self, rule: Rule):
        self.positions = Positions(rule.tree(), backwards=True)
        self.known: dict = {}

    def first(self, data: bytes, last: int, floor: int) -> int:
        """The smallest start, ``floor`` or later, of a match of the rule whose last byte is at ``last``."""
        p, known, state, best = self.positions, self.known, self.positions.start, last
        for at in range(last, floor - 1, -1):
            key = (state, data[at])
            state = known.get(key)
            if state is None:
                state = known[key] = p.moved(*key)
            if not state:
                break
            if p.last in state:
                best = at
        return best


def cached(build: Callable[[], Automaton]) -> Callable[[], Automaton]:
    """Builds once per worker."""
    made: list[Automaton] = []

    def get() -> Automaton:
        if not made:
            made.append(build())
        return made[0]

    return get

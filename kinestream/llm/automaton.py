"""Many regular expressions as one minimal deterministic automaton over bytes."""

from __future__ import annotations

from array import array
from collections import defaultdict
from re import _constants as sre
from re import _parser

_FOLD = 0x20


class _Nfa:
    """A Thompson automaton: edges by byte set, and empty edges."""

    def __init__(self) -> None:
        self.edges: list[tuple[frozenset[int], int] | None] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append(None)
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int, fold: bool, back: bool) -> int:
        """Append a parsed pattern behind ``start``; back: to be read from its end. Returns its last state."""
        for op, arg in reversed(list(tree)) if back else tree:
            if op is sre.LITERAL:
                start = self._step(start, self._cased({arg}, fold))
            elif op is sre.IN:
                start = self._step(start, self._cased(self._set(arg), fold))
            elif op is sre.SUBPATTERN:
                _, on, _, inner = arg
                start = self.add(inner, start, fold or bool(on & 2), back)
            elif op is sre.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    first = self.state()
                    self.empty[start].append(first)
                    self.empty[self.add(branch, first, fold, back)].append(end)
                start = end
            elif op is sre.MAX_REPEAT:
                least, most, inner = arg
                for _ in range(least):
                    start = self.add(inner, start, fold, back)
                if most is sre.MAXREPEAT:
                    first = self.state()
                    self.empty[start].append(first)
                    self.empty[self.add(inner, first, fold, back)].append(first)
                    start = first
                else:
                    ends = [start]
                    for _ in range(most - least):
                        ends.append(start := self.add(inner, start, fold, back))
                    end = self.state()
                    for x in ends:
                        self.empty[x].append(end)
                    start = end
            else:
                raise ValueError(f"not supported in a scan rule: {op}")
        return start

    def _step(self, start: int, over: frozenset[int]) -> int:
        here, end = self.state(), self.state()
        self.empty[start].append(here)
        self.edges[here] = (over, end)
        return end

    @staticmethod
    def _cased(found: set[int], fold: bool) -> frozenset[int]:
        if max(found) > 127:
            raise ValueError("scan rules are over ASCII")
        return frozenset(found | {c ^ _FOLD for c in found if fold and chr(c).isalpha()})

    @staticmethod
    def _set(parts) -> set[int]:
        found: set[int] = set()
        for op, arg in parts:
            if op is sre.LITERAL:
                found.add(arg)
            elif op is sre.RANGE:
                found |= set(range(arg[0], arg[1] + 1))
            else:
                raise ValueError(f"not supported in a scan rule: {op}")
        return found

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


class Dfa:
    """A minimal automaton. ``table[state + kind[byte]]`` is the next state; bytes that no rule tells apart are one kind, and states are
    multiples of the number of kinds.

    States from ``accepting`` on are those in which a rule's match ends; ``ends[state]`` has the rules' numbers.
    The first state is 0 unless it is accepting; ``start`` says.
    """

    def __init__(self, patterns: list[str], anywhere: bool, back: bool = False):
        nfa = _Nfa()
        first, last = nfa.state(), {}
        for n, p in enumerate(patterns):
            own = nfa.state()
            nfa.empty[first].append(own)
            last[nfa.add(_parser.parse(p), own, False, back)] = n
        begin = nfa.closed([first])
        kinds = self._kinds(nfa)
        states, rows, todo = {begin: 0}, [], [begin]
        for here in todo:
            row = []
            for byte in kinds.values():
                to = nfa.closed({e[1] for s in here if (e := nfa.edges[s]) and byte in e[0]})
                to = to | begin if anywhere else to
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                row.append(states[to])
            rows.append(row)
        marks = [frozenset(last[x] for x in s if x in last) for s in states]
        self._minimal(rows, marks, list(kinds), 0)

    @staticmethod
    def _kinds(nfa: _Nfa) -> dict[frozenset[int], int]:
        """Bytes that no edge tells apart, as one: {bytes: one of them}."""
        sets = {e[0] for e in nfa.edges if e}
        by = defaultdict(set)
        for b in range(256):
            by[frozenset(i for i, s in enumerate(sets) if b in s)].add(b)
        return {frozenset(v): min(v) for v in by.values()}

    def _minimal(self, rows: list[list[int]], marks: list[frozenset[int]], kinds: list[frozenset[int]], start: int) -> None:
        """Merge states that no text tells apart, by refining classes until they hold, and lay the table out."""
        classes = {m: i for i, m in enumerate(dict.fromkeys(marks))}
        of, n = [classes[m] for m in marks], len(classes)
        while True:
            signs: dict[tuple, int] = {}
            of = [signs.setdefault((of[s], *(of[t] for t in rows[s])), len(signs)) for s in range(len(rows))]
            if len(signs) == n:
                break
            n = len(signs)
        kept = {c: s for s, c in reversed([*enumerate(of)])}
        order = sorted(kept, key=lambda c: (bool(marks[kept[c]]), c != of[start], c))
        width = len(kinds)
        place = {c: width * i for i, c in enumerate(order)}
        self.kind = bytes(next(i for i, k in enumerate(kinds) if b in k) for b in range(256))
        table = array("i", [place[of[to]] for c in order for to in rows[kept[c]]])
        self.table: list[int] = table.tolist()
        self.start = place[of[start]]
        self.accepting = min((place[c] for c in order if marks[kept[c]]), default=width * n)
        self.ends = {place[c]: tuple(sorted(marks[kept[c]])) for c in order if marks[kept[c]]}
        self.dead = next((place[c] for c in order if not marks[kept[c]] and all(of[t] == c for t in rows[kept[c]])), -1)
        self.states = n


class Scanner:
    """Finds the matches of all rules in one pass over the bytes.

    A rule is a head and a set of characters, of which one or more follow the head. The combined automaton reads
    every byte once and says where a head and its first character end. There the rule's own automaton, built of
    the rule read backwards, finds the leftmost start behind the rule's last match, and the match goes on
    while the rule's table has the characters. So matches are the leftmost, longest and non-overlapping ones of each rule. One automaton that
    reads to the ends of matches, too, would have to know which of the rules are within one at any time: 15,046 states
    instead of 657 for the rules of ``secrets``, and 16 s to build.
    """

    def __init__(self, rules: dict[str, tuple[str, str]]):
        self.names = list(rules)
        patterns = [head + tail for head, tail in rules.values()]
        self.forward = Dfa(patterns, anywhere=True)
        self.backward = [Dfa([p], anywhere=False, back=True) for p in patterns]
        self.goes_on = [bytes(len(m) for m in self._members(tail)) for _, tail in rules.values()]

    @staticmethod
    def _members(tail: str) -> list[tuple[int, ...]]:
        """For each byte the rule that a set has it, if so."""
        own = Dfa([tail], anywhere=False)
        return [own.ends.get(own.table[own.start + own.kind[b]], ()) for b in range(256)]

    def spans(self, raw: bytes) -> list[tuple[int, int, int, int]]:
        """(start, end, rule number, place of the first character of the set) of each match, by byte."""
        table, least, state = self.forward.table, self.forward.accepting, self.forward.start
        hits = []
        for at, kind in enumerate(raw.translate(self.forward.kind)):
            state = table[state + kind]
            if state >= least:
                hits.append((at, state))
        found, after, n = [], [0] * len(self.names), len(raw)
        for at, state in hits:
            for rule in self.forward.ends[state]:
                if at >= after[rule] and (start := self._start(rule, raw, after[rule], at)) is not None:
                    end, goes_on = at + 1, self.goes_on[rule]
                    while end < n and goes_on[raw[end]]:
                        end += 1
                    after[rule] = end
                    found.append((start, end, rule, at))
        return sorted(found, key=lambda x: (x[0], x[2]))

    def _start(self, rule: int, raw: bytes, after: int, last: int) -> int | None:
        own = self.backward[rule]
        table, kind, state, start = own.table, own.kind, own.start, None
        for at in range(last, after - 1, -1):
            state = table[state + kind[raw[at]]]
            if state == own.dead:
                break
            if state >= own.accepting:
                start = at
        return start

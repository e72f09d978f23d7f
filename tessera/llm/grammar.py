"""Table-driven parsing from bundled grammars.

A grammar is EBNF text whose right sides are regular expressions over terminals and rule names. Each rule becomes
a deterministic automaton, and for every state and terminal the table holds the states that take its place once
the terminal is read, all rule entries on the way folded in. Parsing a token is then one table lookup, after
returning from the rules that end before it. Between a terminal and a rule that may begin with it the terminal
wins, else the alternative written first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

_TOKEN = re.compile(r"\s*(?:#[^\n]*\n\s*)*('(?:[^'])*'|[A-Za-z_]\w*|[:;|()\[\]*+])")
END = "$end"


@dataclass
class _Nfa:
    arcs: list[list[tuple[str | None, int]]] = field(default_factory=list)

    def state(self) -> int:
        self.arcs.append([])
        return len(self.arcs) - 1


class Grammar:
    """Parser tables of one grammar; ``parse`` accepts a sequence of terminal names."""

    def __init__(self, text: str, start: str) -> None:
        self.rules = self._read(text)
        self.states: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.entry: dict[str, int] = {}
        self.owner: list[str] = []
        for name, (nfa, a, z) in self.rules.items():
            self._determinise(name, nfa, a, z)
        self.nullable = self._nullable()
        self._memo: dict[int, dict[str, tuple[int, ...]]] = {}
        self.table = [self._moves(s, ()) for s in range(len(self.states))]
        self.start = self.entry[start]

    def _read(self, text: str) -> dict[str, tuple[_Nfa, int, int]]:
        toks, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"grammar: {text[at:at + 40]!r}")
            toks.append(m.group(1))
            at = m.end()
        rules: dict[str, tuple[_Nfa, int, int]] = {}
        i = 0
        while i < len(toks):
            name, nfa = toks[i], _Nfa()
            if toks[i + 1] != ":":
                raise ValueError(f"grammar: {name}")
            a, z, i = self._alternatives(toks, i + 2, nfa)
            if toks[i] != ";":
                raise ValueError(f"grammar: {name} at {toks[i]}")
            rules[name] = (nfa, a, z)
            i += 1
        return rules

    def _alternatives(self, toks: list[str], i: int, nfa: _Nfa) -> tuple[int, int, int]:
        a, z = nfa.state(), nfa.state()
        while True:
            b, y, i = self._sequence(toks, i, nfa)
            nfa.arcs[a].append((None, b))
            nfa.arcs[y].append((None, z))
            if toks[i] != "|":
                return a, z, i
            i += 1

    def _sequence(self, toks: list[str], i: int, nfa: _Nfa) -> tuple[int, int, int]:
        a = z = nfa.state()
        while toks[i] not in "|;)]":
            t = toks[i]
            if t in "([":
                b, y, i = self._alternatives(toks, i + 1, nfa)
                if t == "[":
                    nfa.arcs[b].append((None, y))
            else:
                b, y = nfa.state(), nfa.state()
                nfa.arcs[b].append((t, y))
            i += 1
            if toks[i] in "*+":
                nfa.arcs[y].append((None, b))
                if toks[i] == "*":
                    nfa.arcs[b].append((None, y))
                i += 1
            nfa.arcs[z].append((None, b))
            z = y
        return a, z, i

    def _determinise(self, name: str, nfa: _Nfa, a: int, z: int) -> None:
        def closure(seed: Sequence[int]) -> tuple[int, ...]:
            seen: dict[int, None] = {}

            def visit(s: int) -> None:
                if s not in seen:
                    seen[s] = None
                    for label, to in nfa.arcs[s]:
                        if label is None:
                            visit(to)

            for s in seed:
                visit(s)
            return tuple(seen)

        first = closure([a])
        names = {frozenset(first): len(self.states)}
        todo = [first]
        self.entry[name] = len(self.states)
        self.states.append({})
        self.final.append(z in first)
        self.owner.append(name)
        while todo:
            cur = todo.pop(0)
            at = names[frozenset(cur)]
            by: dict[str, list[int]] = {}
            for s in cur:
                for label, to in nfa.arcs[s]:
                    if label is not None:
                        by.setdefault(label, []).append(to)
            for label, to in by.items():
                nxt = closure(to)
                k = frozenset(nxt)
                if k not in names:
                    names[k] = len(self.states)
                    self.states.append({})
                    self.final.append(z in nxt)
                    self.owner.append(name)
                    todo.append(nxt)
                self.states[at][label] = names[k]

    def _nullable(self) -> set[str]:
        out: set[str] = set()
        while True:
            new = set()
            for name in self.rules:
                seen, todo = set(), [self.entry[name]]
                while todo:
                    s = todo.pop()
                    if s in seen:
                        continue
                    seen.add(s)
                    if self.final[s]:
                        new.add(name)
                    todo += [to for label, to in self.states[s].items() if label in out]
            if new == out:
                return out
            out = new

    def _moves(self, s: int, open_rules: tuple[int, ...]) -> dict[str, tuple[int, ...]]:
        if s in self._memo:
            return self._memo[s]
        if s in open_rules:
            raise ValueError(f"left recursion in {self.owner[s]}")
        out: dict[str, tuple[int, ...]] = {}
        rest = {}
        for label, to in self.states[s].items():
            back = () if self.final[to] and not self.states[to] else (to,)
            if label in self.rules:
                rest[label] = (to, back)
            else:
                out[label.strip("'")] = back
        for label, (to, back) in rest.items():
            for t, seq in self._moves(self.entry[label], (*open_rules, s)).items():
                out.setdefault(t, back + seq)
            if label in self.nullable:
                for t, seq in self._moves(to, (*open_rules, s)).items():
                    out.setdefault(t, seq)
        self._memo[s] = out
        return out

    def ends(self, stack: Sequence[int]) -> bool:
        return all(self.final[s] or self._skips(s) for s in stack)

    def _skips(self, s: int) -> bool:
        """Whether the rest of a rule can be empty."""
        return any(label in self.nullable and (self.final[to] or self._skips(to)) for label, to in self.states[s].items())

    def parse(self, tokens: Sequence[str], start: str | None = None) -> int:
        """Index of the first token that does not fit, the number of tokens if more were needed, -1 if all is well."""
        table, final = self.table, self.final
        stack = [self.start if start is None else self.entry[start]]
        for i, t in enumerate(tokens):
            if not stack:
                return i
            s = stack.pop()
            seq = table[s].get(t)
            while seq is None:
                if not stack or not (final[s] or self._skips(s)):
                    return i
                s = stack.pop()
                seq = table[s].get(t)
            stack += seq
        return -1 if self.ends(stack) else len(tokens)

    def parse_inserting(self, tokens: Sequence[str], newline: str, mark: str, closer: str, apart: str = "") -> int:
        """As ``parse``, where ``newline`` tokens are passed over and a missing ``mark`` is filled in before a token
        that does not fit, if a newline or a ``closer`` stands there, and at the end. ``apart`` never goes on a line."""
        table = self.table
        stack, fresh = [self.start], False

        def step(t: str) -> bool:
            k = len(stack)
            while k:
                k -= 1
                s = stack[k]
                seq = table[s].get(t)
                if seq is not None:
                    del stack[k:]
                    stack.extend(seq)
                    return True
                if not (self.final[s] or self._skips(s)):
                    return False
            return False

        for i, t in enumerate(tokens):
            if t == newline:
                fresh = True
                continue
            if fresh and t == apart:
                step(mark)
            if not step(t) and not ((fresh or t == closer) and step(mark) and step(t)):
                return i
            fresh = False
        if self.ends(stack) or step(mark) and self.ends(stack):
            return -1
        return len(tokens)

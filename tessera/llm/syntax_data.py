"""JSON, TOML and YAML: lexers and grammars."""

from __future__ import annotations

import re
from functools import lru_cache

from tessera.llm.grammar import Grammar

# ---- JSON

_JSON_LEX = re.compile(r'[ \t\r\n]*("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.])|[{}\[\]:,]|true\b|false\b|null\b|\S)')
_JSON_KIND = {p: p for p in "{ } [ ] : ,".split()} | dict.fromkeys(("true", "false", "null"), "ATOM")

JSON_GRAMMAR = """
value: ATOM | STR | '{' [pair (',' pair)*] '}' | '[' [value (',' value)*] ']' ;
pair: STR ':' value ;
"""


@lru_cache(maxsize=1)
def json_grammar() -> Grammar:
    return Grammar(JSON_GRAMMAR, "value")


def check_json(text: str) -> int | None:
    """Line of the first error of a strict JSON text, None if there is none."""
    kinds = []
    for w in _JSON_LEX.findall(text):
        k = _JSON_KIND.get(w)
        if k is None:
            c = w[0]
            k = "STR" if c == '"' and len(w) > 1 else "ATOM" if c.isdigit() or c == "-" and len(w) > 1 else "ERROR"
        kinds.append(k)
    at = json_grammar().parse(kinds)
    if at < 0:
        return None
    for i, m in enumerate(_JSON_LEX.finditer(text)):
        if i == at:
            return text.count("\n", 0, m.start(1)) + 1
    return text.count("\n") + 1


# ---- TOML

_TOML_SPACE = re.compile(r"(?:[ \t]|#[^\n\x00-\x08\x0b\x0c\x0e-\x1f\x7f]*)*")
_ESC = r"\\(?:[btnfr\"\\]|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8})"
_TOML_STR = re.compile(
    r'"""(?:[^"\\\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|' + _ESC + r'|\\[ \t]*\n\s*|"(?!""))*"{3,5}' + r"|'''(?:[^'\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|'(?!''))*'{3,5}" + r'|"(?:[^"\\\n\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|' + _ESC + r')*"' + r"|'[^'\n\x00-\x08\x0b\x0c\x0e-\x1f\x7f]*'"
)
_TOML_BARE = re.compile(r"[A-Za-z0-9_-]+")
_TOML_VALUE = re.compile(
    r"(?:\d{4}-\d\d-\d\d(?:[Tt ]\d\d:\d\d:\d\d(?:\.\d+)?(?:[Zz]|[+-]\d\d:\d\d)?)?|\d\d:\d\d:\d\d(?:\.\d+)?|true|false|[+-]?(?:inf|nan)"
    r"|0x[0-9a-fA-F](?:_?[0-9a-fA-F])*|0o[0-7](?:_?[0-7])*|0b[01](?:_?[01])*|[+-]?(?:0|[1-9](?:_?\d)*)(?:\.\d(?:_?\d)*)?(?:[eE][+-]?\d(?:_?\d)*)?)(?![\w.+:-])"
)

TOML_GRAMMAR = """
doc: [entry] (NL [entry])* ;
entry: '[' key ']' | '[[' key ']]' | key '=' value ;
key: (BARE | STR) ('.' (BARE | STR))* ;
value: STR | MLSTR | VAL | '[' NL* [value NL* (',' NL* value NL*)* [',' NL*]] ']' | '{' [key '=' value (',' key '=' value)*] '}' ;
"""


@lru_cache(maxsize=1)
def toml_grammar() -> Grammar:
    return Grammar(TOML_GRAMMAR, "doc")


def _toml_tokens(text: str) -> list[tuple[str, str, int]]:
    """``(terminal, word, offset)``; keys and values are told apart by where they stand."""
    out: list[tuple[str, str, int]] = []
    at, n = 0, len(text)
    nest: list[str] = []
    value = False
    while True:
        at = _TOML_SPACE.match(text, at).end()
        if at >= n:
            return out
        c = text[at]
        if c == "\n":
            out.append(("NL", c, at))
            at += 1
            value = value if nest else False
            continue
        if c in "\"'":
            m = _TOML_STR.match(text, at)
            if not m:
                out.append(("ERROR", c, at))
                return out
            w = m.group()
            out.append(("MLSTR" if w[:3] in ('"""', "'''") and len(w) > 5 else "STR", w, at))
            at = m.end()
            continue
        if value and c not in "[]{},=":
            m = _TOML_VALUE.match(text, at)
            if not m or not m.group():
                out.append(("ERROR", c, at))
                return out
            out.append(("VAL", m.group(), at))
            at = m.end()
            continue
        m = _TOML_BARE.match(text, at)
        if m:
            out.append(("BARE", m.group(), at))
            at = m.end()
            continue
        if not value and not nest and c in "[]" and text[at : at + 2] == c * 2:
            out.append((c * 2, c * 2, at))
            at += 2
            continue
        out.append((c if c in "[]{}=,." else "ERROR", c, at))
        if c == "=":
            value = True
        elif c == "[" and value:
            nest.append("[")
        elif c == "{":
            nest.append("{")
            value = False
        elif c in "]}" and nest:
            nest.pop()
            value = bool(nest) and nest[-1] == "[" or not nest
        elif c == "," and nest:
            value = nest[-1] == "["
        at += 1


def _toml_clash(toks: list[tuple[str, str, int]]) -> int | None:
    """Offset of the first key or table that is defined twice."""
    values: set[tuple[str, ...]] = set()
    tables: set[tuple[str, ...]] = set()
    implied: set[tuple[str, ...]] = set()
    lists: dict[tuple[str, ...], int] = {}
    here: tuple[str, ...] = ()
    i, n, depth, start = 0, len(toks), 0, True

    def key(i: int) -> tuple[list[str], int]:
        parts = []
        while i < n and toks[i][0] in ("BARE", "STR", "."):
            if toks[i][0] != ".":
                w = toks[i][1]
                parts.append(w[1:-1] if toks[i][0] == "STR" else w)
            i += 1
        return parts, i

    def resolve(parts: list[str]) -> tuple[str, ...]:
        path: tuple[str, ...] = ()
        for p in parts:
            path += (p,)
            if path in lists:
                path += (f"\0{lists[path]}",)
        return path

    while i < n:
        kind, _, off = toks[i]
        if kind in ("[", "{") and not start:
            depth += 1
        elif kind in ("]", "}") and depth:
            depth -= 1
        if kind == "NL" and not depth:
            start = True
            i += 1
            continue
        if start and kind in ("[", "[["):
            parts, j = key(i + 1)
            if not parts:
                return off
            base = resolve(parts[:-1])
            for k in range(1, len(base) + 1):
                if base[:k] in values:
                    return off
                implied.add(base[:k])
            full = base + (parts[-1],)
            if kind == "[":
                if full in tables or full in values or full in lists:
                    return off
                tables.add(full)
                here = full
            else:
                if full in tables or full in values or full in implied and full not in lists:
                    return off
                lists[full] = lists.get(full, -1) + 1
                here = full + (f"\0{lists[full]}",)
            i, start = j + 1, False
            continue
        if start and kind in ("BARE", "STR"):
            parts, j = key(i)
            full = here + tuple(parts)
            for k in range(len(here) + 1, len(full)):
                if full[:k] in values or full[:k] in tables and full[:k] != here:
                    return off
                implied.add(full[:k])
            if full in values or full in tables or full in lists or full in implied:
                return off
            values.add(full)
            i, start = j, False
            continue
        start = False
        i += 1
    return None


def check_toml(text: str) -> int | None:
    """Line of the first error of a TOML 1.0 text, None if there is none."""
    text = text.removeprefix("﻿").replace("\r\n", "\n")
    toks = _toml_tokens(text)
    at = toml_grammar().parse([t[0] for t in toks])
    if at < 0:
        off = _toml_clash(toks)
        return None if off is None else text.count("\n", 0, off) + 1
    off = toks[at][2] if at < len(toks) else len(text)
    return text.count("\n", 0, off) + 1


# ---- YAML

YAML_GRAMMAR = """
stream: DIRECTIVE* [node] (DOCEND | DIRECTIVE+ DOCSTART [node] | DOCSTART [node])* ;
node: ALIAS | props [content] | content ;
nodei: ALIAS | props [content | entries] | content | entries ;
props: ANCHOR [TAG] | TAG [ANCHOR] ;
content: SCALAR | SEQ (ENTRY [node])* END | MAP pair* END | '[' [item (',' item)* [',']] ']' | '{' [item (',' item)* [',']] '}' ;
entries: (ENTRY [node])+ ;
pair: KEY [nodei] [VALUE [nodei]] | VALUE [nodei] ;
item: node [VALUE [node]] | KEY [node] [VALUE [node]] | VALUE [node] ;
"""
_Y_BLANK = re.compile(r"[ \t]*")
_Y_PLAIN_BLOCK = re.compile(r"(?:[^\s:#]|:(?=\S)|(?<=\S)#)(?:[^\n:#]|:(?=[^\s])|(?<=[^\s])#)*")
_Y_PLAIN_FLOW = re.compile(r"(?:[^\s:#,\[\]{}?]|[:?](?=[^\s,\[\]{}])|(?<=\S)#)(?:[^\n:#,\[\]{}]|:(?=[^\s,\[\]{}])|(?<=[^\s])#)*")
_Y_DOUBLE = re.compile(r'"(?:[^"\\]|\\(?:[0abt\tnvfre "/\\N_LP\n\r]|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}))*"')
_Y_SINGLE = re.compile(r"'(?:[^']|'')*'")
_Y_PROP = re.compile(r"[&*][^\s,\[\]{}]+|!<[^>\s]*>|![^\s,\[\]{}]*")
_Y_HEAD = re.compile(r"[|>](?:[+-]?[1-9]?|[1-9][+-])[ \t]*(?:(?<=[ \t])#[^\n]*)?(?=\n|\Z)")
_Y_MARK = re.compile(r"(?:---|\.\.\.)(?=\s|\Z)")


class _Fault(Exception):
    pass


class _Yaml:
    """Lexer that turns indentation and implicit keys into terminals."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.at = 0
        self.line_start = 0
        self.out: list[tuple[str, int]] = []
        self.levels = [-1]
        self.flow: list[str] = []
        self.fresh = True  # a key may stand here
        self.anchors: set[str] = set()
        self.pending: tuple[int, int, int] | None = None  # first property of a node: token index, offset, column

    def put(self, kind: str, off: int) -> None:
        self.out.append((kind, off))

    def unwind(self, col: int) -> None:
        while self.levels[-1] > col:
            self.levels.pop()
            self.put("END", self.at)

    def run(self) -> list[tuple[str, int]]:
        text, n = self.text, len(self.text)
        while True:
            self.space()
            if self.at >= n:
                break
            self.token(text[self.at])
        if self.flow:
            raise _Fault
        self.unwind(-1)
        return self.out

    def space(self) -> None:
        text, n = self.text, len(self.text)
        while self.at < n:
            m = _Y_BLANK.match(text, self.at)
            begin, self.at = self.at, m.end()
            if self.at < n and text[self.at] == "#" and (self.at == self.line_start or text[self.at - 1] in " \t\n"):
                e = text.find("\n", self.at)
                self.at = n if e < 0 else e
            elif "\t" in m.group() and self.fresh and not self.flow and self.at < n and text[self.at] != "\n" and not text[self.line_start : begin].strip(" "):
                raise _Fault
            if self.at < n and text[self.at] == "\n":
                self.at += 1
                self.line_start = self.at
                if not self.flow:
                    # a property at the end of a line is the collection's below, not its first key's
                    self.fresh, self.pending = True, None
                continue
            return

    def token(self, c: str) -> None:
        text, at = self.text, self.at
        col = at - self.line_start
        nxt = text[at + 1 : at + 2]
        if col == 0 and c in "-." and _Y_MARK.match(text, at):
            if self.flow:
                raise _Fault
            self.unwind(-1)
            self.put("DOCSTART" if c == "-" else "DOCEND", at)
            self.anchors.clear()
            self.at += 3
            self.fresh, self.pending = False, None
            return
        if col == 0 and c == "%" and not self.flow and len(self.levels) == 1:
            e = text.find("\n", at)
            self.put("DIRECTIVE", at)
            self.at = len(text) if e < 0 else e
            return
        if not self.flow:
            self.unwind(col)
        gap = not nxt or nxt in " \t\n"
        if self.flow:
            if c in "[{":
                self.pending = None
                self.flow.append("]" if c == "[" else "}")
                self.put(c, at)
                self.at += 1
                return
            if c in "]}":
                if self.flow.pop() != c:
                    raise _Fault
                self.put(c, at)
                self.at += 1
                self.after_flow()
                return
            if c == ",":
                self.put(c, at)
                self.at += 1
                self.pending = None
                return
            if c == "?" and gap:
                self.put("KEY", at)
                self.at += 1
                return
            if c == ":" and (gap or nxt in ",[]{}" or self.json_key()):
                self.put("VALUE", at)
                self.at += 1
                self.pending = None
                return
        else:
            if c == "-" and gap:
                if not self.fresh:
                    raise _Fault
                self.open(col, "SEQ", len(self.out))
                self.put("ENTRY", at)
                self.at += 1
                self.pending = None
                return
            if c in "?:" and gap:
                if not self.fresh and not (c == ":" and self.out and self.out[-1][0] == "KEY"):
                    raise _Fault
                self.open(col, "MAP", len(self.out))
                self.put("KEY" if c == "?" else "VALUE", at)
                self.at += 1
                self.fresh, self.pending = True, None
                return
            if c in "[{":
                self.pending = None
                self.flow.append("]" if c == "[" else "}")
                self.put(c, at)
                self.at += 1
                return
            if c in "]},":
                raise _Fault
            if c in "|>":
                self.block_scalar()
                return
        if c in "&*!":
            m = _Y_PROP.match(text, at)
            if not m:
                raise _Fault
            if c == "*":
                if m.group()[1:] not in self.anchors:
                    raise _Fault
                self.scalar("ALIAS", m.end(), col)
                return
            if self.pending is None:
                self.pending = (len(self.out), at, col)
            self.put("ANCHOR" if c == "&" else "TAG", at)
            if c == "&":
                self.anchors.add(m.group()[1:])
            self.at = m.end()
            return
        if c == '"' or c == "'":
            m = (_Y_DOUBLE if c == '"' else _Y_SINGLE).match(text, at)
            if not m:
                raise _Fault
            self.scalar("SCALAR", m.end(), col)
            return
        if c in "%@`" or c == "\t" or c in "-?:" and gap and not self.flow:
            raise _Fault
        m = (_Y_PLAIN_FLOW if self.flow else _Y_PLAIN_BLOCK).match(text, at)
        if not m:
            raise _Fault
        self.plain(m.end(), col)

    def json_key(self) -> bool:
        return bool(self.out) and self.out[-1][0] in ("SCALAR", "]", "}") and self.text[self.at - 1] in "\"'}]"

    def open(self, col: int, kind: str, index: int) -> None:
        if col > self.levels[-1]:
            self.levels.append(col)
            self.out.insert(index, (kind, self.at))

    def is_key(self, end: int) -> bool:
        at = _Y_BLANK.match(self.text, end).end()
        if self.text[at : at + 1] != ":":
            return False
        nxt = self.text[at + 1 : at + 2]
        return not nxt or nxt in " \t\n" or bool(self.flow) and (nxt in ",[]{}" or self.text[end - 1] in "\"'")

    def scalar(self, kind: str, end: int, col: int) -> None:
        start = self.at
        index, first, col = self.pending or (len(self.out), start, col)
        several = "\n" in self.text[first:end]
        if self.is_key(end):
            if several and not (kind == "SCALAR" and self.flow and self.flow[-1] == "}"):
                raise _Fault
            self.key(index, first, col, kind, start, end)
            return
        self.put(kind, start)
        self.at = end
        self.seen(start, end)
        self.fresh, self.pending = False, None

    def seen(self, start: int, end: int) -> None:
        e = self.text.rfind("\n", start, end)
        if e >= 0:
            self.line_start = e + 1

    def key(self, index: int, first: int, col: int, kind: str, start: int, end: int) -> None:
        if not self.flow:
            if not self.fresh:
                raise _Fault
            before = len(self.levels)
            self.open(col, "MAP", index)
            index += len(self.levels) - before
        self.out.insert(index, ("KEY", first))
        self.put(kind, start)
        self.at = _Y_BLANK.match(self.text, end).end()
        self.put("VALUE", self.at)
        self.at += 1
        self.fresh, self.pending = False, None

    def after_flow(self) -> None:
        if not self.flow:
            self.fresh = False
        self.pending = None
        if not self.flow and self.is_key(self.at):
            raise _Fault

    def plain(self, end: int, col: int) -> None:
        text, n = self.text, len(self.text)
        start = self.at
        end = start + len(text[start:end].rstrip(" \t"))
        if self.is_key(end):
            self.scalar("SCALAR", end, col)
            return
        lines = False
        least = self.levels[-1] + 1
        while True:
            at = _Y_BLANK.match(text, end).end()
            if at >= n or text[at] != "\n":
                break
            while at < n and text[at] == "\n":
                begin = at + 1
                at = _Y_BLANK.match(text, begin).end()
            if at >= n or text[at] == "#":
                break
            if not self.flow and (len(text[begin:at].split("\t")[0]) < least or at == begin and _Y_MARK.match(text, at)):
                break
            if self.flow and text[at] in ",[]{}" or self.flow and at == begin and _Y_MARK.match(text, at):
                break
            m = (_Y_PLAIN_FLOW if self.flow else _Y_PLAIN_BLOCK).match(text, at)
            if not m:
                break
            self.line_start = begin
            lines = True
            end = at + len(m.group().rstrip(" \t"))
        self.put("SCALAR", start)
        self.at = end
        self.pending = None
        self.fresh = lines and not self.flow
        if lines and self.is_key(end):
            raise _Fault

    def block_scalar(self) -> None:
        text, n = self.text, len(self.text)
        m = _Y_HEAD.match(text, self.at)
        if not m:
            raise _Fault
        self.put("SCALAR", self.at)
        digit = next((int(d) for d in m.group()[1:3] if d.isdigit()), 0)
        parent = max(self.levels[-1], 0) if self.levels[-1] >= 0 else -1
        indent = (max(parent, 0) + digit) if digit else 0
        at = m.end()
        while at < n:
            begin = at + 1
            e = text.find("\n", begin)
            e = n if e < 0 else e
            line = text[begin:e]
            body = line.lstrip(" ")
            if body:
                lead = len(line) - len(body)
                if not indent:
                    if lead <= parent:
                        break
                    if body[0] == "\t" and not body.strip():
                        at = e
                        continue
                    indent = max(lead, parent + 1)
                if lead < indent and body.strip("\t\r ") and not (lead == 0 and indent == 0):
                    break
                if indent == 0 and _Y_MARK.match(line):
                    break
            if begin > n:
                break
            at = e
        self.at = min(at, n)
        self.line_start = text.rfind("\n", 0, self.at) + 1
        self.fresh, self.pending = True, None


@lru_cache(maxsize=1)
def yaml_grammar() -> Grammar:
    return Grammar(YAML_GRAMMAR, "stream")


def check_yaml(text: str) -> int | None:
    """Line of the first error of a YAML text, None if there is none."""
    text = text.removeprefix("﻿").replace("\r\n", "\n").replace("\r", "\n")
    if re.search(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", text):
        return 1
    lexer = _Yaml(text)
    try:
        toks = lexer.run()
    except _Fault:
        return text.count("\n", 0, lexer.at) + 1
    at = yaml_grammar().parse([t[0] for t in toks])
    if at < 0:
        return None
    off = toks[at][1] if at < len(toks) else len(text)
    return text.count("\n", 0, off) + 1

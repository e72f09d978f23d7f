"""Canonical layout of a text, re-emitted from its tokens and compared with the layout it has.

A text is lexed into strings, comments, numbers and the rest. Comments are dropped, strings become a mark that holds
their place, and the rest is emitted anew: in brace languages one line for each statement and brace, indented by
nesting; in markup one line for each tag; elsewhere one line for each logical line, with joined statements taken
apart and brackets closed up; lines wider than the page are wrapped. Three figures compare the two layouts:

* ``expansion``: canonical lines for each original line that holds code; compressed layout makes it large.
* ``uniform``: the share of original lines that repeat the canonical shape of the line one period before them, for the
  best period up to ``PERIODS``; what a template wrote repeats itself.
* ``literals``: numbers and encoded strings as a share of all letters and digits outside comments.

Each share has a fixed weight of evidence against it in its divisor (``*_PRIOR``), so short texts need a stronger
layout instead of falling below a size limit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

WIDTH = 120
PERIODS = 12
LINE_PRIOR, LITERAL_PRIOR = 1.0, 120

_STRINGS = r"\"\"\"[\s\S]*?\"\"\"|'''[\s\S]*?'''|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`"
_NUMBER = r"(?<![\w$#.])-?(?:0[xX][0-9a-fA-F]+|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)(?![\w])"
_COMMENT = {
    "hash": r"#[^\n]*",
    "slash": r"//[^\n]*|/\*[\s\S]*?\*/",
    "dash": r"--[^\n]*|/\*[\s\S]*?\*/",
    "markup": r"<!--[\s\S]*?-->",
    "any": r"#[^\n]*|//[^\n]*|/\*[\s\S]*?\*/|--[^\n]*",
}
TOKENS = {k: re.compile(f"{_STRINGS}|{c}|{_NUMBER}" if k != "markup" else c) for k, c in _COMMENT.items()}
STARTS = {"hash": ("#",), "slash": ("//", "/*"), "dash": ("--", "/*"), "markup": ("<!--",), "any": ("#", "//", "/*", "--")}
FAMILY = (
    dict.fromkeys("py pyi pyx sh bash rb pl yaml yml toml env cfg ini conf dockerfile mk tf r lock sum".split(), "hash")
    | dict.fromkeys("js jsx mjs cjs ts tsx go java c h cc cpp hpp cs css scss less json rs kt swift scala proto php dart".split(), "slash")
    | dict.fromkeys("sql lua hs".split(), "dash")
    | dict.fromkeys("md markdown html htm xml svg rst txt vue".split(), "markup")
)
#: Languages of statements in braces; of tags; and of prose, which has no canonical layout.
BRACED = frozenset("js jsx mjs cjs ts tsx css scss less java go c h cc cpp hpp cs rs kt swift scala php dart json".split())
TAGGED = frozenset("html htm xml svg".split())
PROSE = frozenset("md markdown rst txt vue csv tsv log".split())
#: Settings and records, whose lines are alike by their format and not by a template.
SETTINGS = frozenset("env ini cfg conf toml yaml yml json properties lock sum".split())
_ENCODED = re.compile(r"^(?:[A-Za-z0-9+/]{24,}={0,2}|[0-9a-fA-F]{16,}|(?:\\x[0-9a-fA-F]{2}){8,})$")

_FOR_HEAD = re.compile(r"\bfor\s*\([^(){}]*\)")
_BREAKS = re.compile(r"[;{}]")
_TAG = re.compile(r">")
_JOINED = re.compile(r";(?=\s*\S)|(?<=:)[ \t]+(?=(?:return|pass|break|continue|raise|yield)\b)")
#: Letters and digits fold into one mark each, words with a digit into the digit's.
_FLAT = str.maketrans({**dict.fromkeys("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_", "w"), **dict.fromkeys("0123456789", "n")})
_SHAPES = ((re.compile(r"w*n[wn.]*"), "n"), (re.compile(r"ww+"), "w"), (re.compile(r"[ \t\r]+"), " "))
_MARK = "\x01"


@dataclass(frozen=True)
class Layout:
    """Figures of one text; ``lines`` and ``canonical`` count lines that hold code."""

    lines: int
    canonical: int
    expansion: float
    uniform: float
    literals: float


def lex(text: str, ext: str) -> tuple[str, int, int]:
    """Text with comments dropped and strings marked, characters of literals, and characters of comments."""
    family = FAMILY.get(ext, "any")
    starts = STARTS[family]
    literal = hidden = at = 0
    out: list[str] = []
    for m in TOKENS[family].finditer(text):
        tok = m.group()
        if tok.startswith(starts):
            hidden += len(tok)
            put = "\n" * tok.count("\n")
        elif tok[0] in "\"'`":
            inner = tok.strip(tok[0])
            if len(inner) >= 16 and " " not in inner and _ENCODED.match(inner):
                literal += len(inner)
            put = _MARK + "\n" * tok.count("\n")
        else:
            literal += len(tok)
            continue
        out.append(text[at : m.start()])
        out.append(put)
        at = m.end()
    out.append(text[at:])
    return "".join(out), literal, hidden


def _wrapped(line: str) -> int:
    """Lines that a canonical line takes on a page of ``WIDTH``; what has no blanks or commas is not broken."""
    if len(line) <= WIDTH:
        return 1
    return min(-(-len(line) // WIDTH), 1 + line.count(",") + line.count(" "))


def emit(code: str, ext: str) -> list[str]:
    """Canonical lines, without indentation, of lexed code."""
    if ext in PROSE:
        return [x for x in map(str.strip, code.split("\n")) if x]
    if ext in BRACED:
        code = _BREAKS.sub(lambda m: m.group() + "\n", _FOR_HEAD.sub("for()", code))
    elif ext in TAGGED:
        code = _TAG.sub(">\n", code)
    else:
        code = _JOINED.sub("\n", code)
    return [x for x in map(str.strip, code.split("\n")) if x]


def uniformity(code: str, lines: list[str]) -> float:
    """Share of lines whose indentation and shape are those of the line one period before, for the best period."""
    n = len(lines)
    if n < 3:
        return 0.0
    flat = code.translate(_FLAT)
    for pat, put in _SHAPES:
        flat = pat.sub(put, flat)
    shapes = np.fromiter((hash((len(x) - len(x.lstrip()), y)) for x, y in zip(lines, (y for y in flat.split("\n") if y.strip()))), dtype=np.int64, count=n)
    return max(float((shapes[:-p] == shapes[p:]).sum()) / (n + 2 * LINE_PRIOR) for p in range(1, min(PERIODS, n - 1) + 1))


def measure(text: str, ext: str) -> Layout:
    """Layout figures of one text."""
    code, literal, hidden = lex(text, ext)
    lines = [x for x in code.split("\n") if x.strip()]
    canonical = emit(code, ext)
    count = len(canonical) if ext in PROSE or ext in TAGGED else sum(map(_wrapped, canonical))
    solid = sum(map(str.isalnum, text)) - hidden if literal else 0
    return Layout(
        len(lines),
        count,
        count / (len(lines) + LINE_PRIOR),
        uniformity(code, lines),
        min(1.0, literal / (max(0, solid) + LITERAL_PRIOR)) if solid > 0 else 0.0,
    )

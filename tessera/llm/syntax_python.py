"""Python 3.13: lexer with indentation and grammar."""

from __future__ import annotations

import re
from functools import lru_cache

from tessera.llm.grammar import Grammar
from tessera.llm.syntax_python_rules import Fault, Rules

# The reserved words, operators and string prefixes of the language.
KEYWORDS = frozenset(
    "False None True and as assert async await break class continue def del elif else except finally for from global if import in is lambda nonlocal not or pass raise return try while with yield".split()
)
# How deep brackets and indentation may nest.
MOST_BRACKETS, MOST_INDENTS = 200, 100
_PREFIX = r"(?:[rR][bB]?|[bB][rR]?|[uU])?"
_BODY = {'"': r'"(?:[^"\\\n]|\\(?:\r\n|.|\n))*"', "'": r"'(?:[^'\\\n]|\\(?:\r\n|.|\n))*'"}
_HOLE = r"\{(?:[^{}\n\"']|'[^'\n]*'|\"[^\"\n]*\"|\{[^{}\n]*\})*\}"
_STRINGS = "|".join(
    (
        r'(?:[rRbBuUfF]{0,2})"""(?:[^"\\]|\\[\s\S]|"(?!""))*"""',
        r"(?:[rRbBuUfF]{0,2})'''(?:[^'\\]|\\[\s\S]|'(?!''))*'''",
        rf'[rR]?[fF][rR]?(?!""")"(?:[^"\\\n{{]|\\.|\{{\{{|{_HOLE})*"',
        rf"[rR]?[fF][rR]?(?!''')'(?:[^'\\\n{{]|\\.|\{{\{{|{_HOLE})*'",
        rf"(?:{_PREFIX}|[fF][rR]?|[rR][fF])(?!{chr(34) * 3}|{chr(39) * 3})(?:{_BODY[chr(34)]}|{_BODY[chr(39)]})",
    )
)
_LEX = re.compile(
    r"(?:[ \t\f]+|\\\r?\n|#[^\r\n]*)*("
    r"(?:\r?\n[ \t\f]*(?:#[^\r\n]*)?(?=\r?\n|\Z))*\r?\n[ \t\f]*"
    rf"|{_STRINGS}"
    r"|(?:[A-Za-z_]|[^\x00-\x7f])(?:\w|[^\x00-\x7f])*"
    r"|0[xX](?:_?[0-9a-fA-F])+\b|0[oO](?:_?[0-7])+\b|0[bB](?:_?[01])+\b|(?:\d(?:_?\d)*\.?(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?[jJ]?"
    r"|\*\*=|//=|>>=|<<=|\.\.\.|:=|->|[-+*/%@&|^]=|//|\*\*|<<|>>|[<>=!]=|[-+*/%@&|^~<>=()\[\]{},:.;]"
    r"|\S)"
)
_KIND = {k: k for k in KEYWORDS} | {p: p for p in "( ) [ ] { } , : . ; = -> := ... * ** / @ ~".split()}
_KIND |= {p: "AUG" for p in "+= -= *= /= %= @= &= |= ^= **= //= >>= <<=".split()}
_KIND |= {p: "BIN" for p in "% & ^ // << >> | < > <= >= == !=".split()} | {"+": "ADD", "-": "ADD"}
_BAD_NUMBER = re.compile(r"0[\d_]*[1-9][\d_]*$")

GRAMMAR = """
hole: value ;
file: (NEWLINE | stmt)* ;
stmt: simple | compound ;
simple: small (';' small)* [';'] NEWLINE ;
small: exprs | 'del' starlist | 'pass' | 'break' | 'continue' | 'return' [starlist] | 'raise' [test ['from' test]]
     | 'global' NAME (',' NAME)* | 'nonlocal' NAME (',' NAME)* | 'assert' test [',' test] | imports | TYPE NAME [typarams] '=' test ;
exprs: value [':' test ['=' value] | AUG value | ('=' value)+] ;
value: 'yield' ['from' test | starlist] | starlist ;
starlist: star (',' (star))* [','] ;
star: '*' bin | named ;
imports: 'import' dotted ['as' NAME] (',' dotted ['as' NAME])* | 'from' (('.' | '...')+ [dotted] | dotted) 'import' ('*' | '(' names ')' | names) ;
names: NAME ['as' NAME] (',' (NAME ['as' NAME]))* [','] ;
dotted: NAME ('.' NAME)* ;
compound: 'if' named ':' suite ('elif' named ':' suite)* ['else' ':' suite] | 'while' named ':' suite ['else' ':' suite] | forstmt | withstmt
     | 'try' ':' suite (('except' [test ['as' NAME]] ':' suite)+ tryrest | ('except' '*' test ['as' NAME] ':' suite)+ tryrest | 'finally' ':' suite)
     | funcdef | classdef | ('@' named NEWLINE)+ (funcdef | classdef | 'async' funcdef) | 'async' (funcdef | forstmt | withstmt)
     | MATCH starlist ':' NEWLINE INDENT (CASE starpat ['if' named] ':' suite)+ DEDENT ;
tryrest: ['else' ':' suite] ['finally' ':' suite] ;
starpat: pat (',' (pat))* [','] ;
pat: '*' bin | or ['as' NAME] ;
forstmt: 'for' targets 'in' starlist ':' suite ['else' ':' suite] ;
targets: target (',' (target))* [','] ;
target: ['*'] unary ;
withstmt: 'with' witem (',' witem)* ':' suite ;
witem: test ['as' unary] ;
funcdef: 'def' NAME [typarams] '(' [params] ')' ['->' test] ':' suite ;
params: param (',' (param))* [','] ;
param: NAME [':' starann] ['=' test] | '*' [NAME [':' starann]] | '**' NAME [':' test] | '/' ;
starann: ['*'] test ;
typarams: '[' typaram (',' (typaram))* [','] ']' ;
typaram: ['*' | '**'] NAME [':' test] ['=' test] ;
classdef: 'class' NAME [typarams] ['(' [args] ')'] ':' suite ;
suite: simple | NEWLINE INDENT stmt+ DEDENT ;
named: test [':=' test] ;
test: 'lambda' [lparams] ':' test | or ['if' or 'else' test] ;
lparams: lparam (',' (lparam))* [','] ;
lparam: NAME ['=' test] | '*' [NAME] | '**' NAME | '/' ;
or: cmp (('and' | 'or') cmp)* ;
cmp: 'not' cmp | bin (('in' | 'not' 'in' | 'is' ['not']) bin)* ;
bin: unary ((BIN | ADD | '*' | '**' | '/' | '@') unary)* ;
unary: (ADD | '~') unary | ['await'] atom trailer* ;
trailer: '(' [args] ')' | '[' subs ']' | '.' NAME ;
subs: sub (',' (sub))* [','] ;
sub: '*' bin | named [':' [test] [':' [test]]] | ':' [test] [':' [test]] ;
args: arg (',' (arg))* [','] ;
arg: '*' test | '**' test | test ['=' pval | ':=' test | 'as' NAME] [comp] ;
pval: test ['as' NAME] ;
comp: ['async'] 'for' targets 'in' or ('if' cond | ['async'] 'for' targets 'in' or)* ;
cond: or [':=' or] ;
atom: NAME | NUMBER | STRING+ | '...' | 'None' | 'True' | 'False' | '(' ['yield' ['from' test | starlist] | group] ')' | '[' [group] ']' | '{' [braces] '}' ;
group: star [comp | 'as' unary (',' (star ['as' unary]))* [','] | (',' | (',' (star ['as' unary]))+ [','])] ;
braces: ('**' bin | star [':' pval]) [comp | (',' | (',' ('**' bin | star [':' pval]))+ [','])] ;
"""


@lru_cache(maxsize=1)
def grammar() -> Grammar:
    return Grammar(GRAMMAR, "file")


def tokens(text: str) -> tuple[list[str], list[int], list[str]]:
    """Terminal names and, for each, the line it lies on and its word. Faults of the lexer come as ERROR terminals."""
    if text.startswith("﻿"):
        text = text[1:]
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    out: list[str] = []
    lines: list[int] = []
    words: list[str] = []
    all_words: list[str] = []
    depth: list[str] = []
    levels = [(0, 0)]
    line = 1
    put, at_line, keep = out.append, lines.append, all_words.append

    def mark(at: int) -> None:
        at_line(at)
        keep("")

    start = True
    kind_of = _KIND.get
    for tok in _LEX.findall(f"\n{text}\n"):
        c = tok[0]
        if c == "\n":
            line += tok.count("\n")
            if depth:
                continue
            if out and out[-1] not in ("NEWLINE", "INDENT", "DEDENT"):
                _soft(out, words)
                put("NEWLINE")
                mark(line - 1)
            words.clear()
            ind = tok[tok.rfind("\n") + 1 :]
            col = len(ind) if "\t" not in ind and "\f" not in ind else _column(ind)
            alt = len(ind.rpartition("\f")[2])
            start = True
            pending = (col, alt)
            continue
        if start and not depth:
            start = False
            col, alt = pending
            top = levels[-1]
            if col > top[0]:
                put("INDENT" if alt > top[1] and len(levels) < MOST_INDENTS else "ERROR")
                mark(line - 1)
                levels.append(pending)
            else:
                while col < levels[-1][0]:
                    levels.pop()
                    put("DEDENT")
                    mark(line - 1)
                if levels[-1] != pending:
                    put("ERROR")
                    mark(line - 1)
        kind = kind_of(tok)
        if kind is None:
            if c.isalpha() or c == "_" or not c.isascii():
                kind = "STRING" if tok[-1] in "\"'" else "NAME" if tok.isascii() or tok.isidentifier() else "ERROR"
            elif c in "\"'":
                kind = "STRING" if len(tok) > 1 else "ERROR"
            elif c.isdigit() or c == "." and len(tok) > 1:
                kind = "ERROR" if _BAD_NUMBER.match(tok) else "NUMBER"
            else:
                kind = "ERROR"
            line += tok.count("\n") if kind == "STRING" else 0
        elif c in "([{":
            depth.append(")]}"["([{".index(c)])
            if len(depth) > MOST_BRACKETS:
                kind = "ERROR"
        elif c in ")]}":
            if not depth or depth.pop() != c:
                kind = "ERROR"
        put(kind)
        at_line(line - 1)
        keep(tok)
        if not words or len(words) < 3:
            words.append(tok)
    if out and out[-1] not in ("NEWLINE", "DEDENT"):
        _soft(out, words)
        put("NEWLINE")
        mark(line)
    if depth:
        put("ERROR")
        mark(line)
    for _ in levels[1:]:
        put("DEDENT")
        mark(line)
    return out, lines, all_words


def _column(indent: str) -> int:
    n = 0
    for c in indent:
        n = 0 if c == "\f" else n + 1 if c == " " else (n // 8 + 1) * 8
    return n


def _soft(out: list[str], words: list[str]) -> None:
    """Turn a leading match, case or type into a keyword where its line reads like such a statement."""
    if not words or words[0] not in ("match", "case", "type") or len(words) < 2:
        return
    n = len(out)
    i = n - 1
    while i >= 0 and out[i] not in ("NEWLINE", "INDENT", "DEDENT"):
        i -= 1
    i += 1
    if out[i] != "NAME" or i + 1 >= n:
        return
    if words[0] == "type":
        if out[i + 1] == "NAME":
            out[i] = "TYPE"
    elif out[n - 1] == ":" or words[0] == "case":
        if words[1] not in ("=", ".", ",", ")", ":", "+=") and not (words[1] in ("(", "[") and out[n - 1] != ":" and not (words[0] == "case" and "MATCH" in out and _inline_case(out, i))):
            out[i] = words[0].upper()


def _inline_case(out: list[str], i: int) -> bool:
    """Whether a colon outside brackets follows the word at ``i`` on its line."""
    depth = 0
    for t in out[i + 1 :]:
        depth += (t in "([{") - (t in ")]}") if t else 0
        if t == ":" and not depth:
            return True
    return False


def check(text: str) -> int | None:
    """Line of the first error, None if there is none."""
    if "\0" in text:
        return text.count("\n", 0, text.index("\0")) + 1
    toks, lines, words = tokens(text)
    at = grammar().parse(toks)
    if at < 0:
        fault = Rules(toks, words, _hole_parses).run()
        if fault is None:
            return None
        at = fault
    return min(max(1, lines[min(at, len(lines) - 1)]), text.count("\n") + 1) if lines else 1


def _hole_parses(text: str) -> bool:
    """Whether the expression of an f-string's replacement field is valid."""
    toks, _, words = tokens(f"({text}\n)")
    inner, kept = toks[1:-2], words[1:-2]
    if toks[:1] != ["("] or toks[-2:] != [")", "NEWLINE"] or grammar().parse(inner, "hole") >= 0:
        return False
    rules = Rules([*inner, "NEWLINE"], [*kept, ""], _hole_parses)
    try:
        rules.value(0, len(inner))
        for i in rules.match:
            rules.bracket(i, False, False, False)
        for i, t in enumerate(inner):
            if t == "STRING":
                rules.string(i, kept[i])
    except Fault:
        return False
    return True

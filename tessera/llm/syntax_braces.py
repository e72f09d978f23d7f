"""JavaScript modules, TypeScript, Go and Java: lexers and grammars."""

from __future__ import annotations

import re
from functools import lru_cache

from tessera.llm.grammar import Grammar
from tessera.llm.syntax_script_rules import java_fault, script_fault

_SPACE = r"(?:[ \t\f\v\r ﻿]+|//[^\n]*|/\*[^*]*\*+(?:[^/*][^*]*\*+)*/)*"
_DQ = r'"(?:[^"\\\n]|\\[\s\S])*"'
_SQ = r"'(?:[^'\\\n]|\\[\s\S])*'"
_TPL = r"`(?:[^`\\$]|\\[\s\S]|\$(?!\{)|\$\{(?:[^{}`\"']|" + _DQ + "|" + _SQ + r"|`[^`]*`|\{(?:[^{}]|\{[^{}]*\})*\})*\})*`"
_NUM = r"0[xX][0-9a-fA-F_]+[nNlL]?|0[bB][01_]+[nNlL]?|0[oO][0-7_]+n?|(?:\d[\d_]*(?:\.(?!\.)[\d_]*)?|\.\d[\d_]*)(?:[eE][+-]?[\d_]+)?[nlLfFdDi]?"
_REGEX = r"/(?![*/])(?:[^/\\\n\[]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[A-Za-z]*"


def _groups(spec: dict[str, str]) -> dict[str, str]:
    return {p: k for k, ps in spec.items() for p in ps.split()}


# ---- JavaScript and TypeScript

# Reserved words and punctuators.
JS_WORDS = frozenset(
    "await break case catch class const continue debugger default delete do else enum export extends false finally for function if import in instanceof new null return super switch this throw true try typeof var void while with yield".split()
)
JS_SOFT = frozenset("async of get set static let from as".split())
TS_SOFT = frozenset("type interface namespace module declare abstract readonly public private protected override keyof infer is asserts satisfies unique accessor global out".split())
_JS_PUNCT = ">>>= ... === !== **= <<= >>= >>> &&= ||= ??= => == != <= >= && || ?? ?. ++ -- += -= *= /= %= &= |= ^= << >> ** { } ( ) [ ] ; , < > + - * / % & | ^ ! ~ ? : = . @"
_JS_LEX = re.compile(
    _SPACE + r"((?:\r?\n[ \t\r]*)+|" + "|".join((_DQ, _SQ, _TPL, r"[$_#A-Za-zª-￿][$\w‌‍]*", _NUM)) + "|" + "|".join(map(re.escape, _JS_PUNCT.split())) + r"|\S)"
)
_JS_SLOW = re.compile(_SPACE + "(" + _REGEX + ")")
_JS_KIND = {w: w for w in JS_WORDS | JS_SOFT} | _groups(
    {
        "BIN": "=== !== == != <= >= && || ?? << >> >>> ** / % & ^",
        "ASG": ">>>= **= <<= >>= &&= ||= ??= += -= *= /= %= &= |= ^=",
        "INC": "++ --",
        "ADD": "+ -",
        "UN": "! ~",
    }
)
_JS_KIND |= {p: p for p in "... => ?. { } ( ) [ ] ; , < > * | ? : = . @ instanceof in".split()}

_JS_COMMON = """
module: item* ;
block: '{' item* '}' ;
var: ('var' | 'const' | 'let') decl (',' decl)* ;
export: 'export' ('default' (function | class | 'async' asyncrest ';' | assign ';') | '*' ['as' propname] 'from' STR [with] ';' | '{' [spec (',' (spec))* [',']] '}' ['from' STR [with]] ';' | EXPORTED) ;
spec: (ident | 'default' | STR) ['as' (ident | 'default' | STR)] ;
with: 'with' object ;
imports: 'import' ( '(' assign ')' post* exprtail | '.' ident post* exprtail | STR [with] | clause 'from' STR [with] | IMPORTED) ';' ;
clause: ident [',' (named | '*' 'as' ident)] | named | '*' 'as' ident ;
named: '{' [spec (',' (spec))* [',']] '}' ;
exprtail: (binop unary)* [ASG assign | '=' assign] ;
ident: ID | LABEL | 'async' | 'of' | 'get' | 'set' | 'static' | 'from' | 'as' | SOFT ;
propname: ident | KEY | STR | NUM | 'let' ;
if: 'if' '(' expr ')' stmt ['else' stmt] ;
for: 'for' ['await'] '(' [forinit] [('of' | 'in') expr | ';' [expr] ';' [expr]] ')' stmt ;
forinit: ('var' | 'const' | 'let') fordecl (',' fordecl)* | expr ;
switch: 'switch' '(' expr ')' '{' (('case' expr | 'default') ':' item*)* '}' ;
try: 'try' block ('catch' ['(' binding ')'] block ['finally' block] | 'finally' block) ;
expr: assign (',' assign)* ;
assign: cond [ASG assign | '=' assign] | 'yield' [['*'] assign] ;
cond: unary (binop unary)* ['?' assign ':' assign] ;
binop: BIN | ADD | '*' | '<' | '>' | '|' | 'in' | 'instanceof' ;
unary: (ADD | UN | INC | 'typeof' | 'void' | 'delete' | 'await') unary | primary post* [INC] ;
post: '.' name | '?.' (name | '[' expr ']' | args) | '[' expr ']' | args ['=>' body] | TPL ;
name: ident | KEY | 'let' | PRIV ;
args: '(' [arg (',' (arg))* [',']] ')' ;
primary: 'this' | 'super' | 'null' | 'true' | 'false' | NUM | STR | TPL | REGEX | PRIV | array | object | function | class | paren | ident ['=>' body] | 'let' | 'async' asyncrest
     | 'new' ['.' ident | newtarget] | 'import' ('(' assign [',' assign] [','] ')' | '.' ident) ;
newtarget: 'new' newtarget | ('this' | 'super' | function | class | paren | ident | array | object) ('.' name | '[' expr ']' | TPL)* [args] ;
asyncrest: ['function' ['*'] [ident] funcrest | ident '=>' body | paren] ;
body: block | assign ;
array: '[' ','* [elem (',' [elem])*] ']' ;
elem: '...' assign | assign ;
object: '{' [prop (',' (prop))* [',']] '}' ;
function: 'function' ['*'] [ident] funcrest ;
"""

JS_GRAMMAR = (
    _JS_COMMON
    + """
item: export | imports | stmt ;
stmt: block | var ';' | function | class | if | for | switch | try | ';' | LABEL ':' stmt | 'do' stmt 'while' '(' expr ')' [';'] | 'while' '(' expr ')' stmt
     | ('break' | 'continue') [ident] ';' | 'return' [expr] ';' | 'throw' expr ';' | 'debugger' ';' | expr ';' ;
decl: binding ['=' assign] ;
fordecl: binding ['=' cond] ;
binding: ident | array | object ;
arg: '...' assign | assign ;
paren: '(' [pelem (',' (pelem))* [',']] ')' ['=>' body] ;
pelem: '...' assign | assign ;
prop: '...' assign | 'get' [propfn | proprest] | 'set' [propfn | proprest] | 'async' [['*'] propfn | proprest] | '*' propfn | (ID | LABEL | 'of' | 'static' | 'from' | 'as' | SOFT | KEY | STR | NUM | 'let' | PRIV) [proprest] | '[' assign ']' proprest ;
propfn: (propname | '[' assign ']' | PRIV) params block ;
proprest: ':' assign | '=' assign | params block ;
params: '(' [pelem (',' (pelem))* [',']] ')' ;
funcrest: params block ;
class: ('@' unary)* 'class' [ident] ['extends' unary] '{' member* '}' ;
member: ';' | ('@' unary)* ( 'static' [block | mkey | mrest] | mkey ) ;
mkey: ('get' | 'set' | 'async') [['*'] mname mrest | mrest] | ['*'] mname2 [mrest | ';'] ;
mname: propname | '[' assign ']' | PRIV ;
mname2: ID | LABEL | 'of' | 'from' | 'as' | SOFT | KEY | STR | NUM | 'let' | PRIV | '[' assign ']' ;
mrest: params block | '=' assign ';' | ';' ;
"""
).replace("| EXPORTED", "| var ';' | function | class | 'async' 'function' ['*'] ident funcrest").replace("| IMPORTED", "")

TS_GRAMMAR = (
    _JS_COMMON.replace("spec: (ident | 'default' | STR)", "spec: (ident | 'default' | STR) [ident | 'default']")
    .replace("('var' | 'const' | 'let') decl (',' decl)* ;", "('var' | 'const' | 'let') (enum | decl (',' decl)*) ;")
    .replace("clause 'from' STR [with]", "clause ('from' STR [with] | '=' assign)")
    .replace("assign ';') | '*'", "tsdecl | assign ';') | [TYPEONLY] '*'")
    .replace("| '{' [spec (',' (spec))* [',']] '}' ['from' STR [with]] ';'", "| [TYPEONLY] '{' [spec (',' (spec))* [',']] '}' ['from' STR [with]] ';'")
    + """
item: export | imports | stmt ;
stmt: block | var ';' | function | class | if | for | switch | try | ';' | LABEL ':' stmt | 'do' stmt 'while' '(' expr ')' [';'] | 'while' '(' expr ')' stmt
     | ('break' | 'continue') [ident] ';' | 'return' [expr] ';' | 'throw' expr ';' | 'debugger' ';' | expr ';' | tsdecl ;
tsdecl: TYPEDEF ident '=' type ';' | INTERFACE ident ['extends' type (',' type)*] objtype | NAMESPACE [ident ('.' ident)* | STR] [block] [';'] | DECLARE (tsdecl | var ';' | function | class | item) | enum | ABSTRACT class ;
enum: 'enum' ident '{' [emember (',' (emember))* [',']] '}' ;
emember: (ident | KEY | STR | 'let' | '[' STR ']') ['=' assign] ;
decl: binding [DEF] [':' type] ['=' assign] ;
fordecl: binding [':' type] ['=' cond] ;
binding: ident | array | object ;
arg: '...' assign | assign ;
paren: '(' [pelem (',' (pelem))* [',']] ')' [RET type] ['=>' body] ;
pelem: ('@' unary)* ['...'] [ACCESS+] ('this' ':' type | assign [OPT] [':' type] ['=' assign]) ;
prop: '...' assign | 'get' [propfn | proprest] | 'set' [propfn | proprest] | 'async' [['*'] propfn | proprest] | '*' propfn | (ID | LABEL | 'of' | 'static' | 'from' | 'as' | SOFT | KEY | STR | NUM | 'let' | PRIV) [proprest] | '[' assign ']' proprest ;
propfn: (propname | '[' assign ']' | PRIV) params [rtype] block ;
proprest: ':' assign | '=' assign | params [rtype] block ;
rtype: (':' | RET) type ;
params: '(' [pelem (',' (pelem))* [',']] ')' ;
funcrest: params [rtype] (block | ';') ;
class: ('@' unary)* ['abstract'] 'class' [ident] ['extends' unary] [IMPLEMENTS type (',' type)*] '{' member* '}' ;
member: ';' | ('@' unary)* (ACCESS | DECLARE)* ( 'static' [block | ACCESS+ mkey | mkey | mrest] | mkey ) ;
mkey: ('get' | 'set' | 'async') [['*'] mname mrest | mrest] | ['*'] mname2 [mrest] ;
mname: propname | '[' assign ']' | PRIV ;
mname2: ID | LABEL | 'of' | 'from' | 'as' | SOFT | KEY | STR | NUM | 'let' | PRIV | '[' assign [':' type] ']' ;
mrest: [OPT | DEF] (params [rtype] (block | ';') | [':' type] ['=' assign] ';') ;
type: ['|' | BIN] tunary (('|' | BIN) tunary)* ['extends' type '?' type ':' type] ;
tunary: (TYPEOP | ACCESS | 'typeof') tunary | tprimary ('[' [type] ']')* ;
tprimary: ('this' | ident ('.' name)*) [IS type] | 'void' | 'null' | 'true' | 'false' | STR | ADD NUM | NUM | TPL | 'import' '(' STR ')' ('.' ident)* | objtype | '[' [telem (',' (telem))* [',']] ']' | tparen | 'new' tparen ;
telem: ['...'] type [OPT | '?'] [':' type] ;
tparen: '(' [pelemt (',' (pelemt))* [',']] ')' ['=>' type] ;
pelemt: ['...'] type [OPT] [':' type] ;
objtype: '{' [tmember (sep [tmember])*] '}' ;
sep: ';' | ',' ;
tmember: (ADD | ACCESS | 'get' | 'set')* (propname [OPT] | '[' type [':' type | 'in' type ['as' type]] ']' [ADD] [OPT] | 'new' | params0) [params] [rtype] ;
params0: '(' [pelem (',' (pelem))* [',']] ')' ;
"""
).replace("| EXPORTED", "| var ';' | function | class | 'async' 'function' ['*'] ident funcrest | tsdecl | '=' assign ';'").replace("| IMPORTED", "| TYPEONLY clause 'from' STR")


def _js_words(text: str) -> list[str]:
    toks = _JS_LEX.findall(text)
    if "/" not in toks and "/=" not in toks:
        return toks
    out: list[str] = []
    at, n, prev, before = 0, len(text), "", ""
    heads: list[bool] = []  # of each open parenthesis, whether a statement follows it
    headed = False
    while at < n:
        if prev in _BEFORE_REGEX or headed and prev == ")":
            m = _JS_SLOW.match(text, at)
            if m:
                out.append(m.group(1))
                before, prev, at = prev, m.group(1), m.end()
                continue
        m = _JS_LEX.match(text, at)
        if not m:
            break
        out.append(m.group(1))
        w = m.group(1)
        if w[0] not in "\r\n":
            if w == "(":
                heads.append(prev in ("if", "while", "for", "with") and before != "." or prev == "await" and before == "for")
            elif w == ")" and heads:
                headed = heads.pop()
            before, prev = prev, w
        at = m.end()
    return out


_BEFORE_REGEX = frozenset("( , = : [ ! & | ? { } ; + - * % ~ ^ < > => && || ?? == === != !== += return typeof case in of delete void throw new do else instanceof await yield".split()) | {""}
#: Reserved words that are read as a method's name before a parenthesis.
_METHOD_WORDS = frozenset("delete catch finally default in instanceof enum extends const case continue break".split())


def _js_kinds(words: list[str], ts: bool) -> list[str]:
    """Terminal names; newlines stay as a newline terminal."""
    out: list[str] = []
    get = _JS_KIND.get
    prev = ""
    n = len(words)
    for i, w in enumerate(words):
        k = get(w)
        c = w[0]
        if k is None:
            if c in "\r\n":
                out.append("\n")
                continue
            if c.isalpha() or c in "_$":
                k = "SOFT" if ts and w in TS_SOFT else "ID"
            elif c.isdigit() or c == "." and len(w) > 1:
                k = "NUM" if not (len(w) > 1 and c == "0" and w[1].isdigit()) else "ERROR"
            elif c in "\"'":
                k = "STR" if len(w) > 1 else "ERROR"
            elif c == "`":
                k = "TPL" if len(w) > 1 else "ERROR"
            elif c == "/" and len(w) > 1:
                k = "REGEX"
            elif c == "#" and len(w) > 1:
                k = "PRIV"
            else:
                k = "ERROR"
        if k in ("ID", "async", "of", "from", "as", "SOFT", "static", "get", "set") or c.isalpha() and k in JS_WORDS:
            nxt = words[i + 1] if i + 1 < n else ""
            if k in JS_WORDS:
                if prev in (".", "?.") or nxt == "(" and prev in ("{", ",", "}", ";") and k in _METHOD_WORDS and not (k in ("catch", "finally") and prev == "}") or nxt == ":" and prev in ("{", ",", ";") and k not in ("default", "this", "null", "true", "false"):
                    k = "KEY"
            elif nxt == ":" and k == "ID":
                k = "LABEL"
        out.append(k)
        prev = w
    return out


_TS_TYPE_WORDS = JS_WORDS - frozenset("break case catch class const continue debugger default delete do else export finally for function if return switch throw try var while with yield await".split()) | {"const"}
_TS_AFTER = frozenset("( ) , ; { } [ ] = > | & . ? ?. => : ! ` && || ?? == === != !== + ... extends implements instanceof as from in of".split())
_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}", "<": ">"}, frozenset(")]}>")
_TS_INSIDE_PUNCT = frozenset(". , | & [ ] { } ( ) : ; ? => < > = ... - + @ * ?.".split())


def _type_arguments(words: list[str], i: int, inside: frozenset[str], word_ok) -> int:
    """Index after the ``>`` that closes the type arguments opened at ``i``, or 0 if these are none."""
    stack = [">"]
    j = i + 1
    n = len(words)
    while j < n:
        w = words[j]
        c = w[0]
        if w == "<" or w in "([{":
            stack.append(_OPEN[w])
        elif w in (">", ">>", ">>>"):
            for _ in w:
                if not stack or stack[-1] != ">":
                    return 0
                stack.pop()
                if not stack:
                    return j + 1 if _ == ">" and w == ">" or len(w) > 1 else 0
        elif w in _CLOSE:
            if not stack or stack.pop() != w:
                return 0
        elif w == ";" and (stack[-1] != "}"):
            return 0
        elif not (w in inside or word_ok(w) or c in "\r\n\"'`" or c.isdigit()):
            return 0
        j += 1
    return 0


def _strip_types(words: list[str]) -> list[str]:
    """Words of a TypeScript text without type arguments and parameters; marks what only a look ahead can tell."""
    out: list[str] = []
    i, n = 0, len(words)
    ok = lambda w: (w[0].isalpha() or w[0] in "_$") and (w not in JS_WORDS or w in _TS_TYPE_WORDS or w in ("const", "in"))
    while i < n:
        w = words[i]
        if w == "<":
            prev = next((x for x in reversed(out) if x[0] not in "\r\n"), "")
            named = prev and (prev[0].isalpha() or prev[0] in "_$" or prev == "?.")
            j = _type_arguments(words, i, _TS_INSIDE_PUNCT, ok)
            if j:
                k = j
                while k < n and words[k][0] in "\r\n":
                    k += 1
                nxt = words[k] if k < n else ""
                if (named and (not nxt or nxt in _TS_AFTER or nxt[0] == "`" or k > j)) or (not named and (nxt == "(" or nxt and (nxt[0].isalpha() or nxt[0] in "_${["))):
                    i = j
                    continue
        out.append(w)
        i += 1
    return out


def _ts_kinds(words: list[str]) -> tuple[list[str], list[str]]:
    """Terminal names, and the words they stand for: type arguments and non-null marks are left out."""
    words = _strip_types(words)
    kinds = _js_kinds(words, True)
    solid = [i for i, k in enumerate(kinds) if k != "\n"]
    at = {i: p for p, i in enumerate(solid)}
    depth: list[tuple[int, int]] = []
    opener: dict[int, int] = {}
    closer: dict[int, int] = {}
    for p, i in enumerate(solid):
        w = words[i]
        if w in ("(", "[", "{"):
            depth.append((i, p))
        elif w in (")", "]", "}") and depth:
            opener[i], q = depth.pop()
            closer[q] = p

    def word(i: int, d: int) -> str:
        p = at[i] + d
        return words[solid[p]] if 0 <= p < len(solid) else ""

    def fresh(i: int) -> bool:
        p = at[i]
        return p == 0 or i - solid[p - 1] > 1 or words[solid[p - 1]] in (";", "{", "}", ")", "export", "declare", "default", "abstract", ":")

    for i in solid:
        k, w = kinds[i], words[i]
        if w == "?":
            if word(i, 1) in (":", ",", ")", "]", ";", "}"):
                kinds[i] = "OPT"
            elif word(i, 1) == "(" and word(i, -2) in ("{", "}", ";", ",", "async", "public", "private", "protected", "abstract", "static") and _closes_to_type(words, solid, closer, at[i] + 1):
                kinds[i] = "OPT"
        elif w == "!" and (word(i, 1) in (":",) or word(i, -1) and (word(i, -1)[0].isalnum() or word(i, -1)[0] in "_$" or word(i, -1) in (")", "]")) and word(i, 1) not in ("(",) and i and not (i - solid[at[i] - 1] > 1)):
            kinds[i] = "DEF" if word(i, 1) == ":" else "\n!"
        elif w == ":" and word(i, -1) == ")":
            if _arrow_return(words, solid, closer, at[i] + 1) and word(opener.get(solid[at[i] - 1], i), -1) != "?":
                kinds[i] = "RET"
        elif k in ("SOFT", "LABEL", "ID", "as", "static") or w in ("abstract", "implements", "enum"):
            nxt = word(i, 1)
            named = nxt[:1].isalpha() or nxt[:1] in ("_", "$")
            if w == "type" and named and word(i, 2) == "=" and fresh(i):
                kinds[i] = "TYPEDEF"
            elif w == "type" and word(i, -1) in ("import", "export") and nxt != "from" and nxt != ",":
                kinds[i] = "TYPEONLY"
            elif w == "interface" and named and fresh(i):
                kinds[i] = "INTERFACE"
            elif w in ("namespace", "module", "global") and (named or nxt[:1] in "\"'" and nxt or nxt == "{" and w == "global") and fresh(i):
                kinds[i] = "NAMESPACE"
            elif w == "declare" and named and fresh(i):
                kinds[i] = "DECLARE"
            elif w == "abstract" and nxt == "class":
                kinds[i] = "ABSTRACT"
            elif w == "implements" and named:
                kinds[i] = "IMPLEMENTS"
            elif w in ("public", "private", "protected", "readonly", "override", "abstract", "declare", "accessor") and (named or nxt in ("[", "{", "*", "...") or nxt[:1] in ("#", "'", '"')) and nxt not in ("in", "of", "instanceof", "as"):
                kinds[i] = "ACCESS"
            elif w in ("keyof", "infer", "unique", "readonly") and (named or nxt in ("(", "[", "{")):
                kinds[i] = "TYPEOP"
            elif w == "asserts" and named:
                kinds[i] = "TYPEOP"
            elif w == "is" and word(i, -1)[:1].isalpha() and (named or nxt in ("{", "[", "(")):
                kinds[i] = "IS"
            elif w in ("as", "satisfies") and word(i, -1) and (word(i, -1) in (")", "]", "}") or word(i, -1)[0].isalnum() or word(i, -1)[0] in "_$\"'`") and (named or nxt in ("{", "[", "(") or nxt[:1] in ("'", '"')) and word(i, -1) not in ("*", "{", ",", "import", "return"):
                if not _in_spec(words, solid, at[i]):
                    kinds[i] = "CAST"
    kept = [i for i, k in enumerate(kinds) if k != "\n!"]
    return [kinds[i] for i in kept], [words[i] for i in kept]


def _in_spec(words: list[str], solid: list[int], p: int) -> bool:
    """Whether the word at ``p`` lies in the braces of an import or export list."""
    q = p
    while q >= 0 and words[solid[q]] not in ("{", "}", ";", "(", ")"):
        q -= 1
    return q >= 1 and words[solid[q]] == "{" and words[solid[q - 1]] in ("import", "export", "type", ",")


def _closes_to_type(words: list[str], solid: list[int], closer: dict[int, int], p: int) -> bool:
    """Whether the parenthesis at ``p`` closes before a colon or brace, as of an optional method."""
    q = closer.get(p, len(solid))
    return q + 1 < len(solid) and words[solid[q + 1]] in (":", "{", ";")


def _arrow_return(words: list[str], solid: list[int], closer: dict[int, int], p: int) -> bool:
    """Whether a type that ends in ``=>`` begins at ``p``."""
    q, n = p, len(solid)
    while q < n:
        w = words[solid[q]]
        if w == "=>":
            return words[solid[q - 1]] != ")" or q + 1 < n
        if w in ("(", "[", "{"):
            if w == "{" and q > p and words[solid[q - 1]] not in ("|", "&") or q not in closer:
                return False
            q = closer[q]
        elif not (w[0].isalnum() or w[0] in "_$\"'`" or w in (".", "|", "&")) or w in ("return", "const", "if"):
            return False
        q += 1
    return False


@lru_cache(maxsize=1)
def js_grammar() -> Grammar:
    return Grammar(JS_GRAMMAR, "module")


@lru_cache(maxsize=1)
def ts_grammar() -> Grammar:
    text = TS_GRAMMAR.replace("cond: unary (binop unary)*", "cond: unary (binop unary | CAST casttype)*").replace("exprtail: (binop unary)*", "exprtail: (binop unary | CAST casttype)*")
    return Grammar(text + "casttype: 'const' | tunary ;\n", "module")


def _line(words: list[str], at: int) -> int:
    """Line of the token at ``at``: newlines stand in the words, strings and templates may hold some."""
    return 1 + sum(w.count("\n") for w in words[: at + 1] if w[0] in "\r\n`\"'")


def _holes(words: list[str]):
    """Expressions of template literals."""
    for i, w in enumerate(words):
        if w[0] == "`" and "${" in w:
            at = 0
            while (s := w.find("${", at)) >= 0:
                if s and w[s - 1] == "\\":
                    at = s + 2
                    continue
                d, e = 1, s + 2
                while e < len(w) and d:
                    d += (w[e] == "{") - (w[e] == "}")
                    e += 1
                yield i, w[s + 2 : e - 1]
                at = e


def _check_script(text: str, g: Grammar, ts: bool) -> int | None:
    if text.startswith("#!"):
        text = "//" + text[2:]
    words = _js_words(text + "\n")
    if ts:
        kinds, words = _ts_kinds(words)
    else:
        kinds = _js_kinds(words, False)
    at = g.parse_inserting(kinds, "\n", ";", "}", "INC")
    if at >= 0:
        return _line(words, min(at, len(words) - 1))
    solid = [i for i, k in enumerate(kinds) if k != "\n"]
    fresh = {n for n, i in enumerate(solid) if i and kinds[i - 1] == "\n"}
    fault = script_fault([kinds[i] for i in solid], [words[i] for i in solid], fresh, ts)
    if fault is not None:
        return _line(words, solid[fault])
    for i, hole in _holes(words):
        sub = _js_words(hole)
        kinds = [k for k in (_ts_kinds(sub)[0] if ts else _js_kinds(sub, False)) if k != "\n"]
        if g.parse(kinds, "expr") >= 0:
            return _line(words, i)
    return None


def check_js(text: str) -> int | None:
    """Line of the first error of an ES module, None if there is none."""
    return _check_script(text, js_grammar(), False)


def check_ts(text: str) -> int | None:
    """Line of the first error of a TypeScript file, None if there is none."""
    return _check_script(text, ts_grammar(), True)


# ---- Go

# Reserved words and operators.
GO_WORDS = frozenset("break case chan const continue default defer else fallthrough for func go goto if import interface map package range return select struct switch type var".split())
_GO_PUNCT = "<<= >>= &^= ... && || <- ++ -- == != <= >= := += -= *= /= %= &= |= ^= << >> &^ + - * / % & | ^ < > = ! ( ) [ ] { } , ; . : ~"
_GO_LEX = re.compile(_SPACE + r"((?:\r?\n[ \t\r]*)+|" + r"`[^`]*`|" + _DQ + r"|'(?:[^'\\\n]|\\.)+'|[^\W\d]\w*|" + _NUM + "|" + "|".join(map(re.escape, _GO_PUNCT.split())) + r"|\S)")
_GO_KIND = {w: w for w in GO_WORDS} | _groups({"BIN": "&& || == != <= >= << >> &^ / % | < >", "ASG": "+= -= *= /= %= &= |= ^= <<= >>= &^=", "INC": "++ --", "UN": "+ - ^ & !"})
_GO_KIND |= {p: p for p in "... <- := * = ( ) [ ] { } , ; . : ~".split()}
_GO_ENDS = frozenset("ID NUM STR break continue fallthrough return INC ) ] }".split())

_GO_EXPR = """
expr{X}: unary{X} ((BIN | UN | '*' | '<-') unary{X})* ;
unary{X}: (UN | '*' | '<-' | '~') unary{X} | operand{X} post{X}* ;
post{X}: '.' (ID | '(' ('type' | type) ')') | '[' index ']' | '(' [arg (',' (arg))* [',']] ')' {LIT};
operand{X}: ID | NUM | STR | '(' expr ')' | 'func' sig [block] | arraytype {TLIT} | 'struct' fields {TLIT} | 'map' '[' type ']' type0 {TLIT} | 'chan' ['<-'] type0 | 'interface' imembers ;
exprs{X}: expr{X} (',' expr{X})* ;
simple{X}: exprs{X} [(':=' | '=') ('range' expr{X} | exprs{X}) | ASG expr{X} | INC] | 'range' expr{X} ;
"""

GO_GRAMMAR = (
    """
file: 'package' ID ';' ('import' (ispec | '(' [ispec (';' [ispec])*] ')') ';')* (top ';')* ;
ispec: ['.' | ID] STR ;
top: 'func' ['(' [param (',' (param))* [',']] ')'] ID [tparams] sig [block] | decl ;
decl: ('var' | 'const') (vspec | '(' [vspec (';' [vspec])*] ')') | 'type' (tspec | '(' [tspec (';' [tspec])*] ')') ;
vspec: ID (',' ID)* [type] ['=' exprs] ;
tspec: ID [tparams] ['='] type ;
tparams: '[' [tpar (',' (tpar))* [',']] ']' ;
tpar: expr [constraint] ;
constraint: cterm (BIN cterm)* ;
cterm: ['~'] type ;
sig: '(' [param (',' (param))* [',']] ')' [type | '(' [param (',' (param))* [',']] ')'] ;
param: '...' type | type ['...'] [type] ;
type: ID ['.' ID] ['[' ['...' | expr (',' expr)*] ']' [type]] | type0x ;
type0: type ;
type0x: '*' type | arraytype | 'map' '[' type ']' type | 'chan' ['<-'] type | '<-' 'chan' type | 'func' sig | 'struct' fields | 'interface' imembers | '(' type ')' ;
arraytype: '[' ['...' | expr] ']' type ;
fields: '{' [field (';' [field])*] '}' ;
field: (ID [(',' ID)* type | '.' ID] | '*' type) [STR] ;
imembers: '{' [imember (';' [imember])*] '}' ;
imember: cunion [sig] ;
cunion: cterm (BIN cterm)* ;
block: '{' [stmt] (';' [stmt])* '}' ;
stmt: decl | simple [':' [stmt]] | ('go' | 'defer') expr | 'return' [exprs] | ('break' | 'continue') [ID] | 'goto' ID | 'fallthrough' | block | ifstmt | 'for' [forhead] block | 'switch' [ifhead] '{' (('case' exprs | 'default') ':' [stmt] (';' [stmt])*)* '}'
     | 'select' '{' (('case' simple | 'default') ':' [stmt] (';' [stmt])*)* '}' ;
ifstmt: 'if' ifhead block ['else' (ifstmt | block)] ;
ifhead: simpleNB [';' [simpleNB]] | ';' [simpleNB] ;
forhead: simpleNB [';' [simpleNB] ';' [simpleNB]] | ';' [simpleNB] ';' [simpleNB] ;
index: [ixval] [':' [expr] [':' [expr]]] (',' (type))* [','] ;
ixval: expr ;
arg: expr ['...'] ;
lit: '{' [elem (',' (elem))* [',']] '}' ;
elem: (lit | expr) [':' (lit | expr)] ;
"""
    + _GO_EXPR.replace("{X}", "").replace("{LIT}", "| lit ").replace("{TLIT}", "[lit]")
    + _GO_EXPR.replace("{X}", "NB").replace("{LIT}", "").replace("{TLIT}", "[lit]")
)


@lru_cache(maxsize=1)
def go_grammar() -> Grammar:
    return Grammar(GO_GRAMMAR, "file")


def check_go(text: str) -> int | None:
    """Line of the first error of a Go file, None if there is none."""
    words = _GO_LEX.findall(text.removeprefix("﻿") + "\n")
    kinds: list[str] = []
    where: list[int] = []
    get, prev = _GO_KIND.get, ""
    for i, w in enumerate(words):
        k = get(w)
        if k is None:
            c = w[0]
            if c in "\r\n":
                if prev not in _GO_ENDS:
                    continue
                k = ";"
            elif c.isalpha() or c == "_":
                k = "ID"
            elif c.isdigit() or c == "." and len(w) > 1:
                k = "NUM"
            else:
                k = "STR" if c in "\"'`" and len(w) > 1 else "ERROR"
        kinds.append(k)
        where.append(i)
        prev = k
    at = go_grammar().parse(kinds)
    if at < 0:
        return None
    return _line(words, where[min(at, len(where) - 1)]) if where else 1


# ---- Java

# Reserved words and operators.
JAVA_WORDS = frozenset(
    "abstract assert boolean break byte case catch char class continue default do double else enum extends final finally float for if implements import instanceof int interface long native new null package private protected public return short static strictfp super switch synchronized this throw throws transient try void volatile while true false goto const".split()
)
_JAVA_PUNCT = ">>>= <<= >>= >>> ... -> :: ++ -- && || == != <= >= += -= *= /= %= &= |= ^= << >> + - * / % & | ^ ! ~ ? : = < > ( ) [ ] { } ; , . @"
_JAVA_LEX = re.compile(_SPACE + r"(\n[ \t\r\n]*|" + r'"""[ \t]*\r?\n(?:[^"\\]|\\[\s\S]|"(?!""))*"""|' + _DQ + r"|'(?:[^'\\\n]|\\u+[0-9a-fA-F]{4}|\\[0-7]{1,3}|\\.)'|non-sealed\b|[$_A-Za-zª-￿][$\w]*|" + _NUM + "|" + "|".join(map(re.escape, _JAVA_PUNCT.split())) + r"|\S)")
_JAVA_KIND = {w: w for w in JAVA_WORDS - {"goto", "const"}}
_JAVA_KIND |= dict.fromkeys("boolean byte char double float int long short void".split(), "PRIM")
_JAVA_KIND |= dict.fromkeys("abstract final native non-sealed private protected public strictfp transient volatile".split(), "MOD")
_JAVA_KIND |= _groups({"BIN": "&& || == != <= >= << >> >>> * / % & | ^ < >", "ASG": ">>>= <<= >>= += -= *= /= %= &= |= ^=", "INC": "++ --", "ADD": "+ -", "UN": "! ~"})
_JAVA_KIND |= {p: p for p in "... -> :: ? : = ( ) [ ] { } ; , . @".split()}
_JAVA_INSIDE = frozenset(". , ? & [ ] < > @".split())

JAVA_GRAMMAR = """
unit: ['package' qname ';'] (';' | 'import' ['static'] qname ';')* (typedecl | ';')* ;
qname: ID ('.' (ID | BIN))* ;
mod: MOD | 'static' | 'synchronized' | anno | 'default' | SEALED ;
anno: '@' ID ('.' ID)* ['(' [elem (',' (elem))* [',']] ')'] ;
elem: (expr ['=' value]) | value1 ;
value: expr | braces | anno ;
value1: braces | anno ;
braces: '{' [value (',' (value))* [',']] '}' ;
typedecl: mod* typebody ;
typebody: 'class' ID ['extends' type] ['implements' types] [PERMITS types] classbody | 'interface' ID ['extends' types] [PERMITS types] classbody | ATINTERFACE ID classbody
     | 'enum' ID ['implements' types] '{' [enumc (',' (enumc))* [',']] [';' member*] '}' | RECORD ID params ['implements' types] classbody ;
types: type (',' type)* ;
type: anno* (ID | PRIM) ('.' anno* ID)* dims ;
dims: ('[' ']')* ;
enumc: anno* ID [args] [classbody] ;
classbody: '{' member* '}' ;
member: ';' | block | 'static' [block | mod* mrest] | mod0 mod* mrest | mrest ;
mod0: MOD | 'synchronized' | anno | 'default' | SEALED ;
mrest: typebody | type (methodrest | block | ID (methodrest | fieldrest)) ;
methodrest: params dims ['throws' types] (block | ['default' value] ';') ;
fieldrest: dims ['=' init] (',' ID dims ['=' init])* ';' ;
params: '(' [param (',' (param))* [',']] ')' ;
param: (MOD | anno)* type ['...'] (ID ['.' 'this'] | 'this') dims ;
init: expr | braces ;
block: '{' stmt* '}' ;
stmt: block | ';' | 'if' '(' expr ')' stmt ['else' stmt] | 'while' '(' expr ')' stmt | 'do' stmt 'while' '(' expr ')' ';' | 'for' '(' [forinit] (':' expr | ';' [expr] ';' [exprs]) ')' stmt
     | 'switch' switchrest | 'try' ['(' resource (';' [resource])* ')'] block ('catch' '(' (MOD | anno)* expr ID ')' block)* ['finally' block] | 'synchronized' '(' expr ')' block
     | 'return' [expr] ';' | 'throw' expr ';' | ('break' | 'continue') [ID] ';' | 'assert' expr [':' expr] ';' | YIELD expr ';' | LABEL ':' stmt | localtype | modlocal | exprlocal ;
localtype: 'class' ID ['extends' type] ['implements' types] classbody | 'interface' ID ['extends' types] classbody | 'enum' ID '{' [enumc (',' (enumc))* [',']] [';' member*] '}' | RECORD ID params ['implements' types] classbody ;
modlocal: (MOD | anno | 'static' | SEALED)+ (localtype | exprlocal) ;
exprlocal: expr [ID declrest] ';' ;
declrest: dims ['=' init] (',' ID dims ['=' init])* ;
forinit: (MOD | anno)* expr [ID declrest] (',' expr)* ;
resource: (MOD | anno)* expr [ID '=' expr] ;
switchrest: '(' expr ')' '{' case* '}' ;
case: ('case' pattern (',' (pattern | 'default'))* [WHEN expr] | 'default') [':' | '->' (block | 'throw' expr ';' | expr ';')] | stmt ;
pattern: (MOD | anno)* expr [ID] ;
exprs: expr (',' expr)* ;
expr: tern [(ASG | '=') init] ;
tern: unary (binop unary | 'instanceof' (MOD | anno)* unary [ID])* ['?' tern0 ':' tern0] ;
tern0: expr ;
binop: BIN | ADD ;
unary: (ADD | UN | INC) unary | primary post* INC* ;
post: '.' (ID | 'new' creator | 'this' | 'super' | 'class' | anno) | '[' [expr] ']' | args | '::' (ID | 'new') ;
args: '(' [arg (',' arg)*] ')' ;
arg: expr [ID] ;
primary: ID ['->' body] | PRIM | NUM | STR | 'null' | 'true' | 'false' | 'this' | 'super' | 'new' creator | '(' [(MOD | anno)* expr [['...'] ID dims] (',' (MOD | anno)* expr [['...'] ID dims])*] ')' ['->' body | cast] | 'switch' switchrest ;
cast: UN unary | primary0 post* ;
primary0: ID ['->' body] | NUM | STR | 'null' | 'true' | 'false' | 'this' | 'super' | 'new' creator | '(' [expr [ID] (',' expr [ID])*] ')' ['->' body | cast] | 'switch' switchrest ;
body: block | expr | 'throw' expr ;
creator: anno* (ID | PRIM) ('.' ID)* (args [classbody] | ('[' [expr] ']')+ [braces]) ;
"""


@lru_cache(maxsize=1)
def java_grammar() -> Grammar:
    return Grammar(JAVA_GRAMMAR, "unit")


def _java_type_word(w: str) -> bool:
    return (w[0].isalpha() or w[0] in "_$") and (w not in JAVA_WORDS or w in ("extends", "super") or _JAVA_KIND.get(w) == "PRIM")


def check_java(text: str) -> int | None:
    """Line of the first error of a Java file, None if there is none."""
    words = _JAVA_LEX.findall(text.removeprefix("﻿").removesuffix("\x1a") + "\n")
    solid: list[int] = [i for i, w in enumerate(words) if w[0] != "\n"]
    toks = [words[i] for i in solid]
    if "<" in toks:
        keep: list[int] = []
        i, n = 0, len(toks)
        while i < n:
            if toks[i] == "<" and i:
                p = toks[i - 1]
                if p[0].isalpha() or p[0] in "_$" or p in (".", "::", "{", "}", ";", ")", "@"):
                    j = _type_arguments(toks, i, _JAVA_INSIDE, _java_type_word)
                    nxt = toks[j] if j and j < n else ""
                    if j and (nxt[:1].isalpha() or nxt[:1] in ("_", "$") or nxt in ("(", ")", "[", "{", ",", ">", ".", "::", ";", "...", "&", "@")) and nxt not in ("instanceof",):
                        i = j
                        continue
            keep.append(i)
            i += 1
        solid = [solid[i] for i in keep]
        toks = [toks[i] for i in keep]
    kinds: list[str] = []
    marks: list[int] = []
    get, n = _JAVA_KIND.get, len(toks)
    for i, w in enumerate(toks):
        k = get(w)
        if k is None:
            c = w[0]
            if c.isalpha() or c in "_$":
                k = "ID"
                nxt = toks[i + 1] if i + 1 < n else ""
                if nxt == ":" and (i == 0 or toks[i - 1] in (";", "{", "}", ")")):
                    k = "LABEL"
                elif w in ("record", "sealed", "permits", "yield", "when") and (nxt[:1].isalpha() or nxt[:1] == "_" or w in ("yield", "when") and (nxt[:1] in "(\"'-!" or nxt[:1].isdigit())):
                    if w == "yield":
                        k = "YIELD" if i and toks[i - 1] in (";", "{", "}", "->", ":") and nxt not in ("=", ".", "(") or nxt[:1] in "\"'" or nxt[:1].isdigit() else "ID"
                    elif w == "when":
                        k = "WHEN" if i and (toks[i - 1][0].isalpha() or toks[i - 1] == ")") else "ID"
                    elif w == "record":
                        k = "RECORD" if i + 2 < n and toks[i + 2] in ("(", "<") else "ID"
                    else:
                        k = w.upper()
            elif c.isdigit() or c == "." and len(w) > 1:
                k = "NUM"
            else:
                k = "STR" if c in "\"'" and len(w) > 1 else "ERROR"
        elif w == "interface" and i and toks[i - 1] == "@":
            kinds.pop()
            marks.pop()
            k = "ATINTERFACE"
        kinds.append(k)
        marks.append(solid[i])
    at = java_grammar().parse(kinds)
    if at < 0:
        fault = java_fault(kinds)
        if fault is None:
            return None
        at = fault
    return _line(words, marks[min(at, len(marks) - 1)]) if marks else 1

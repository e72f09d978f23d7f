"""What JavaScript modules, TypeScript and Java demand beyond their grammars' token order.

The passes run on token streams that fit the grammar: initialisers of declarations, names declared twice in a block,
assignment targets, parameters of arrow functions, places of return, constructors, and Java's expression statements.
"""

from __future__ import annotations

_OPEN = {"(": ")", "[": "]", "{": "}"}
_HEADS = frozenset(("if", "for", "while", "switch", "catch", "with"))
_LITERALS = frozenset(("NUM", "STR", "TPL", "REGEX", "true", "false", "null", "this"))


def brackets(kinds: list[str]) -> dict[int, int]:
    """Opening bracket -> its closing one."""
    out: dict[int, int] = {}
    stack: list[int] = []
    for i, t in enumerate(kinds):
        if t in _OPEN:
            stack.append(i)
        elif t in (")", "]", "}") and stack:
            out[stack.pop()] = i
    return out


def script_fault(kinds: list[str], words: list[str], fresh: set[int], ts: bool) -> int | None:
    """Index of the first token at fault in a JavaScript module (or, with fewer rules, a TypeScript file).

    ``fresh``: the tokens that begin a line.
    """
    match = brackets(kinds)
    opener = {z: a for a, z in match.items()}
    ambient = ts and any(k in ("DECLARE", "NAMESPACE") for k in kinds)
    inside: list[int] = []
    names: list[dict[str, str]] = [{}]
    n = len(kinds)
    for i, t in enumerate(kinds):
        prev = kinds[i - 1] if i else ""
        if t in _OPEN:
            inside.append(i)
            if t == "{":
                names.append({})
                if not ts and _class_body(kinds, opener, i) and _constructors(kinds, words, match, i) > 1:
                    return i
        elif t in (")", "]", "}"):
            if inside:
                inside.pop()
            if t == "}" and len(names) > 1:
                names.pop()
        elif t in ("const", "let", "var") and (i + 1 < n and (kinds[i + 1] in ("ID", "LABEL", "[", "{", "SOFT", "async", "of", "get", "set", "static", "from", "as"))):
            loop = bool(inside) and kinds[inside[-1]] == "(" and inside[-1] + 1 == i and kinds[inside[-1] - 1] in ("for", "await")
            fault = _declared(kinds, words, match, fresh, i, loop or ambient, names[-1] if not loop else {}, ts)
            if fault is not None:
                return fault
        elif t == "class" and not ts and prev in ("", ";", "}", "{", "export") and i + 1 < n and kinds[i + 1] == "ID":
            if words[i + 1] in names[-1]:
                return i + 1
            names[-1][words[i + 1]] = "class"
        elif t == "return" and not _in_function(kinds, inside, opener, ts):
            return i
        elif t == "delete" and not ts and i + 2 < n and kinds[i + 1] == "ID" and kinds[i + 2] not in (".", "?.", "[", "(", "TPL"):
            return i
        elif ts:
            continue
        elif t in ("=", "ASG"):
            if prev in _LITERALS and not _member_name(kinds, inside, i, match) or prev in ("ID", "KEY") and i > 1 and kinds[i - 2] == "?.":
                return i
            if prev == ")" and _is_call(kinds, opener[i - 1]):
                return i
            if t == "ASG" and prev in ("]", "}") and i - 1 in opener and not (prev == "]" and _is_call(kinds, opener[i - 1])):
                return i
        elif t == "INC":
            nxt = kinds[i + 1] if i + 1 < n else ""
            if prev in _LITERALS or nxt in _LITERALS and nxt != "this" and prev not in ("ID", ")", "]", "KEY"):
                return i
        elif t == "=>" and prev == ")":
            a = opener[i - 1] + 1
            first = True
            while a < i - 1:
                if first and kinds[a] not in ("ID", "LABEL", "[", "{", "...", "async", "of", "get", "set", "static", "from", "as", "SOFT"):
                    return a
                first = kinds[a] == ","
                a = match.get(a, a) + 1
    return None


def _is_call(kinds: list[str], a: int) -> bool:
    """Whether the bracket at ``a`` follows a value, as that of a call or an index does."""
    return a > 0 and kinds[a - 1] in ("ID", "KEY", ")", "]", "super", "this", "TPL", "STR", "async", "of", "from", "get", "set", "as", "static", "let", "import")


def _member_name(kinds: list[str], inside: list[int], i: int, match: dict[int, int]) -> bool:
    """Whether the literal before ``i`` names a field of a class."""
    return bool(inside) and kinds[inside[-1]] == "{" and (kinds[i - 2] in ("{", ";", "}", "static") or i - 2 == inside[-1]) and kinds[i - 1] in ("STR", "NUM")


def _class_body(kinds: list[str], opener: dict[int, int], i: int) -> bool:
    """Whether the brace at ``i`` opens a class body."""
    j = i - 1
    while j >= 0 and kinds[j] not in (";", "{", "}", "=", ":", ",", "=>", "return", "(", "["):
        if kinds[j] == "class":
            return True
        j = opener.get(j, j) - 1
    return False


def _constructors(kinds: list[str], words: list[str], match: dict[int, int], i: int) -> int:
    count, j, z = 0, i + 1, match[i]
    while j < z:
        if words[j] == "constructor" and kinds[j + 1] == "(" and kinds[j - 1] in ("{", "}", ";"):
            count += 1
        j = match.get(j, j) + 1
    return count


def _in_function(kinds: list[str], inside: list[int], opener: dict[int, int], ts: bool) -> bool:
    for a in inside:
        if kinds[a] != "{":
            continue
        prev = kinds[a - 1] if a else ""
        if prev == "=>" or ts and prev not in (")", ";", "{", "", "try", "else", "do", "finally"):
            return True
        if prev == ")" and a - 1 in opener:
            p = opener[a - 1]
            head = kinds[p - 1] if p else ""
            if head not in _HEADS and not (head == "await" and p > 1 and kinds[p - 2] == "for"):
                return True
    return False


def _declared(kinds: list[str], words: list[str], match: dict[int, int], fresh: set[int], i: int, free: bool, names: dict[str, str], ts: bool) -> int | None:
    """Checks the declaration at ``i``: initialisers unless ``free``, and names of the block."""
    how, j, n = kinds[i], i + 1, len(kinds)
    lexical = how != "var"
    while j < n:
        at, pattern = j, kinds[j] in ("[", "{")
        if not pattern:
            seen = names.get(words[j])
            if seen and (lexical or seen != "var"):
                return j
            names.setdefault(words[j], "let" if lexical else "var")
        j = match.get(j, j) + 1
        ended = j >= n or kinds[j] == ";" or kinds[j] == "," and not ts or j in fresh and kinds[j] not in ("=", ",", ":", "DEF")
        if ended and (how == "const" or pattern) and not free:
            return at
        # to the next declarator: a comma outside brackets before the statement ends
        while j < n and kinds[j] not in (";", ")", "}", "]", ",") and (j not in fresh or kinds[j] in ("=", "=>", "?", ":", ".", "?.", "BIN", "ADD", "*", "|") or kinds[j - 1] in ("=", "=>", "?", ":", "BIN", "ADD", "*", "|")):
            j = match.get(j, j) + 1
        if j >= n or kinds[j] != ",":
            return None
        j += 1
    return None


_JAVA_WORDS = frozenset(("return", "break", "continue", "import", "package", "throw", "assert", "YIELD", "case", "default", "new", "=", "ASG", "INC", "PRIM", "switch", "MOD", "static", "@", "while", "do", "LABEL", "if", "for", "else", "class", "interface", "enum", "RECORD", "->", "::", "SEALED"))


def java_fault(kinds: list[str]) -> int | None:
    """Index of the first statement that is a bare expression without effect."""
    match = brackets(kinds)
    inside: list[int] = []
    begin, header = 0, 0
    enums: set[int] = set()
    for i, t in enumerate(kinds):
        if t in _OPEN:
            if t == "{":
                if "enum" in kinds[header:i]:
                    enums.add(i)
                begin = header = i + 1
            inside.append(i)
        elif t in (")", "]", "}"):
            top = inside.pop() if inside else -1
            if t == "}":
                begin = header = i + 1
                enums.discard(top)
        elif t == ";" and (not inside or kinds[inside[-1]] == "{"):
            if inside and inside[-1] not in enums and begin < i and _bare(kinds, match, begin, i):
                return begin
            if inside:
                enums.discard(inside[-1])
            begin = header = i + 1
    return None


def _bare(kinds: list[str], match: dict[int, int], a: int, b: int) -> bool:
    """Whether tokens ``[a, b)`` are an expression that is no assignment, step, call or creation."""
    operator, j, last = False, a, ""
    while j < b:
        t = kinds[j]
        if t in _JAVA_WORDS or t == "ID" and last in ("ID", "]"):
            return False
        operator = operator or t in ("BIN", "ADD", "?")
        last = kinds[match[j]] if j in match else t
        j = match.get(j, j) + 1
    return operator or last != ")" and kinds[b - 1] not in ("}", ",")

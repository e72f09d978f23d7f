"""What Python 3.13 demands beyond the grammar's token order.

The token stream, known to fit the grammar, is walked by logical lines and brackets: targets of assignments, loops and
contexts, order of arguments and parameters, walrus and star positions, displays, string literals and the holes of
f-strings, and the places where return, yield, await, break and continue may stand.
"""

from __future__ import annotations

import re
import unicodedata
from keyword import iskeyword
from collections.abc import Callable, Iterator

_CONST = frozenset(("NUMBER", "None", "True", "False", "..."))
_ENDS_ATOM = frozenset(("NAME", ")", "]", "}", "STRING", "NUMBER", "None", "True", "False", "..."))
_HEADS = frozenset(("if", "elif", "else", "while", "for", "with", "try", "except", "finally", "def", "class", "MATCH", "CASE"))
#: What alone in brackets can be no fault.
_PLAIN = frozenset(("NAME", "STRING", "NUMBER", "None", "True", "False"))
_SIMPLE_HOLE = re.compile(r"[A-Za-z_]\w*", re.A)
_LAYOUT = frozenset(("NEWLINE", "INDENT", "DEDENT"))
_BEFORE_WALRUS = frozenset(("(", "[", "{", ",", "if", "elif", "while", "MATCH", "@"))
_BAD_ESCAPE = re.compile(r"(?<!\\)(?:\\\\)*\\(?:x(?![0-9a-fA-F]{2})|u(?![0-9a-fA-F]{4})|U(?!(?:000[0-9a-fA-F]|0010)[0-9a-fA-F]{4})|N(?!\{[^{}\n]+\}))")
_BAD_BYTE = re.compile(r"(?<!\\)(?:\\\\)*\\x(?![0-9a-fA-F]{2})")
_PREFIX = re.compile(r"[A-Za-z]*")
_NAMED = re.compile(r"(?<!\\)(?:\\\\)*\\N\{([^{}\n]+)\}")
# What may be imported from __future__.
_FUTURE = frozenset("nested_scopes generators division absolute_import with_statement print_function unicode_literals barry_as_FLUFL generator_stop annotations".split())


def _named(name: str) -> bool:
    """Whether a character bears this name."""
    try:
        unicodedata.lookup(name)
    except KeyError:
        return False
    return True


class Fault(Exception):
    """Carries the index of the token at fault."""


class Rules:
    def __init__(self, kinds: list[str], words: list[str], parse: Callable[[str], bool]) -> None:
        self.k, self.w, self.parse = kinds, words, parse
        self.early, self.begun = True, False  # whether an import from __future__ may still come; whether a statement has
        self.match: dict[int, int] = {}
        stack: list[int] = []
        for i, t in enumerate(kinds):
            if t in "([{" and t:
                stack.append(i)
            elif t in ")]}" and t and stack:
                self.match[stack.pop()] = i

    # -- scanning

    def lambda_colon(self, i: int, b: int) -> int:
        """Index of the colon of the lambda at ``i``."""
        k, depth, i = self.k, 1, i + 1
        while i < b:
            if i in self.match:
                i = self.match[i]
            elif k[i] == "lambda":
                depth += 1
            elif k[i] == ":":
                depth -= 1
                if not depth:
                    return i
            i += 1
        return b

    def top(self, a: int, b: int) -> Iterator[int]:
        """Indices in ``[a, b)`` outside of inner brackets and of lambdas' parameters."""
        k, match = self.k, self.match
        while a < b:
            yield a
            if k[a] == "lambda":
                a = self.lambda_colon(a, b)
            elif a in match:
                a = match[a]
            a += 1

    def parts(self, a: int, b: int) -> tuple[list[tuple[int, int]], bool]:
        """Ranges between the commas of ``[a, b)``, and whether there is a comma."""
        k, out, begin, comma, clause = self.k, [], a, False, False
        for i in self.top(a, b):
            if k[i] == "for" or clause and k[i] == "in":
                clause = k[i] == "for"
            elif k[i] == "," and not clause:
                out.append((begin, i))
                begin, comma = i + 1, True
        if begin < b:
            out.append((begin, b))
        return out, comma

    # -- targets

    def targets(self, a: int, b: int, mode: str = "assign", listed: bool = False) -> None:
        """``mode``: assign, del (no stars) or single (one name, attribute or item)."""
        parts, comma = self.parts(a, b)
        if not parts and not listed or mode == "single" and (comma or len(parts) != 1):
            raise Fault(a)
        stars = 0
        for x, y in parts:
            if self.k[x] == "*":
                stars += 1
                if mode != "assign" or not (comma or listed) or stars > 1:
                    raise Fault(x)
                x += 1
            self.target(x, y, mode)

    def target(self, x: int, y: int, mode: str) -> None:
        k, match = self.k, self.match
        if x >= y:
            raise Fault(max(0, x - 1))
        first = k[x]
        if first in ("(", "[") and match.get(x) == y - 1:
            if first == "(" and y - x > 2 and not self.parts(x + 1, y - 1)[1]:
                return self.target(x + 1, y - 1, mode)
            if mode == "single":
                raise Fault(x)
            return self.targets(x + 1, y - 1, mode, True)
        if first == "STRING":
            p = x
            while p < y and k[p] == "STRING":
                p += 1
        elif first in ("(", "[", "{"):
            p = match[x] + 1
        elif first == "NAME" or first in _CONST:
            p = x + 1
        else:
            raise Fault(x)
        last = ""
        while p < y:
            last = k[p]
            if last == ".":
                p += 2
            elif last in ("(", "["):
                p = match[p] + 1
            else:
                raise Fault(p)
        if not (last in (".", "[") if last else first == "NAME"):
            raise Fault(x)

    # -- brackets

    def arguments(self, a: int, b: int) -> None:
        k, keyword, mapping, names = self.k, False, False, set()
        parts, comma = self.parts(a, b)
        for x, y in parts:
            first = k[x] if x < y else ""
            if first == "**":
                mapping = True
            elif first == "*":
                if mapping:
                    raise Fault(x)
            elif y > x + 1 and k[x + 1] == "=":
                if first != "NAME" or self.w[x] in names:
                    raise Fault(x)
                names.add(self.w[x])
                keyword = True
            else:
                if keyword or mapping:
                    raise Fault(x)
                for i in self.top(x, y):
                    if k[i] == "=" or k[i] == "for" and comma:
                        raise Fault(i)

    def parameters(self, a: int, b: int) -> None:
        k, names = self.k, set()
        default = star = bare = slash = closed = False
        for n, (x, y) in enumerate(self.parts(a, b)[0]):
            if closed or x >= y:
                raise Fault(x)
            first = k[x]
            if first == "/":
                if slash or star or not n or y != x + 1:
                    raise Fault(x)
                slash = True
                continue
            at = x
            if first == "*":
                if star:
                    raise Fault(x)
                star = True
                bare = y == x + 1
                if bare:
                    continue
                at = x + 1
            elif first == "**":
                if bare:
                    raise Fault(x)
                closed, at = True, x + 1
            else:
                bare = False
                if y > x + 2 and k[x + 1] == ":" and k[x + 2] == "*":
                    raise Fault(x + 2)
            if k[at] != "NAME" or self.w[at] in names:
                raise Fault(at)
            names.add(self.w[at])
            has = any(k[i] == "=" for i in self.top(at, y))
            if has and at > x or not has and default and not star and at == x:
                raise Fault(x)
            default = default or has
        if bare:
            raise Fault(a)

    def bracket(self, i: int, as_ok: bool, params: bool, case: bool) -> None:
        k, z = self.k, self.match[i]
        a, t = i + 1, k[i]
        if z <= a + (k[a] in _PLAIN):
            return None
        call = t == "(" and i and k[i - 1] in _ENDS_ATOM
        item = t == "[" and i and k[i - 1] in _ENDS_ATOM
        if params:
            return self.parameters(a, z)
        colon = plain = starred = 0
        comp = False
        fresh, begin = True, a
        comma = False
        for j in self.top(a, z):
            c = k[j]
            if fresh:
                begin, fresh = j, False
                starred += c == "*"
                plain += c != "**"
                if c == "**" and t == "{":
                    colon += 1
            if c == ",":
                fresh, comma = not comp, True
            elif c == ":" and t == "{" and k[begin] != "lambda":
                colon += 1
                plain -= 1
                if k[begin] == "*":
                    raise Fault(j)
            elif c == "for":
                comp = True
                self.comprehension(j, z)
            elif c == "as" and not as_ok:
                raise Fault(j)
            elif c == ":=" and (k[j - 1] != "NAME" or k[j - 2] not in _BEFORE_WALRUS):
                raise Fault(j)
        if comp and not item and (k[a] == "*" or k[a] == "**"):
            raise Fault(a)
        if t == "{" and colon and plain and not case or t == "(" and not call and starred and not comma and not case:
            raise Fault(i)
        if call and not case:
            self.arguments(a, z)

    def comprehension(self, j: int, z: int) -> None:
        """Targets of the comprehension clause whose ``for`` is at ``j``."""
        for q in self.top(j + 1, z):
            if self.k[q] == "in":
                return self.targets(j + 1, q)

    # -- statements

    def value(self, a: int, b: int, walrus: bool = False) -> None:
        """An expression list outside brackets."""
        k, comma, star = self.k, False, False
        if a < b and k[a] == "yield":
            a += 1 + (a + 1 < b and k[a + 1] == "from")
        begin = True
        for i in self.top(a, b):
            t = k[i]
            if begin and t == "*":
                star = True
            begin = False
            if t == ",":
                comma = begin = True
            elif t == ":=":
                if not walrus or i != a + 1 or k[a] != "NAME":
                    raise Fault(i)
        if star and not comma:
            raise Fault(a)

    def simple(self, a: int, b: int, near: str, loop: bool, adrift: bool) -> None:
        """``near``: def, adef, class or nothing; ``adrift``: in the body of an ``except*``."""
        k = self.k
        first = k[a]
        if self.early and (first != "from" or self.w[a + 1] != "__future__"):
            self.early = not self.begun and all(t == "STRING" for t in k[a:b])
        self.begun = True
        if first == "del":
            self.targets(a + 1, b, "del")
        elif first == "return":
            if near not in ("def", "adef") or adrift:
                raise Fault(a)
            self.value(a + 1, b)
        elif first in ("break", "continue"):
            if not loop:
                raise Fault(a)
        elif first == "nonlocal":
            if not near:
                raise Fault(a)
        elif first == "from":
            if k[b - 1] == "," or k[b - 1] == "*" and near:
                raise Fault(b - 1)
            if self.w[a + 1] == "__future__" and k[a + 2] == "import":
                if not self.early:
                    raise Fault(a)
                for i in range(a + 3, b):
                    if k[i] == "NAME" and k[i - 1] != "as" and self.w[i] not in _FUTURE:
                        raise Fault(i)
        elif first in ("raise", "assert"):
            self.value(a + 1, b)
        elif first not in ("pass", "global", "import", "TYPE"):
            eq = [i for i in self.top(a, b) if k[i] == "=" or k[i] == "AUG" or k[i] == ":" and k[i] != "lambda"]
            eq = [i for i in eq if not (k[i] == ":" and self._of_lambda(a, i))]
            if not eq:
                return self.value(a, b)
            if k[eq[0]] in (":", "AUG"):
                if k[eq[0]] == ":" and k[a] == "(" and self.match[a] != eq[0] - 1:
                    raise Fault(a)
                self.targets(a, eq[0], "single")
                for x, y in zip(eq, [*eq[1:], b]):
                    self.value(x + 1, y)
                return
            begin = a
            for i in eq:
                self.targets(begin, i)
                begin = i + 1
            self.value(begin, b)

    def _of_lambda(self, a: int, i: int) -> bool:
        j = a
        while j <= i:
            if self.k[j] == "lambda":
                j = self.lambda_colon(j, len(self.k))
                if j == i:
                    return True
            elif j in self.match:
                j = self.match[j]
            j += 1
        return False

    def header(self, a: int, b: int) -> int:
        """Index of the colon that ends the head of the compound statement at ``a``."""
        for i in self.top(a, b):
            if self.k[i] == ":" and not self._of_lambda(a, i):
                return i
        return b

    def head(self, a: int, colon: int) -> tuple[int, int]:
        """Checks of a head; opening brackets of a parameter list and of a parenthesised ``with`` (-1: none)."""
        k = self.k
        first = k[a]
        if first in ("if", "elif", "while", "MATCH"):
            self.value(a + 1, colon, True)
        elif first == "for":
            for i in self.top(a + 1, colon):
                if k[i] == "in":
                    self.targets(a + 1, i)
                    self.value(i + 1, colon)
                    break
        elif first == "with":
            if k[a + 1] == "(" and self.match[a + 1] == colon - 1:
                self.contexts(a + 2, colon - 1)
                return -1, a + 1
            self.contexts(a + 1, colon)
        elif first == "def":
            return next((i for i in self.top(a, colon) if k[i] == "("), -1), -1
        return -1, -1

    def contexts(self, a: int, b: int) -> None:
        for x, y in self.parts(a, b)[0]:
            for i in self.top(x, y):
                if self.k[i] == "as":
                    if self.k[i + 1] == "*":
                        raise Fault(i + 1)
                    self.target(i + 1, y, "assign")

    def run(self) -> int | None:
        """Index of the first token at fault, None if there is none."""
        try:
            self._run()
        except Fault as f:
            return f.args[0]
        return None

    def _run(self) -> None:
        k, w = self.k, self.w
        blocks: list[str] = []
        head, n, a = "", len(k), 0
        while a < n:
            t = k[a]
            if t in _LAYOUT:
                if t == "INDENT":
                    blocks.append(head)
                elif t == "DEDENT" and blocks:
                    blocks.pop()
                a += 1
                continue
            b = a
            while b < n and k[b] != "NEWLINE":
                b += 1
            head = self._logical(a, b, blocks)
            a = b
        for i, t in enumerate(k):
            if t == "STRING":
                self.string(i, w[i])

    def _logical(self, a: int, b: int, blocks: list[str]) -> str:
        k = self.k
        start = a
        is_async = k[a] == "async"
        a += is_async
        first = k[a]
        outer = self._near(blocks)
        kind, params, with_at, colon = "", -1, -1, a - 1
        if first in _HEADS or first == "@":
            self.early = False
        if first in _HEADS:
            colon = self.header(a, b)
            params, with_at = self.head(a, colon)
            kind = {"def": "adef" if is_async else "def", "class": "class", "for": "loop", "while": "loop"}.get(first, "")
            if first == "except":
                kind = "star" if k[a + 1] == "*" else ""
            if is_async and first != "def" and outer[0] != "adef":
                raise Fault(start)
        elif first == "@":
            self.value(a + 1, b, True)
            colon = b
        if not hasattr(self, "_plain_await"):
            self._plain_await = "await" not in k and "yield" not in k
        anywhere = first == "from" or first == "CASE"
        lambdas = False
        for i in range(start, b):
            t = k[i]
            if i in self.match and t in "([{":
                self.bracket(i, anywhere or i == with_at, i == params, first == "CASE" and i < colon)
            elif t == "lambda":
                lambdas = True
                self.parameters(i + 1, self.lambda_colon(i, b))
        if not self._plain_await and not lambdas:
            inner = self._near([*blocks, kind])[0]
            for i in range(start, b):
                t = k[i]
                if t in ("await", "yield"):
                    near = inner if i > colon else outer[0]
                    if t == "yield" and near not in ("def", "adef") or t == "await" and near != "adef" and not self._in_generator(start, i):
                        raise Fault(i)
        if colon < b - 1 and first != "@":
            near, loop, adrift = self._near([*blocks, kind]) if kind else outer
            x = colon + 1
            for i in [*(i for i in self.top(x, b) if k[i] == ";"), b]:
                if x < i:
                    self.simple(x, i, near, loop, adrift)
                x = i + 1
        return kind

    def _in_generator(self, a: int, i: int) -> bool:
        """Whether a generator expression of the line from ``a`` on encloses ``i``; it may await wherever it stands."""
        return any(self.k[j] == "(" and self.match[j] > i and any(self.k[x] == "for" for x in self.top(j + 1, self.match[j])) for j in range(a, i) if j in self.match)

    @staticmethod
    def _near(blocks: list[str]) -> tuple[str, bool, bool]:
        """Nearest function or class, whether a loop lies nearer than it, and whether an ``except*`` does."""
        loop = star = False
        for t in reversed(blocks):
            if t in ("def", "adef", "class"):
                return t, loop, star
            if t == "loop" and not star:
                loop = True
            star = star or t == "star" and not loop
        return "", loop, star

    # -- strings

    def string(self, i: int, word: str) -> None:
        prefix = _PREFIX.match(word).group().lower()
        is_bytes = "b" in prefix
        if i and self.k[i - 1] == "STRING" and ("b" in _PREFIX.match(self.w[i - 1]).group().lower()) != is_bytes:
            raise Fault(i)
        if is_bytes and not word.isascii():
            raise Fault(i)
        if "\\" in word and "r" not in prefix and (_BAD_BYTE if is_bytes else _BAD_ESCAPE).search(word):
            raise Fault(i)
        if "\\N{" in word and not is_bytes and "r" not in prefix and not all(_named(x) for x in _NAMED.findall(word)):
            raise Fault(i)
        if "f" in prefix and ("{" in word or "}" in word):
            n = len(prefix)
            q = 3 if word[n : n + 3] in ('"""', "'''") and len(word) >= n + 6 else 1
            if not self.holes(word[n + q : -q], "r" in prefix, 0):
                raise Fault(i)

    def holes(self, body: str, raw: bool, level: int) -> bool:
        """Whether all replacement fields of an f-string's body, or of a format, are valid."""
        at, n = 0, len(body)
        while at < n:
            c = body[at]
            if c == "\\" and not raw:
                if body.startswith("\\N{", at):
                    at = body.find("}", at) + 1 or n
                else:
                    at += 1 if body[at + 1 : at + 2] in "{}" else 2
            elif c in "{}" and body[at + 1 : at + 2] == c and not level:
                at += 2
            elif c == "}":
                return False
            elif c == "{":
                at = self.hole(body, at + 1, raw, level)
                if at < 0:
                    return False
            else:
                at += 1
        return True

    def hole(self, body: str, at: int, raw: bool, level: int) -> int:
        """Index after the field that begins at ``at``; -1 if it is invalid."""
        if level > 2:
            return -1
        depth, begin, n = 0, at, len(body)
        while at < n:
            c = body[at]
            if c in "\"'":
                q = c * 3 if body.startswith(c * 3, at) else c
                e = at + len(q)
                while e < n and not body.startswith(q, e):
                    e += 2 if body[e] == "\\" else 1
                at = e + len(q)
                continue
            if c in "([{":
                depth += 1
            elif c in ")]}":
                if not depth:
                    break
                depth -= 1
            elif c == "#":
                e = body.find("\n", at)
                at = n if e < 0 else e
                continue
            elif not depth and c == "!" and body[at + 1 : at + 2] != "=":
                break
            elif not depth and c == ":":
                break
            at += 1
        if at >= n or body[at] in ")]":
            return -1
        expr = body[begin:at]
        if (m := re.search(r"(?<![=!<>:])=\s*$", expr)) is not None:
            expr = expr[: m.start()]
        if not (_SIMPLE_HOLE.fullmatch(expr) and not iskeyword(expr)) and (not expr.strip() or not self.parse(expr)):
            return -1
        if body[at] == "!":
            m = re.compile(r"!\s*[rsa]\s*(?=[:}])").match(body, at)
            if not m:
                return -1
            at = m.end()
        if body[at] == ":":
            begin = at + 1
            depth, at = 0, begin
            while at < n and (depth or body[at] != "}"):
                depth += (body[at] == "{") - (body[at] == "}")
                at += 1
            if at >= n or not self.holes(body[begin:at], raw, level + 1):
                return -1
        return at + 1

"""Python files as rows of symbols, imports, routes, calls, constants and module docs: one pass of the standard parser over each text.

Constants are module-level names in capitals, with the first 160 characters of their value.

Defined results: files that do not parse give one row of kind ``error``; empty and null texts give none.
"""

from __future__ import annotations

import ast
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "file_id long, kind string, name string, scope string, start_line int, end_line int, detail string"
# Verbs that route decorators use.
VERBS = ("get", "post", "put", "delete", "patch", "head", "options")
# Router constructors with the keyword of their prefix, and the calls that register Django routes.
ROUTERS = {"APIRouter": "prefix", "Blueprint": "url_prefix", "Router": "prefix", "Mount": "path"}
DJANGO = ("path", "re_path", "url")


def _dotted(node: ast.AST) -> str | None:
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    return ".".join([node.id, *reversed(parts)]) if isinstance(node, ast.Name) else None


def _text(node: ast.AST | None) -> str | None:
    return node.value if isinstance(node, ast.Constant) and isinstance(node.value, str) else None


def _prefixes(tree: ast.Module) -> dict[str, str]:
    """Route prefix of each variable that holds a router."""
    out = {}
    for n in ast.walk(tree):
        if isinstance(n, (ast.Assign, ast.AnnAssign)) and isinstance(n.value, ast.Call):
            key = ROUTERS.get((_dotted(n.value.func) or "").rsplit(".", 1)[-1])
            prefix = next((_text(k.value) for k in n.value.keywords if key and k.arg == key), None)
            if prefix:
                out |= {t.id: prefix for t in (n.targets if isinstance(n, ast.Assign) else [n.target]) if isinstance(t, ast.Name)}
    return out


def _join(prefix: str, path: str) -> str:
    if not prefix.strip("/"):
        return path
    return f"/{prefix.strip('/')}" + ("" if path == "/" else f"/{path.lstrip('/')}")


def _django(tree: ast.Module) -> Iterator[tuple]:
    """Rows of path(), re_path() and url() calls; the scope is the view, the method any."""
    for n in ast.walk(tree):
        if isinstance(n, ast.Call) and n.args and (_dotted(n.func) or "").rsplit(".", 1)[-1] in DJANGO and (route := _text(n.args[0])) is not None:
            yield ("route", route if route.startswith("/") else f"/{route}", ast.unparse(n.args[1]) if len(n.args) > 1 else "", n.lineno, n.end_lineno, "*")


def _route(dec: ast.expr, prefixes: dict[str, str]) -> str | None:
    """``METHODS path`` of a route decorator; its first argument must be a path that starts with a slash, its router's prefix goes in front."""
    if not isinstance(dec, ast.Call) or not isinstance(dec.func, ast.Attribute) or not dec.args:
        return None
    first = dec.args[0]
    if not (isinstance(first, ast.Constant) and isinstance(first.value, str) and first.value.startswith("/")):
        return None
    verb = dec.func.attr
    path = _join(prefixes.get(dec.func.value.id, "") if isinstance(dec.func.value, ast.Name) else "", first.value)
    if verb in VERBS:
        return f"{verb.upper()} {path}"
    if verb == "websocket":
        return f"WEBSOCKET {path}"
    if verb in ("route", "api_route"):
        for kw in dec.keywords:
            if kw.arg == "methods" and isinstance(kw.value, (ast.List, ast.Tuple, ast.Set)):
                names = sorted(e.value.upper() for e in kw.value.elts if isinstance(e, ast.Constant) and isinstance(e.value, str))
                return f"{','.join(names)} {path}"
        return f"GET {path}"
    return None


def parse(text: str) -> list[tuple]:
    """``(kind, name, scope, start_line, end_line, detail)`` rows of one file."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(text)
    except (SyntaxError, ValueError, RecursionError) as e:
        return [("error", type(e).__name__, "", getattr(e, "lineno", None), None, None)]
    out: list[tuple] = []
    prefixes = _prefixes(tree)

    def calls(body: list[ast.stmt], owner: str) -> None:
        todo: list[ast.AST] = list(body)
        while todo:
            n = todo.pop()
            if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                continue
            if isinstance(n, ast.Call) and (name := _dotted(n.func)):
                out.append(("call", name, owner, n.lineno, n.end_lineno, None))
            todo += ast.iter_child_nodes(n)

    def visit(body: list[ast.stmt], scope: tuple[str, ...], in_class: bool) -> None:
        for n in body:
            if isinstance(n, ast.ClassDef):
                out.append(("class", n.name, ".".join(scope), n.lineno, n.end_lineno, ",".join(filter(None, map(_dotted, n.bases)))))
                visit(n.body, (*scope, n.name), True)
            elif isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
                sign = f"{'async ' if isinstance(n, ast.AsyncFunctionDef) else ''}def {n.name}({ast.unparse(n.args)})" + (f" -> {ast.unparse(n.returns)}" if n.returns else "")
                out.append(("method" if in_class else "function", n.name, ".".join(scope), n.lineno, n.end_lineno, sign))
                for r in filter(None, (_route(x, prefixes) for x in n.decorator_list)):
                    out.append(("route", r.split(" ", 1)[1], ".".join((*scope, n.name)), n.lineno, n.end_lineno, r.split(" ", 1)[0]))
                calls(n.body, ".".join((*scope, n.name)))
                visit(n.body, (*scope, n.name), False)
            elif isinstance(n, ast.Import):
                out.extend(("import", a.name, ".".join(scope), n.lineno, n.end_lineno, a.asname) for a in n.names)
            elif isinstance(n, ast.ImportFrom):
                out.extend(("import", "." * n.level + (n.module or "") + ":" + a.name, ".".join(scope), n.lineno, n.end_lineno, a.asname) for a in n.names)
            else:
                if isinstance(n, (ast.Assign, ast.AnnAssign)) and not scope:
                    for t in n.targets if isinstance(n, ast.Assign) else [n.target]:
                        if isinstance(t, ast.Name) and t.id.isupper() and len(t.id) > 2:
                            out.append(("constant", t.id, "", n.lineno, n.end_lineno, ast.unparse(n.value)[:160] if n.value else ""))
                for block in ("body", "orelse", "finalbody", "handlers", "cases"):
                    inner = getattr(n, block, None)
                    if isinstance(inner, list):
                        visit([x for h in inner for x in (h.body if isinstance(h, (ast.ExceptHandler, ast.match_case)) else [h])], scope, in_class)

    if (doc := ast.get_docstring(tree)) is not None:
        out.append(("doc", "", "", tree.body[0].lineno, tree.body[0].end_lineno, doc))
    visit(tree.body, (), False)
    out.extend(_django(tree))
    return out


def parse_python(files: DataFrame) -> DataFrame:
    """Rows of ``parse`` for each (file_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, *r) for i, t in zip(pdf["file_id"], pdf["text"]) if t for r in parse(t)]
            out = pd.DataFrame(rows, columns=["file_id", "kind", "name", "scope", "start_line", "end_line", "detail"])
            yield out.astype({"start_line": "Int32", "end_line": "Int32"})

    return files.select("file_id", "text").filter("text IS NOT NULL").mapInPandas(run, SCHEMA)

"""Plans read out of free text, and citations that are not quite citations."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- plans

_FENCE = re.compile(r"^[ \t]*(`{3,}|~{3,})[ \t]*([^\n`]*)\n(.*?)^[ \t]*\1[ \t]*$", re.M | re.S)
_QUOTES = str.maketrans({"“": '"', "”": '"', "„": '"', "‘": "'", "’": "'"})
_STRAY = re.compile(r'("(?:[^"\\]|\\.)*"\s*:\s*)\[\s*\]\s*,\s*("(?:[^"\\]|\\.)*")(?=\s*[,}])')


class PlanError(ValueError):
    """The text holds no plan, or more than one."""


@dataclass
class Plan:
    document: dict
    sections: list[dict] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def balanced(text: str, start: int = 0, pair: str = "{}") -> str | None:
    """The first balanced piece from ``start`` on; brackets inside strings do not count."""
    begin = text.find(pair[0], start)
    if begin < 0:
        return None
    depth, quoted, i = 0, False, begin
    while i < len(text):
        c = text[i]
        if quoted:
            i += c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        elif c in pair:
            depth += 1 if c == pair[0] else -1
            if not depth:
                return text[begin : i + 1]
        i += 1
    return None


def repair(text: str) -> str:
    """A string that stands without a key behind an empty list goes into that list; the result must parse to count."""
    fixed = _STRAY.sub(r"\1[\2]", text)
    try:
        json.loads(fixed)
    except ValueError:
        return text
    return fixed


def loads(text: str) -> object:
    """JSON of a text: as it is, with straight quotes, or repaired."""
    for form in (text, text.translate(_QUOTES), repair(text.translate(_QUOTES))):
        try:
            return json.loads(form)
        except ValueError as e:
            fault = e
    raise fault


def _rows(text: str, warnings: list[str]) -> list[dict]:
    """Rows of a JSON array or of JSON lines; lines that do not parse are left out with a warning."""
    body = text.strip()
    if body.startswith("["):
        try:
            got = loads(body)
            return [r for r in got if isinstance(r, dict)]
        except ValueError:
            pass
    out = []
    for n, line in enumerate(body.splitlines(), 1):
        if line.strip():
            try:
                row = loads(line)
            except ValueError:
                warnings.append(f"row {n} is malformed")
                continue
            if isinstance(row, dict):
                out.append(row)
    return out


def _blocks(text: str) -> list[tuple[str, str]]:
    """``(label, body)`` of the fenced blocks; the label is the info string and the last line of text before the block."""
    out = []
    for m in _FENCE.finditer(text):
        before = [x for x in text[: m.start()].splitlines() if x.strip()]
        out.append((f"{m.group(2)} {before[-1] if before else ''}".lower(), m.group(3)))
    return out


def _is_document(x: object) -> bool:
    return isinstance(x, dict) and ("section_order" in x or isinstance(x.get("sections"), list))


def parse_plan(text: str) -> Plan:
    """The document plan and the section plans of a response.

    The document is the one block that is an object with sections or an order (labelled blocks first); the sections are
    the rows with a section_id of all other blocks. Without fences an object below a heading on the document plan is taken. Two
    candidates of one standing, or none, are an error.
    """
    warnings: list[str] = []
    documents: list[tuple[bool, dict]] = []
    sections: list[dict] = []
    for label, body in _blocks(text):
        try:
            whole = loads(body)
        except ValueError:
            whole = None
        if _is_document(whole):
            documents.append(("document" in label, whole))
        else:
            sections += [r for r in (_rows(body, warnings) if not isinstance(whole, dict) else [whole]) if "section_id" in r]
    if not documents:
        for m in re.finditer(r"^#{1,6}[^\n]*document[ _-]?plan[^\n]*$", text, re.I | re.M):
            piece = balanced(text, m.end())
            if piece is not None:
                try:
                    whole = loads(piece)
                except ValueError:
                    continue
                if _is_document(whole):
                    documents.append((True, whole))
                    warnings.append("document plan found below a heading")
    best = [d for named, d in documents if named] or [d for _, d in documents]
    if len(best) != 1:
        raise PlanError("no document plan" if not best else "several document plans")
    return Plan(best[0], sections, warnings)


def merge_plans(document: DataFrame, plans: DataFrame) -> DataFrame:
    """``(part, pos, section_id, title, plan_no, matched)``: sections of document plans with the plan of each.

    ``document`` is (part, pos, section_id, title), ``plans`` (part, plan_no, section_id, title). A plan belongs to the first
    section of its id; what is left is matched by title, the n-th section of a title to its n-th plan. Each plan is used once;
    those left over are appended behind the last section.
    """
    first = lambda df, key, by: df.withColumn("n", F.row_number().over(_window(["part", key], by)))
    d = first(document.filter("section_id IS NOT NULL"), "section_id", "pos").filter("n = 1").select("part", "section_id", "pos")
    p = first(plans.filter("section_id IS NOT NULL"), "section_id", "plan_no").filter("n = 1").select("part", "section_id", "plan_no")
    by_id = d.join(p, ["part", "section_id"]).select("part", "pos", "plan_no")
    rest_d = document.join(by_id.select("part", "pos"), ["part", "pos"], "left_anti").withColumn("key", F.lower(F.trim("title")))
    rest_p = plans.join(by_id.select("part", "plan_no"), ["part", "plan_no"], "left_anti").withColumn("key", F.lower(F.trim("title")))
    by_title = first(rest_d.filter("key <> ''"), "key", "pos").select("part", "key", "n", "pos").join(first(rest_p.filter("key <> ''"), "key", "plan_no").select("part", "key", "n", "plan_no"), ["part", "key", "n"]).select("part", "pos", "plan_no")
    pairs = by_id.withColumn("matched", F.lit("id")).unionByName(by_title.withColumn("matched", F.lit("title")))
    whole = document.join(pairs, ["part", "pos"], "left").select("part", "pos", "section_id", "title", "plan_no", F.coalesce("matched", F.lit("none")).alias("matched"))
    last = document.groupBy("part").agg(F.max("pos").alias("last"))
    left = plans.join(pairs.select("part", "plan_no"), ["part", "plan_no"], "left_anti").join(last, "part", "left")
    left = left.withColumn("n", F.row_number().over(_window(["part"], "plan_no")))
    return whole.unionByName(left.select("part", (F.coalesce("last", F.lit(0)) + F.col("n")).alias("pos"), "section_id", "title", "plan_no", F.lit("appended").alias("matched")))


def _window(part: list[str], order: str):
    from pyspark.sql import Window

    return Window.partitionBy(*part).orderBy(order)


# ---- citations

_TOKEN = re.compile(r"\[ev:[^\[\]\n]*\]?")
_CANONICAL = re.compile(r"\[ev:[a-z0-9][a-z0-9-]*:\d{4}\]")
_BARE = re.compile(r"(?<![\w\[])ev:[A-Za-z0-9][\w-]*:\d+")
_SECTION = re.compile(r"[a-z0-9][a-z0-9-]*")


def _suggestion(core: str) -> str | None:
    """A citation of the same section and number in four digits, if both can be read."""
    parts = core.split(":")
    digits = re.match(r"\s*(\d+)", parts[2]) if len(parts) > 2 else None
    if digits is None or not _SECTION.fullmatch(parts[1]) or int(digits.group(1)) > 9999:
        return None
    return f"ev:{parts[1]}:{int(digits.group(1)):04d}"


def _category(token: str) -> str:
    if not token.endswith("]"):
        return "dangling_opener"
    parts = token[1:-1].split(":")
    if len(parts) != 3:
        return "missing_ordinal_separator" if len(parts) == 2 else "extra_field"
    if not _SECTION.fullmatch(parts[1]):
        return "invalid_section_id"
    if not parts[2]:
        return "missing_ordinal"
    return "wrong_ordinal_width" if parts[2].isdigit() else "malformed_ordinal"


def malformed_citations(text: str | None) -> list[tuple[int, int, str, str, str | None]]:
    """``(line, column, token, category, suggestion)`` of tokens that begin like a citation ``[ev:section:0001]`` and are none."""
    if not text:
        return []
    found = [(m.start(), m.group(), _category(m.group()), _suggestion(m.group().strip("[]"))) for m in _TOKEN.finditer(text) if not _CANONICAL.fullmatch(m.group())]
    taken = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    found += [(m.start(), m.group(), "unbracketed_token", _suggestion(m.group())) for m in _BARE.finditer(text) if not any(a <= m.start() < z for a, z in taken)]
    return [(text.count("\n", 0, at) + 1, at - text.rfind("\n", 0, at), token, kind, hint) for at, token, kind, hint in sorted(found)]


def citation_faults(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, line_no, column_no, token, category, suggestion)``; null texts have none, repeated rows count once."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").contains("ev:"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(k, *x) for k, t in zip(pdf["key"], pdf["text"]) for x in malformed_citations(t)], columns=["key", "line_no", "column_no", "token", "category", "suggestion"])

    fields = [T.StructField("line_no", T.IntegerType()), T.StructField("column_no", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in ("token", "category", "suggestion"))]
    return src.mapInPandas(run, T.StructType([T.StructField("key", src.schema["key"].dataType), *fields])).distinct().withColumnRenamed("key", key)


# ---- topics in texts

_HEADING = re.compile(r"^ {0,3}(#{1,6})[ \t]+(.*?)[ \t]*#*$")


def heading_slug(line: str) -> str | None:
    """Anchor of a heading line: lower case, words joined by dashes; None for other lines."""
    m = _HEADING.match(line)
    return re.sub(r"[\s-]+", "-", re.sub(r"[^\w\s-]", "", m.group(2).lower())).strip("-") if m else None


def topic_block(markdown: str | None, topic: str, anchor: str | None = None) -> str | None:
    """The part of a text on a topic: below the heading of the anchor, else below a heading that names it, else the paragraph that does."""
    lines = (markdown or "").splitlines()

    def below(i: int) -> str:
        level = len(_HEADING.match(lines[i]).group(1))
        stop = next((j for j in range(i + 1, len(lines)) if (m := _HEADING.match(lines[j])) and len(m.group(1)) <= level), len(lines))
        return "\n".join(lines[i:stop]).strip()

    heads = [i for i, x in enumerate(lines) if _HEADING.match(x)]
    want = (topic or "").strip().lower()
    for test in (lambda i: anchor and heading_slug(lines[i]) == anchor.lstrip("#").lower(), lambda i: want and want in lines[i].lower()):
        for i in heads:
            if test(i):
                return below(i)
    return next((p.strip() for p in re.split(r"\n\s*\n", markdown or "") if want and want in p.lower()), None)

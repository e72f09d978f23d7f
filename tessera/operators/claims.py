"""Claims written as skeletons: rendering with exact tokens, tokens typed by hand, and whether a plan of claims holds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Placeholders of tokens in a skeleton, and shapes of tokens that should not be typed.
PLACEHOLDER = re.compile(r"\{\{(tok:[a-z0-9][a-z0-9-]*:\d{4})\}\}")
TYPED = (
    re.compile(r"\b(?:GET|POST|PUT|DELETE|PATCH|HEAD|OPTIONS)[ \t]+/[\w/{}.:-]*"),
    re.compile(r"\b[\w.+-]+(?:/[\w.+-]+)+\b"),
    re.compile(r"(?<![\w.])/[A-Za-z0-9_./{}:-]+"),
    re.compile(r"\b[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+\b"),
    re.compile(r"\b[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+\b"),
    re.compile(r"\b[A-Za-z_][\w.]*\(\)"),
)
_CODE = re.compile(r"`([^`\n]+)`")


def render_claim(skeleton: str, tokens: dict[str, str], evidence_ids: list[str]) -> str:
    """placeholders become tokens in back-ticks, blanks collapse, citations follow; unknown placeholders stay."""
    body = PLACEHOLDER.sub(lambda m: f"`{tokens[m.group(1)]}`" if m.group(1) in tokens else m.group(0), " ".join((skeleton or "").split()))
    cites = "".join(f"[{e}]" for e in evidence_ids)
    return f"{body} {cites}".strip()


def typed_tokens(skeleton: str | None) -> list[str]:
    """what a skeleton spells out instead of naming a placeholder: code spans, then identifier shapes in the rest, in order, once each."""
    plain = PLACEHOLDER.sub(" ", skeleton or "")
    found = [m.group(1).strip() for m in _CODE.finditer(plain) if m.group(1).strip()]
    blank = lambda m: " " * len(m.group())
    rest, shaped = _CODE.sub(blank, plain), []
    for shape in TYPED:
        shaped += [(m.start(), m.group()) for m in shape.finditer(rest)]
        rest = shape.sub(blank, rest)
    return list(dict.fromkeys([*found, *(t for _, t in sorted(shaped))]))


def claim_faults(claim: dict, *, tokens: dict[str, str], evidence: set[str], topics: set[str]) -> list[str]:
    """Codes of one claim: no_skeleton, uncited, unknown_evidence, unknown_token, undeclared_token, unused_token, typed_token, placeholder_text, unknown_topic."""
    skeleton, cited, named = claim.get("skeleton") or "", claim.get("evidence_ids") or [], claim.get("token_ids") or []
    used = PLACEHOLDER.findall(skeleton)
    out = []
    if not skeleton.strip():
        out.append("no_skeleton")
    if not cited:
        out.append("uncited")
    if set(cited) - evidence:
        out.append("unknown_evidence")
    if (set(used) | set(named)) - set(tokens):
        out.append("unknown_token")
    if set(used) - set(named):
        out.append("undeclared_token")
    if set(named) - set(used):
        out.append("unused_token")
    if typed_tokens(skeleton):
        out.append("typed_token")
    if "..." in skeleton or "…" in skeleton or "[ev:" in skeleton:
        out.append("placeholder_text")
    if claim.get("required_topic") and claim["required_topic"] not in topics:
        out.append("unknown_topic")
    return out


def typed_in(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, token)``: tokens that the texts of a table spell out; null texts have none."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(k, t) for k, x in zip(pdf["key"], pdf["text"]) for t in typed_tokens(x)], columns=["key", "token"])

    return src.mapInPandas(run, f"key {src.schema['key'].dataType.simpleString()}, token string").distinct().withColumnRenamed("key", key)


class UnreadableReport(ValueError):
    """A readiness report without status or failures."""


def parse_readiness(text: str) -> dict:
    """Status, failures and warnings of a readiness report; warnings may be absent."""

    def value(name: str, form: str) -> str | None:
        m = re.search(rf"^[-*_\s]*{name}[*_\s]*[:：][*_`\s]*({form})", text or "", re.I | re.M)
        return m.group(1) if m else None

    status, failures, warnings = value("status", r"[A-Za-z]+"), value("failures", r"\d+"), value("warnings", r"\d+")
    if status is None or failures is None:
        raise UnreadableReport("status or failures are missing")
    return {"status": status.upper(), "failures": int(failures), "warnings": None if warnings is None else int(warnings)}

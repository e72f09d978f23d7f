"""References inside plans: source fields, context artifacts, section roles and JSON pointers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folders that only hold planning context, those that are generated, and names of diagnostics.
CONTEXT_PREFIXES = ("derived/", "planner-digest/")
GENERATED_PREFIXES = ("derived/planning-", "planner-digest/")
DIAGNOSTIC_NAMES = ("planning-gaps.md",)
# Roles of sections that stand outside of the evidence lanes.
PROVENANCE_ROLES = ("provenance", "meta", "provenance_meta")


def source_field(field: Column) -> tuple[Column, Column]:
    """Name and index of ``retrieval_needs.files[2]``; the name is the last part, the index -1 where there is none."""
    name = F.regexp_extract(F.coalesce(field, F.lit("")), r"(?:^|\.)([^.\[\]]+)(?:\[\d+\])?$", 1)
    index = F.regexp_extract(F.coalesce(field, F.lit("")), r"\[(\d+)\]$", 1)
    return F.nullif(name, F.lit("")), F.when(index == "", -1).otherwise(index.cast("int"))


def clean_reference(ref: Column) -> Column:
    """The path of a reference: its anchor dropped, trimmed, with forward slashes."""
    return F.replace(F.trim(F.substring_index(F.trim(ref), ":", 1)), F.lit("\\"), F.lit("/"))


def context_artifact(ref: Column, names: tuple[str, ...] = ()) -> Column:
    """The path if it lies in a context folder or bears one of ``names``, else null."""
    path = clean_reference(ref)
    inside = path.startswith(CONTEXT_PREFIXES[0]) | path.startswith(CONTEXT_PREFIXES[1])
    return F.when(inside | F.element_at(F.split(path, "/"), -1).isin(*names, ""), F.nullif(path, F.lit("")))


def generated_context(ref: Column) -> Column:
    """Whether a reference lies in a generated context folder."""
    path = clean_reference(ref)
    return F.coalesce(path.startswith(GENERATED_PREFIXES[0]) | path.startswith(GENERATED_PREFIXES[1]), F.lit(False))


def diagnostic_artifact(ref: Column) -> Column:
    """The path if it names a planning diagnostic, else null."""
    path = clean_reference(ref)
    return F.when(F.element_at(F.split(path, "/"), -1).isin(*DIAGNOSTIC_NAMES), path)


def section_role(role: Column) -> Column:
    """Provenance for provenance and meta roles in any spelling, source for all others and null."""
    return F.when(F.replace(F.lower(F.trim(role)), F.lit("-"), F.lit("_")).isin(*PROVENANCE_ROLES), "provenance").otherwise("source")


def has_signal(*needs: Column) -> Column:
    """Whether any of the needs (arrays) holds something; null arrays hold nothing."""
    out = F.lit(False)
    for n in needs:
        out = out | (F.coalesce(F.size(n), F.lit(0)) > 0)
    return out


def derived_contract(marker: Column, n_paths: Column) -> Column:
    """Whether a contract was derived: it is marked so, or has no paths."""
    return F.coalesce(marker, F.lit(False)) | (F.coalesce(n_paths, F.lit(0)) == 0)


def pointer_parts(pointer: Column) -> Column:
    """P20: steps of a JSON pointer with ``~1`` and ``~0`` resolved; null for texts that are no pointer."""
    parts = F.transform(F.slice(F.split(pointer, "/"), 2, 1000), lambda x: F.replace(F.replace(x, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~")))
    return F.when(pointer.startswith("/"), parts)

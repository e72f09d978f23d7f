"""Files that no developer of the repository wrote by hand.

Each text is lexed, re-emitted in canonical layout and compared with the layout it has (``layout.py``): extreme
expansion marks minified code, a layout that repeats itself line by line generated code, dominance of numbers and
encoded strings data blobs. These reasons come from the layout alone, for every language and every size.

What tools and people lay out alike no layout can tell apart: generated code that went through a formatter,
third-party copies, migrations. For these there are side reasons: comments (never strings or prose) are searched for the
marks that tools and importers leave, texts are compared line by line with known third-party files, and names and folders
that only tools or package managers use count as well. Each row says whether its reasons come from the layout.

Defined results: null texts and files without a text give no row; an empty text is hand-written; repeated rows of a
file count once; null paths are judged by their text alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import layout

# Names and folders.
LOCK_NAMES = re.compile(r"(?:\.lock|(?:^|/)(?:go\.sum|package-lock\.json|npm-shrinkwrap\.json|pnpm-lock\.ya?ml|packages\.lock\.json|bun\.lockb))$")
TOOL_NAMES = re.compile(r"(?:_pb2(?:_grpc)?\.pyi?|\.pb(?:\.gw)?\.(?:go|cc|h)|_generated\.\w+|_gen\.go|\.g\.(?:ts|dart|cs)|\.gen\.\w+|\.designer\.cs|(?:^|/)zz_generated\.\w+)$")
VENDOR_DIRS = re.compile(r"(?:^|/)(?:vendor|_vendor|third[_-]?party|3rd[_-]?party|node_modules|bower_components|site-packages|dist-packages|extern|external|externals|bundled|static/libs)/")
MIGRATION = re.compile(r"^(?:Revision ID|revision\s*(?::\s*str\s*)?=)\s*:?\s*['\"]?\w+", re.M)
MIGRATION_DIRS = re.compile(r"(?:^|/)(?:migrations|alembic)/(?:versions/)?[^/]+\.\w+$")

# What tools and importers write into comments.
GENERATED_MARK = re.compile(
    r"code generated by|\bdo not (?:edit|modify)\b|\bauto-?generated\b|automatically generated|@generated\b|<auto-generated|^\W*generated (?:file\b|by\b|from\b)|machine[- ](?:written|generated)"
    r"|\b(?:produced|created|rendered|emitted|written) by \S+ v?\d+(?:\.\d+)+|edits (?:will be|get|are) (?:lost|overwritten)|changes (?:will be|get|are) (?:lost|overwritten)|rendered from template"
    r"|automatisch (?:erzeugt|generiert|erstellt)|nicht (?:von hand )?bearbeiten|généré automatiquement|ne pas modifier|generado automáticamente|no editar|gerado automaticamente|generato automaticamente|сгенерирован|自动生成",
    re.I,
)
VENDOR_MARK = re.compile(
    r"third[- ]party code\b|\bimported from upstream\b|\bvendored from\b|\bbundled copy of\b|^\W*\S+ v?\d+(?:\.\d+)+ - distributed under\b|\b(?:copied|taken|adapted|forked) from upstream\b|keep in sync with upstream",
    re.I,
)
_ANY_MARK = re.compile(r"generat|do not|gerado|generato|généré|automat|сгенерир|自动|nicht |machine|produced by|created by|rendered|emitted by|written by|overwritten|will be lost|third|upstream|vendored|bundled|distributed", re.I)

#: Parameters of the layout measures.
EXPANSION, UNIFORM, DOMINANCE = 5.0, 0.75, 0.45
LAYOUT_REASONS = ("minified", "uniform", "data")
UPSTREAM_SHARE, LINE_CHARS = 0.5, 12
#: Known third-party files up to this size are broadcast; beyond it their lines are joined.
KNOWN_BYTES = 64 << 20


def extension(path: str | None) -> str:
    name = (path or "").rsplit("/", 1)[-1].lower()
    return name.rsplit(".", 1)[-1] if "." in name else name


def _comments(text: str, ext: str) -> Iterator[str]:
    """Comments that begin their line."""
    family = layout.FAMILY.get(ext, "any")
    for m in layout.TOKENS[family].finditer(text):
        tok = m.group()
        if tok.startswith(layout.STARTS[family]) and not text[text.rfind("\n", 0, m.start()) + 1 : m.start()].strip():
            yield tok


def reasons(path: str | None, text: str, known: dict[str, frozenset[int]] | None = None) -> list[str]:
    """Why a file counts as not written by hand; empty if it is hand-written."""
    p = path or ""
    if not text.strip():
        return []
    ext, out = extension(path), []
    if LOCK_NAMES.search(p):
        out.append("lock")
    if TOOL_NAMES.search(p):
        out.append("tool_name")
    if VENDOR_DIRS.search(p):
        out.append("vendor_folder")
    if MIGRATION_DIRS.search(p) and MIGRATION.search(text):
        out.append("migration")
    if _ANY_MARK.search(text):
        for c in _comments(text, ext):
            if GENERATED_MARK.search(c):
                out.append("generated_mark")
                break
            if VENDOR_MARK.search(c):
                out.append("vendor_mark")
                break
    f = layout.measure(text, ext)
    if f.expansion >= EXPANSION and ext not in layout.PROSE:
        out.append("minified")
    if f.literals >= DOMINANCE:
        out.append("data")
    elif f.uniform >= UNIFORM and ext not in layout.PROSE | layout.SETTINGS:
        out.append("uniform")
    if known:
        own = {x for x in map(str.strip, text.split("\n")) if len(x) >= LINE_CHARS}
        hits: Counter[int] = Counter()
        for x in own:
            for i in known.get(x, ()):
                hits[i] += 1
        if hits and hits.most_common(1)[0][1] >= UPSTREAM_SHARE * len(own):
            # what layout a third-party copy has says nothing about a generator of this repository
            out = [*(x for x in out if x != "uniform"), "upstream"]
    return out


def known_lines(upstream: DataFrame, text: str = "text") -> dict[str, frozenset[int]] | None:
    """Lines of the known third-party files, each with the files that hold it; None beyond ``KNOWN_BYTES``."""
    src = upstream.select(upstream[text].alias("text")).filter("text IS NOT NULL").distinct()
    if src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n > KNOWN_BYTES:
        return None
    out: dict[str, set[int]] = {}
    for i, row in enumerate(src.toLocalIterator()):
        for x in {x.strip() for x in row.text.split("\n")}:
            if len(x) >= LINE_CHARS:
                out.setdefault(x, set()).add(i)
    return {x: frozenset(s) for x, s in out.items()}


def _line_hashes(df: DataFrame, key: str) -> DataFrame:
    """``(key, line)``: hashes of the distinct lines of at least ``LINE_CHARS`` characters of each text."""
    lines = F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")))
    return df.select(key, F.explode(F.filter(lines, lambda x: F.length(x) >= LINE_CHARS)).alias("x")).select(key, F.xxhash64("x").alias("line"))


def upstream_copies(texts: DataFrame, upstream: DataFrame, text: str = "text") -> DataFrame:
    """``file_id`` of each text that shares enough of its lines with one known file, by a join of line hashes."""
    own = _line_hashes(texts.select("file_id", "text").distinct(), "file_id")
    known = _line_hashes(upstream.select(upstream[text].alias("text")).filter("text IS NOT NULL").distinct().withColumn("up", F.xxhash64("text")), "up")
    total = own.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
    shared = own.join(known, "line").groupBy("file_id", "up").agg(F.count(F.lit(1)).alias("k")).groupBy("file_id").agg(F.max("k").alias("k"))
    return shared.join(total, "file_id").filter(F.col("k") >= UPSTREAM_SHARE * F.col("n")).select("file_id")


def classify_files(files: DataFrame, texts: DataFrame, upstream: DataFrame | None = None, *, file_id: str = "file_id", path: str = "path", text: str = "text") -> DataFrame:
    """``(file_id, handwritten, by_layout, reasons)`` of each file with a text; ``reasons`` is a sorted, comma-separated list."""
    spark = files.sparkSession
    lines = known_lines(upstream) if upstream is not None else {}
    known = spark.sparkContext.broadcast(lines or {})
    paths = files.select(files[file_id].alias("file_id"), files[path].alias("path")).filter("file_id IS NOT NULL").groupBy("file_id").agg(F.min("path").alias("path"))
    src = texts.select(texts[file_id].alias("file_id"), texts[text].alias("text")).filter("text IS NOT NULL")
    both = src.join(paths, "file_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            why = [sorted(reasons(p, t, known.value)) for p, t in zip(pdf["path"], pdf["text"])]
            yield pd.DataFrame({"file_id": pdf["file_id"], "reasons": [",".join(w) for w in why]})

    schema = T.StructType([both.schema["file_id"], T.StructField("reasons", T.StringType())])
    out = both.mapInPandas(run, schema)
    if lines is None:
        copies = upstream_copies(src.join(paths.select("file_id"), "file_id"), upstream).withColumn("upstream", F.lit("upstream"))
        out = out.join(copies, "file_id", "left").withColumn("reasons", F.concat_ws(",", F.when(F.col("upstream").isNull(), F.split("reasons", ",")).otherwise(F.array_sort(F.filter(F.concat(F.split("reasons", ","), F.array("upstream")), lambda x: ~x.isin("", "uniform")))))).drop("upstream")
    by_layout = F.arrays_overlap(F.split("reasons", ","), F.array(*map(F.lit, LAYOUT_REASONS)))
    return out.select("file_id", (F.col("reasons") == "").alias("handwritten"), by_layout.alias("by_layout"), "reasons")

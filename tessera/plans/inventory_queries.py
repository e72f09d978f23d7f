"""Queries on the file inventory, scalar expressions and chunkers, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.chunking import boundary_sections, line_windows, markdown_sections, text_lines
from tessera.operators.tables import count_by, one_per_key
from tessera.session import table

WINDOW, OVERLAP = 40, 8
PHRASE = "release note"


def _files(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"])


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).join(table(spark, d, "file_texts").select("file_id", "text"), "file_id")


def inventory_files(spark: SparkSession, d: str) -> DataFrame:
    """Derived fields of each file that has a text."""
    x = _texts(spark, d)
    return x.select(
        "file_id",
        S.base_name(F.col("path")).alias("name"),
        S.extension(F.col("path")).alias("ext"),
        S.top_dir(F.col("path")).alias("top_dir"),
        S.language_for(S.extension(F.col("path")), S.base_name(F.col("path"))).alias("language"),
        S.line_count(F.col("text")).alias("line_count"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.sha2("text", 256).alias("sha256"),
        S.indexable(F.col("path"), F.octet_length("text")).alias("indexable"),
    )


def inventory_classify(spark: SparkSession, d: str) -> DataFrame:
    """Category and flags of each path."""
    p = F.col("path")
    return _files(spark, d).select("file_id", S.classify(p).alias("category"), S.is_generated(p).alias("is_generated"), S.is_vendor(p).alias("is_vendor"))


def inventory_rollup(spark: SparkSession, d: str) -> DataFrame:
    """A2: counts by category, by top folder and in total, with one pass of grouping sets."""
    f = _files(spark, d).select(S.classify(F.col("path")).alias("category"), S.top_dir(F.col("path")).alias("top_dir"))
    out = f.groupingSets([["category"], ["top_dir"], []], "category", "top_dir").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    return out.select(F.when(F.col("g") == 1, "category").when(F.col("g") == 2, "top_dir").otherwise("all").alias("dimension"), F.coalesce("category", "top_dir", F.lit("")).alias("value"), "n")


def inventory_top_dirs(spark: SparkSession, d: str) -> DataFrame:
    """The ten largest top folders, ties by name."""
    f = _files(spark, d).select(S.top_dir(F.col("path")).alias("top_dir"))
    return count_by(f, "top_dir", 10).select(F.col("key").alias("top_dir"), "n")


def inventory_distinct_paths(spark: SparkSession, d: str) -> DataFrame:
    """Distinct paths of the chunk corpus, one column read."""
    return table(spark, d, "chunks").select("path").filter("path IS NOT NULL").distinct()


def inventory_read_text(spark: SparkSession, d: str) -> DataFrame:
    """S3: texts that are readable: below the cap and without NUL in their first 8,000 characters."""
    t = table(spark, d, "file_texts")
    ok = (F.octet_length("text") <= S.TEXT_CAP) & (F.instr(F.substring("text", 1, 8000), "\0") == 0)
    return t.select("file_id", ok.alias("readable"), F.when(ok, F.length("text")).cast("long").alias("n_chars"))


def inventory_modules(spark: SparkSession, d: str) -> DataFrame:
    """Module -> path of Python files; of several paths the last one holds."""
    f = _files(spark, d).filter(F.col("path").rlike(r"\.py[ix]?$"))
    return f.groupBy("repo", S.module_dotted(F.col("path")).alias("module")).agg(F.max("path").alias("path"), F.count(F.lit(1)).alias("n_paths"))


def scalar_text(spark: SparkSession, d: str) -> DataFrame:
    """Size, slug, label and clipped excerpt of documents."""
    t = F.col("text")
    x = table(spark, d, "documents").filter("text IS NOT NULL")
    title = F.regexp_extract(t, r"^#{1,6} ([^\n]*)", 1)
    return x.select("doc_id", S.token_estimate(t).alias("tokens"), S.slug(F.regexp_replace(title, r"[^\x00-\x7F]", "")).alias("slug"), S.kebab(title).alias("label"), F.length(S.clip(t, 240)).cast("long").alias("clipped"))


def scalar_bounded(spark: SparkSession, d: str) -> DataFrame:
    """P10: documents with a bounded phrase."""
    return table(spark, d, "documents").filter(S.bounded(F.col("text"), PHRASE)).select("doc_id")


def scalar_anchor(spark: SparkSession, d: str) -> DataFrame:
    """Anchors of chunks written and read back, in both orders."""
    c = one_per_key(table(spark, d, "chunks"), "chunk_id", ["path", "start_line", "end_line"])
    ref = F.concat("path", F.lit(":"), F.col("end_line").cast("string"), F.lit("-"), F.col("start_line").cast("string"))
    return c.select("chunk_id", ref.alias("anchor"), S.anchor_start(ref).alias("a_start"), S.anchor_end(ref).alias("a_end"), F.greatest(F.col("end_line") - F.col("start_line") + 1, F.lit(0)).alias("n_lines"))


def chunk_windows(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping line windows over all file texts with ids and hashes."""
    w = line_windows(table(spark, d, "file_texts"), ["file_id"], "text", length=WINDOW, overlap=OVERLAP)
    return w.select("file_id", "start_line", "end_line", S.token_estimate(F.col("text")).alias("tokens"), F.sha2("text", 256).alias("sha256"))


def chunk_toml(spark: SparkSession, d: str) -> DataFrame:
    """Sections of TOML files by their headers."""
    x = text_lines(_texts(spark, d).filter(F.col("path").endswith(".toml")).withColumn("text", F.replace("text", F.lit("\r"), F.lit(""))), ["file_id"], "text")
    pat = r"^\s*\[+([^\]]+)\]+"
    s = boundary_sections(x, ["file_id"], F.col("line").rlike(pat), F.trim(F.regexp_extract("line", pat, 1)))
    return s.select("file_id", F.col("title").alias("section"), "start_line", "end_line")


def chunk_yaml(spark: SparkSession, d: str) -> DataFrame:
    """Top-level keys of YAML files."""
    x = text_lines(_texts(spark, d).filter(F.col("path").rlike(r"\.ya?ml$")).withColumn("text", F.replace("text", F.lit("\r"), F.lit(""))), ["file_id"], "text")
    pat = r"^([A-Za-z_][\w.\-]*)\s*:"
    s = boundary_sections(x, ["file_id"], F.col("line").rlike(pat), F.regexp_extract("line", pat, 1))
    return s.select("file_id", F.col("title").alias("section"), "start_line", "end_line")


def chunk_dockerfile(spark: SparkSession, d: str) -> DataFrame:
    """Build stages of Dockerfiles."""
    x = text_lines(_texts(spark, d).filter(F.col("path").endswith(".dockerfile")).withColumn("text", F.replace("text", F.lit("\r"), F.lit(""))), ["file_id"], "text")
    pat = r"^FROM\s+\S+(?:\s+AS\s+(\S+))?"
    s = boundary_sections(x, ["file_id"], F.col("line").rlike(pat), F.regexp_extract("line", pat, 1))
    return s.select("file_id", F.col("title").alias("stage"), "start_line", "end_line")


def chunk_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Heading paths of Markdown files, fences respected."""
    x = text_lines(_texts(spark, d).filter(F.col("path").endswith(".md")).withColumn("text", F.replace("text", F.lit("\r"), F.lit(""))), ["file_id"], "text")
    return markdown_sections(x, ["file_id"]).select("file_id", "heading_path", F.col("level").cast("long").alias("level"), "start_line", "end_line")


def chunk_schema_gate(spark: SparkSession, d: str) -> DataFrame:
    """Defects of the chunk table: null keys and keys that occur more than once."""
    c = table(spark, d, "chunks")
    missing = c.select(*(F.sum(F.col(k).isNull().cast("long")).alias(k) for k in ("chunk_id", "path", "text", "sha256")))
    nulls = missing.unpivot([], ["chunk_id", "path", "text", "sha256"], "field", "n").select(F.lit("null").alias("defect"), F.col("field").alias("handle"), "n")
    dup = c.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("repeated").alias("defect"), F.col("chunk_id").alias("handle"), "n")
    return nulls.filter("n > 0").unionByName(dup)


_F = "(SELECT file_id, max(repo) AS repo, max(path) AS path FROM files WHERE file_id IS NOT NULL GROUP BY file_id)"
_T = f"(SELECT f.file_id, f.repo, f.path, t.text FROM {_F} f JOIN file_texts t ON f.file_id = t.file_id)"
_NAME = "list_extract(string_split(path, '/'), -1)"
_EXT = f"lower(regexp_extract({_NAME}, '[^.](\\.[^.]+)$', 1))"
_TOP = "CASE WHEN contains(path, '/') THEN string_split(path, '/')[1] ELSE '(root)' END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_GEN = f"({_NAME} IN {_in(S.GENERATED_NAMES)} OR " + " OR ".join(f"suffix({_NAME}, '{e}')" for e in S.GENERATED_ENDS) + " OR contains('/' || lower(path), '/migrations/versions/'))"
_VEN = "(" + " OR ".join(f"contains('/' || path, '{p}')" for p in S.VENDOR_PARTS) + ")"
_LANG = f"CASE WHEN starts_with(lower({_NAME}), 'dockerfile') THEN 'dockerfile' WHEN lower({_NAME}) IN ('go.mod', 'go.sum') THEN 'go-mod' WHEN lower({_NAME}) = 'makefile' THEN 'makefile' " + " ".join(
    f"WHEN {_EXT} = '{e}' THEN '{k}'" for e, k in S.EXTENSIONS.items()
) + " ELSE 'other' END"
_CODE = _in([e for e, k in S.EXTENSIONS.items() if k not in ("markdown", "text", "rst")])
_CLASS = f"""CASE WHEN {_EXT} IN {_in(S.BINARY)} THEN 'asset' WHEN {_GEN} THEN 'generated' WHEN {_VEN} THEN 'vendor'
WHEN lower({_NAME}) LIKE '%dockerfile%' OR lower({_NAME}) LIKE '%docker-compose%' OR lower(path) LIKE 'docker/%' OR lower(path) LIKE 'helm/%' OR '/' || lower(path) LIKE '%/.github/workflows/%'
  OR (lower(path) LIKE '%.tmpl' AND lower(path) LIKE '%helm%') OR lower({_NAME}) IN ('build.sh', 'entrypoint.sh') OR lower(path) LIKE 'deploy/%' OR '/' || lower(path) LIKE '%/k8s/%' THEN 'deployment'
WHEN '/' || lower(path) LIKE '%/test/%' OR '/' || lower(path) LIKE '%/tests/%' OR contains('/' || lower(path), '/__tests__/') OR starts_with(lower({_NAME}), 'test_') OR lower({_NAME}) = 'conftest.py'
  OR suffix(lower(path), '_test.go') OR suffix(lower(path), '_test.py') OR suffix(lower(path), '.test.ts') OR suffix(lower(path), '.test.tsx') OR suffix(lower(path), '.spec.ts') THEN 'test'
WHEN {_EXT} IN ('.md', '.mdx', '.rst') OR lower(path) LIKE 'docs/%' THEN 'docs'
WHEN {_EXT} IN ('.toml', '.cfg', '.ini', '.env', '.yaml', '.yml', '.json') OR ({_EXT} = '' AND starts_with({_NAME}, '.env')) OR {_NAME} IN {_in(S.CONFIG_NAMES)} OR lower(path) LIKE 'conf/%' THEN 'config'
WHEN {_EXT} IN {_CODE} THEN 'source' ELSE 'other' END"""
_ALL_EXT = _in(S.EXTENSIONS)


def _sections(where: str, pattern: str, title: str) -> str:
    return f"""WITH l AS (
  SELECT file_id, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line, generate_subscripts(string_split(replace(text, chr(13), ''), chr(10)), 1) AS line_no FROM {_T} WHERE {where}),
m AS (SELECT *, regexp_matches(line, '{pattern}') AS b FROM l),
s AS (SELECT *, sum(CASE WHEN b THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY line_no) AS section_no FROM m)
SELECT file_id, coalesce(max(CASE WHEN b THEN trim(regexp_extract(line, '{pattern}', 1)) END), '(preamble)') AS {title}, CAST(min(line_no) AS INTEGER) AS start_line, CAST(max(line_no) AS INTEGER) AS end_line
FROM s GROUP BY file_id, section_no"""


_H = "\n".join(f", last_value(CASE WHEN level = {k} THEN line_no END IGNORE NULLS) OVER w AS p{k}, last_value(CASE WHEN level = {k} THEN title END IGNORE NULLS) OVER w AS t{k}" for k in range(1, 7))
_PATH = ", ".join(f"CASE WHEN level >= {k} AND p{k} > greatest(0, {', '.join([f'coalesce(p{j}, 0)' for j in range(1, k)] or ['0'])}) THEN t{k} END" for k in range(1, 7))

QUERIES = {
    f.__name__: f
    for f in (
        inventory_files, inventory_classify, inventory_rollup, inventory_top_dirs, inventory_distinct_paths, inventory_read_text, inventory_modules, scalar_text, scalar_bounded, scalar_anchor,
        chunk_windows, chunk_toml, chunk_yaml, chunk_dockerfile, chunk_markdown, chunk_schema_gate,
    )
}

ORACLE = {
    "inventory_files": f"""SELECT file_id, {_NAME} AS name, {_EXT} AS ext, {_TOP} AS top_dir, {_LANG} AS language,
CASE WHEN text = '' THEN 0 WHEN suffix(text, chr(10)) THEN length(text) - length(replace(text, chr(10), '')) ELSE length(text) - length(replace(text, chr(10), '')) + 1 END AS line_count,
strlen(text) AS size_bytes, sha256(text) AS sha256, ({_EXT} NOT IN {_in(S.BINARY)} AND NOT {_GEN} AND NOT {_VEN} AND {_EXT} IN {_ALL_EXT} AND strlen(text) <= {S.TEXT_CAP}) AS indexable FROM {_T}""",
    "inventory_classify": f"SELECT file_id, {_CLASS} AS category, {_GEN} AS is_generated, {_VEN} AS is_vendor FROM {_F}",
    "inventory_rollup": f"""WITH f AS (SELECT {_CLASS} AS category, {_TOP} AS top_dir FROM {_F})
SELECT 'category' AS dimension, category AS value, count(*) AS n FROM f GROUP BY category UNION ALL SELECT 'top_dir', top_dir, count(*) FROM f GROUP BY top_dir UNION ALL SELECT 'all', '', count(*) FROM f""",
    "inventory_top_dirs": f"SELECT {_TOP} AS top_dir, count(*) AS n FROM {_F} GROUP BY 1 ORDER BY n DESC, top_dir LIMIT 10",
    "inventory_distinct_paths": "SELECT DISTINCT path FROM chunks WHERE path IS NOT NULL",
    "inventory_read_text": f"""SELECT file_id, (strlen(text) <= {S.TEXT_CAP} AND NOT contains(substring(text, 1, 8000), chr(0))) AS readable,
CASE WHEN strlen(text) <= {S.TEXT_CAP} AND NOT contains(substring(text, 1, 8000), chr(0)) THEN length(text) END AS n_chars FROM file_texts""",
    "inventory_modules": rf"""SELECT repo, regexp_replace(replace(regexp_replace(regexp_replace(path, '^src/', ''), '\.(?:py|pyi|pyx)$', ''), '/', '.'), '(?:^|\.)__init__$', '') AS module, max(path) AS path, count(*) AS n_paths
FROM {_F} WHERE regexp_matches(path, '\.py[ix]?$') GROUP BY 1, 2""",
    "scalar_text": r"""WITH t AS (SELECT doc_id, text, regexp_extract(text, '^#{1,6} ([^\n]*)', 1) AS title FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, substring(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(title, '[^\x00-\x7F]', '', 'g'))), '[ \-_/.]', '-', 'g'), '[^\p{L}\p{N}\-]', '', 'g'), '-{2,}', '-', 'g'), '^-+|-+$', '', 'g'), 1, 64) AS sl FROM t)
SELECT doc_id, (length(text) + 3) // 4 AS tokens, CASE WHEN sl = '' THEN 'item' ELSE sl END AS slug, regexp_replace(regexp_replace(lower(title), '[^0-9a-z]+', '-', 'g'), '^-|-$', '', 'g') AS label,
CASE WHEN length(text) > 240 THEN length(regexp_replace(substring(text, 1, 240), '[ \t\n\x0b\f\r]+$', '')) + 13 ELSE length(text) END AS clipped FROM s""",
    "scalar_bounded": f"SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|[^a-z0-9]){PHRASE}($|[^a-z0-9])')",
    "scalar_anchor": """SELECT chunk_id, max(path) || ':' || max(end_line) || '-' || max(start_line) AS anchor, least(max(start_line), max(end_line)) AS a_start, greatest(max(start_line), max(end_line)) AS a_end,
greatest(max(end_line) - max(start_line) + 1, 0) AS n_lines FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id""",
    "chunk_windows": f"""WITH t AS (SELECT file_id, string_split(text, chr(10)) AS lines FROM file_texts WHERE text IS NOT NULL),
k AS (SELECT *, unnest(range(0, 1 + CAST(ceil(greatest(len(lines) - {WINDOW}, 0) / {WINDOW - OVERLAP}.0) AS INTEGER))) AS i FROM t),
w AS (SELECT file_id, 1 + i * {WINDOW - OVERLAP} AS a, least(i * {WINDOW - OVERLAP} + {WINDOW}, len(lines)) AS z, lines FROM k),
x AS (SELECT file_id, a, z, array_to_string(lines[a:z], chr(10)) AS text FROM w)
SELECT file_id, CAST(a AS INTEGER) AS start_line, CAST(z AS INTEGER) AS end_line, (length(text) + 3) // 4 AS tokens, sha256(text) AS sha256 FROM x""",
    "chunk_toml": _sections("suffix(path, '.toml')", r"^\s*\[+([^\]]+)\]+", "section"),
    "chunk_yaml": _sections("regexp_matches(path, '\\.ya?ml$')", r"^([A-Za-z_][\w.\-]*)\s*:", "section"),
    "chunk_dockerfile": _sections("suffix(path, '.dockerfile')", r"^FROM\s+\S+(?:\s+AS\s+(\S+))?", "stage"),
    "chunk_markdown": rf"""WITH l AS (
  SELECT file_id, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line, generate_subscripts(string_split(replace(text, chr(13), ''), chr(10)), 1) AS line_no FROM {_T} WHERE suffix(path, '.md')),
f AS (SELECT *, starts_with(ltrim(line), '```') OR starts_with(ltrim(line), '~~~') AS fence FROM l),
i AS (SELECT *, (sum(CASE WHEN fence THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY line_no)) % 2 = 1 OR fence AS inside FROM f),
h AS (SELECT *, CASE WHEN NOT inside AND regexp_matches(line, '^(#{{1,6}})\s+(.*\S)\s*$') THEN length(regexp_extract(line, '^(#{{1,6}})\s+(.*\S)\s*$', 1)) END AS level, regexp_extract(line, '^(#{{1,6}})\s+(.*\S)\s*$', 2) AS title FROM i),
s AS (SELECT *, count(level) OVER w AS section_no {_H} FROM h WINDOW w AS (PARTITION BY file_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
p AS (SELECT *, CASE WHEN level IS NOT NULL THEN concat_ws(' > ', {_PATH}) END AS path FROM s)
SELECT file_id, coalesce(max(path), '(preamble)') AS heading_path, max(level) AS level, CAST(min(line_no) AS INTEGER) AS start_line, CAST(max(line_no) AS INTEGER) AS end_line FROM p GROUP BY file_id, section_no""",
    "chunk_schema_gate": """SELECT 'null' AS defect, handle, n FROM (
SELECT 'chunk_id' AS handle, count(*) FILTER (chunk_id IS NULL) AS n FROM chunks UNION ALL SELECT 'path', count(*) FILTER (path IS NULL) FROM chunks
UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM chunks UNION ALL SELECT 'sha256', count(*) FILTER (sha256 IS NULL) FROM chunks) WHERE n > 0
UNION ALL SELECT 'repeated', chunk_id, count(*) FROM chunks GROUP BY chunk_id HAVING count(*) > 1""",
}

"""Queries on coverage, lineage, obligations and the texts of sections, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.chunking import text_lines
from tessera.operators.joins import first_per
from tessera.operators.pyast import parse_python
from tessera.operators.tables import one_per_key
from tessera.session import ship_package, table

#: Detectors as (family, kind, token); kinds: ext, dir, name (bounded in the base name), path (prefix).
DETECTORS = (
    ("documentation", "ext", ".md"), ("documentation", "dir", "docs"), ("testing", "dir", "tests"), ("testing", "name", "test"), ("deployment", "dir", "deploy"), ("deployment", "ext", ".dockerfile"),
    ("configuration", "ext", ".toml"), ("configuration", "ext", ".yaml"), ("configuration", "path", "conf/"), ("data", "ext", ".sql"), ("data", "name", "record"), ("interface", "path", "api/"), ("interface", "dir", "web"),
)
PAGE_CAP = 4


def _files(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"])


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "sections"), "section_id", ["repo", "title", "section_role", "page_profile", "priority", "section_order", "parent_section_id", "markdown"])


def _used(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").filter("section_id IS NOT NULL").select("section_id", F.explode("used_evidence_ids").alias("evidence_id")).filter("evidence_id IS NOT NULL").distinct()


def _topics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").filter("section_id IS NOT NULL").select("section_id", F.explode("covered_topics").alias("topic")).filter("topic IS NOT NULL").distinct()


def _reasons(spark: SparkSession, d: str) -> DataFrame:
    det = F.broadcast(spark.createDataFrame(list(DETECTORS), "family string, kind string, token string"))
    f = _files(spark, d).filter("path IS NOT NULL").filter(~S.is_generated(F.col("path")) & ~S.is_vendor(F.col("path")) & ~S.extension(F.col("path")).isin(*S.BINARY))
    f = f.withColumn("low", F.lower("path")).withColumn("base", F.element_at(F.split("low", "/"), -1)).withColumn("ext", S.extension(F.col("path")))
    t = F.col("token")
    fits = (
        F.when(F.col("kind") == "ext", F.col("ext") == t)
        .when(F.col("kind") == "dir", F.array_contains(F.slice(F.split("low", "/"), 1, F.size(F.split("low", "/")) - 1), t))
        .when(F.col("kind") == "name", F.regexp_like("base", F.concat(F.lit("(?<![a-z0-9])"), t, F.lit("(?![a-z0-9])"))))
        .otherwise(F.col("low").startswith(t))
    )
    return f.join(det, fits).select("repo", "path", "family", F.concat_ws(":", "kind", "token").alias("reason"))


def catalog_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Files that signal one of seven example families, with their sorted reasons; family_candidates has the thirteen families of B10."""
    return _reasons(spark, d).groupBy("repo", "path", "family").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))


def catalog_topics(spark: SparkSession, d: str) -> DataFrame:
    """On catalog_candidates: a topic for each family of a repository, with status by files alone, and one for each folder of a present family with two folders or more."""
    c = _reasons(spark, d).select("repo", "family", "path").distinct()
    top = c.groupBy("repo", "family").agg(F.count(F.lit(1)).alias("files")).withColumn("status", S.signal_status(F.col("files"), F.lit(0), F.lit(0)))
    kid = c.withColumn("facet", S.top_dir(F.col("path"))).groupBy("repo", "family", "facet").agg(F.count(F.lit(1)).alias("files"))
    wide = kid.join(top.filter("status = 'present'").select("repo", "family"), ["repo", "family"], "left_semi")
    n = wide.groupBy("repo", "family").agg(F.count(F.lit(1)).alias("facets")).filter("facets >= 2")
    wide = wide.join(n, ["repo", "family"], "left_semi").withColumn("status", S.signal_status(F.col("files"), F.lit(0), F.lit(0)))
    return top.withColumn("facet", F.lit("")).select("repo", "family", "facet", "files", "status").unionByName(wide.select("repo", "family", "facet", "files", "status"))


def coverage_breadth(spark: SparkSession, d: str) -> DataFrame:
    """A22, A24, V7 and of A23 one of four levels (density by role): sections of each role against the pages their topics need, four topics a page."""
    s = _sections(spark, d).withColumn("role", F.coalesce("section_role", F.lit("")))
    t = _topics(spark, d).join(s.select("section_id", "repo", "role"), "section_id").groupBy("repo", "role").agg(F.countDistinct("topic").alias("topics"))
    p = s.groupBy("repo", "role").agg(F.count(F.lit(1)).alias("pages"))
    x = p.join(t, ["repo", "role"], "left").withColumn("topics", F.coalesce("topics", F.lit(0)))
    floor = F.ceil(F.col("topics") / PAGE_CAP).cast("long")
    return x.select("repo", "role", "pages", "topics", floor.alias("floor"), (F.col("pages") < floor).alias("compressed"))


def coverage_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Each topic of a section through evidence and citation: the first broken link."""
    cited = _sections(spark, d).select("section_id", F.explode(F.regexp_extract_all("markdown", F.lit(r"\[(EV-\d+)\]"), F.lit(1))).alias("evidence_id")).distinct()
    e = _used(spark, d).join(cited.withColumn("cited", F.lit(1)), ["section_id", "evidence_id"], "left").groupBy("section_id").agg(F.count(F.lit(1)).alias("mapped"), F.sum(F.coalesce("cited", F.lit(0))).alias("cited"))
    x = _topics(spark, d).join(e, "section_id", "left")
    state = F.when(F.coalesce("mapped", F.lit(0)) == 0, "no_evidence").when(F.col("cited") == 0, "not_cited").when(F.col("cited") < F.col("mapped"), "partly_cited").otherwise("complete")
    return x.select("section_id", "topic", state.alias("state"))


def coverage_obligations(spark: SparkSession, d: str) -> DataFrame:
    """The one defect of each section that comes first in precedence, with counts by repository."""
    n = _used(spark, d).groupBy("section_id").agg(F.count(F.lit(1)).alias("mapped"))
    t = _topics(spark, d).groupBy("section_id").agg(F.count(F.lit(1)).alias("topics"))
    x = _sections(spark, d).join(n, "section_id", "left").join(t, "section_id", "left")
    code = F.when(F.coalesce("topics", F.lit(0)) == 0, "no_topic").when(F.coalesce("mapped", F.lit(0)) == 0, "no_evidence").when(F.col("mapped") < F.col("topics"), "thin").otherwise("complete")
    return x.groupBy("repo", code.alias("code")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("priority") == "must").alias("blocking"))


def dedupe_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Labels of section titles, unique in a repository by numbers in id order."""
    s = _sections(spark, d).select("section_id", "repo", S.kebab(F.coalesce("title", F.lit(""))).alias("slug")).withColumn("slug", F.when(F.col("slug") == "", "section").otherwise(F.col("slug")))
    n = F.row_number().over(Window.partitionBy("repo", "slug").orderBy("section_id"))
    return s.withColumn("n", n).select("section_id", F.when(F.col("n") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", F.col("n").cast("string"))).alias("slug"))


def text_query(spark: SparkSession, d: str) -> DataFrame:
    """Search text of each section: title, labels and topics, first spelling of each kept in order."""
    s = table(spark, d, "sections").filter("section_id IS NOT NULL").select("section_id", F.concat(F.array("title"), F.coalesce("coverage_labels", F.expr("cast(array() as array<string>)")), F.coalesce("covered_topics", F.expr("cast(array() as array<string>)"))).alias("parts"))
    e = s.select("section_id", F.posexplode("parts").alias("pos", "part")).withColumn("part", F.trim("part")).filter("part <> ''")
    one = e.groupBy("section_id", F.lower("part").alias("key")).agg(F.min(F.struct("pos", "part")).alias("first"))
    return one.groupBy("section_id").agg(F.array_sort(F.collect_list("first")).alias("all")).select("section_id", F.array_join("all.part", " ").alias("query"))


def text_uncited(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of sections, code and headings left out, with and without citations."""
    body = F.regexp_replace("markdown", r"(?s)```.*?```", "")
    p = _sections(spark, d).select("section_id", F.explode(F.split(body, r"\n[ \t]*\n")).alias("p")).withColumn("p", F.trim(F.regexp_replace("p", r"(?m)^#{1,6} .*$", "")))
    p = p.withColumn("p", F.regexp_replace("p", r"^\s+|\s+$", "")).filter("p <> ''")
    return p.groupBy("section_id").agg(F.count(F.lit(1)).alias("paragraphs"), F.count_if(~F.col("p").rlike(r"\[EV-\d+\]")).alias("uncited"))


def text_near_citations(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of documents that look like citations but are none, with their line."""
    lines = text_lines(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], "text")
    x = lines.select("doc_id", "line_no", F.explode(F.regexp_extract_all(F.regexp_replace("line", r"\[EV-\d{6}\]", ""), F.lit(r"\[?\b[Ee][Vv][ _-]?\d+\]?"), F.lit(0))).alias("token"))
    kind = F.when(~F.col("token").startswith("["), "bare").when(~F.col("token").endswith("]"), "dangling").when(~F.col("token").contains("EV-"), "spelling").otherwise("digits")
    return x.groupBy("doc_id", "line_no", "token").agg(F.max(kind).alias("kind"), F.count(F.lit(1)).alias("n")).withColumn("line_no", F.col("line_no").cast("long"))


def text_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Assignments in shell and environment files with one step of expansion; names with several values are dropped."""
    f = _files(spark, d).filter(F.col("path").rlike(r"\.(sh|env)$")).join(table(spark, d, "file_texts").select("file_id", F.replace("text", F.lit("\r"), F.lit("")).alias("text")), "file_id")
    pat = r"^\s*(?:export\s+)?([A-Za-z_]\w*)=([^\s\"'`;|&<>]*)\s*$"
    a = text_lines(f, ["file_id"], "text").filter(F.col("line").rlike(pat)).select("file_id", F.regexp_extract("line", pat, 1).alias("name"), F.regexp_extract("line", pat, 2).alias("value"))
    one = a.groupBy("file_id", "name").agg(F.min("value").alias("value"), F.countDistinct("value").alias("k")).filter("k = 1").drop("k")
    ref = one.withColumn("of", F.nullif(F.regexp_extract("value", r"^\$\{?([A-Za-z_]\w*)\}?", 1), F.lit("")))
    other = one.select("file_id", F.col("name").alias("of"), F.col("value").alias("inner"))
    x = ref.join(other, ["file_id", "of"], "left")
    return x.select("file_id", "name", "value", F.when(F.col("of").isNull(), F.col("value")).when(F.col("inner").isNotNull(), F.concat("inner", F.regexp_replace("value", r"^\$\{?[A-Za-z_]\w*\}?", ""))).alias("expanded"))


def span_headers(spark: SparkSession, d: str) -> DataFrame:
    """Header range of each module: from its first line to the line above its first definition."""
    s = one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "path", "kind", "start_line", "end_line"])
    first = s.filter("kind IN ('class', 'function')").groupBy("repo", "path").agg(F.min("start_line").alias("first_def"))
    m = s.filter("kind = 'module'").join(first, ["repo", "path"], "left")
    last = F.greatest(F.lit(1), F.least(F.coalesce("first_def", "end_line") - 1, F.col("end_line")))
    return m.select("symbol_id", last.cast("long").alias("last_line"))


def rank_handles(spark: SparkSession, d: str) -> DataFrame:
    """Up to twenty representative symbols of each repository: classes, tests, then others, by position inside each kind."""
    s = one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "path", "name", "kind", "start_line"])
    group = F.when(F.col("kind") == "class", 0).when(F.col("name").startswith("test_"), 1).when(F.col("kind") == "module", 3).otherwise(2)
    x = s.withColumn("g", group)
    x = first_per(x, ["repo", "g"], [F.col("path"), F.col("start_line"), F.col("symbol_id")], 8, "k")
    return first_per(x, ["repo"], [F.col("g"), F.col("k"), F.col("symbol_id")], 20).select("repo", "place", "symbol_id")


def ast_contracts(spark: SparkSession, d: str) -> DataFrame:
    """Operations by route and method of the Python files."""
    ship_package(spark)
    f = _files(spark, d).filter(F.col("path").rlike(r"\.py$"))
    r = parse_python(f.join(table(spark, d, "file_texts"), "file_id")).filter("kind = 'route'").join(f.select("file_id", "repo"), "file_id")
    route = F.regexp_replace("name", "<([^<>]+)>", "{$1}")
    return r.select("repo", route.alias("route"), F.explode(F.split("detail", ",")).alias("method"), F.col("scope").alias("handler")).groupBy("repo", "route", "method").agg(F.max("handler").alias("handler"))


_F = "(SELECT file_id, max(repo) AS repo, max(path) AS path FROM files WHERE file_id IS NOT NULL GROUP BY file_id)"
_SEC = "(SELECT section_id, max(repo) AS repo, max(title) AS title, max(section_role) AS section_role, max(priority) AS priority, max(markdown) AS markdown FROM sections WHERE section_id IS NOT NULL GROUP BY section_id)"
_USED = "(SELECT DISTINCT section_id, evidence_id FROM (SELECT section_id, unnest(used_evidence_ids) AS evidence_id FROM sections WHERE section_id IS NOT NULL) WHERE evidence_id IS NOT NULL)"
_TOPICS = "(SELECT DISTINCT section_id, topic FROM (SELECT section_id, unnest(covered_topics) AS topic FROM sections WHERE section_id IS NOT NULL) WHERE topic IS NOT NULL)"
_SYM = "(SELECT symbol_id, max(repo) AS repo, max(path) AS path, max(name) AS name, max(kind) AS kind, max(start_line) AS start_line, max(end_line) AS end_line FROM symbols WHERE symbol_id IS NOT NULL GROUP BY symbol_id)"


def _reason_sql() -> str:
    from tessera.plans.inventory_queries import _EXT, _GEN, _VEN, _in

    base = "list_extract(string_split(lower(path), '/'), -1)"
    tests = {"ext": f"{_EXT} = '{{}}'", "dir": "list_contains(list_slice(string_split(lower(path), '/'), 1, len(string_split(lower(path), '/')) - 1), '{}')", "name": f"regexp_matches({base}, '(^|[^a-z0-9]){{}}($|[^a-z0-9])')", "path": "starts_with(lower(path), '{}')"}
    keep = f"NOT {_GEN} AND NOT {_VEN} AND {_EXT} NOT IN {_in(S.BINARY)}"
    return "(" + " UNION ALL ".join(f"SELECT repo, path, '{f}' AS family, '{k}:{t}' AS reason FROM {_F} WHERE path IS NOT NULL AND {keep} AND {tests[k].format(t)}" for f, k, t in DETECTORS) + ")"


_STATUS = "CASE WHEN files = 0 THEN 'missing' WHEN files >= 3 THEN 'present' ELSE 'low' END"

QUERIES = {
    f.__name__: f
    for f in (
        catalog_candidates, catalog_topics, coverage_breadth, coverage_lineage, coverage_obligations, dedupe_slugs, text_query, text_uncited, text_near_citations, text_assignments, span_headers, rank_handles, ast_contracts,
    )
}

ORACLE = {
    "catalog_candidates": f"SELECT repo, path, family, array_to_string(list_sort(list(DISTINCT reason)), ',') AS reasons FROM {_reason_sql()} GROUP BY repo, path, family",
    "catalog_topics": f"""WITH c AS (SELECT DISTINCT repo, family, path FROM {_reason_sql()}), top AS (SELECT repo, family, count(*) AS files FROM c GROUP BY ALL),
kid AS (SELECT repo, family, CASE WHEN contains(path, '/') THEN string_split(path, '/')[1] ELSE '(root)' END AS facet, count(*) AS files FROM c GROUP BY ALL),
w AS (SELECT k.*, count(*) OVER (PARTITION BY k.repo, k.family) AS n FROM kid k JOIN top t ON k.repo = t.repo AND k.family = t.family WHERE t.files >= 3)
SELECT repo, family, '' AS facet, files, {_STATUS} AS status FROM top UNION ALL SELECT repo, family, facet, files, {_STATUS} FROM w WHERE n >= 2""",
    "coverage_breadth": f"""WITH s AS (SELECT *, coalesce(section_role, '') AS role FROM {_SEC}), t AS (SELECT s.repo, s.role, count(DISTINCT topic) AS topics FROM {_TOPICS} t JOIN s USING (section_id) GROUP BY 1, 2), p AS (SELECT repo, role, count(*) AS pages FROM s GROUP BY ALL)
SELECT p.repo, p.role, pages, coalesce(topics, 0) AS topics, CAST(ceil(coalesce(topics, 0) / {PAGE_CAP}.0) AS BIGINT) AS floor, pages < ceil(coalesce(topics, 0) / {PAGE_CAP}.0) AS compressed FROM p LEFT JOIN t ON p.repo = t.repo AND p.role = t.role""",
    "coverage_lineage": f"""WITH c AS (SELECT DISTINCT section_id, unnest(regexp_extract_all(markdown, '\\[(EV-\\d+)\\]', 1)) AS evidence_id FROM {_SEC}),
e AS (SELECT u.section_id, count(*) AS mapped, count(c.evidence_id) AS cited FROM {_USED} u LEFT JOIN c ON u.section_id = c.section_id AND u.evidence_id = c.evidence_id GROUP BY u.section_id)
SELECT t.section_id, t.topic, CASE WHEN coalesce(mapped, 0) = 0 THEN 'no_evidence' WHEN cited = 0 THEN 'not_cited' WHEN cited < mapped THEN 'partly_cited' ELSE 'complete' END AS state FROM {_TOPICS} t LEFT JOIN e ON t.section_id = e.section_id""",
    "coverage_obligations": f"""WITH n AS (SELECT section_id, count(*) AS mapped FROM {_USED} GROUP BY 1), t AS (SELECT section_id, count(*) AS topics FROM {_TOPICS} GROUP BY 1),
x AS (SELECT s.*, mapped, topics FROM {_SEC} s LEFT JOIN n USING (section_id) LEFT JOIN t USING (section_id))
SELECT repo, CASE WHEN coalesce(topics, 0) = 0 THEN 'no_topic' WHEN coalesce(mapped, 0) = 0 THEN 'no_evidence' WHEN mapped < topics THEN 'thin' ELSE 'complete' END AS code, count(*) AS n, count(*) FILTER (priority = 'must') AS blocking FROM x GROUP BY 1, 2""",
    "dedupe_slugs": f"""WITH k AS (SELECT section_id, repo, regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^0-9a-z]+', '-', 'g'), '^-|-$', '', 'g') AS s FROM {_SEC}), l AS (SELECT section_id, repo, CASE WHEN s = '' THEN 'section' ELSE s END AS slug FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY repo, slug ORDER BY section_id) AS n FROM l) SELECT section_id, CASE WHEN n = 1 THEN slug ELSE slug || '-' || n END AS slug FROM r""",
    "text_query": """WITH s AS (SELECT section_id, list_concat(list_concat([title], coalesce(coverage_labels, [])), coalesce(covered_topics, [])) AS parts FROM sections WHERE section_id IS NOT NULL),
e AS (SELECT section_id, generate_subscripts(parts, 1) AS pos, trim(unnest(parts)) AS part FROM s), o AS (SELECT section_id, lower(part) AS key, min(struct_pack(pos := pos, part := part)) AS f FROM e WHERE part <> '' GROUP BY ALL)
SELECT section_id, string_agg(f.part, ' ' ORDER BY f.pos) AS query FROM o GROUP BY section_id""",
    "text_uncited": rf"""WITH b AS (SELECT section_id, unnest(regexp_split_to_array(regexp_replace(markdown, '(?s)```.*?```', '', 'g'), '\n[ \t]*\n')) AS p FROM {_SEC}),
c AS (SELECT section_id, regexp_replace(trim(regexp_replace(p, '(?m)^#{{1,6}} .*$', '', 'g')), '^\s+|\s+$', '', 'g') AS p FROM b)
SELECT section_id, count(*) AS paragraphs, count(*) FILTER (NOT regexp_matches(p, '\[EV-\d+\]')) AS uncited FROM c WHERE p <> '' GROUP BY section_id""",
    "text_near_citations": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, line_no, unnest(regexp_extract_all(regexp_replace(line, '\[EV-\d{6}\]', '', 'g'), '\[?\b[Ee][Vv][ _-]?\d+\]?')) AS token FROM l)
SELECT doc_id, line_no, token, max(CASE WHEN NOT starts_with(token, '[') THEN 'bare' WHEN NOT suffix(token, ']') THEN 'dangling' WHEN NOT contains(token, 'EV-') THEN 'spelling' ELSE 'digits' END) AS kind, count(*) AS n FROM t GROUP BY doc_id, line_no, token""",
    "text_assignments": rf"""WITH l AS (SELECT f.file_id, unnest(string_split(replace(t.text, chr(13), ''), chr(10))) AS line FROM {_F} f JOIN file_texts t ON f.file_id = t.file_id WHERE regexp_matches(f.path, '\.(sh|env)$')),
a AS (SELECT file_id, regexp_extract(line, '^\s*(?:export\s+)?([A-Za-z_]\w*)=([^\s"''`;|&<>]*)\s*$', 1) AS name, regexp_extract(line, '^\s*(?:export\s+)?([A-Za-z_]\w*)=([^\s"''`;|&<>]*)\s*$', 2) AS value FROM l WHERE regexp_matches(line, '^\s*(?:export\s+)?([A-Za-z_]\w*)=([^\s"''`;|&<>]*)\s*$')),
o AS (SELECT file_id, name, min(value) AS value FROM a GROUP BY file_id, name HAVING count(DISTINCT value) = 1), r AS (SELECT *, nullif(regexp_extract(value, '^\$\{{?([A-Za-z_]\w*)\}}?', 1), '') AS ref FROM o)
SELECT r.file_id, r.name, r.value, CASE WHEN r.ref IS NULL THEN r.value WHEN i.value IS NOT NULL THEN i.value || regexp_replace(r.value, '^\$\{{?[A-Za-z_]\w*\}}?', '') END AS expanded FROM r LEFT JOIN o i ON r.file_id = i.file_id AND r.ref = i.name""",
    "span_headers": f"WITH d AS (SELECT repo, path, min(start_line) AS first_def FROM {_SYM} WHERE kind IN ('class', 'function') GROUP BY ALL) SELECT m.symbol_id, CAST(greatest(1, least(coalesce(first_def, end_line) - 1, end_line)) AS BIGINT) AS last_line FROM {_SYM} m LEFT JOIN d ON m.repo = d.repo AND m.path = d.path WHERE m.kind = 'module'",
    "rank_handles": f"""WITH x AS (SELECT *, CASE WHEN kind = 'class' THEN 0 WHEN starts_with(name, 'test_') THEN 1 WHEN kind = 'module' THEN 3 ELSE 2 END AS g FROM {_SYM}), k AS (SELECT *, row_number() OVER (PARTITION BY repo, g ORDER BY path, start_line, symbol_id) AS k FROM x),
r AS (SELECT repo, symbol_id, row_number() OVER (PARTITION BY repo ORDER BY g, k, symbol_id) AS place FROM k WHERE k <= 8) SELECT repo, place, symbol_id FROM r WHERE place <= 20""",
}

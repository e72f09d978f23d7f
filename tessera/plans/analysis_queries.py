"""Queries on pattern packs, the graph, parsed Python, gates and evidence lanes, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.chunking import text_lines
from tessera.operators.graph import build_graph, degrees, hubs, neighbours, whole_graph
from tessera.operators.joins import first_per, overlap_join
from tessera.operators.patterns import PACKS, SKIPPED, digest, preview, preview_texts, scan
from tessera.operators.pyast import parse_python
from tessera.operators.references import import_targets, resolve_calls
from tessera.operators.search import fingerprint
from tessera.operators.tables import one_per_key
from tessera.plans.relational_queries import join_mentions, join_tests
from tessera.session import checkpoint, ship_package, table


def _files(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"])


def _symbols(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "path", "name", "kind", "parent_symbol_id", "bases", "start_line", "end_line"])


def _lines(spark: SparkSession, d: str) -> DataFrame:
    t = _files(spark, d).join(table(spark, d, "file_texts").select("file_id", F.replace("text", F.lit("\r"), F.lit("")).alias("text")), "file_id")
    return text_lines(t, ["file_id", "path"], "text")


def _scan(spark: SparkSession, d: str) -> DataFrame:
    return scan(_lines(spark, d), ["file_id", "path"], "path")


def scan_packs(spark: SparkSession, d: str) -> DataFrame:
    """Matching lines of all packs with the number of matches."""
    return _scan(spark, d).select("pack", "file_id", F.col("line_no").cast("long").alias("line_no"), F.col("n_matches").cast("long").alias("n_matches"), "first_match")


def scan_digest(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty hits of each pack with totals."""
    hits = checkpoint(_scan(spark, d).select("pack", "path", "file_id", "line_no", F.substring("line", 1, 240).alias("line")))
    x = digest(hits, ["path", "line_no", "file_id"], 20)
    return x.select("pack", "file_id", F.col("line_no").cast("long").alias("line_no"), F.substring("line", 1, 240).alias("text"), "place", "total", "truncated")


def scan_top_files(spark: SparkSession, d: str) -> DataFrame:
    """The three files with most hits of each pack."""
    n = _scan(spark, d).groupBy("pack", "path").agg(F.count(F.lit(1)).alias("n"))
    return first_per(n, ["pack"], [F.desc("n"), F.col("path")], 3)


def scan_preview(spark: SparkSession, d: str) -> DataFrame:
    """X4 for three packs, as its SQL has it: hits with two lines around them; scan_previews has the hits of all packs and their symbols."""
    hits = _scan(spark, d).filter(F.col("pack").isin("entrypoints", "web_routes", "auth_security"))
    return preview(hits, _lines(spark, d), ["file_id"]).select("file_id", "pack", F.col("line_no").cast("long").alias("line_no"), "context")


def scan_previews(spark: SparkSession, d: str) -> DataFrame:
    """Every hit of every pack with two lines around it and the smallest symbol around it (null at module level)."""
    t = _files(spark, d).join(table(spark, d, "file_texts").select("file_id", F.replace("text", F.lit("\r"), F.lit("")).alias("text")), "file_id")
    got = checkpoint(preview_texts(t, ["file_id", "repo", "path"], "path", "text"))
    raw = table(spark, d, "symbols")
    more = F.coalesce(F.array_size("decorators"), F.lit(0)) if "decorators" in raw.columns else F.lit(0)
    s = one_per_key(raw, "symbol_id", ["repo", "path", "kind", "start_line", "end_line", *(["decorators"] if "decorators" in raw.columns else [])])
    s = s.filter("kind <> 'module'").select("symbol_id", "repo", "path", (F.col("start_line") - more).alias("r_start"), F.col("end_line").alias("r_end"))
    at = got.select("file_id", "repo", "path", "line_no").distinct().withColumns({"l_start": F.col("line_no"), "l_end": F.col("line_no")})
    near = overlap_join(at, s, ["repo", "path"]).withColumn("size", F.col("r_end") - F.col("r_start"))
    within = first_per(near, ["file_id", "line_no"], [F.col("size"), F.col("symbol_id")], 1).select("file_id", "line_no", "symbol_id")
    return got.join(within, ["file_id", "line_no"], "left").select("file_id", "pack", F.col("line_no").cast("long").alias("line_no"), "context", "symbol_id")


def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of repositories, files and symbols with labels; graph_whole_nodes has all node types."""
    return build_graph(_files(spark, d), _symbols(spark, d))[0]


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """G2, G3 and of J8 the bases that are unique classes: containment and inheritance edges whose ends exist; graph_whole_edges has all edge types."""
    return build_graph(_files(spark, d), _symbols(spark, d))[1]


def graph_types(spark: SparkSession, d: str) -> DataFrame:
    """A3 on graph_nodes and graph_edges: numbers of nodes and edges by type."""
    nodes, edges = build_graph(_files(spark, d), _symbols(spark, d))
    return nodes.groupBy(F.concat(F.lit("node:"), "type").alias("type")).agg(F.count(F.lit(1)).alias("n")).unionByName(edges.groupBy(F.concat(F.lit("edge:"), "type").alias("type")).agg(F.count(F.lit(1)).alias("n")))


def graph_hubs(spark: SparkSession, d: str) -> DataFrame:
    """A4, R6 on graph_edges: the 30 nodes with most edges, ties by id."""
    _, edges = build_graph(_files(spark, d), _symbols(spark, d))
    x = degrees(edges).withColumn("total", F.col("n_in") + F.col("n_out"))
    return x.orderBy(F.desc("total"), "node_id").limit(30)


def graph_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """J18 on graph_edges: up to eight neighbours of every class; lane_graph adds their sources."""
    nodes, edges = build_graph(_files(spark, d), _symbols(spark, d))
    return neighbours(edges, nodes.filter("type = 'class'"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    t = _files(spark, d).filter(F.col("path").rlike(r"\.py[ix]?$")).join(table(spark, d, "file_texts"), "file_id")
    return parse_python(t)


def _whole_graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    files = checkpoint(_files(spark, d))
    raw = table(spark, d, "symbols")
    more = ["decorators"] if "decorators" in raw.columns else []
    s = one_per_key(raw, "symbol_id", ["repo", "path", "name", "kind", "parent_symbol_id", "bases", "start_line", "end_line", *more])
    if not more:
        s = s.withColumn("decorators", F.lit(None).cast("array<string>"))
    parsed = checkpoint(_parsed(spark, d).filter("kind IN ('import', 'call')").join(files, "file_id"))
    return whole_graph(files, checkpoint(s), parsed, join_tests(spark, d), join_mentions(spark, d), table(spark, d, "documents"))


def graph_whole_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Repositories, files, tests, configuration, symbols, dependencies and documents."""
    return _whole_graph(spark, d)[0]


def graph_whole_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of all seven types whose ends exist."""
    return _whole_graph(spark, d)[1]


def graph_whole_types(spark: SparkSession, d: str) -> DataFrame:
    """A3: numbers of nodes and edges by type, on the whole graph."""
    nodes, edges = _whole_graph(spark, d)
    return nodes.groupBy(F.concat(F.lit("node:"), "type").alias("type")).agg(F.count(F.lit(1)).alias("n")).unionByName(edges.groupBy(F.concat(F.lit("edge:"), "type").alias("type")).agg(F.count(F.lit(1)).alias("n")))


def graph_whole_hubs(spark: SparkSession, d: str) -> DataFrame:
    """The 30 nodes with most edges of each type, by source and by target, and over all types, on the whole graph."""
    return hubs(_whole_graph(spark, d)[1])


def graph_whole_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Up to eight neighbours of every class, on the whole graph."""
    nodes, edges = _whole_graph(spark, d)
    return neighbours(edges, nodes.filter("type = 'class'"))


def ast_rows(spark: SparkSession, d: str) -> DataFrame:
    """Symbols, imports, routes, calls, constants and module docs of all Python files."""
    return _parsed(spark, d)


def ast_external_imports(spark: SparkSession, d: str) -> DataFrame:
    """Imported packages that are no module of the repository, by number of imports."""
    i = _parsed(spark, d).filter("kind = 'import' AND name NOT LIKE '.%'").select("file_id", F.regexp_extract("name", r"^[^.:]+", 0).alias("package"))
    f = _files(spark, d).select("file_id", "repo")
    own = _files(spark, d).filter("path LIKE '%.py'").select("repo", F.regexp_replace(F.substring_index(F.regexp_replace("path", "^src/", ""), "/", 1), r"\.py$", "").alias("package")).distinct()
    return i.join(f, "file_id").join(own, ["repo", "package"], "left_anti").groupBy("repo", "package").agg(F.count(F.lit(1)).alias("n"))


def ast_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls resolved to a top-level definition of the same file, else to an imported one, else to a unique name of the repository; calls of oneself are dropped."""
    files = checkpoint(_files(spark, d))
    p = checkpoint(_parsed(spark, d).filter("kind IN ('function', 'method', 'class', 'import', 'call')").join(files, "file_id"))
    own = F.concat_ws(".", F.nullif(F.col("scope"), F.lit("")), "name")
    defs = p.filter("kind IN ('function', 'method', 'class')").select("repo", "path", "name", F.concat("path", F.lit(":"), own).alias("target_id"), (F.col("scope") == "").alias("top"))
    c = p.filter("kind = 'call'").select("file_id", "repo", "path", F.col("scope").alias("caller"), "name", "start_line")
    x = resolve_calls(c, import_targets(files, p), defs).filter(~F.col("target_id").eqNullSafe(F.concat("path", F.lit(":"), "caller")))
    return x.select("file_id", "caller", "callee", "start_line", "confidence")


def gate_sections(spark: SparkSession, d: str) -> DataFrame:
    """Defects of sections: missing fields, no evidence, citation of nothing."""
    s = one_per_key(table(spark, d, "sections"), "section_id", ["title", "section_role", "priority", "markdown", "used_evidence_ids"])
    codes = F.array(
        F.when(F.coalesce("title", F.lit("")) == "", "no_title"),
        F.when(F.col("section_role").isNull(), "no_role"),
        F.when(F.col("priority").isNull(), "no_priority"),
        F.when(F.coalesce("markdown", F.lit("")) == "", "no_text"),
        F.when(F.coalesce(F.size("used_evidence_ids"), F.lit(0)) <= 0, "no_evidence"),
    )
    return s.select("section_id", F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("defect"))


def gate_freshness(spark: SparkSession, d: str) -> DataFrame:
    """A19, and of V15 a comparison of loads: whether the first load of each repository equals its present state; index_states consults the stored index."""
    c = table(spark, d, "chunks").filter("chunk_id IS NOT NULL")
    now = fingerprint(one_per_key(c, "chunk_id", ["repo", "sha256"]), "chunk_id", "sha256", ["repo"])
    first = fingerprint(c.groupBy("chunk_id").agg(F.max("repo").alias("repo"), F.min("sha256").alias("sha256")), "chunk_id", "sha256", ["repo"]).withColumnRenamed("fingerprint", "indexed")
    return now.join(first, "repo", "left").select("repo", F.when(F.col("indexed").isNull(), "missing").when(F.col("indexed") == F.col("fingerprint"), "verified").otherwise("stale").alias("state"))


def gate_capabilities(spark: SparkSession, d: str) -> DataFrame:
    """Which surfaces have rows, as one row."""
    names = ("files", "file_texts", "chunks", "symbols", "sections", "documents", "embeddings")
    out = None
    for n in names:
        part = table(spark, d, n).limit(1).agg((F.count(F.lit(1)) > 0).alias(n))
        out = part if out is None else out.crossJoin(part)
    return out.withColumn("retrieval_mode", F.when(F.col("embeddings"), "hybrid").otherwise("lexical"))


def gate_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Topics by number of sections and mapped evidence: sufficient, weak or missing."""
    s = table(spark, d, "sections").filter("section_id IS NOT NULL").select("section_id", "covered_topics", "used_evidence_ids")
    t = s.select("section_id", F.explode("covered_topics").alias("topic"), "used_evidence_ids")
    e = t.select("topic", "section_id", F.explode_outer("used_evidence_ids").alias("e"))
    g = e.groupBy("topic").agg(F.countDistinct("section_id").alias("sections"), F.countDistinct("e").alias("mapped"))
    return g.select("topic", "sections", "mapped", F.when(F.col("mapped") >= 3, "sufficient").when(F.col("mapped") > 0, "weak").otherwise("missing").alias("status"))


def lane_files(spark: SparkSession, d: str) -> DataFrame:
    """Of E1 and J19 the lookup by path, without range anchors and spans: of each document with a path: the first three chunks of that file, or why there are none."""
    docs = table(spark, d, "documents").filter("path IS NOT NULL").select("doc_id", "repo", "path")
    c = one_per_key(table(spark, d, "chunks"), "chunk_id", ["repo", "path", "start_line"])
    first = first_per(c.filter("path IS NOT NULL"), ["repo", "path"], [F.col("start_line"), F.col("chunk_id")], 3)
    top = docs.join(first, ["repo", "path"]).select("doc_id", "place", "chunk_id")
    known = _files(spark, d).select("repo", "path", F.lit(True).alias("known")).distinct()
    lost = docs.join(top.select("doc_id").distinct(), "doc_id", "left_anti").join(known, ["repo", "path"], "left")
    return top.withColumn("state", F.lit("hit")).unionByName(lost.select("doc_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("chunk_id"), F.when(F.col("known"), "no_hits").otherwise("unresolved").alias("state")))


def lane_summary(spark: SparkSession, d: str) -> DataFrame:
    """Of A29 one lane: per repository requested, returned and missing files."""
    x = lane_files(spark, d).groupBy("doc_id").agg(F.max((F.col("state") == "hit").cast("long")).alias("hit"))
    r = table(spark, d, "documents").filter("path IS NOT NULL").select("doc_id", "repo")
    return x.join(r, "doc_id").groupBy("repo").agg(F.count(F.lit(1)).alias("requested"), F.sum("hit").alias("returned"), F.sum(1 - F.col("hit")).alias("missing"))


def events_payload(spark: SparkSession, d: str) -> DataFrame:
    """JSON payloads of events read leniently: the value, and whether the text parsed."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k.isNotNull().cast("long")).alias("parsed"), F.sum(k).alias("total"))


_F = "(SELECT file_id, max(repo) AS repo, max(path) AS path FROM files WHERE file_id IS NOT NULL GROUP BY file_id)"
_S = "(SELECT symbol_id, max(repo) AS repo, max(path) AS path, max(name) AS name, max(kind) AS kind, max(parent_symbol_id) AS parent_symbol_id, max(bases) AS bases FROM symbols WHERE symbol_id IS NOT NULL GROUP BY symbol_id)"
_LINES = f"(SELECT file_id, path, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT f.file_id, f.path, string_split(replace(t.text, chr(13), ''), chr(10)) AS ls FROM {_F} f JOIN file_texts t ON f.file_id = t.file_id))"


def _pack_sql(name: str) -> str:
    pattern, ends, _ = PACKS[name]
    pattern = pattern.replace("'", "''")
    fits = " OR ".join(f"suffix(path, '{e}')" for e in ends.split())
    skip = ", ".join(f"'{s}'" for s in SKIPPED)
    return f"SELECT '{name}' AS pack, file_id, path, line_no, line, len(regexp_extract_all(line, '{pattern}')) AS n_matches, regexp_extract(line, '{pattern}') AS first_match FROM {_LINES} WHERE ({fits}) AND regexp_matches(line, '{pattern}') AND NOT list_has_any(string_split(path, '/'), [{skip}])"


_SCAN = "(" + " UNION ALL ".join(map(_pack_sql, PACKS)) + ")"
_NODES = f"""nodes AS (SELECT node_id, max(type) AS type, max(repo) AS repo, max(label) AS label FROM (
SELECT 'repo:' || repo AS node_id, 'repository' AS type, repo, repo AS label FROM {_F} UNION ALL SELECT 'file:' || repo || '/' || path, 'file', repo, path FROM {_F}
UNION ALL SELECT 'sym:' || symbol_id, kind, repo, concat_ws(' ', name, '[' || kind || ']') FROM {_S}) GROUP BY node_id)"""
_EDGES = f"""{_NODES}, uc AS (SELECT repo, name, min(symbol_id) AS base_id FROM {_S} WHERE kind = 'class' GROUP BY repo, name HAVING count(*) = 1),
raw AS (SELECT DISTINCT * FROM (SELECT 'repo:' || repo AS src, 'CONTAINS' AS type, 'file:' || repo || '/' || path AS dst FROM {_F}
UNION ALL SELECT 'file:' || repo || '/' || path, 'CONTAINS', 'sym:' || symbol_id FROM {_S} WHERE kind = 'module'
UNION ALL SELECT 'sym:' || parent_symbol_id, 'CONTAINS', 'sym:' || symbol_id FROM {_S} WHERE parent_symbol_id <> '' AND parent_symbol_id <> symbol_id
UNION ALL SELECT 'sym:' || b.symbol_id, 'INHERITS', 'sym:' || uc.base_id FROM (SELECT repo, symbol_id, unnest(bases) AS base FROM {_S} WHERE kind = 'class') b JOIN uc ON b.repo = uc.repo AND b.base = uc.name WHERE b.symbol_id <> uc.base_id)),
edges AS (SELECT * FROM raw WHERE src IN (SELECT node_id FROM nodes) AND dst IN (SELECT node_id FROM nodes))"""
_LANE = f"""docs AS (SELECT doc_id, repo, path FROM documents WHERE path IS NOT NULL), c AS (SELECT chunk_id, max(repo) AS repo, max(path) AS path, max(start_line) AS start_line FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id),
top AS (SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start_line, chunk_id) AS place, chunk_id FROM docs JOIN c USING (repo, path)) WHERE place <= 3),
lane AS (SELECT doc_id, place, chunk_id, 'hit' AS state FROM top UNION ALL SELECT d.doc_id, NULL, NULL, CASE WHEN f.path IS NOT NULL THEN 'no_hits' ELSE 'unresolved' END FROM docs d LEFT JOIN (SELECT DISTINCT repo, path FROM {_F}) f ON d.repo = f.repo AND d.path = f.path WHERE d.doc_id NOT IN (SELECT doc_id FROM top))"""

QUERIES = {
    f.__name__: f
    for f in (
        scan_packs, scan_digest, scan_top_files, scan_preview, scan_previews, graph_nodes, graph_edges, graph_types, graph_hubs, graph_neighbours,
        graph_whole_nodes, graph_whole_edges, graph_whole_types, graph_whole_hubs, graph_whole_neighbours, ast_rows, ast_external_imports, ast_calls,
        gate_sections, gate_freshness, gate_capabilities, gate_coverage, lane_files, lane_summary, events_payload,
    )
}

ORACLE = {
    "scan_packs": f"SELECT pack, file_id, line_no, n_matches, first_match FROM {_SCAN}",
    "scan_digest": f"SELECT pack, file_id, line_no, substring(line, 1, 240) AS text, place, total, total > 20 AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY pack ORDER BY path, line_no, file_id) AS place, count(*) OVER (PARTITION BY pack) AS total FROM {_SCAN}) WHERE place <= 20",
    "scan_top_files": f"SELECT * FROM (SELECT pack, path, n, row_number() OVER (PARTITION BY pack ORDER BY n DESC, path) AS place FROM (SELECT pack, path, count(*) AS n FROM {_SCAN} GROUP BY ALL)) WHERE place <= 3",
    "scan_preview": f"SELECT s.file_id, s.pack, s.line_no, string_agg(l.line, chr(10) ORDER BY l.line_no) AS context FROM {_SCAN} s JOIN {_LINES} l ON s.file_id = l.file_id AND l.line_no BETWEEN s.line_no - 2 AND s.line_no + 2 WHERE s.pack IN ('entrypoints', 'web_routes', 'auth_security') GROUP BY ALL",
    "graph_nodes": f"WITH {_NODES} SELECT * FROM nodes",
    "graph_edges": f"WITH {_EDGES} SELECT * FROM edges",
    "graph_types": f"WITH {_EDGES} SELECT 'node:' || type AS type, count(*) AS n FROM nodes GROUP BY 1 UNION ALL SELECT 'edge:' || type, count(*) FROM edges GROUP BY 1",
    "graph_hubs": f"WITH {_EDGES}, e AS (SELECT src AS node_id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) SELECT node_id, CAST(sum(i) AS BIGINT) AS n_in, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) + sum(o) AS BIGINT) AS total FROM e GROUP BY node_id ORDER BY total DESC, node_id LIMIT 30",
    "graph_neighbours": f"WITH {_EDGES}, b AS (SELECT src AS node_id, type, dst AS neighbour FROM edges UNION ALL SELECT dst, type, src FROM edges), n AS (SELECT node_id, neighbour, min(CASE type WHEN 'CONTAINS' THEN 0 ELSE 1 END) AS p FROM b WHERE node_id IN (SELECT node_id FROM nodes WHERE type = 'class') GROUP BY ALL) SELECT node_id, place, neighbour FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY p, neighbour) AS place FROM n) WHERE place <= 8",
    "gate_sections": """WITH s AS (SELECT section_id, max(title) AS title, max(section_role) AS r, max(priority) AS p, max(markdown) AS m, max(used_evidence_ids) AS u FROM sections WHERE section_id IS NOT NULL GROUP BY section_id)
SELECT section_id, 'no_title' AS defect FROM s WHERE coalesce(title, '') = '' UNION ALL SELECT section_id, 'no_role' FROM s WHERE r IS NULL UNION ALL SELECT section_id, 'no_priority' FROM s WHERE p IS NULL
UNION ALL SELECT section_id, 'no_text' FROM s WHERE coalesce(m, '') = '' UNION ALL SELECT section_id, 'no_evidence' FROM s WHERE coalesce(len(u), 0) <= 0""",
    "gate_freshness": """WITH a AS (SELECT chunk_id, max(repo) AS repo, max(sha256) AS x, min(sha256) AS y FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id)
SELECT repo, CASE WHEN string_agg(chunk_id || chr(9) || coalesce(x, ''), chr(10) ORDER BY chunk_id) = string_agg(chunk_id || chr(9) || coalesce(y, ''), chr(10) ORDER BY chunk_id) THEN 'verified' ELSE 'stale' END AS state FROM a GROUP BY repo""",
    "gate_capabilities": "SELECT " + ", ".join(f"(SELECT count(*) > 0 FROM {n}) AS {n}" for n in ("files", "file_texts", "chunks", "symbols", "sections", "documents", "embeddings")) + ", CASE WHEN (SELECT count(*) > 0 FROM embeddings) THEN 'hybrid' ELSE 'lexical' END AS retrieval_mode",
    "gate_coverage": """WITH t AS (SELECT section_id, unnest(covered_topics) AS topic, used_evidence_ids AS u FROM sections WHERE section_id IS NOT NULL),
e AS (SELECT topic, section_id, unnest(CASE WHEN coalesce(len(u), 0) = 0 THEN [NULL] ELSE u END) AS e FROM t)
SELECT topic, count(DISTINCT section_id) AS sections, count(DISTINCT e) AS mapped, CASE WHEN count(DISTINCT e) >= 3 THEN 'sufficient' WHEN count(DISTINCT e) > 0 THEN 'weak' ELSE 'missing' END AS status FROM e GROUP BY topic""",
    "lane_files": f"WITH {_LANE} SELECT * FROM lane",
    "lane_summary": f"WITH {_LANE}, x AS (SELECT doc_id, max(CASE WHEN state = 'hit' THEN 1 ELSE 0 END) AS hit FROM lane GROUP BY doc_id) SELECT repo, count(*) AS requested, CAST(sum(hit) AS BIGINT) AS returned, CAST(sum(1 - hit) AS BIGINT) AS missing FROM x JOIN docs USING (doc_id) GROUP BY repo",
    "events_payload": "SELECT event_type, count(*) AS n, count(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS parsed, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type",
}

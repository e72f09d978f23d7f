"""Pages, their sources and their texts: graph lane, source map, summaries, embed texts, support of identifiers, drafts and outlines, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.hierarchy import hierarchies, resolve_hierarchy
from tessera.operators.joins import first_per
from tessera.operators.tables import one_per_key
from tessera.plans import lane_queries as lanes
from tessera.plans.analysis_queries import graph_neighbours
from tessera.plans.analysis_queries import ORACLE as _ANALYSIS
from tessera.plans.hierarchy_queries import _WALK
from tessera.plans.record_queries import PLACEHOLDERS, _chunks, _q, _sections, _symbols
from tessera.plans.record_queries import _CH, _SE, _SY
from tessera.session import checkpoint, table

ROUTES_SHOWN, EMBED_CHARS = 40, 2000


def lane_graph(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of each class with their source: a symbol's own span, else the first chunk of its file, else none (low); observed ones are medium."""
    near = graph_neighbours(spark, d)
    s = _symbols(spark, d).select(F.concat(F.lit("sym:"), "symbol_id").alias("neighbour"), "repo", "path", "span_id")
    first = first_per(_chunks(spark, d).filter("path IS NOT NULL"), ["repo", "path"], [F.col("start_line"), F.col("chunk_id")], 1).select(F.concat(F.lit("file:"), "repo", F.lit("/"), "path").alias("file"), F.col("chunk_id"))
    x = near.join(s, "neighbour", "left").withColumn("file", F.when(F.col("neighbour").startswith("file:"), F.col("neighbour")).otherwise(F.concat(F.lit("file:"), "repo", F.lit("/"), "path")))
    x = x.join(first, "file", "left")
    source = F.coalesce("span_id", "chunk_id")
    return x.select("node_id", "place", "neighbour", source.alias("source"), F.when(source.isNull(), "low").otherwise("medium").alias("confidence"))


def source_map(spark: SparkSession, d: str) -> DataFrame:
    """Of each module page and lane the requests, handles and citeable handles; a page without any citeable handle fails its floor.

    Files and symbols may be cited by spans and chunks, tests by chunks only.
    """
    asked, got = (checkpoint(x) for x in lanes._hits(spark, d))
    chunks = _chunks(spark, d).select(F.col("chunk_id").alias("item"), F.lit(True).alias("chunk"))
    spans = _symbols(spark, d).filter("span_id IS NOT NULL").select(F.col("span_id").alias("item")).distinct().withColumn("span", F.lit(True))
    x = got.join(chunks, "item", "left").join(spans, "item", "left")
    ok = F.col("chunk").isNotNull() | (F.col("lane") != "test") & F.col("span").isNotNull()
    n = x.groupBy("section_id", "lane").agg(F.countDistinct("item").alias("handles"), F.countDistinct(F.when(ok, F.col("item"))).alias("citeable"))
    y = asked.groupBy("section_id", "lane").agg(F.count(F.lit(1)).alias("requests")).join(n, ["section_id", "lane"], "left")
    total = n.groupBy("section_id").agg((F.sum("citeable") > 0).alias("page"))
    y = y.join(total, "section_id", "left")
    return y.select("section_id", "lane", "requests", F.coalesce("handles", F.lit(0)).cast("long").alias("handles"), F.coalesce("citeable", F.lit(0)).cast("long").alias("citeable"), F.coalesce("page", F.lit(False)).alias("floor_met"))


def api_summary(spark: SparkSession, d: str) -> DataFrame:
    """The first forty routes of each repository with their verbs, and how many more there are."""
    x = lanes.operations(spark, d).groupBy("repo", "route").agg(F.array_join(F.array_sort(F.collect_set("method")), ",").alias("methods"))
    n = x.groupBy("repo").agg(F.count(F.lit(1)).alias("total"))
    top = first_per(x, ["repo"], [F.col("route")], ROUTES_SHOWN)
    return top.join(n, "repo").select("repo", "place", "route", "methods", F.greatest(F.lit(0), F.col("total") - ROUTES_SHOWN).cast("long").alias("more"))


def embed_texts(spark: SparkSession, d: str) -> DataFrame:
    """F8: what a chunk's vector is made of: path, symbol, heading and body, the first 2,000 characters, as digest and length."""
    c = one_per_key(table(spark, d, "chunks"), "chunk_id", ["path", "symbol_name", "heading_path", "text"])
    t = F.substring(F.concat_ws("\n", *(F.nullif(F.col(x), F.lit("")) for x in ("path", "symbol_name", "heading_path", "text"))), 1, EMBED_CHARS)
    return c.select("chunk_id", F.length(t).cast("long").alias("n_chars"), F.sha2(t, 256).alias("sha256"))


def table_cells(spark: SparkSession, d: str) -> DataFrame:
    """titles as cells of Markdown tables: pipes escaped, line ends as blanks."""
    cell = F.replace(F.regexp_replace(F.coalesce("title", F.lit("")), r"\r?\n", " "), F.lit("|"), F.lit("\\|"))
    return _sections(spark, d).select("section_id", F.concat(F.lit("| "), cell, F.lit(" |")).alias("cell"))


def identifier_support(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers in the code spans of documents, and whether the file they are about holds them; paths are asked without a leading slash."""
    docs = table(spark, d, "documents").filter("doc_id IS NOT NULL AND path IS NOT NULL").groupBy("doc_id").agg(F.max("repo").alias("repo"), F.max("path").alias("path"), F.max("text").alias("text"))
    tok = docs.select("doc_id", "repo", "path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("`([^`\n]+)`"), F.lit(1)))).alias("token"))
    f = one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"]).filter("path IS NOT NULL")
    body = table(spark, d, "file_texts").filter("file_id IS NOT NULL").groupBy("file_id").agg(F.max("text").alias("body"))
    have = f.join(body, "file_id").groupBy("repo", "path").agg(F.max("body").alias("body"))
    x = tok.join(have, ["repo", "path"], "left")
    shape = F.when(F.col("token").rlike(r"^/?[\w.+-]+(/[\w.+-]+)+$"), "path").when(F.col("token").rlike(r"^[A-Z][A-Z0-9]*(_[A-Z0-9]+)+$"), "env").when(F.col("token").rlike(r"^[A-Za-z_]\w*(\.[A-Za-z_]\w*)+$"), "dotted").when(F.col("token").rlike(r"^[A-Za-z_][\w.]*\(\)?$"), "call").otherwise("other")
    bare = F.regexp_replace(F.regexp_replace("token", r"^/", ""), r"\(\)?$", "")
    state = F.when(F.col("body").isNull(), "no_text").when(F.contains("body", bare), "supported").otherwise("unsupported")
    return x.select("doc_id", "token", shape.alias("shape"), state.alias("support"))


def claim_topics(spark: SparkSession, d: str) -> DataFrame:
    """Evidence that stands for exactly one topic of its repository's sections gives that topic, other evidence none."""
    s = table(spark, d, "sections").filter("section_id IS NOT NULL").select("repo", F.explode("used_evidence_ids").alias("evidence_id"), "covered_topics").filter("evidence_id IS NOT NULL")
    x = s.select("repo", "evidence_id", F.explode_outer("covered_topics").alias("topic")).groupBy("repo", "evidence_id").agg(F.countDistinct("topic").alias("topics"), F.min("topic").alias("one"))
    return x.select("repo", "evidence_id", "topics", F.when(F.col("topics") == 1, F.col("one")).alias("topic"))


def generated_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Topics of a section that its text speaks of as a whole phrase: covered, else omitted; without a text invalid."""
    s = _sections(spark, d).select("section_id", F.lower("markdown").alias("body"), F.explode(F.array_distinct("covered_topics")).alias("topic")).filter("topic IS NOT NULL")
    low = F.lower(F.trim("topic"))
    at = F.concat(F.lit(" "), F.regexp_replace("body", "[^a-z0-9]+", " "), F.lit(" "))
    phrase = F.concat(F.lit(" "), F.trim(F.regexp_replace(low, "[^a-z0-9]+", " ")), F.lit(" "))
    state = F.when(F.coalesce(F.trim("body"), F.lit("")) == "", "invalid").when(F.contains(at, phrase), "covered").otherwise("omitted")
    return s.select("section_id", "topic", state.alias("state"))


def draft_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Each section's text: structure, citations of what is not used, placeholders and uncited paragraphs; pass, rewrite or fail."""
    s = _sections(spark, d)
    none = F.expr("cast(array() as array<string>)")
    cited = F.array_distinct(F.regexp_extract_all(F.coalesce("markdown", F.lit("")), F.lit(r"\[(EV-\d+)\]"), F.lit(1)))
    lost = F.size(F.array_except(cited, F.coalesce("used_evidence_ids", none)))
    body = F.regexp_replace(F.coalesce("markdown", F.lit("")), r"(?s)```.*?```", "")
    paragraphs = F.filter(F.transform(F.split(body, r"\n[ \t]*\n"), lambda p: F.regexp_replace(F.regexp_replace(p, r"(?m)^#{1,6} .*$", ""), r"^\s+|\s+$", "")), lambda p: p != "")
    bare = F.size(F.filter(paragraphs, lambda p: ~p.rlike(r"\[EV-\d+\]")))
    holds = S.any_of([F.coalesce("markdown", F.lit("")).rlike(p) for p in PLACEHOLDERS])
    structure = (F.coalesce("title", F.lit("")) == "") | (F.coalesce(F.trim("markdown"), F.lit("")) == "")
    x = s.select("section_id", structure.alias("structure"), lost.cast("long").alias("unknown_citations"), holds.alias("placeholder"), bare.cast("long").alias("uncited"))
    verdict = F.when(F.col("structure") | (F.col("unknown_citations") > 0), "fail").when(F.col("placeholder") | (F.col("uncited") > 0), "rewrite").otherwise("pass")
    return x.withColumn("verdict", verdict)


def section_outline(spark: SparkSession, d: str) -> DataFrame:
    """Sections in reading order: each gets its number among its siblings, by order and id, behind those of its ancestors; none on or below a loop."""
    h = checkpoint(resolve_hierarchy(hierarchies({"sections": (table(spark, d, "sections"), "section_id", "parent_section_id")})).filter("depth >= 0"))
    s = one_per_key(table(spark, d, "sections"), "section_id", ["repo", "section_order"])
    up = F.when(F.size("path") > 1, F.get("path", F.size("path") - 2))
    x = h.join(s.select(F.col("section_id").alias("node"), "repo", "section_order"), "node").withColumn("parent", F.coalesce(up, F.concat(F.lit("\0"), F.coalesce("repo", F.lit("")))))
    rank = first_per(x.select("node", "parent", "section_order"), ["parent"], [F.col("section_order").asc_nulls_last(), F.col("node")], 1 << 30, "n").select(F.col("node").alias("step"), "n")
    steps = h.select("node", "depth", F.posexplode("path").alias("at", "step")).join(rank, "step")
    out = steps.groupBy("node", "depth").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("a"))
    return out.select(F.col("node").alias("section_id"), F.col("depth").cast("int").alias("depth"), F.array_join(F.transform("a", lambda e: F.lpad(e["n"].cast("string"), 5, "0")), ".").alias("outline"))


_HOLDS = " OR ".join(f"regexp_matches(m, '{_q(p)}')" for p in PLACEHOLDERS)
_GOT = f"""s AS MATERIALIZED {lanes._S}, c AS MATERIALIZED {lanes._C}, f AS MATERIALIZED {lanes._FL}, sp AS (SELECT repo, path, span_id AS hit, min(start_line) AS a, max(end_line) AS z FROM s WHERE span_id IS NOT NULL GROUP BY ALL), ch AS (SELECT repo, path, chunk_id AS hit, start_line AS a, end_line AS z FROM c),
asked AS (SELECT concat_ws('/', repo, path) AS section_id, 'file_anchor' AS lane FROM s WHERE kind <> 'module' UNION ALL SELECT concat_ws('/', repo, path), 'symbol_anchor' FROM s WHERE kind = 'class' UNION ALL SELECT concat_ws('/', repo, path), 'test' FROM {lanes._TESTS}),
got AS MATERIALIZED (SELECT concat_ws('/', repo, path) AS section_id, 'file_anchor' AS lane, hit AS item FROM {lanes._RANGED} UNION ALL SELECT concat_ws('/', repo, path), 'symbol_anchor', hit FROM {lanes._MEMBERS} UNION ALL SELECT concat_ws('/', repo, path), 'test', hit FROM {lanes._TEST_LANE} WHERE hit IS NOT NULL)"""

QUERIES = {f.__name__: f for f in (lane_graph, source_map, api_summary, embed_texts, table_cells, identifier_support, claim_topics, generated_coverage, draft_verdicts, section_outline)}

ORACLE = {
    "lane_graph": f"""WITH near AS ({_ANALYSIS['graph_neighbours']}), s AS {_SY}, fc AS (SELECT 'file:' || repo || '/' || path AS file, chunk_id FROM (SELECT repo, path, chunk_id, row_number() OVER (PARTITION BY repo, path ORDER BY start_line, chunk_id) AS k FROM {_CH} WHERE path IS NOT NULL) WHERE k = 1),
x AS (SELECT n.*, s.span_id, CASE WHEN starts_with(n.neighbour, 'file:') THEN n.neighbour ELSE 'file:' || s.repo || '/' || s.path END AS file FROM near n LEFT JOIN s ON n.neighbour = 'sym:' || s.symbol_id)
SELECT node_id, place, neighbour, coalesce(span_id, chunk_id) AS source, CASE WHEN coalesce(span_id, chunk_id) IS NULL THEN 'low' ELSE 'medium' END AS confidence FROM x LEFT JOIN fc USING (file)""",
    "source_map": f"""WITH {_GOT}, n AS (SELECT section_id, lane, count(DISTINCT item) AS handles, count(DISTINCT CASE WHEN item IN (SELECT chunk_id FROM c) OR lane <> 'test' AND item IN (SELECT span_id FROM s WHERE span_id IS NOT NULL) THEN item END) AS citeable FROM got GROUP BY ALL),
t AS (SELECT section_id, sum(citeable) > 0 AS page FROM n GROUP BY ALL), a AS (SELECT section_id, lane, count(*) AS requests FROM asked GROUP BY ALL)
SELECT a.section_id, a.lane, a.requests, coalesce(n.handles, 0) AS handles, coalesce(n.citeable, 0) AS citeable, coalesce(t.page, false) AS floor_met FROM a LEFT JOIN n ON a.section_id = n.section_id AND a.lane = n.lane LEFT JOIN t ON a.section_id = t.section_id""",
    "api_summary": f"""WITH {lanes._BASE}, {lanes._OPS}, r AS (SELECT repo, route, string_agg(DISTINCT method, ',' ORDER BY method) AS methods FROM ops GROUP BY ALL)
SELECT repo, place, route, methods, greatest(0, total - {ROUTES_SHOWN}) AS more FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY route) AS place, count(*) OVER (PARTITION BY repo) AS total FROM r) WHERE place <= {ROUTES_SHOWN}""",
    "embed_texts": f"WITH c AS (SELECT chunk_id, max(path) AS p, max(symbol_name) AS s, max(heading_path) AS h, max(text) AS t FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id), e AS (SELECT chunk_id, substring(concat_ws(chr(10), nullif(p, ''), nullif(s, ''), nullif(h, ''), nullif(t, '')), 1, {EMBED_CHARS}) AS x FROM c) SELECT chunk_id, length(x) AS n_chars, sha256(x) AS sha256 FROM e",
    "table_cells": f"SELECT section_id, '| ' || replace(regexp_replace(coalesce(title, ''), '\\r?\\n', ' ', 'g'), '|', '\\|') || ' |' AS cell FROM {_SE}",
    "identifier_support": rf"""WITH d AS (SELECT doc_id, max(repo) AS repo, max(path) AS path, max(text) AS text FROM documents WHERE doc_id IS NOT NULL AND path IS NOT NULL GROUP BY doc_id), t AS (SELECT doc_id, repo, path, unnest(list_distinct(regexp_extract_all(text, '`([^`\n]+)`', 1))) AS token FROM d),
b AS (SELECT f.repo, f.path, max(x.body) AS body FROM {lanes._FL} f JOIN (SELECT file_id, max(text) AS body FROM file_texts WHERE file_id IS NOT NULL GROUP BY file_id) x ON f.file_id = x.file_id WHERE f.path IS NOT NULL GROUP BY ALL)
SELECT doc_id, token, CASE WHEN regexp_matches(token, '^/?[\w.+-]+(/[\w.+-]+)+$') THEN 'path' WHEN regexp_matches(token, '^[A-Z][A-Z0-9]*(_[A-Z0-9]+)+$') THEN 'env' WHEN regexp_matches(token, '^[A-Za-z_]\w*(\.[A-Za-z_]\w*)+$') THEN 'dotted' WHEN regexp_matches(token, '^[A-Za-z_][\w.]*\(\)?$') THEN 'call' ELSE 'other' END AS shape,
CASE WHEN body IS NULL THEN 'no_text' WHEN contains(body, regexp_replace(regexp_replace(token, '^/', ''), '\(\)?$', '')) THEN 'supported' ELSE 'unsupported' END AS support FROM t LEFT JOIN b ON t.repo = b.repo AND t.path = b.path""",
    "claim_topics": """WITH s AS (SELECT repo, unnest(used_evidence_ids) AS evidence_id, covered_topics AS t FROM sections WHERE section_id IS NOT NULL), x AS (SELECT repo, evidence_id, unnest(CASE WHEN coalesce(len(t), 0) = 0 THEN [NULL] ELSE t END) AS topic FROM s WHERE evidence_id IS NOT NULL),
g AS (SELECT repo, evidence_id, count(DISTINCT topic) AS topics, min(topic) AS one FROM x GROUP BY ALL) SELECT repo, evidence_id, topics, CASE WHEN topics = 1 THEN one END AS topic FROM g""",
    "generated_coverage": f"""WITH x AS (SELECT section_id, lower(markdown) AS body, unnest(list_distinct(topics)) AS topic FROM {_SE})
SELECT section_id, topic, CASE WHEN coalesce(trim(body), '') = '' THEN 'invalid' WHEN contains(' ' || regexp_replace(body, '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || trim(regexp_replace(lower(trim(topic)), '[^a-z0-9]+', ' ', 'g')) || ' ') THEN 'covered' ELSE 'omitted' END AS state FROM x WHERE topic IS NOT NULL""",
    "draft_verdicts": rf"""WITH s AS (SELECT section_id, title, coalesce(markdown, '') AS m, coalesce(used, []) AS used FROM {_SE}),
p AS (SELECT *, list_distinct(regexp_extract_all(m, '\[(EV-\d+)\]', 1)) AS cited, list_filter(list_transform(regexp_split_to_array(regexp_replace(m, '(?s)```.*?```', '', 'g'), '\n[ \t]*\n'), lambda q: regexp_replace(regexp_replace(q, '(?m)^#{{1,6}} .*$', '', 'g'), '^\s+|\s+$', '', 'g')), lambda q: q <> '') AS ps FROM s),
x AS (SELECT section_id, coalesce(title, '') = '' OR trim(m) = '' AS structure, len(list_filter(cited, lambda e: NOT list_contains(used, e))) AS unknown_citations, ({_HOLDS}) AS placeholder, len(list_filter(ps, lambda q: NOT regexp_matches(q, '\[EV-\d+\]'))) AS uncited FROM p)
SELECT *, CASE WHEN structure OR unknown_citations > 0 THEN 'fail' WHEN placeholder OR uncited > 0 THEN 'rewrite' ELSE 'pass' END AS verdict FROM x""",
    "section_outline": _WALK
    + f""", o AS (SELECT section_id, max(repo) AS repo, max(section_order) AS section_order FROM sections WHERE section_id IS NOT NULL GROUP BY section_id),
l AS (SELECT d.node, d.depth, d.ids, o.section_order, coalesce(CASE WHEN len(d.ids) > 1 THEN d.ids[len(d.ids) - 1] END, chr(1) || coalesce(o.repo, '')) AS parent FROM down d JOIN o ON d.node = o.section_id WHERE d.tree = 'sections'),
r AS (SELECT node, row_number() OVER (PARTITION BY parent ORDER BY section_order NULLS LAST, node) AS n FROM l), e AS (SELECT node, depth, unnest(ids) AS step, generate_subscripts(ids, 1) AS at FROM l)
SELECT e.node AS section_id, e.depth, string_agg(lpad(CAST(r.n AS VARCHAR), 5, '0'), '.' ORDER BY e.at) AS outline FROM e JOIN r ON e.step = r.node GROUP BY e.node, e.depth""",
}

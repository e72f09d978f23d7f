"""Obligations of pages, scores of sources, lineage of families and caps of packs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.joins import first_per
from tessera.operators.obligations import EXACT_LANES, obligations
from tessera.operators.patterns import DIGEST_CAP, PACKS, RAW_CAP, digest, scan
from tessera.operators.tables import one_per_key
from tessera.plans.analysis_queries import _F, _SCAN, _lines
from tessera.plans.catalog_queries import ORACLE as _CATALOG
from tessera.plans.catalog_queries import breadth_budget, planned_coverage, topic_catalog
from tessera.plans.inventory_queries import _EXT, _GEN, _LANG, _VEN, _in
from tessera.plans.lane_queries import ORACLE as _LANES
from tessera.plans.lane_queries import contract_requests, resolve_symbol_forms, resolve_tests
from tessera.plans.page_queries import ORACLE as _PAGES
from tessera.plans.page_queries import generated_coverage, source_map
from tessera.plans.record_queries import _CH, _SE, _chunks, _sections
from tessera.plans.taxonomy import PROFILES
from tessera.session import checkpoint, table

# How precise a lane's handle is, and what being required and being citeable add.
LANE_WEIGHT = {"contract": 5, "symbol_anchor": 4, "file_anchor": 4, "test": 3, "query_pack": 2}
REQUIRED_BONUS, CITEABLE_BONUS = 2, 1
#: Topics that every module page must cover, with the need each names; ``flow`` can only be recalled.
PAGE_TOPICS = (("key_files", "files"), ("entrypoints", "symbols"), ("tests", "tests"), ("flow", "graph_nodes"))
_FIELD = {lane: field for field, lane in EXACT_LANES.items()}
_FLOOR = PROFILES["subsystem-deep-dive"][2]


def page_obligations(spark: SparkSession, d: str) -> DataFrame:
    """The four topics of each module page against its needs: complete, or the defect."""
    m = checkpoint(source_map(spark, d))
    field = F.element_at(F.create_map(*(F.lit(x) for kv in _FIELD.items() for x in kv)), F.col("lane"))
    needs = m.select("section_id", field.alias("field"), F.lit(0).alias("index"), (F.col("citeable") > 0).alias("citeable"))
    pages = m.select("section_id").distinct()
    broad = pages.select("section_id", F.lit("graph_nodes").alias("field"), F.lit(0).alias("index"), F.lit(None).cast("boolean").alias("citeable"))
    every = F.explode(F.array(*(F.struct(F.lit(t).alias("topic"), F.lit(f"retrieval_needs.{n}[0]").alias("source")) for t, n in PAGE_TOPICS)))
    t = pages.select("section_id", every.alias("t")).select("section_id", "t.topic", "t.source")
    req = t.select("section_id", "topic", F.array("source").alias("source_fields"), F.array(*map(F.lit, _FLOOR)).alias("acceptable_lanes"))
    return obligations(t.select("section_id", "topic", F.lit(True).alias("required")), req, needs.unionByName(broad)).select("section_id", "topic", "status", "defect")


def source_scores(spark: SparkSession, d: str) -> DataFrame:
    """The lanes of each module page by score: their weight, 2 more where a required topic names them and 1 more where they can be cited; ties by field."""
    m = source_map(spark, d)
    weight = F.element_at(F.create_map(*(F.lit(x) for kv in LANE_WEIGHT.items() for x in kv)), F.col("lane"))
    field = F.element_at(F.create_map(*(F.lit(x) for kv in _FIELD.items() for x in kv)), F.col("lane"))
    x = m.select("section_id", field.alias("field"), (weight + REQUIRED_BONUS + F.when(F.col("citeable") > 0, CITEABLE_BONUS).otherwise(0)).alias("score"))
    return first_per(x, ["section_id"], [F.desc("score"), F.col("field")], len(LANE_WEIGHT)).select("section_id", "place", "field", "score")


def traceability(spark: SparkSession, d: str) -> DataFrame:
    """Each family of a repository from its signals through a planned section, its evidence and its text: the first leg that is missing."""
    plan = planned_coverage(spark, d)
    s = _sections(spark, d).select(F.col("section_id").alias("first_section"), (F.size("used_evidence_ids") > 0).alias("evidenced"), F.col("markdown").rlike(r"\[EV-\d+\]").alias("cited"))
    told = generated_coverage(spark, d).groupBy(F.col("section_id").alias("first_section")).agg(F.max(F.col("state") == "covered").alias("told"))
    x = plan.join(s, "first_section", "left").join(told, "first_section", "left")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    leg = F.when(F.col("coverage") == "not_applicable", "none_needed").when(F.col("coverage") == "missing", "plan").when(no("evidenced"), "evidence").when(no("cited"), "citation").when(no("told"), "text").otherwise("unbroken")
    return x.select("repo", "family", "first_section", leg.alias("broken_at"))


def gate_breadth(spark: SparkSession, d: str) -> DataFrame:
    """Leaf sections of each repository against the floor its catalog asks for, and flat plans where several families need pages."""
    s = _sections(spark, d)
    parents = s.filter("parent_section_id <> ''").select(F.col("parent_section_id").alias("section_id"), F.lit(True).alias("inner")).distinct()
    x = s.join(parents, "section_id", "left").groupBy("repo").agg(F.count_if(F.col("inner").isNull()).alias("leaf_pages"), F.count_if(F.col("parent_section_id") != "").alias("children"))
    b = breadth_budget(spark, d).select("repo", "least_pages", "needs_hierarchy").join(x, "repo", "left")
    b = b.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("leaf_pages", "children")})
    verdict = F.when(F.col("leaf_pages") < F.col("least_pages"), "insufficient_breadth").when(F.col("needs_hierarchy") & (F.col("children") == 0), "flat_hierarchy").otherwise("pass")
    return b.select("repo", "leaf_pages", "least_pages", "children", verdict.alias("verdict"))


def pack_rules(spark: SparkSession, d: str) -> DataFrame:
    """One rule row for each pack."""
    return spark.createDataFrame([(k, p, e, w) for k, (p, e, w) in PACKS.items()], "pack string, pattern string, endings string, purpose string")


def scan_caps(spark: SparkSession, d: str) -> DataFrame:
    """The first 80 hits of each pack by path and line, with the hits before any cap, those under the raw cap of 4,000 and what was cut."""
    hits = checkpoint(scan(_lines(spark, d), ["file_id", "path"], "path").select("pack", "path", "file_id", "line_no"))
    x = digest(hits, ["path", "line_no", "file_id"], DIGEST_CAP)
    return x.select("pack", "place", "path", "file_id", F.col("line_no").cast("long").alias("line_no"), "total", F.least("total", F.lit(RAW_CAP)).cast("long").alias("raw_kept"), (F.col("total") > RAW_CAP).alias("raw_truncated"), "truncated")


def needs_resolution(spark: SparkSession, d: str) -> DataFrame:
    """References of each repository by lane: kept where they resolve to one thing, hints where to nothing, unresolved where to several or to no operation."""
    verdict = lambda kept, lost: F.when(F.col("resolution").isin(*kept), "kept").when(F.col("resolution").isin(*lost), "unresolved").otherwise("hint")
    a = resolve_symbol_forms(spark, d).select("repo", F.lit("symbol_anchor").alias("lane"), verdict(("exact", "unique_alias"), ("ambiguous",)).alias("outcome"))
    b = resolve_tests(spark, d).select("repo", F.lit("test").alias("lane"), verdict(("test_file", "unique_suffix", "file_exists"), ("ambiguous",)).alias("outcome"))
    c = contract_requests(spark, d).select("repo", F.lit("contract").alias("lane"), verdict(("exact", "path_only"), ("no_match",)).alias("outcome"))
    return a.unionByName(b).unionByName(c).groupBy("repo", "lane", "outcome").agg(F.count(F.lit(1)).alias("n"))


def expected_types(spark: SparkSession, d: str) -> DataFrame:
    """F16: evidence that a repository's needs let expect: the lanes that keep something, and the graph where symbols are kept."""
    kept = needs_resolution(spark, d).filter("outcome = 'kept'").select("repo", "lane").distinct()
    return kept.unionByName(kept.filter("lane = 'symbol_anchor'").select("repo", F.lit("graph_neighbors").alias("lane")))


def index_remap(spark: SparkSession, d: str) -> DataFrame:
    """places of the named chunks of a file before and after those are pruned that resolve to no single symbol; null for the pruned."""
    c = _chunks(spark, d).filter("symbol_name IS NOT NULL AND path IS NOT NULL").select("repo", "path", "chunk_id", "start_line", F.concat("path", F.lit(":"), "symbol_name").alias("ref"))
    r = resolve_symbol_forms(spark, d).select("repo", "ref", F.col("resolution").isin("exact", "unique_alias").alias("kept"))
    x = c.join(r, ["repo", "ref"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    w = Window.partitionBy("repo", "path").orderBy("start_line", "chunk_id")
    before = F.row_number().over(w) - 1
    after = F.sum(F.col("kept").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    return x.select("chunk_id", before.cast("long").alias("raw_index"), F.when(F.col("kept"), after).alias("new_index"))


def catalog_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Number and digest of the topics of each repository's catalog in canonical form; a catalog has at most 169 topics."""
    row = F.concat_ws("\t", "topic_id", F.coalesce("parent_id", F.lit("")), "label", "kind", "profile", "status", "priority", "tier", F.col("least_items").cast("string"))
    t = topic_catalog(spark, d).select("repo", row.alias("row"))
    return t.groupBy("repo").agg(F.count(F.lit(1)).alias("topics"), F.sha2(F.array_join(F.array_sort(F.collect_list("row")), "\n"), 256).alias("fingerprint"))


def repo_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Of each repository the files, what is left out of them and why, and its three largest languages by files."""
    f = one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"]).filter("path IS NOT NULL")
    p = F.col("path")
    lang = S.language_for(S.extension(p), S.base_name(p))
    n = f.groupBy("repo").agg(F.count(F.lit(1)).alias("files"), F.count_if(S.is_generated(p)).alias("generated"), F.count_if(S.is_vendor(p)).alias("vendored"), F.count_if(S.extension(p).isin(*S.BINARY)).alias("binary"), F.count_if(lang == "other").alias("unknown"))
    top = first_per(f.groupBy("repo", lang.alias("language")).agg(F.count(F.lit(1)).alias("n")), ["repo"], [F.desc("n"), F.col("language")], 3)
    top = top.groupBy("repo").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "language", "n"))), lambda x: F.concat_ws("=", x["language"], x["n"].cast("string"))), ",").alias("languages"))
    return n.join(top, "repo")


QUERIES = {f.__name__: f for f in (page_obligations, source_scores, traceability, gate_breadth, pack_rules, scan_caps, needs_resolution, expected_types, index_remap, catalog_fingerprints, repo_summaries)}

_LANE_FIELD = "CASE lane " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _FIELD.items()) + " END"
_LANE_SCORE = "CASE lane " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANE_WEIGHT.items()) + " END"
_TOPIC_ROWS = ", ".join(f"('{t}', '{n}')" for t, n in PAGE_TOPICS)

_NEEDS = f"""SELECT repo, lane, outcome, count(*) AS n FROM (SELECT repo, 'symbol_anchor' AS lane, CASE WHEN resolution IN ('exact', 'unique_alias') THEN 'kept' WHEN resolution = 'ambiguous' THEN 'unresolved' ELSE 'hint' END AS outcome FROM ({_LANES['resolve_symbol_forms']})
UNION ALL SELECT repo, 'test', CASE WHEN resolution IN ('test_file', 'unique_suffix', 'file_exists') THEN 'kept' WHEN resolution = 'ambiguous' THEN 'unresolved' ELSE 'hint' END FROM ({_LANES['resolve_tests']})
UNION ALL SELECT repo, 'contract', CASE WHEN resolution IN ('exact', 'path_only') THEN 'kept' ELSE 'unresolved' END FROM ({_LANES['contract_requests']})) GROUP BY ALL"""

ORACLE = {
    "needs_resolution": _NEEDS,
    "expected_types": f"WITH n AS ({_NEEDS}) SELECT DISTINCT repo, lane FROM n WHERE outcome = 'kept' UNION ALL SELECT DISTINCT repo, 'graph_neighbors' FROM n WHERE outcome = 'kept' AND lane = 'symbol_anchor'",
    "index_remap": f"""WITH r AS ({_LANES['resolve_symbol_forms']}), x AS (SELECT c.*, coalesce(r.resolution IN ('exact', 'unique_alias'), false) AS kept FROM {_CH} c LEFT JOIN r ON c.repo = r.repo AND c.path || ':' || c.symbol_name = r.ref WHERE c.symbol_name IS NOT NULL AND c.path IS NOT NULL)
SELECT chunk_id, row_number() OVER w - 1 AS raw_index, CASE WHEN kept THEN CAST(sum(CAST(kept AS BIGINT)) OVER (PARTITION BY repo, path ORDER BY start_line, chunk_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - 1 END AS new_index FROM x WINDOW w AS (PARTITION BY repo, path ORDER BY start_line, chunk_id)""",
    "catalog_fingerprints": f"WITH t AS ({_CATALOG['topic_catalog']}), r AS (SELECT repo, concat_ws(chr(9), topic_id, coalesce(parent_id, ''), label, kind, profile, status, priority, tier, CAST(least_items AS VARCHAR)) AS row FROM t) SELECT repo, count(*) AS topics, sha256(string_agg(row, chr(10) ORDER BY row)) AS fingerprint FROM r GROUP BY repo",
    "repo_summaries": f"""WITH f AS (SELECT repo, {_GEN} AS g, {_VEN} AS v, {_EXT} IN {_in(S.BINARY)} AS b, {_LANG} AS language FROM {_F} WHERE path IS NOT NULL), l AS (SELECT repo, language, count(*) AS n FROM f GROUP BY ALL),
t AS (SELECT repo, string_agg(language || '=' || n, ',' ORDER BY n DESC, language) AS languages FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY n DESC, language) AS k FROM l) WHERE k <= 3 GROUP BY repo)
SELECT f.repo, count(*) AS files, count(*) FILTER (g) AS generated, count(*) FILTER (v) AS vendored, count(*) FILTER (b) AS "binary", count(*) FILTER (language = 'other') AS unknown, max(t.languages) AS languages FROM f JOIN t ON f.repo = t.repo GROUP BY f.repo""",
    "page_obligations": f"""WITH m AS MATERIALIZED ({_PAGES['source_map']}), p AS (SELECT DISTINCT section_id FROM m), t(topic, field) AS (VALUES {_TOPIC_ROWS}),
x AS (SELECT p.section_id, t.topic, t.field, n.citeable > 0 AS c, n.section_id IS NOT NULL AS have FROM p CROSS JOIN t LEFT JOIN (SELECT *, {_LANE_FIELD} AS field FROM m) n ON n.section_id = p.section_id AND n.field = t.field)
SELECT section_id, topic, CASE WHEN field <> 'graph_nodes' AND have AND c THEN 'complete' ELSE 'incomplete' END AS status, CASE WHEN field = 'graph_nodes' THEN 'broad_only_source_fields' WHEN NOT have THEN 'invalid_source_field' WHEN NOT c THEN 'source_not_citeable' END AS defect FROM x""",
    "source_scores": f"""WITH m AS ({_PAGES['source_map']}), x AS (SELECT section_id, {_LANE_FIELD} AS field, CAST({_LANE_SCORE} + {REQUIRED_BONUS} + CASE WHEN citeable > 0 THEN {CITEABLE_BONUS} ELSE 0 END AS INTEGER) AS score FROM m)
SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY score DESC, field) AS place, field, score FROM x""",
    "traceability": f"""WITH p AS ({_CATALOG['planned_coverage']}), g AS ({_PAGES['generated_coverage']}), s AS {_SE}, t AS (SELECT section_id, bool_or(state = 'covered') AS told FROM g GROUP BY ALL)
SELECT p.repo, p.family, p.first_section, CASE WHEN p.coverage = 'not_applicable' THEN 'none_needed' WHEN p.coverage = 'missing' THEN 'plan' WHEN coalesce(len(s.used), 0) = 0 THEN 'evidence' WHEN NOT coalesce(regexp_matches(s.markdown, '\\[EV-\\d+\\]'), false) THEN 'citation' WHEN NOT coalesce(t.told, false) THEN 'text' ELSE 'unbroken' END AS broken_at
FROM p LEFT JOIN s ON p.first_section = s.section_id LEFT JOIN t ON p.first_section = t.section_id""",
    "gate_breadth": f"""WITH b AS ({_CATALOG['breadth_budget']}), s AS {_SE}, x AS (SELECT repo, count(*) FILTER (section_id NOT IN (SELECT parent_section_id FROM s WHERE parent_section_id <> '')) AS leaf_pages, count(*) FILTER (parent_section_id <> '') AS children FROM s GROUP BY repo)
SELECT b.repo, coalesce(x.leaf_pages, 0) AS leaf_pages, b.least_pages, coalesce(x.children, 0) AS children, CASE WHEN coalesce(x.leaf_pages, 0) < b.least_pages THEN 'insufficient_breadth' WHEN b.needs_hierarchy AND coalesce(x.children, 0) = 0 THEN 'flat_hierarchy' ELSE 'pass' END AS verdict FROM b LEFT JOIN x ON b.repo = x.repo""",
    "pack_rules": "SELECT * FROM (VALUES " + ", ".join("('" + "', '".join(v.replace("'", "''") for v in (k, *w)) + "')" for k, w in PACKS.items()) + ") t(pack, pattern, endings, purpose)",
    "scan_caps": f"SELECT pack, place, path, file_id, line_no, total, least(total, {RAW_CAP}) AS raw_kept, total > {RAW_CAP} AS raw_truncated, total > {DIGEST_CAP} AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY pack ORDER BY path, line_no, file_id) AS place, count(*) OVER (PARTITION BY pack) AS total FROM {_SCAN}) WHERE place <= {DIGEST_CAP}",
}

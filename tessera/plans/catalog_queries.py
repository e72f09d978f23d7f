"""Topic families of repositories: signals, facets, the catalog of topics and what plans cover of it, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.joins import first_per
from tessera.operators.patterns import scan
from tessera.operators.tables import one_per_key
from tessera.plans.analysis_queries import _F, _SCAN, _lines
from tessera.plans.inventory_queries import _CLASS, _EXT, _GEN, _VEN, _in
from tessera.plans.taxonomy import DEFAULT_PROFILE, DETECTORS, FAMILIES, PROFILES, STATUS, SUGGESTED_PROFILE
from tessera.session import checkpoint, table

FACET_PATHS, FACETS, PAGE_TOPICS, SPLIT_FROM, SEEDS = 15, 12, 4, 6, 24


def _files(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"]).filter("path IS NOT NULL")


def _reason_array(tokens: dict[str, tuple[str, ...]]) -> Column:
    """Sorted reasons why a file (low, base, dirs, ext) signals a family; no joins, one array for each row."""
    tests = [F.when(F.col("ext") == t, f"ext:{t}") for t in tokens.get("ext", ())]
    tests += [F.when(F.array_contains("dirs", t), f"dir:{t}") for t in tokens.get("dir", ())]
    tests += [F.when(F.col("base") == t, f"file:{t}") for t in tokens.get("file", ())]
    tests += [F.when(S.bounded(F.col("base"), t), f"name:{t}") for t in tokens.get("name", ())]
    tests += [F.when(F.col("low").startswith(t), f"path:{t}") for t in tokens.get("path", ())]
    return F.array_sort(F.array_compact(F.array(*tests))) if tests else F.expr("cast(array() as array<string>)")


def family_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Hand-kept files that signal one of the thirteen families, with their sorted reasons of all five kinds."""
    f = _files(spark, d).filter(~S.is_generated(F.col("path")) & ~S.is_vendor(F.col("path")) & ~S.extension(F.col("path")).isin(*S.BINARY))
    f = f.withColumn("low", F.lower("path")).withColumns({"base": F.element_at(F.split("low", "/"), -1), "dirs": F.slice(F.split("low", "/"), 1, F.size(F.split("low", "/")) - 1), "ext": S.extension(F.col("path"))})
    every = F.array(*(F.struct(F.lit(k).alias("family"), _reason_array(t).alias("reasons")) for k, t in DETECTORS.items() if t))
    x = f.select("repo", "path", S.classify(F.col("path")).alias("category"), F.explode(F.filter(every, lambda e: F.size(e["reasons"]) > 0)).alias("e"))
    return x.select("repo", "path", "e.family", F.array_join("e.reasons", ",").alias("reasons"), "category").distinct()


def _families(spark: SparkSession) -> DataFrame:
    rows = [(k, label, "|".join(DETECTORS[k].get("pack", ())), SUGGESTED_PROFILE.get(k, DEFAULT_PROFILE)) for k, (label, _, _) in FAMILIES.items()]
    return F.broadcast(spark.createDataFrame(rows, "family string, label string, packs string, profile string"))


def family_signals(spark: SparkSession, d: str) -> DataFrame:
    """Files, pack hits and symbols of each family in each repository, with status, strength, priority and least evidence.

    The glossary is synthesized from the labels of the families found and the top folders, at most 24 of them.
    """
    repos = _files(spark, d).select("repo").distinct()
    cand = family_candidates(spark, d).groupBy("repo", "family").agg(F.countDistinct("path").alias("files"))
    at = _files(spark, d).select("file_id", "repo")
    packs = {p: k for k, t in DETECTORS.items() for p in t.get("pack", ())}
    of_pack = F.element_at(F.create_map(*(F.lit(x) for kv in packs.items() for x in kv)), F.col("pack"))
    hits = scan(_lines(spark, d), ["file_id", "path"], "path", tuple(packs)).join(at, "file_id").groupBy("repo", of_pack.alias("family")).agg(F.count(F.lit(1)).alias("hits"))
    s = one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "name"]).withColumn("hay", F.lower(F.concat_ws(" ", "symbol_id", "name")))
    named = F.array(*(F.when(S.any_of([S.bounded(F.col("hay"), t) for t in tokens["symbol"]]), F.lit(k)) for k, tokens in DETECTORS.items() if "symbol" in tokens))
    syms = s.select("repo", F.explode(F.array_compact(named)).alias("family")).groupBy("repo", "family").agg(F.count(F.lit(1)).alias("symbols"))
    x = repos.crossJoin(_families(spark)).join(cand, ["repo", "family"], "left").join(hits, ["repo", "family"], "left").join(syms, ["repo", "family"], "left")
    x = x.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("files", "hits", "symbols")})
    status = F.when(F.col("family") == "glossary", "synthesized").when(F.col("files") + F.col("hits") + F.col("symbols") == 0, "missing").when((F.col("files") >= 3) | (F.col("hits") >= 5) | (F.col("symbols") >= 3), "present").otherwise("low")
    x = x.withColumn("status", status)
    said = lambda i: F.element_at(F.create_map(*(F.lit(v) for k, w in STATUS.items() for v in (k, w[i]))), F.col("status"))
    folders = _files(spark, d).select("repo", S.top_dir(F.col("path")).alias("seed")).filter("seed <> '(root)'").distinct()
    seeds = x.filter("status IN ('present', 'low')").select("repo", F.lit(0).alias("o"), F.col("label").alias("seed")).unionByName(folders.select("repo", F.lit(1).alias("o"), "seed"))
    seeds = first_per(seeds, ["repo"], [F.col("o"), F.col("seed")], SEEDS).groupBy("repo").agg(F.max("place").alias("seeds")).withColumn("family", F.lit("glossary"))
    x = x.join(seeds, ["repo", "family"], "left")
    return x.select("repo", "family", "files", "hits", "symbols", "status", said(0).alias("strength"), said(1).alias("priority"), said(2).alias("least_items"), F.coalesce("seeds", F.lit(0)).cast("long").alias("seeds"))


def family_facets(spark: SparkSession, d: str, signals: DataFrame | None = None) -> DataFrame:
    """A family's files by their folder: the twelve largest facets, in folder order, with unique keys, first paths, categories and reasons.

    Only families that are present and have two facets or more are divided. Keys that collide are numbered in folder order.
    """
    c = checkpoint(family_candidates(spark, d))
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("(root)")
    c = c.withColumn("directory", folder)
    key = ["repo", "family", "directory"]
    n = c.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    big = first_per(n, ["repo", "family"], [F.desc("n"), F.col("directory")], FACETS).drop("place")
    many = big.groupBy("repo", "family").agg(F.count(F.lit(1)).alias("facets")).filter("facets >= 2").drop("facets")
    present = (family_signals(spark, d) if signals is None else signals).filter("status = 'present'").select("repo", "family")
    big = big.join(many, ["repo", "family"], "left_semi").join(present, ["repo", "family"], "left_semi")
    paths = first_per(c.select(*key, "path"), key, [F.col("path")], FACET_PATHS).groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("path")), "|").alias("paths"))
    cats = c.select(*key, "category").distinct().groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("category")), ",").alias("categories"))
    why = c.select(*key, F.explode(F.split("reasons", ",")).alias("reason")).distinct().groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("reason")), ",").alias("reasons"))
    x = big.withColumn("slug", F.when(F.col("directory") == "(root)", "root").otherwise(S.slug(F.col("directory"))))
    x = first_per(x, ["repo", "family", "slug"], [F.col("directory")], FACETS)
    facet = F.when(F.col("place") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", "place"))
    return x.join(paths, key).join(cats, key).join(why, key).select("repo", "family", "directory", facet.alias("facet"), "n", "paths", "categories", "reasons")


def topic_catalog(spark: SparkSession, d: str) -> DataFrame:
    """All topics of a repository: a parent for each family, a child for each facet, with status, priority, profile and promotion tier."""
    said = lambda i: F.element_at(F.create_map(*(F.lit(v) for k, w in STATUS.items() for v in (k, w[i]))), F.col("status"))
    signals = checkpoint(family_signals(spark, d))
    parent = signals.join(_families(spark), "family").select("repo", F.col("family").alias("topic_id"), F.lit(None).cast("string").alias("parent_id"), "family", "label", F.lit("family").alias("kind"), "profile", "status")
    child = family_facets(spark, d, signals).select("repo", F.concat_ws("/", "family", "facet").alias("topic_id"), F.col("family").alias("parent_id"), "family", F.col("directory").alias("label"), F.lit("subsystem").alias("kind"), F.lit(DEFAULT_PROFILE).alias("profile"), F.when(F.col("n") >= 3, "present").otherwise("low").alias("status"))
    x = parent.unionByName(child).withColumns({"priority": said(1), "least_items": said(2)})
    tier = F.when(F.col("priority") != "must", "optional").when(F.col("kind") == "family", "overview").otherwise("page")
    return x.withColumn("tier", tier)


def breadth_budget(spark: SparkSession, d: str) -> DataFrame:
    """Of each repository the promoted topics, the least and most leaf pages they need, families that must be split and whether a flat plan fails."""
    t = topic_catalog(spark, d)
    n = t.groupBy("repo", "family").agg(F.sum((F.col("tier") == "page").cast("long")).alias("n"), F.max((F.col("tier") == "overview").cast("long")).alias("o"))
    x = n.groupBy("repo").agg(
        F.sum("n").alias("promoted"), F.sum(F.ceil(F.col("n") / PAGE_TOPICS)).alias("least_pages"), F.sum("n").alias("most_pages"),
        F.sum((F.col("n") > SPLIT_FROM).cast("long")).alias("split_families"), (F.sum((F.col("n") > 0).cast("long")) >= 3).alias("needs_hierarchy"),
        (F.sum("n") + F.sum(F.when(F.col("n") > 0, F.col("o")).otherwise(0))).alias("least_topics"),
    )
    return x


def planned_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Which families the sections of a repository plan for, by label or by a keyword in their title, topics and labels; blocking where one with signals is not."""
    s = one_per_key(table(spark, d, "sections"), "section_id", ["repo", "title", "covered_topics", "coverage_labels"])
    words = lambda c: F.coalesce(F.col(c), F.expr("cast(array() as array<string>)"))
    s = s.withColumn("labels", F.transform(words("coverage_labels"), lambda x: F.lower(F.trim(x))))
    s = s.withColumn("hay", F.lower(F.concat_ws(" ", F.col("title"), F.array_join(words("covered_topics"), " "), F.array_join(words("coverage_labels"), " "))))
    fits = [F.when(S.any_of([F.array_contains("labels", x) for x in labels] + [S.bounded(F.col("hay"), x) for x in keys]), F.lit(k)) for k, (_, labels, keys) in FAMILIES.items()]
    got = s.select("repo", "section_id", F.explode(F.array_compact(F.array(*fits))).alias("family")).groupBy("repo", "family").agg(F.count(F.lit(1)).alias("sections"), F.min("section_id").alias("first_section"))
    x = family_signals(spark, d).select("repo", "family", "status").join(got, ["repo", "family"], "left")
    verdict = F.when(F.col("sections").isNotNull(), "covered").when(F.col("status") == "missing", "not_applicable").otherwise("missing")
    return x.select("repo", "family", F.coalesce("sections", F.lit(0)).cast("long").alias("sections"), "first_section", verdict.alias("coverage"))


def gate_planned(spark: SparkSession, d: str) -> DataFrame:
    """One verdict for each repository: the families that are missing, and the exit code of the gate."""
    x = planned_coverage(spark, d).groupBy("repo").agg(F.sum((F.col("coverage") == "covered").cast("long")).alias("covered"), F.array_join(F.array_sort(F.array_compact(F.collect_list(F.when(F.col("coverage") == "missing", F.col("family"))))), ",").alias("missing"))
    return x.withColumn("exit_code", F.when(F.col("missing") == "", 0).otherwise(3))


def profile_dimension(spark: SparkSession, d: str) -> DataFrame:
    """The ten page profiles: blocks, those that need evidence, floor lanes and least exact items."""
    rows = [(k, "|".join(b), "|".join(x for x in b if x not in free), "|".join(lanes), n) for k, (b, free, lanes, n) in PROFILES.items()]
    return spark.createDataFrame(rows, "profile string, blocks string, evidence_blocks string, floor_lanes string, least_items int")


def _bounded_sql(column: str, token: str) -> str:
    return f"regexp_matches({column}, '(^|[^a-z0-9]){token.replace('.', chr(92) + '.')}([^a-z0-9]|$)')"


def _reasons_sql(tokens: dict[str, tuple[str, ...]]) -> str:
    tests = [f"CASE WHEN ext = '{t}' THEN 'ext:{t}' END" for t in tokens.get("ext", ())]
    tests += [f"CASE WHEN list_contains(dirs, '{t}') THEN 'dir:{t}' END" for t in tokens.get("dir", ())]
    tests += [f"CASE WHEN base = '{t}' THEN 'file:{t}' END" for t in tokens.get("file", ())]
    tests += [f"CASE WHEN {_bounded_sql('base', t)} THEN 'name:{t}' END" for t in tokens.get("name", ())]
    tests += [f"CASE WHEN starts_with(low, '{t}') THEN 'path:{t}' END" for t in tokens.get("path", ())]
    return "array_to_string(list_sort(list_filter([" + ", ".join(tests) + "], lambda x: x IS NOT NULL)), ',')"


_CAND = f"""src AS (SELECT DISTINCT repo, path, lower(path) AS low, string_split(lower(path), '/')[-1] AS base, string_split(lower(path), '/')[:-2] AS dirs, {_EXT} AS ext FROM {_F} WHERE path IS NOT NULL AND NOT {_GEN} AND NOT {_VEN} AND {_EXT} NOT IN {_in(S.BINARY)}),
cand AS MATERIALIZED (SELECT * FROM ({' UNION ALL '.join(f"SELECT repo, path, '{k}' AS family, {_reasons_sql(t)} AS reasons FROM src" for k, t in DETECTORS.items() if t)}) WHERE reasons <> '')"""
_FAM = "fam(family, label, profile) AS (VALUES " + ", ".join(f"('{k}', '{label}', '{SUGGESTED_PROFILE.get(k, DEFAULT_PROFILE)}')" for k, (label, _, _) in FAMILIES.items()) + ")"
_SAID = "said(status, strength, priority, least_items) AS (VALUES " + ", ".join(f"('{k}', '{a}', '{b}', {n})" for k, (a, b, n) in STATUS.items()) + ")"
_SYMS = " UNION ALL ".join(f"SELECT repo, '{k}' AS family FROM sy WHERE " + " OR ".join(_bounded_sql("hay", t) for t in tokens["symbol"]) for k, tokens in DETECTORS.items() if "symbol" in tokens)
_PACKS = " ".join(f"WHEN '{p}' THEN '{k}'" for k, t in DETECTORS.items() for p in t.get("pack", ()))
_SIGNALS = f"""{_CAND}, {_FAM}, {_SAID}, repos_ AS (SELECT DISTINCT repo FROM {_F} WHERE path IS NOT NULL),
sy AS MATERIALIZED (SELECT symbol_id, max(repo) AS repo, lower(concat_ws(' ', symbol_id, max(name))) AS hay FROM symbols WHERE symbol_id IS NOT NULL GROUP BY symbol_id),
nf AS (SELECT repo, family, count(DISTINCT path) AS n FROM cand GROUP BY ALL), ns AS (SELECT repo, family, count(*) AS n FROM ({_SYMS}) GROUP BY ALL),
nh AS (SELECT g.repo, CASE x.pack {_PACKS} END AS family, count(*) AS n FROM {_SCAN} x JOIN {_F} g ON x.file_id = g.file_id WHERE CASE x.pack {_PACKS} END IS NOT NULL GROUP BY ALL),
b AS (SELECT r.repo, f.family, f.label, f.profile, coalesce(nf.n, 0) AS files, coalesce(nh.n, 0) AS hits, coalesce(ns.n, 0) AS symbols FROM repos_ r CROSS JOIN fam f LEFT JOIN nf ON r.repo = nf.repo AND f.family = nf.family LEFT JOIN nh ON r.repo = nh.repo AND f.family = nh.family LEFT JOIN ns ON r.repo = ns.repo AND f.family = ns.family),
st AS MATERIALIZED (SELECT *, CASE WHEN family = 'glossary' THEN 'synthesized' WHEN files + hits + symbols = 0 THEN 'missing' WHEN files >= 3 OR hits >= 5 OR symbols >= 3 THEN 'present' ELSE 'low' END AS status FROM b),
seed AS (SELECT repo, least(count(*), {SEEDS}) AS seeds FROM (SELECT repo, label FROM st WHERE status IN ('present', 'low') UNION ALL SELECT DISTINCT repo, string_split(path, '/')[1] FROM {_F} WHERE contains(path, '/')) GROUP BY repo),
signals AS MATERIALIZED (SELECT st.*, said.strength, said.priority, said.least_items, CASE WHEN st.family = 'glossary' THEN coalesce(seed.seeds, 0) ELSE 0 END AS seeds FROM st JOIN said USING (status) LEFT JOIN seed USING (repo))"""
_FACETS = f"""{_SIGNALS}, cf AS MATERIALIZED (SELECT *, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '(root)' END AS directory FROM cand),
big AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo, family ORDER BY n DESC, directory) AS p FROM (SELECT repo, family, directory, count(*) AS n FROM cf GROUP BY ALL)) WHERE p <= {FACETS}),
kept AS (SELECT big.*, CASE WHEN directory = '(root)' THEN 'root' ELSE coalesce(nullif(substring(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(directory)), '[ \\-_/.]', '-', 'g'), '[^\\p{{L}}\\p{{N}}\\-]', '', 'g'), '-{{2,}}', '-', 'g'), '^-+|-+$', '', 'g'), 1, 64), ''), 'item') END AS slug
 FROM big JOIN (SELECT repo, family FROM big GROUP BY ALL HAVING count(*) >= 2) USING (repo, family) JOIN (SELECT repo, family FROM signals WHERE status = 'present') USING (repo, family)),
num AS (SELECT *, row_number() OVER (PARTITION BY repo, family, slug ORDER BY directory) AS k FROM kept),
ps AS (SELECT repo, family, directory, string_agg(path, '|' ORDER BY path) AS paths FROM (SELECT *, row_number() OVER (PARTITION BY repo, family, directory ORDER BY path) AS k FROM cf) WHERE k <= {FACET_PATHS} GROUP BY ALL),
rs AS (SELECT repo, family, directory, string_agg(DISTINCT r, ',' ORDER BY r) AS reasons FROM (SELECT repo, family, directory, unnest(string_split(reasons, ',')) AS r FROM cf) GROUP BY ALL),
facets AS MATERIALIZED (SELECT n.repo, n.family, n.directory, CASE WHEN n.k = 1 THEN n.slug ELSE n.slug || '-' || n.k END AS facet, n.n, ps.paths, rs.reasons FROM num n JOIN ps USING (repo, family, directory) JOIN rs USING (repo, family, directory))"""
_TOPICS = f"""{_FACETS}, raw AS (SELECT repo, family AS topic_id, CAST(NULL AS VARCHAR) AS parent_id, family, label, 'family' AS kind, profile, status FROM signals
UNION ALL SELECT repo, family || '/' || facet, family, family, directory, 'subsystem', '{DEFAULT_PROFILE}', CASE WHEN n >= 3 THEN 'present' ELSE 'low' END FROM facets),
topics AS MATERIALIZED (SELECT raw.*, said.priority, said.least_items, CASE WHEN said.priority <> 'must' THEN 'optional' WHEN kind = 'family' THEN 'overview' ELSE 'page' END AS tier FROM raw JOIN said USING (status))"""
_FITS = " UNION ALL ".join(
    f"SELECT repo, section_id, '{k}' AS family FROM sec WHERE " + " OR ".join([f"list_contains(labels, '{x}')" for x in labels] + [_bounded_sql("hay", x) for x in keys]) for k, (_, labels, keys) in FAMILIES.items()
)
_PLANNED = f"""{_SIGNALS}, sec AS MATERIALIZED (SELECT section_id, repo, list_transform(coalesce(l, []), lambda x: lower(trim(x))) AS labels, lower(concat_ws(' ', title, array_to_string(coalesce(t, []), ' '), array_to_string(coalesce(l, []), ' '))) AS hay
 FROM (SELECT section_id, max(repo) AS repo, max(title) AS title, max(covered_topics) AS t, max(coverage_labels) AS l FROM sections WHERE section_id IS NOT NULL GROUP BY section_id)),
g AS (SELECT repo, family, count(*) AS sections, min(section_id) AS first_section FROM ({_FITS}) GROUP BY ALL),
planned AS MATERIALIZED (SELECT s.repo, s.family, coalesce(g.sections, 0) AS sections, g.first_section, CASE WHEN g.sections IS NOT NULL THEN 'covered' WHEN s.status = 'missing' THEN 'not_applicable' ELSE 'missing' END AS coverage FROM signals s LEFT JOIN g ON s.repo = g.repo AND s.family = g.family)"""

QUERIES = {f.__name__: f for f in (family_candidates, family_signals, family_facets, topic_catalog, breadth_budget, planned_coverage, gate_planned, profile_dimension)}

ORACLE = {
    "family_candidates": f"WITH {_CAND} SELECT *, {_CLASS} AS category FROM cand",
    "family_signals": f"WITH {_SIGNALS} SELECT repo, family, files, hits, symbols, status, strength, priority, least_items, seeds FROM signals",
    "family_facets": f"WITH {_FACETS}, cs AS (SELECT repo, family, directory, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM (SELECT *, {_CLASS} AS category FROM cf) GROUP BY ALL) SELECT facets.*, cs.categories FROM facets JOIN cs USING (repo, family, directory)",
    "topic_catalog": f"WITH {_TOPICS} SELECT * FROM topics",
    "breadth_budget": f"""WITH {_TOPICS}, n AS (SELECT repo, family, count(*) FILTER (tier = 'page') AS n, CAST(bool_or(tier = 'overview') AS BIGINT) AS o FROM topics GROUP BY ALL)
SELECT repo, CAST(sum(n) AS BIGINT) AS promoted, CAST(sum((n + {PAGE_TOPICS - 1}) // {PAGE_TOPICS}) AS BIGINT) AS least_pages, CAST(sum(n) AS BIGINT) AS most_pages, count(*) FILTER (n > {SPLIT_FROM}) AS split_families, count(*) FILTER (n > 0) >= 3 AS needs_hierarchy, CAST(sum(n) + sum(CASE WHEN n > 0 THEN o ELSE 0 END) AS BIGINT) AS least_topics FROM n GROUP BY repo""",
    "planned_coverage": f"WITH {_PLANNED} SELECT * FROM planned",
    "gate_planned": f"WITH {_PLANNED}, x AS (SELECT repo, count(*) FILTER (coverage = 'covered') AS covered, coalesce(string_agg(family, ',' ORDER BY family) FILTER (coverage = 'missing'), '') AS missing FROM planned GROUP BY repo) SELECT *, CASE WHEN missing = '' THEN 0 ELSE 3 END AS exit_code FROM x",
    "profile_dimension": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{'|'.join(b)}', '{'|'.join(x for x in b if x not in free)}', '{'|'.join(lanes)}', {n})" for k, (b, free, lanes, n) in PROFILES.items()) + ") t(profile, blocks, evidence_blocks, floor_lanes, least_items)",
}

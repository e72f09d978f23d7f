"""Queries on joins, ranking, search and aggregates, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.joins import first_per, overlap_join, resolve, suffixes
from tessera.operators.ranking import CONFIDENCES, LANES, allocate, assign_ids, capped, fold_hits, hit_order, order_of, prefix_budget
from tessera.operators.search import bm25, cosine_top_k, fingerprint
from tessera.operators.tables import count_by, one_per_key
from tessera.session import ship_package, table

SEARCHES = ("coverage report nightly job", "parser", "release_note search_window", "symbol table symbol table", "evidence packet zzz")
K = 8


def _chunks(spark: SparkSession, d: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return one_per_key(table(spark, d, "chunks"), "chunk_id", ["repo", "path", "start_line", "end_line", *extra])


def _symbols(spark: SparkSession, d: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "path", "name", "kind", "start_line", "end_line", *extra])


def _files(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"])


def _sections(spark: SparkSession, d: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return one_per_key(table(spark, d, "sections"), "section_id", ["repo", *extra])


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    left = _chunks(spark, d).select("chunk_id", "repo", "path", F.col("start_line").alias("l_start"), F.col("end_line").alias("l_end"))
    right = _symbols(spark, d).select("symbol_id", "repo", "path", "kind", F.col("start_line").alias("r_start"), F.col("end_line").alias("r_end"))
    return overlap_join(left, right, ["repo", "path"])


def join_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Up to eight overlapping symbols of each chunk, smallest first."""
    x = _ranges(spark, d).withColumn("size", F.col("r_end") - F.col("r_start"))
    return first_per(x, ["chunk_id"], [F.col("size"), F.col("symbol_id")], 8).select("chunk_id", "place", "symbol_id")


def join_first_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Up to three overlapping symbols of each chunk, earliest start first."""
    return first_per(_ranges(spark, d), ["chunk_id"], [F.col("r_start"), F.col("symbol_id")], 3).select("chunk_id", "place", "symbol_id")


def join_enclosing(spark: SparkSession, d: str) -> DataFrame:
    """The smallest symbol around the first line of each chunk."""
    x = _ranges(spark, d).filter("r_start <= l_start AND l_start <= r_end AND kind <> 'module'").withColumn("size", F.col("r_end") - F.col("r_start"))
    return first_per(x, ["chunk_id"], [F.col("size"), F.col("symbol_id")], 1).select("chunk_id", "symbol_id")


def join_unique_index(spark: SparkSession, d: str) -> DataFrame:
    """Names that only one symbol of a repository has, and the ambiguous ones with their number."""
    g = _symbols(spark, d).groupBy("repo", "name").agg(F.count(F.lit(1)).alias("n"), F.min("symbol_id").alias("s"))
    return g.select("repo", "name", "n", F.when(F.col("n") == 1, F.col("s")).alias("symbol_id"))


def join_resolve_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Symbol names in chunks resolved by name, then by the last part of the module; never guessing."""
    refs = _chunks(spark, d, ("symbol_name",)).filter("symbol_name IS NOT NULL").select("repo", "symbol_name").distinct()
    s = _symbols(spark, d, ("module",))
    names = s.select("repo", F.col("name").alias("alias"), "symbol_id", F.lit(0).alias("level"))
    tails = s.filter("kind = 'module'").select("repo", F.element_at(F.split("module", r"\."), -1).alias("alias"), "symbol_id", F.lit(1).alias("level"))
    return resolve(refs, ["repo", "symbol_name"], names.unionByName(tails), ["repo", "alias"], "symbol_id")


def join_resolve_files(spark: SparkSession, d: str) -> DataFrame:
    """File references, given by the last one or two parts of a path, resolved by exploded suffixes."""
    p = F.split("path", "/")
    src = table(spark, d, "documents").filter("path IS NOT NULL").select("repo", "path")
    refs = src.select("repo", F.array_join(F.slice(p, F.greatest(F.size(p) - 1, F.lit(1)), 2), "/").alias("ref")).unionByName(src.select("repo", F.element_at(p, -1).alias("ref"))).distinct()
    f = _files(spark, d).select("repo", "path", F.explode(suffixes(F.col("path"))).alias("alias"))
    return resolve(refs, ["repo", "ref"], f.withColumn("level", F.when(F.col("alias") == F.col("path"), 0).otherwise(1)), ["repo", "alias"], "path")


def join_directories(spark: SparkSession, d: str) -> DataFrame:
    """Which top folders named by documents hold files of the repository."""
    refs = table(spark, d, "documents").filter("path LIKE '%/%'").select("repo", F.substring_index("path", "/", 1).alias("dir")).distinct()
    dirs = _files(spark, d).filter("path LIKE '%/%'").select("repo", F.substring_index("path", "/", 1).alias("dir")).distinct().withColumn("known", F.lit(True))
    return refs.join(dirs, ["repo", "dir"], "left").select("repo", "dir", F.coalesce("known", F.lit(False)).alias("known"))


def join_parents(spark: SparkSession, d: str) -> DataFrame:
    """Parents of sections: dropped when the section itself, kept with a warning when unknown."""
    s = _sections(spark, d, ("parent_section_id",)).withColumn("parent", F.nullif("parent_section_id", F.lit("")))
    ids = s.select(F.col("section_id").alias("parent"), F.lit(True).alias("known"))
    x = s.join(ids, "parent", "left")
    state = F.when(F.col("parent").isNull(), "root").when(F.col("parent") == F.col("section_id"), "self").when(F.col("known"), "resolved").otherwise("unknown")
    return x.select("section_id", state.alias("state"), F.when(F.col("parent") != F.col("section_id"), F.col("parent")).alias("parent_id"))


def _cited(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d, ("markdown",)).select("section_id", "repo", F.explode(F.regexp_extract_all("markdown", F.lit(r"\[(EV-\d+)\]"), F.lit(1))).alias("evidence_id"))


def _used(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").filter("section_id IS NOT NULL").select("section_id", "repo", F.explode("used_evidence_ids").alias("evidence_id")).filter("evidence_id IS NOT NULL").distinct()


def join_citations(spark: SparkSession, d: str) -> DataFrame:
    """Per section, ids cited but not listed and ids listed but not cited."""
    cited, used = _cited(spark, d).select("section_id", "evidence_id").distinct(), _used(spark, d).select("section_id", "evidence_id")
    a = cited.join(used, ["section_id", "evidence_id"], "left_anti").withColumn("defect", F.lit("unlisted"))
    b = used.join(cited, ["section_id", "evidence_id"], "left_anti").withColumn("defect", F.lit("uncited"))
    return a.unionByName(b)


def join_cross_citations(spark: SparkSession, d: str) -> DataFrame:
    """Citations whose id is listed only by other sections."""
    cited, used = _cited(spark, d).select("section_id", "evidence_id").distinct(), _used(spark, d).select("section_id", "evidence_id")
    lost = cited.join(used, ["section_id", "evidence_id"], "left_anti")
    owner = used.groupBy("evidence_id").agg(F.min("section_id").alias("owner"))
    return lost.join(owner, "evidence_id").select("section_id", "evidence_id", "owner")


def agg_citation_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Cited ids with their first user, number of users and of occurrences."""
    return _cited(spark, d).groupBy("evidence_id").agg(F.min("section_id").alias("owner"), F.countDistinct("section_id").alias("users"), F.count(F.lit(1)).alias("occurrences"))


def join_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Code spans of documents longer than three characters that are the unique name of a symbol of the repository."""
    words = table(spark, d, "documents").select("repo", "doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("`(\\w+)`"), F.lit(1)))).alias("name")).filter(F.length("name") > 3)
    uniq = _symbols(spark, d).groupBy("repo", "name").agg(F.count(F.lit(1)).alias("n"), F.min("symbol_id").alias("symbol_id")).filter("n = 1")
    return words.join(uniq, ["repo", "name"]).select("doc_id", "symbol_id")


def join_tests(spark: SparkSession, d: str) -> DataFrame:
    """Test files and the unique file of the repository they are named after."""
    f = _files(spark, d).withColumn("stem", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.\w+$", ""))
    uniq = f.groupBy("repo", "stem").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("target")).filter("n = 1").select("repo", F.col("stem").alias("of"), "target")
    t = f.filter(F.col("stem").startswith("test_")).withColumn("of", F.regexp_replace("stem", "^test_", ""))
    return t.join(uniq, ["repo", "of"]).select("repo", "path", "target")


def rank_bm25(spark: SparkSession, d: str) -> DataFrame:
    """The best chunks of fixed queries over text, symbol name, heading path and path."""
    c = one_per_key(table(spark, d, "chunks"), "chunk_id", ["text", "symbol_name", "heading_path", "path"])
    q = spark.createDataFrame(list(enumerate(SEARCHES)), "query_id long, query string")
    return bm25(c, "chunk_id", F.concat_ws(" ", "text", "symbol_name", "heading_path", "path"), q, K)


def search_documents(spark: SparkSession, d: str) -> DataFrame:
    """The best documents of fixed queries (the flagship)."""
    q = spark.createDataFrame(list(enumerate(SEARCHES)), "query_id long, query string")
    return bm25(table(spark, d, "documents").filter("text IS NOT NULL"), "doc_id", F.col("text"), q, K)


def rank_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Exact cosine neighbours of every vector whose id is divisible by 20."""
    e = table(spark, d, "embeddings")
    return cosine_top_k(e, e.filter("vec_id % 20 = 0"), "vec_id", "embedding", K)


def agg_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Content digest of each repository's chunks."""
    return fingerprint(one_per_key(table(spark, d, "chunks"), "chunk_id", ["repo", "sha256"]), "chunk_id", "sha256", ["repo"])


def agg_symbols_by_module(spark: SparkSession, d: str) -> DataFrame:
    """The 25 modules with most symbols."""
    return count_by(_symbols(spark, d, ("module",)), "module", 25).select(F.col("key").alias("module"), "n")


def rank_classes(spark: SparkSession, d: str) -> DataFrame:
    """The 25 classes with most lines, ties by path and id."""
    s = _symbols(spark, d).filter("kind = 'class'").withColumn("n_lines", F.col("end_line") - F.col("start_line") + 1)
    return s.orderBy(F.desc("n_lines"), "path", "symbol_id").limit(25).select("symbol_id", "n_lines")


def agg_facets(spark: SparkSession, d: str) -> DataFrame:
    """Folders of each repository by number of files: the twelve largest with their first paths."""
    f = _files(spark, d).filter("path LIKE '%/%'").withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))
    top = first_per(f.groupBy("repo", "dir").agg(F.count(F.lit(1)).alias("n")), ["repo"], [F.desc("n"), F.col("dir")], 12)
    few = first_per(f.select("repo", "dir", "path").distinct(), ["repo", "dir"], [F.col("path")], 15, "at").groupBy("repo", "dir").agg(F.array_join(F.array_sort(F.collect_list("path")), "|").alias("paths"))
    return top.join(few, ["repo", "dir"]).select("repo", "dir", "n", "paths", "place")


def agg_token_bank(spark: SparkSession, d: str) -> DataFrame:
    """A32 and of U17 one back-tick pattern instead of ten token families: code spans of documents as tokens with kind and number of documents."""
    t = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("`([^`\n]+)`"), F.lit(1))).alias("token"))
    kind = F.when(F.col("token").rlike(r"^[\w.\-]+(/[\w.\-]+)+$"), "path").when(F.col("token").rlike(r"^[A-Z][A-Z0-9_]+$"), "env").when(F.col("token").rlike(r"^[A-Za-z_][A-Za-z0-9_]*$"), "identifier").otherwise("other")
    return t.groupBy("token").agg(F.min(kind).alias("kind"), F.countDistinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n"))


def join_grounding(spark: SparkSession, d: str) -> DataFrame:
    """J26 and of A33 a lookup of paths with one slash, not a search in cited texts: path tokens of documents that are files of their repository or not."""
    t = table(spark, d, "documents").select("repo", F.explode(F.regexp_extract_all("text", F.lit("`([\\w.\\-]+/[\\w.\\-]+)`"), F.lit(1))).alias("token")).distinct()
    f = _files(spark, d).select("repo", F.explode(suffixes(F.col("path"))).alias("token")).distinct().withColumn("grounded", F.lit(True))
    return t.join(f, ["repo", "token"], "left").select("repo", "token", F.coalesce("grounded", F.lit(False)).alias("grounded"))


def rank_budget(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source, newest first, up to 4,000 estimated tokens."""
    x = table(spark, d, "documents").filter("text IS NOT NULL").select("source", "doc_id", "updated_at", F.floor((F.length("text") + 3) / 4).cast("long").alias("tokens"))
    return prefix_budget(x, ["source"], [F.desc("updated_at"), F.col("doc_id")], "tokens", 4000).select("source", "doc_id", F.col("used").cast("long").alias("used"))


def agg_depth(spark: SparkSession, d: str) -> DataFrame:
    """Targets of each section: one for three pieces of evidence, at least one, at most eight."""
    n = _used(spark, d).groupBy("section_id").agg(F.count(F.lit(1)).alias("mapped"))
    return n.select("section_id", "mapped", F.least(F.greatest(F.ceil(F.col("mapped") / 3), F.lit(1)), F.lit(8)).cast("long").alias("target"))


def agg_status(spark: SparkSession, d: str) -> DataFrame:
    """A status of each repository by files and classes under thresholds of its own; family_signals has those of P17 and A16."""
    f = _files(spark, d).groupBy("repo").agg(F.count(F.lit(1)).alias("files"))
    s = _symbols(spark, d).filter("kind = 'class'").groupBy("repo").agg(F.count(F.lit(1)).alias("classes"))
    x = f.join(s, "repo", "left").withColumn("classes", F.coalesce("classes", F.lit(0)))
    return x.select("repo", "files", "classes", F.when((F.col("files") == 0) & (F.col("classes") == 0), "missing").when((F.col("files") >= 300) | (F.col("classes") >= 5), "present").otherwise("low").alias("status"))


def dedupe_ids(spark: SparkSession, d: str) -> DataFrame:
    """Repeated chunk ids get a suffix with their type and number, the earliest keeps its id."""
    c = table(spark, d, "chunks").filter("chunk_id IS NOT NULL").select("chunk_id", "chunk_type", "indexed_at", "loaded_at")
    w = F.row_number().over(Window.partitionBy("chunk_id").orderBy("indexed_at", "loaded_at"))
    x = c.withColumn("n", w)
    return x.select("chunk_id", F.when(F.col("n") == 1, F.col("chunk_id")).otherwise(F.concat("chunk_id", F.lit(":"), "chunk_type", F.lit("#"), F.col("n").cast("string"))).alias("unique_id"))


def dedupe_casefold(spark: SparkSession, d: str) -> DataFrame:
    """Topics of sections, first spelling wins over case and outer blanks."""
    t = table(spark, d, "sections").filter("section_id IS NOT NULL").select("section_id", F.explode("covered_topics").alias("topic")).filter("topic IS NOT NULL").withColumn("key", F.lower(F.trim("topic")))
    return t.groupBy("key").agg(F.min_by("topic", F.struct("section_id", "topic")).alias("topic"), F.countDistinct("section_id").alias("n_sections"))


def _hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits of sections: symbols and chunks of files that documents of the same repository name."""
    docs = table(spark, d, "documents").filter("path IS NOT NULL AND doc_id IS NOT NULL").select(F.col("repo").alias("section_id"), "repo", "path").distinct()
    s = docs.join(_symbols(spark, d), ["repo", "path"]).select(
        "section_id", "path", "start_line", "end_line", F.when(F.col("kind") == "module", "file_anchor").otherwise("symbol_anchor").alias("lane"), F.when(F.col("kind") == "class", "high").otherwise("exact").alias("confidence"),
        F.lit(True).alias("is_span"), F.concat(F.lit("span:"), "symbol_id").alias("dedupe_key"), F.lit(None).cast("int").alias("lane_rank"),
    )
    c = docs.join(_chunks(spark, d), ["repo", "path"])
    base = c.select("section_id", "path", "start_line", "end_line", F.lit(False).alias("is_span"), F.concat(F.lit("chunk:"), "chunk_id").alias("dedupe_key"), F.col("start_line").alias("lane_rank"))
    a = base.withColumn("lane", F.lit("query_pack")).withColumn("confidence", F.lit("medium"))
    b = base.withColumn("lane", F.lit("bm25")).withColumn("confidence", F.lit("low"))
    out = s.unionByName(a).unionByName(b)
    return out.withColumn("coarse_key", F.concat_ws(":", "path", F.concat_ws("-", F.col("start_line").cast("string"), F.col("end_line").cast("string"))))


def rank_fold(spark: SparkSession, d: str) -> DataFrame:
    """Hits folded by key and spans preferred over chunks of the same range."""
    return fold_hits(_hits(spark, d))


def rank_ids(spark: SparkSession, d: str) -> DataFrame:
    """Evidence ids of the folded hits in their final order."""
    x = fold_hits(_hits(spark, d)).withColumn("lane_rank", F.lit(None).cast("int"))
    return assign_ids(x, "section_id", hit_order()).select("evidence_id", "dedupe_key")


def rank_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first five symbols of each repository and kind with totals."""
    return capped(_symbols(spark, d), ["repo", "kind"], [F.col("path"), F.col("start_line"), F.col("symbol_id")], 5).select("repo", "kind", "symbol_id", "place", "total", "truncated")


def rank_allocate(spark: SparkSession, d: str) -> DataFrame:
    """Kept hits of each page under lane and section caps; a page is a file, so what is gathered is bounded by one."""
    ship_package(spark)
    x = fold_hits(_hits(spark, d).withColumn("section_id", F.concat_ws("/", "section_id", "path")))
    w = Window.partitionBy("section_id").orderBy(order_of(CONFIDENCES, "confidence"), order_of(LANES, "lane"), "path", "start_line", "dedupe_key")
    req = F.when(F.col("lane").isin("file_anchor", "symbol_anchor"), F.array(F.concat_ws("|", "lane", "path"))).otherwise(F.expr("cast(array() as array<string>)"))
    return allocate(x.select("section_id", F.col("dedupe_key").alias("item"), "lane", F.row_number().over(w).alias("place"), req.alias("requests")))


def _max(t: str, key: str, cols: str) -> str:
    return f"(SELECT {key}, {', '.join(f'max({c}) AS {c}' for c in cols.split())} FROM {t} WHERE {key} IS NOT NULL GROUP BY {key})"


_C = _max("chunks", "chunk_id", "repo path start_line end_line symbol_name heading_path sha256")
_S = _max("symbols", "symbol_id", "repo path name kind start_line end_line module")
_F = _max("files", "file_id", "repo path")
_X = f"(SELECT c.chunk_id, s.symbol_id, s.kind, c.start_line AS l_start, c.end_line AS l_end, s.start_line AS r_start, s.end_line AS r_end FROM {_C} c JOIN {_S} s ON c.repo = s.repo AND c.path = s.path AND s.start_line <= c.end_line AND c.start_line <= s.end_line)"
_CITED = "(SELECT section_id, unnest(regexp_extract_all(markdown, '\\[(EV-\\d+)\\]', 1)) AS evidence_id FROM " + _max("sections", "section_id", "markdown") + ")"
_USED = "(SELECT DISTINCT section_id, evidence_id FROM (SELECT section_id, unnest(used_evidence_ids) AS evidence_id FROM sections WHERE section_id IS NOT NULL) WHERE evidence_id IS NOT NULL)"
_SUFFIX = f"(SELECT DISTINCT repo, path, array_to_string(list_slice(string_split(path, '/'), i, len(string_split(path, '/'))), '/') AS alias FROM (SELECT repo, path, unnest(range(1, len(string_split(path, '/')) + 1)) AS i FROM {_F}))"


def _resolved(refs: str, ref: str, aliases: str, handle: str) -> str:
    return f"""WITH refs AS ({refs}), a AS ({aliases}), low AS (SELECT repo, alias, min(level) AS level FROM a GROUP BY ALL),
best AS (SELECT a.repo, a.alias, count(*) AS n, list_slice(list_sort(list(a.{handle})), 1, 25) AS c FROM (SELECT DISTINCT * FROM a) a JOIN low USING (repo, alias, level) GROUP BY a.repo, a.alias)
SELECT refs.repo, refs.{ref}, CASE WHEN n IS NULL THEN 'no_match' WHEN n = 1 THEN 'exact' ELSE 'ambiguous' END AS verdict, CASE WHEN n = 1 THEN c[1] END AS {handle}, CASE WHEN n > 1 THEN array_to_string(c, '|') END AS candidates
FROM refs LEFT JOIN best ON refs.repo IS NOT DISTINCT FROM best.repo AND refs.{ref} = best.alias"""


def _bm25_sql(docs: str, key: str) -> str:
    q = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SEARCHES))
    return f"""WITH docs AS ({docs}), q(query_id, query) AS (VALUES {q}),
tl AS (SELECT {key}, regexp_extract_all(lower(text), '[a-z0-9]+') AS ts FROM docs),
toks AS (SELECT {key}, unnest(ts) AS term, generate_subscripts(ts, 1) AS pos FROM tl),
w0 AS (SELECT query_id, regexp_extract_all(lower(query), '[a-z0-9_]+') AS ws FROM q),
w AS (SELECT query_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS phrase FROM w0),
pt AS (SELECT query_id, phrase, list_filter(string_split(word, '_'), lambda x: x <> '') AS parts FROM w),
t AS (SELECT query_id, phrase, len(parts) AS m, unnest(parts) AS term, generate_subscripts(parts, 1) AS off FROM pt),
dl AS (SELECT {key}, count(*) AS dl FROM toks GROUP BY {key}),
st AS (SELECT (SELECT count(*) FROM docs) AS n_docs, (SELECT sum(dl) FROM dl) AS total),
hit AS (SELECT query_id, phrase, m, {key}, pos - off AS s, count(DISTINCT off) AS got FROM toks JOIN t USING (term) GROUP BY ALL),
tf AS (SELECT query_id, phrase, {key}, count(*) AS f FROM hit WHERE got = m GROUP BY ALL),
df AS (SELECT query_id, phrase, count(*) AS df FROM tf GROUP BY ALL),
sc AS (SELECT query_id, {key}, round(-sum((CASE WHEN ln((n_docs - df + 0.5) / (df + 0.5)) > 0 THEN ln((n_docs - df + 0.5) / (df + 0.5)) ELSE 0.000001 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / (total / n_docs)))), 6) AS score
 FROM tf JOIN df USING (query_id, phrase) JOIN dl USING ({key}) CROSS JOIN st GROUP BY query_id, {key}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, {key}) AS place FROM sc)
SELECT CAST(query_id AS BIGINT) AS query_id, place, {key}, score FROM r WHERE place <= {K}"""


def _case(values, col: str) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values)) + f" ELSE {len(values)} END"


_HITS = f"""docs AS (SELECT DISTINCT repo, path FROM documents WHERE path IS NOT NULL AND doc_id IS NOT NULL),
hits AS (
 SELECT s.repo AS section_id, s.path, s.start_line, s.end_line, CASE WHEN kind = 'module' THEN 'file_anchor' ELSE 'symbol_anchor' END AS lane, CASE WHEN kind = 'class' THEN 'high' ELSE 'exact' END AS confidence, true AS is_span, 'span:' || symbol_id AS dedupe_key, 1000000 AS lane_rank FROM {_S} s JOIN docs USING (repo, path)
 UNION ALL SELECT c.repo, c.path, c.start_line, c.end_line, l.lane, l.confidence, false, 'chunk:' || chunk_id, c.start_line FROM {_C} c JOIN docs USING (repo, path) CROSS JOIN (VALUES ('query_pack', 'medium'), ('bm25', 'low')) l(lane, confidence)),
h AS (SELECT *, path || ':' || start_line || '-' || end_line AS coarse_key, {_case(CONFIDENCES, 'confidence')} AS cr, {_case(LANES, 'lane')} AS lp FROM hits),
n AS (SELECT *, row_number() OVER (PARTITION BY section_id, dedupe_key ORDER BY cr, lp, lane_rank, path, start_line, dedupe_key) AS k FROM h),
one AS (SELECT section_id, dedupe_key, max(path) FILTER (k = 1) AS path, max(start_line) FILTER (k = 1) AS start_line, max(end_line) FILTER (k = 1) AS end_line, max(coarse_key) FILTER (k = 1) AS coarse_key, bool_or(is_span) FILTER (k = 1) AS is_span,
  min(cr) AS cr, min(lp) AS lp, max(cr) FILTER (k = 1) AS o1, max(lp) FILTER (k = 1) AS o2, max(lane_rank) FILTER (k = 1) AS o3, list(DISTINCT lane) AS lanes FROM n GROUP BY section_id, dedupe_key),
sp AS (SELECT section_id, coarse_key, dedupe_key AS target FROM (SELECT *, row_number() OVER (PARTITION BY section_id, coarse_key ORDER BY o1, o2, o3, path, start_line, dedupe_key) AS k FROM one WHERE is_span) WHERE k = 1),
mk AS (SELECT one.*, CASE WHEN NOT is_span AND target IS NOT NULL THEN target ELSE dedupe_key END AS owner FROM one LEFT JOIN sp USING (section_id, coarse_key)),
fold AS (SELECT section_id, owner AS dedupe_key, max(path) FILTER (dedupe_key = owner) AS path, max(start_line) FILTER (dedupe_key = owner) AS start_line, max(end_line) FILTER (dedupe_key = owner) AS end_line, bool_or(is_span) FILTER (dedupe_key = owner) AS is_span,
  min(cr) AS cr, min(lp) AS lp, array_to_string(list_sort(list_distinct(flatten(list(lanes)))), ',') AS lanes FROM mk GROUP BY section_id, owner)"""

QUERIES = {
    f.__name__: f
    for f in (
        join_overlap, join_first_overlap, join_enclosing, join_unique_index, join_resolve_symbols, join_resolve_files, join_directories, join_parents, join_citations, join_cross_citations,
        agg_citation_manifest, join_mentions, join_tests, rank_bm25, search_documents, rank_vectors, agg_fingerprint, agg_symbols_by_module, rank_classes, agg_facets, agg_token_bank, join_grounding,
        rank_budget, agg_depth, agg_status, dedupe_ids, dedupe_casefold, rank_fold, rank_ids, rank_cap, rank_allocate,
    )
}

ORACLE = {
    "join_overlap": f"SELECT chunk_id, place, symbol_id FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY r_end - r_start, symbol_id) AS place FROM {_X}) WHERE place <= 8",
    "join_first_overlap": f"SELECT chunk_id, place, symbol_id FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY r_start, symbol_id) AS place FROM {_X}) WHERE place <= 3",
    "join_enclosing": f"SELECT chunk_id, symbol_id FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY r_end - r_start, symbol_id) AS place FROM {_X} WHERE r_start <= l_start AND l_start <= r_end AND kind <> 'module') WHERE place = 1",
    "join_unique_index": f"SELECT repo, name, count(*) AS n, CASE WHEN count(*) = 1 THEN min(symbol_id) END AS symbol_id FROM {_S} GROUP BY repo, name",
    "join_resolve_symbols": _resolved(f"SELECT DISTINCT repo, symbol_name FROM {_C} WHERE symbol_name IS NOT NULL", "symbol_name", f"SELECT repo, name AS alias, symbol_id, 0 AS level FROM {_S} UNION ALL SELECT repo, list_extract(string_split(module, '.'), -1), symbol_id, 1 FROM {_S} WHERE kind = 'module'", "symbol_id"),
    "join_resolve_files": _resolved("SELECT DISTINCT repo, ref FROM (SELECT repo, array_to_string(list_slice(string_split(path, '/'), greatest(len(string_split(path, '/')) - 1, 1), len(string_split(path, '/'))), '/') AS ref FROM documents WHERE path IS NOT NULL UNION ALL SELECT repo, list_extract(string_split(path, '/'), -1) FROM documents WHERE path IS NOT NULL)", "ref", f"SELECT repo, alias, path, CASE WHEN alias = path THEN 0 ELSE 1 END AS level FROM {_SUFFIX}", "path"),
    "join_directories": f"SELECT r.repo, r.dir, f.dir IS NOT NULL AS known FROM (SELECT DISTINCT repo, string_split(path, '/')[1] AS dir FROM documents WHERE path LIKE '%/%') r LEFT JOIN (SELECT DISTINCT repo, string_split(path, '/')[1] AS dir FROM {_F} WHERE path LIKE '%/%') f ON r.repo = f.repo AND r.dir = f.dir",
    "join_parents": "WITH s AS (SELECT section_id, nullif(max(parent_section_id), '') AS parent FROM sections WHERE section_id IS NOT NULL GROUP BY section_id) SELECT s.section_id, CASE WHEN s.parent IS NULL THEN 'root' WHEN s.parent = s.section_id THEN 'self' WHEN p.section_id IS NOT NULL THEN 'resolved' ELSE 'unknown' END AS state, CASE WHEN s.parent <> s.section_id THEN s.parent END AS parent_id FROM s LEFT JOIN s p ON s.parent = p.section_id",
    "join_citations": f"SELECT section_id, evidence_id, 'unlisted' AS defect FROM (SELECT * FROM {_CITED} EXCEPT SELECT * FROM {_USED}) UNION ALL SELECT section_id, evidence_id, 'uncited' FROM (SELECT * FROM {_USED} EXCEPT SELECT * FROM {_CITED})",
    "join_cross_citations": f"SELECT l.section_id, l.evidence_id, o.owner FROM (SELECT * FROM {_CITED} EXCEPT SELECT * FROM {_USED}) l JOIN (SELECT evidence_id, min(section_id) AS owner FROM {_USED} GROUP BY evidence_id) o ON l.evidence_id = o.evidence_id",
    "agg_citation_manifest": f"SELECT evidence_id, min(section_id) AS owner, count(DISTINCT section_id) AS users, count(*) AS occurrences FROM {_CITED} GROUP BY evidence_id",
    "join_mentions": f"SELECT w.doc_id, u.symbol_id FROM (SELECT DISTINCT repo, doc_id, unnest(regexp_extract_all(text, '`(\\w+)`', 1)) AS name FROM documents) w JOIN (SELECT repo, name, min(symbol_id) AS symbol_id FROM {_S} GROUP BY repo, name HAVING count(*) = 1) u ON w.repo = u.repo AND w.name = u.name WHERE length(w.name) > 3",
    "join_tests": f"WITH f AS (SELECT repo, path, regexp_replace(list_extract(string_split(path, '/'), -1), '\\.\\w+$', '') AS stem FROM {_F}), u AS (SELECT repo, stem, min(path) AS target FROM f GROUP BY repo, stem HAVING count(*) = 1) SELECT f.repo, f.path, u.target FROM f JOIN u ON f.repo = u.repo AND starts_with(f.stem, 'test_') AND regexp_replace(f.stem, '^test_', '') = u.stem",
    "rank_bm25": _bm25_sql("SELECT chunk_id, concat_ws(' ', text, symbol_name, heading_path, path) AS text FROM " + _max("chunks", "chunk_id", "text symbol_name heading_path path"), "chunk_id"),
    "search_documents": _bm25_sql("SELECT doc_id, text FROM documents WHERE text IS NOT NULL", "doc_id"),
    "rank_vectors": f"""WITH s AS (SELECT q.vec_id AS query, b.vec_id, round(list_inner_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS score
FROM embeddings q JOIN embeddings b ON q.vec_id % 20 = 0 AND q.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM s) SELECT query, place, vec_id, score FROM r WHERE place <= {K}""",
    "agg_fingerprint": f"""WITH h AS (SELECT DISTINCT repo, md5(chunk_id || chr(9) || coalesce(sha256, '') || chr(10)) AS h FROM {_C})
SELECT repo, sha256(concat_ws(':', CAST(sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS VARCHAR), CAST(sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)) AS VARCHAR), CAST(count(*) AS VARCHAR))) AS fingerprint FROM h GROUP BY repo""",
    "agg_symbols_by_module": f"SELECT module, count(*) AS n FROM {_S} WHERE coalesce(module, '') <> '' GROUP BY module ORDER BY n DESC, module LIMIT 25",
    "rank_classes": f"SELECT symbol_id, end_line - start_line + 1 AS n_lines FROM {_S} WHERE kind = 'class' ORDER BY n_lines DESC, path, symbol_id LIMIT 25",
    "agg_facets": f"WITH g AS (SELECT repo, regexp_replace(path, '/[^/]*$', '') AS dir, count(*) AS n, array_to_string(list_slice(list_sort(list(DISTINCT path)), 1, 15), '|') AS paths FROM {_F} WHERE path LIKE '%/%' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY n DESC, dir) AS place FROM g) SELECT * FROM r WHERE place <= 12",
    "agg_token_bank": r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '`([^`\n]+)`', 1)) AS token FROM documents)
SELECT token, min(CASE WHEN regexp_matches(token, '^[\w.\-]+(/[\w.\-]+)+$') THEN 'path' WHEN regexp_matches(token, '^[A-Z][A-Z0-9_]+$') THEN 'env' WHEN regexp_matches(token, '^[A-Za-z_][A-Za-z0-9_]*$') THEN 'identifier' ELSE 'other' END) AS kind, count(DISTINCT doc_id) AS n_docs, count(*) AS n FROM t GROUP BY token""",
    "join_grounding": rf"SELECT t.repo, t.token, f.alias IS NOT NULL AS grounded FROM (SELECT DISTINCT repo, unnest(regexp_extract_all(text, '`([\w.\-]+/[\w.\-]+)`', 1)) AS token FROM documents) t LEFT JOIN (SELECT DISTINCT repo, alias FROM {_SUFFIX}) f ON t.repo = f.repo AND t.token = f.alias",
    "rank_budget": "WITH x AS (SELECT source, doc_id, sum((length(text) + 3) // 4) OVER (PARTITION BY source ORDER BY updated_at DESC NULLS LAST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM documents WHERE text IS NOT NULL) SELECT source, doc_id, CAST(used AS BIGINT) AS used FROM x WHERE used <= 4000",
    "agg_depth": f"SELECT section_id, count(*) AS mapped, CAST(least(greatest(ceil(count(*) / 3.0), 1), 8) AS BIGINT) AS target FROM {_USED} GROUP BY section_id",
    "agg_status": f"SELECT f.repo, f.files, coalesce(s.classes, 0) AS classes, CASE WHEN f.files = 0 AND coalesce(s.classes, 0) = 0 THEN 'missing' WHEN f.files >= 300 OR coalesce(s.classes, 0) >= 5 THEN 'present' ELSE 'low' END AS status FROM (SELECT repo, count(*) AS files FROM {_F} GROUP BY repo) f LEFT JOIN (SELECT repo, count(*) AS classes FROM {_S} WHERE kind = 'class' GROUP BY repo) s ON f.repo = s.repo",
    "dedupe_ids": "WITH x AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY indexed_at NULLS FIRST, loaded_at NULLS FIRST) AS n FROM chunks WHERE chunk_id IS NOT NULL) SELECT chunk_id, CASE WHEN n = 1 THEN chunk_id ELSE chunk_id || ':' || chunk_type || '#' || n END AS unique_id FROM x",
    "dedupe_casefold": "WITH t AS (SELECT section_id, unnest(covered_topics) AS topic FROM sections WHERE section_id IS NOT NULL), k AS (SELECT *, lower(trim(topic)) AS key FROM t WHERE topic IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY section_id, topic) AS n FROM k) SELECT key, max(topic) FILTER (n = 1) AS topic, count(DISTINCT section_id) AS n_sections FROM r GROUP BY key",
    "rank_fold": f"WITH {_HITS} SELECT section_id, dedupe_key, path, start_line, end_line, is_span, {list(CONFIDENCES)}[cr + 1] AS confidence, {list(LANES)}[lp + 1] AS lane, lanes FROM fold",
    "rank_ids": f"WITH {_HITS} SELECT 'ev:' || section_id || ':' || lpad(CAST(row_number() OVER (PARTITION BY section_id ORDER BY cr, lp, path, start_line, dedupe_key) AS VARCHAR), 4, '0') AS evidence_id, dedupe_key FROM fold",
    "rank_cap": f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY repo, kind ORDER BY path, start_line, symbol_id) AS place, count(*) OVER (PARTITION BY repo, kind) AS total FROM {_S}) SELECT repo, kind, symbol_id, place, total, total > 5 AS truncated FROM r WHERE place <= 5",
}

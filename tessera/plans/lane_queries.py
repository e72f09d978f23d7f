"""Evidence lanes over whole tables, each with its SQL.

The pages that ask for evidence are the modules: the page of a file requests the range of each of its symbols, its
classes, its routes and, in tests, itself; the page of a repository requests every pattern pack. Hits of a request are
numbered by ``place`` inside their ``step`` (own spans before members before chunks) and capped there, so no group grows
with the data. A request without hits keeps a row with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.index import ensure_index, index_state, search
from tessera.operators.joins import first_per, overlap_join, suffixes
from tessera.operators.patterns import scan
from tessera.operators.ranking import allocate
from tessera.operators.tables import one_per_key
from tessera.plans.analysis_queries import _F, _SCAN, _lines
from tessera.plans.inventory_queries import _CLASS
from tessera.session import checkpoint, shared_path, ship_package, table

LANE_CAP, SECTION_CAP = 8, 40
# The verbs of route decorators.
VERBS = "get|post|put|delete|patch|head|options|websocket"
_ROUTE = rf'^@?\w+(?:\.\w+)*\.({VERBS})\(\s*["\'](/[^"\']*)["\']'


def _files(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "files"), "file_id", ["repo", "path", "line_count"])


def _symbols(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "path", "name", "kind", "module", "parent_symbol_id", "span_id", "start_line", "end_line", "decorators"])


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "chunks"), "chunk_id", ["repo", "path", "start_line", "end_line", "symbol_name", "decorators"])


def _spans(symbols: DataFrame) -> DataFrame:
    """``(repo, path, hit, r_start, r_end)`` of the spans that symbols own."""
    return symbols.filter("span_id IS NOT NULL").groupBy("repo", "path", F.col("span_id").alias("hit")).agg(F.min("start_line").alias("r_start"), F.max("end_line").alias("r_end"))


def _chunk_ranges(chunks: DataFrame) -> DataFrame:
    return chunks.select("repo", "path", F.col("chunk_id").alias("hit"), F.col("start_line").alias("r_start"), F.col("end_line").alias("r_end"))


def _overlapping(requests: DataFrame, ranges: DataFrame, step: int, confidence: str, cap: int = LANE_CAP) -> DataFrame:
    """The first overlapping ranges of each request (repo, path, request, l_start, l_end), earliest start first."""
    near = overlap_join(requests, ranges, ["repo", "path"])
    top = first_per(near, ["repo", "path", "request"], [F.col("r_start"), F.col("hit")], cap)
    return top.select("repo", "path", "request", F.lit(step).alias("step"), "place", "hit", F.lit(confidence).alias("confidence"))


def _ranges(symbols: DataFrame) -> DataFrame:
    return symbols.select("repo", "path", F.col("symbol_id").alias("request"), F.col("start_line").alias("l_start"), F.col("end_line").alias("l_end"))


def lane_file_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Each symbol's line range in its file: overlapping spans (exact), then overlapping chunks (high)."""
    s = _symbols(spark, d)
    r = _ranges(s.filter("kind <> 'module'"))
    return _overlapping(r, _spans(s), 1, "exact").unionByName(_overlapping(r, _chunk_ranges(_chunks(spark, d)), 2, "high"))


def lane_file_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Files asked for without a range: their first chunks (high), or why there are none."""
    docs = table(spark, d, "documents").filter("path IS NOT NULL").select("repo", "path").distinct()
    c = _chunks(spark, d).filter("path IS NOT NULL")
    top = first_per(c, ["repo", "path"], [F.col("start_line"), F.col("chunk_id")], LANE_CAP).select("repo", "path", "place", F.col("chunk_id").alias("hit"))
    known = _files(spark, d).select("repo", "path", F.lit(True).alias("known")).distinct()
    x = docs.join(known, ["repo", "path"], "left").join(top, ["repo", "path"], "left")
    reason = F.when(F.col("hit").isNotNull(), "").when(F.col("known"), "no_hits").otherwise("missing_reference")
    return x.select("repo", "path", "place", "hit", reason.alias("reason"))


def lane_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Each class: its own span (exact), the spans of its members (high), then overlapping chunks (high)."""
    s = _symbols(spark, d)
    own = s.filter("kind = 'class'")
    one = own.select("repo", "path", F.col("symbol_id").alias("request"), F.lit(1).alias("step"), F.lit(1).cast("long").alias("place"), F.coalesce("span_id", F.format_string("span:%s:%d-%d:symbol", "path", "start_line", "end_line")).alias("hit"), F.lit("exact").alias("confidence"))
    kids = s.filter("span_id IS NOT NULL AND parent_symbol_id <> symbol_id").select(F.col("parent_symbol_id").alias("request"), F.col("span_id").alias("hit"), F.col("start_line").alias("at"), "symbol_id")
    members = first_per(kids.join(own.select("repo", "path", F.col("symbol_id").alias("request")), "request"), ["request"], [F.col("at"), F.col("symbol_id")], LANE_CAP)
    members = members.select("repo", "path", "request", F.lit(2).alias("step"), "place", "hit", F.lit("high").alias("confidence"))
    return one.unionByName(members).unionByName(_overlapping(_ranges(own), _chunk_ranges(_chunks(spark, d)), 3, "high"))


def lane_packs(spark: SparkSession, d: str) -> DataFrame:
    """The first eight hits of each pack in each repository: the first chunk and the first span around them (medium), or neither."""
    f = _files(spark, d).select("file_id", "repo")
    hits = checkpoint(scan(_lines(spark, d), ["file_id", "path"], "path").select("pack", "file_id", "path", "line_no").join(f, "file_id"))
    top = first_per(hits, ["pack", "repo"], [F.col("path"), F.col("line_no"), F.col("file_id")], LANE_CAP).withColumnRenamed("place", "row")
    at = top.select("repo", "path", F.col("line_no").alias("request"), F.col("line_no").alias("l_start"), F.col("line_no").alias("l_end")).distinct()
    near = lambda ranges, step: _overlapping(at, ranges, step, "medium", 1).select("repo", "path", F.col("request").alias("line_no"), "hit")
    x = top.join(near(_chunk_ranges(_chunks(spark, d)), 1).withColumnRenamed("hit", "chunk_id"), ["repo", "path", "line_no"], "left")
    x = x.join(near(_spans(_symbols(spark, d)), 2).withColumnRenamed("hit", "span_id"), ["repo", "path", "line_no"], "left")
    return x.select("pack", "repo", F.col("row").alias("place"), "path", F.col("line_no").cast("long").alias("line_no"), "chunk_id", "span_id")


def _routes(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, method and route of each route decorator."""
    x = df.select(*keys, F.explode("decorators").alias("text")).filter(F.col("text").rlike(_ROUTE))
    return x.select(*keys, F.upper(F.regexp_extract("text", _ROUTE, 1)).alias("method"), F.regexp_extract("text", _ROUTE, 2).alias("route")).distinct()


def operations(spark: SparkSession, d: str) -> DataFrame:
    """Operations derived from route decorators: method, public route and handler, sorted by route."""
    x = _routes(_symbols(spark, d), ["repo", "symbol_id"])
    return x.groupBy("repo", "route", "method").agg(F.min("symbol_id").alias("handler"), F.count(F.lit(1)).alias("n_handlers")).withColumn("public", public_route(F.col("route")))


def public_route(route: Column) -> Column:
    """Parameters in braces; routes outside of /api and /v1 get the prefix /api/v1, /v1 ones /api."""
    braced = F.regexp_replace(route, r"<([^>/]+)>", "{$1}")
    return F.when(braced.startswith("/api/"), braced).when(braced.startswith("/v1/"), F.concat(F.lit("/api"), braced)).otherwise(F.concat(F.lit("/api/v1"), braced))


def contract_requests(spark: SparkSession, d: str) -> DataFrame:
    """Routes that chunks declare, against the operations of their repository: exact, path_only or no_match, with handler, its span and first chunk."""
    s = _symbols(spark, d)
    ops = checkpoint(operations(spark, d))
    asked = _routes(_chunks(spark, d), ["repo", "path"])
    exact = ops.select("repo", "route", "method", "handler")
    routes = ops.groupBy("repo", "route").agg(F.array_join(F.array_sort(F.collect_set("method")), ",").alias("methods"))
    x = asked.join(exact, ["repo", "route", "method"], "left").join(routes, ["repo", "route"], "left")
    verdict = F.when(F.col("handler").isNotNull(), "exact").when(F.col("methods").isNotNull(), "path_only").otherwise("no_match")
    at = s.select(F.col("symbol_id").alias("handler"), F.col("path").alias("h_path"), F.col("span_id").alias("span"), "start_line", "end_line")
    x = x.join(at, "handler", "left").withColumn("resolution", verdict)
    want = x.filter("handler IS NOT NULL").select("repo", F.col("h_path").alias("path"), F.col("handler").alias("request"), F.col("start_line").alias("l_start"), F.col("end_line").alias("l_end")).distinct()
    first = _overlapping(want, _chunk_ranges(_chunks(spark, d)), 1, "exact", 1).select(F.col("request").alias("handler"), F.col("hit").alias("chunk_id"))
    return x.join(first, "handler", "left").select("repo", "path", "method", "route", "resolution", F.when(F.col("resolution") == "path_only", F.col("methods")).alias("methods"), "handler", F.col("span").alias("span_id"), "chunk_id")


def lane_tests(spark: SparkSession, d: str) -> DataFrame:
    """E5, A10: test files: their first eight chunks (high) with up to eight of their test functions, or no_hits."""
    tests = _files(spark, d).filter(S.classify(F.col("path")) == "test").select("repo", "path").distinct()
    cases = first_per(_symbols(spark, d).filter("kind IN ('function', 'method') AND name LIKE 'test%'"), ["repo", "path"], [F.col("start_line"), F.col("symbol_id")], LANE_CAP)
    cases = cases.groupBy("repo", "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]), "|").alias("cases"))
    c = first_per(_chunks(spark, d).filter("path IS NOT NULL"), ["repo", "path"], [F.col("start_line"), F.col("chunk_id")], LANE_CAP).select("repo", "path", "place", F.col("chunk_id").alias("hit"))
    x = tests.join(c, ["repo", "path"], "left").join(cases, ["repo", "path"], "left")
    return x.select("repo", "path", "place", "hit", "cases", F.when(F.col("hit").isNull(), "no_hits").otherwise("").alias("reason"))


def resolve_symbol_forms(spark: SparkSession, d: str) -> DataFrame:
    """References to symbols in each of their forms: exact ids, else the unique one of the alias's symbols, else ambiguous with up to 25 of them.

    Aliases are the name, module.name, module.parent.name, the module, path:name and path:line.
    """
    s = _symbols(spark, d)
    up = s.select(F.col("symbol_id").alias("parent_symbol_id"), F.col("name").alias("p_name"))
    t = s.join(up, "parent_symbol_id", "left")
    inner = (F.col("kind") != "module") & (F.col("module") != "")
    forms = F.array(
        F.col("name"),
        F.when(F.col("kind") == "module", F.nullif(F.col("module"), F.lit(""))).otherwise(F.when(inner, F.concat_ws(".", "module", "name"))),
        F.when(inner & F.col("p_name").isNotNull() & (F.col("p_name") != F.col("name")), F.concat_ws(".", "module", "p_name", "name")),
        F.concat(F.col("path"), F.lit(":"), F.col("name")),
        F.concat(F.col("path"), F.lit(":"), F.col("start_line").cast("string")),
    )
    aliases = t.select("repo", "symbol_id", F.explode(F.filter(forms, lambda x: x.isNotNull())).alias("ref")).distinct()
    c = _chunks(spark, d)
    named = c.filter("symbol_name IS NOT NULL").select("repo", F.explode(F.array(F.col("symbol_name"), F.concat("path", F.lit(":"), "symbol_name"))).alias("ref"))
    placed = c.select("repo", F.concat(F.col("path"), F.lit(":"), F.col("start_line").cast("string")).alias("ref"))
    ids = s.select("repo", F.col("symbol_id").alias("ref"))
    refs = named.unionByName(placed).unionByName(ids).filter("ref IS NOT NULL").distinct()
    count = aliases.groupBy("repo", "ref").agg(F.count(F.lit(1)).alias("n"))
    few = first_per(aliases, ["repo", "ref"], [F.col("symbol_id")], 25).groupBy("repo", "ref").agg(F.array_join(F.array_sort(F.collect_list("symbol_id")), "|").alias("found"))
    x = refs.join(ids.withColumn("own", F.lit(True)).distinct(), ["repo", "ref"], "left").join(count, ["repo", "ref"], "left").join(few, ["repo", "ref"], "left")
    verdict = F.when(F.col("own"), "exact").when(F.col("n") == 1, "unique_alias").when(F.col("n") > 1, "ambiguous").otherwise("no_match")
    return x.select("repo", "ref", verdict.alias("resolution"), F.when(F.col("own"), F.col("ref")).when(F.col("n") == 1, F.col("found")).alias("symbol_id"), F.when(F.col("own").isNull() & (F.col("n") > 1), F.col("found")).alias("candidates"))


def resolve_tests(spark: SparkSession, d: str) -> DataFrame:
    """References to tests as file::function, by the whole path or by its last part: test_file, unique_suffix, ambiguous, file_exists or hint."""
    f = _files(spark, d).filter("path IS NOT NULL").select("repo", "path").distinct().withColumn("test", S.classify(F.col("path")) == "test")
    fn = _symbols(spark, d).filter("kind = 'function'").groupBy("repo", "path").agg(F.min("name").alias("fn"))
    base = F.element_at(F.split("path", "/"), -1)
    refs = f.join(fn, ["repo", "path"], "left").select("repo", F.explode(F.array("path", base)).alias("file"), "fn").select("repo", F.concat_ws("::", "file", "fn").alias("ref")).distinct()
    refs = refs.withColumns({"file": F.substring_index("ref", "::", 1), "function": F.nullif(F.regexp_extract("ref", "::(.*)$", 1), F.lit(""))})
    tails = f.filter("test").select("repo", "path", F.explode(suffixes(F.col("path"))).alias("file"))
    count = tails.groupBy("repo", "file").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("one"))
    whole = f.select("repo", F.col("path").alias("file"), "test")
    x = refs.join(whole, ["repo", "file"], "left").join(count, ["repo", "file"], "left")
    verdict = F.when(F.col("test"), "test_file").when(F.col("n") == 1, "unique_suffix").when(F.col("n") > 1, "ambiguous").when(~F.col("test"), "file_exists").otherwise("hint")
    x = x.withColumn("resolution", verdict)
    path = F.when(F.col("resolution").isin("test_file", "file_exists"), F.col("file")).when(F.col("resolution") == "unique_suffix", F.col("one"))
    return x.select("repo", "ref", "resolution", path.alias("path"), "function")


def anchor_forms(spark: SparkSession, d: str) -> DataFrame:
    """Ranges named for files, checked against their line counts: exact_range, line_only, file_only or unresolved."""
    f = _files(spark, d).filter("path IS NOT NULL").groupBy("repo", "path").agg(F.max("line_count").alias("line_count"))
    c = _chunks(spark, d).filter("path IS NOT NULL").select("repo", "path", F.explode(F.array(F.format_string("%d-%d", "start_line", "end_line"), F.format_string("%d-%d", "end_line", "start_line"), F.col("end_line").cast("string"), F.coalesce("symbol_name", F.lit("intro")))).alias("anchor")).distinct()
    x = c.join(f.withColumn("known", F.lit(True)), ["repo", "path"], "left")
    number = F.col("anchor").rlike(r"^\d+(-\d+)?$")
    a, b = F.regexp_extract("anchor", r"^(\d+)", 1).cast("long"), F.regexp_extract("anchor", r"(\d+)$", 1).cast("long")
    valid = F.col("line_count").isNull() | ((a >= 1) & (b <= F.col("line_count")) & (a <= b))
    conf = F.when(F.col("known").isNull(), "unresolved").when(~number, "file_only").when(~valid, "file_only").when(a == b, "line_only").otherwise("exact_range")
    return x.select("repo", "path", "anchor", conf.alias("confidence"), F.when(number, F.least(a, b)).alias("first_line"), F.when(number, F.greatest(a, b)).alias("last_line"))


def _hits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Requests (section_id, request, lane) of all module pages, and their candidates (section_id, request, lane, item)."""
    page = F.concat_ws("/", "repo", "path").alias("section_id")
    s = _symbols(spark, d)
    asked = s.filter("kind <> 'module'").select(page, F.concat(F.lit("file_anchor|"), "symbol_id").alias("request"), F.lit("file_anchor").alias("lane"))
    asked = asked.unionByName(s.filter("kind = 'class'").select(page, F.concat(F.lit("symbol_anchor|"), "symbol_id").alias("request"), F.lit("symbol_anchor").alias("lane")))
    tests = lane_tests(spark, d)
    asked = asked.unionByName(tests.select(page, F.concat(F.lit("test|"), "path").alias("request"), F.lit("test").alias("lane")).distinct())
    rank = lambda df: df.withColumn("rank", F.col("step") * 100 + F.col("place"))
    got = None
    for lane, df in (("file_anchor", rank(lane_file_ranges(spark, d))), ("symbol_anchor", rank(lane_symbols(spark, d))), ("test", tests.filter("hit IS NOT NULL").withColumns({"request": F.col("path"), "rank": F.col("place")}))):
        part = df.select(page, F.concat(F.lit(f"{lane}|"), "request").alias("request"), F.lit(lane).alias("lane"), F.col("hit").alias("item"), F.col("rank").cast("long").alias("rank"))
        got = part if got is None else got.unionByName(part)
    return asked, got


SEARCHES = {"q1": "list_items of the chunk index", "q2": "describing changed summaries", "q3": "release notes parser", "q4": "retrieval lanes symbols", "q5": "evidence packets waiting"}


def index_search(spark: SparkSession, d: str) -> DataFrame:
    """The stored index of all documents, built and verified, searched by stems and phrases."""
    docs, path = table(spark, d, "documents"), shared_path(spark, "index")
    ensure_index(docs, "doc_id", "text", path)
    return search(spark, path, SEARCHES, "doc_id")


def index_states(spark: SparkSession, d: str) -> DataFrame:
    """What is found of an index that is not there, is fresh, is forced, and whose corpus has changed."""
    docs, path = table(spark, d, "documents"), shared_path(spark, "index")
    steps = [("first", ensure_index(docs, "doc_id", "text", path)), ("again", ensure_index(docs, "doc_id", "text", path)), ("forced", ensure_index(docs, "doc_id", "text", path, force=True))]
    changed = docs.select("doc_id", F.when(F.col("doc_id") == 1, F.lit("changed")).otherwise(F.col("text")).alias("text"))
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, "new")], "doc_id long, text string"))
    steps += [("changed", index_state(spark, path, changed, "doc_id", "text")), ("grown", index_state(spark, path, more, "doc_id", "text"))]
    return spark.createDataFrame(steps, "step string, state string")


def coverage_exact(spark: SparkSession, d: str) -> DataFrame:
    """What each exact request of a module page kept under the caps: covered, starved_by_cap or no_hits.

    A request has at most three times the lane's cap of candidates when its page is gathered.
    """
    ship_package(spark)
    asked, got = (checkpoint(x) for x in _hits(spark, d))
    items = got.groupBy("section_id", "item").agg(F.min(F.struct("rank", "lane")).alias("m"), F.array_sort(F.collect_set("request")).alias("requests"))
    items = items.select("section_id", "item", F.col("m.lane").alias("lane"), F.col("m.rank").alias("place"), "requests")
    kept = allocate(items, per_lane=LANE_CAP, total=SECTION_CAP).select("section_id", "item", F.lit(1).alias("kept"))
    n = got.select("section_id", "request", "item").distinct().join(kept, ["section_id", "item"], "left").groupBy("section_id", "request").agg(F.count(F.lit(1)).alias("candidates"), F.sum(F.coalesce("kept", F.lit(0))).alias("kept"))
    x = asked.join(n, ["section_id", "request"], "left")
    status = F.when(F.col("candidates").isNull(), "no_hits").when(F.col("kept") > 0, "covered").otherwise("starved_by_cap")
    return x.select("section_id", "lane", "request", F.coalesce("candidates", F.lit(0)).cast("long").alias("candidates"), F.coalesce("kept", F.lit(0)).cast("long").alias("kept"), status.alias("status"))


def lane_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per lane of the module pages the requests, those with candidates, the candidates and the lane's status."""
    asked, got = _hits(spark, d)
    n = got.groupBy("lane", "section_id", "request").agg(F.countDistinct("item").alias("n"))
    x = asked.join(n, ["lane", "section_id", "request"], "left").groupBy("lane").agg(F.count(F.lit(1)).alias("requested"), F.count("n").alias("resolved"), F.sum(F.coalesce("n", F.lit(0))).alias("candidates"))
    return x.withColumn("status", F.when(F.col("requested") == 0, "not_requested").when(F.col("candidates") > 0, "pass").otherwise("miss"))


_S = "(SELECT symbol_id, max(repo) AS repo, max(path) AS path, max(name) AS name, max(kind) AS kind, max(module) AS module, max(parent_symbol_id) AS parent_symbol_id, max(span_id) AS span_id, max(start_line) AS start_line, max(end_line) AS end_line, max(decorators) AS decorators FROM symbols WHERE symbol_id IS NOT NULL GROUP BY symbol_id)"
_C = "(SELECT chunk_id, max(repo) AS repo, max(path) AS path, max(start_line) AS start_line, max(end_line) AS end_line, max(symbol_name) AS symbol_name, max(decorators) AS decorators FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id)"
_FL = "(SELECT file_id, max(repo) AS repo, max(path) AS path, max(line_count) AS line_count FROM files WHERE file_id IS NOT NULL GROUP BY file_id)"
_BASE = f"""s AS MATERIALIZED {_S}, c AS MATERIALIZED {_C}, f AS MATERIALIZED {_FL},
sp AS (SELECT repo, path, span_id AS hit, min(start_line) AS a, max(end_line) AS z FROM s WHERE span_id IS NOT NULL GROUP BY ALL),
ch AS (SELECT repo, path, chunk_id AS hit, start_line AS a, end_line AS z FROM c)"""


def _near_sql(requests: str, ranges: str, step: int, confidence: str, cap: int = LANE_CAP) -> str:
    return f"SELECT repo, path, request, {step} AS step, place, hit, '{confidence}' AS confidence FROM (SELECT q.repo, q.path, q.request, r.hit, row_number() OVER (PARTITION BY q.repo, q.path, q.request ORDER BY r.a, r.hit) AS place FROM {requests} q JOIN {ranges} r ON q.repo = r.repo AND q.path = r.path AND r.a <= q.z AND q.a <= r.z) WHERE place <= {cap}"


_RANGES = "(SELECT repo, path, symbol_id AS request, start_line AS a, end_line AS z FROM s WHERE kind <> 'module')"
_CLASSES = "(SELECT repo, path, symbol_id AS request, start_line AS a, end_line AS z FROM s WHERE kind = 'class')"
_RANGED = f"({_near_sql(_RANGES, 'sp', 1, 'exact')} UNION ALL {_near_sql(_RANGES, 'ch', 2, 'high')})"
_MEMBERS = f"""(SELECT repo, path, symbol_id AS request, 1 AS step, 1 AS place, coalesce(span_id, 'span:' || path || ':' || start_line || '-' || end_line || ':symbol') AS hit, 'exact' AS confidence FROM s WHERE kind = 'class'
UNION ALL SELECT repo, path, request, 2, place, hit, 'high' FROM (SELECT o.repo, o.path, o.symbol_id AS request, k.span_id AS hit, row_number() OVER (PARTITION BY o.symbol_id ORDER BY k.start_line, k.symbol_id) AS place FROM s o JOIN s k ON k.parent_symbol_id = o.symbol_id WHERE o.kind = 'class' AND k.span_id IS NOT NULL AND k.parent_symbol_id <> k.symbol_id) WHERE place <= {LANE_CAP}
UNION ALL {_near_sql(_CLASSES, 'ch', 3, 'high')})"""
_TOP = f"(SELECT repo, path, place, hit FROM (SELECT repo, path, chunk_id AS hit, row_number() OVER (PARTITION BY repo, path ORDER BY start_line, chunk_id) AS place FROM c WHERE path IS NOT NULL) WHERE place <= {LANE_CAP})"
_TESTS = f"(SELECT DISTINCT repo, path FROM f WHERE path IS NOT NULL AND {_CLASS} = 'test')"
_TEST_LANE = f"""(SELECT t.repo, t.path, h.place, h.hit, k.cases, CASE WHEN h.hit IS NULL THEN 'no_hits' ELSE '' END AS reason FROM {_TESTS} t LEFT JOIN {_TOP} h ON t.repo = h.repo AND t.path = h.path
LEFT JOIN (SELECT repo, path, string_agg(name, '|' ORDER BY place) AS cases FROM (SELECT repo, path, name, row_number() OVER (PARTITION BY repo, path ORDER BY start_line, symbol_id) AS place FROM s WHERE kind IN ('function', 'method') AND name LIKE 'test%') WHERE place <= {LANE_CAP} GROUP BY ALL) k ON t.repo = k.repo AND t.path = k.path)"""
_ROUTES = rf"upper(regexp_extract(t, '^@?\w+(?:\.\w+)*\.({VERBS})\(\s*[\"'']', 1)) AS method, regexp_extract(t, '^@?\w+(?:\.\w+)*\.(?:{VERBS})\(\s*[\"''](/[^\"'']*)[\"'']', 1) AS route"
_ROUTED = rf"regexp_matches(t, '^@?\w+(?:\.\w+)*\.(?:{VERBS})\(\s*[\"''](/[^\"'']*)[\"'']')"
_OPS = f"""ops AS MATERIALIZED (SELECT repo, route, method, min(symbol_id) AS handler, count(*) AS n_handlers FROM (SELECT DISTINCT repo, symbol_id, {_ROUTES} FROM (SELECT repo, symbol_id, unnest(decorators) AS t FROM s) WHERE {_ROUTED}) GROUP BY ALL)"""

QUERIES = {
    f.__name__: f
    for f in (
        lane_file_ranges, lane_file_chunks, lane_symbols, lane_packs, operations, contract_requests, lane_tests,
        resolve_symbol_forms, resolve_tests, anchor_forms, coverage_exact, lane_totals, index_search, index_states,
    )
}

ORACLE = {
    "index_states": "SELECT * FROM (VALUES ('first', 'missing'), ('again', 'verified'), ('forced', 'forced'), ('changed', 'stale'), ('grown', 'stale')) t(step, state)",
    "lane_file_ranges": f"WITH {_BASE} SELECT * FROM {_RANGED}",
    "lane_file_chunks": f"""WITH {_BASE} SELECT q.repo, q.path, t.place, t.hit, CASE WHEN t.hit IS NOT NULL THEN '' WHEN k.path IS NOT NULL THEN 'no_hits' ELSE 'missing_reference' END AS reason
FROM (SELECT DISTINCT repo, path FROM documents WHERE path IS NOT NULL) q LEFT JOIN (SELECT DISTINCT repo, path FROM f) k ON q.repo = k.repo AND q.path = k.path LEFT JOIN {_TOP} t ON q.repo = t.repo AND q.path = t.path""",
    "lane_symbols": f"WITH {_BASE} SELECT * FROM {_MEMBERS}",
    "lane_packs": f"""WITH {_BASE}, h AS MATERIALIZED (SELECT * FROM (SELECT x.pack, g.repo, x.path, x.line_no, row_number() OVER (PARTITION BY x.pack, g.repo ORDER BY x.path, x.line_no, x.file_id) AS place FROM {_SCAN} x JOIN {_F} g ON x.file_id = g.file_id) WHERE place <= {LANE_CAP}),
q AS (SELECT DISTINCT repo, path, line_no AS request, line_no AS a, line_no AS z FROM h), nc AS ({_near_sql('q', 'ch', 1, 'medium', 1)}), ns AS ({_near_sql('q', 'sp', 2, 'medium', 1)})
SELECT h.pack, h.repo, h.place, h.path, h.line_no, nc.hit AS chunk_id, ns.hit AS span_id FROM h LEFT JOIN nc ON h.repo = nc.repo AND h.path = nc.path AND h.line_no = nc.request LEFT JOIN ns ON h.repo = ns.repo AND h.path = ns.path AND h.line_no = ns.request""",
    "operations": rf"""WITH {_BASE}, {_OPS}, b AS (SELECT *, regexp_replace(route, '<([^>/]+)>', '{{\1}}', 'g') AS r FROM ops)
SELECT repo, route, method, handler, n_handlers, CASE WHEN starts_with(r, '/api/') THEN r WHEN starts_with(r, '/v1/') THEN '/api' || r ELSE '/api/v1' || r END AS public FROM b""",
    "contract_requests": f"""WITH {_BASE}, {_OPS}, asked AS (SELECT DISTINCT repo, path, {_ROUTES} FROM (SELECT repo, path, unnest(decorators) AS t FROM c) WHERE {_ROUTED}),
m AS (SELECT repo, route, string_agg(DISTINCT method, ',' ORDER BY method) AS methods FROM ops GROUP BY ALL),
x AS (SELECT a.*, o.handler, m.methods, CASE WHEN o.handler IS NOT NULL THEN 'exact' WHEN m.methods IS NOT NULL THEN 'path_only' ELSE 'no_match' END AS resolution FROM asked a LEFT JOIN ops o ON a.repo = o.repo AND a.route = o.route AND a.method = o.method LEFT JOIN m ON a.repo = m.repo AND a.route = m.route),
q AS (SELECT DISTINCT x.repo, h.path, x.handler AS request, h.start_line AS a, h.end_line AS z FROM x JOIN s h ON x.handler = h.symbol_id), n AS ({_near_sql('q', 'ch', 1, 'exact', 1)})
SELECT x.repo, x.path, x.method, x.route, x.resolution, CASE WHEN x.resolution = 'path_only' THEN x.methods END AS methods, x.handler, h.span_id, n.hit AS chunk_id FROM x LEFT JOIN s h ON x.handler = h.symbol_id LEFT JOIN n ON x.handler = n.request""",
    "lane_tests": f"WITH {_BASE} SELECT * FROM {_TEST_LANE}",
    "resolve_symbol_forms": f"""WITH {_BASE}, t AS (SELECT s.*, u.name AS p_name FROM s LEFT JOIN s u ON s.parent_symbol_id = u.symbol_id),
al AS MATERIALIZED (SELECT DISTINCT repo, symbol_id, ref FROM (SELECT repo, symbol_id, name AS ref FROM t
UNION ALL SELECT repo, symbol_id, module FROM t WHERE kind = 'module' AND module <> '' UNION ALL SELECT repo, symbol_id, concat_ws('.', module, name) FROM t WHERE kind <> 'module' AND module <> ''
UNION ALL SELECT repo, symbol_id, concat_ws('.', module, p_name, name) FROM t WHERE kind <> 'module' AND module <> '' AND p_name <> name
UNION ALL SELECT repo, symbol_id, path || ':' || name FROM t UNION ALL SELECT repo, symbol_id, path || ':' || start_line FROM t) WHERE ref IS NOT NULL),
refs AS (SELECT DISTINCT * FROM (SELECT repo, symbol_name AS ref FROM c UNION ALL SELECT repo, path || ':' || symbol_name FROM c UNION ALL SELECT repo, path || ':' || start_line FROM c UNION ALL SELECT repo, symbol_id FROM s) WHERE ref IS NOT NULL),
n AS (SELECT repo, ref, count(*) AS n, array_to_string(list_slice(list_sort(list(symbol_id)), 1, 25), '|') AS found FROM al GROUP BY ALL), own AS (SELECT DISTINCT repo, symbol_id AS ref FROM s)
SELECT r.repo, r.ref, CASE WHEN o.ref IS NOT NULL THEN 'exact' WHEN n.n = 1 THEN 'unique_alias' WHEN n.n > 1 THEN 'ambiguous' ELSE 'no_match' END AS resolution,
CASE WHEN o.ref IS NOT NULL THEN r.ref WHEN n.n = 1 THEN n.found END AS symbol_id, CASE WHEN o.ref IS NULL AND n.n > 1 THEN n.found END AS candidates
FROM refs r LEFT JOIN own o ON r.repo = o.repo AND r.ref = o.ref LEFT JOIN n ON r.repo = n.repo AND r.ref = n.ref""",
    "resolve_tests": f"""WITH {_BASE}, g AS MATERIALIZED (SELECT repo, path, bool_or(test) AS test FROM (SELECT repo, path, {_CLASS} = 'test' AS test FROM f WHERE path IS NOT NULL) GROUP BY ALL),
fn AS (SELECT repo, path, min(name) AS fn FROM s WHERE kind = 'function' GROUP BY ALL),
refs AS (SELECT DISTINCT repo, concat_ws('::', file, fn) AS ref, file, fn AS function FROM (SELECT g.repo, unnest([g.path, string_split(g.path, '/')[-1]]) AS file, fn.fn FROM g LEFT JOIN fn ON g.repo = fn.repo AND g.path = fn.path)),
tails AS (SELECT repo, file, count(*) AS n, min(path) AS one FROM (SELECT repo, path, array_to_string(list_slice(string_split(path, '/'), i, 1000), '/') AS file FROM g, range(1, 1000) r(i) WHERE test AND i <= len(string_split(path, '/'))) GROUP BY ALL),
x AS (SELECT r.*, g.test, t.n, t.one, CASE WHEN g.test THEN 'test_file' WHEN t.n = 1 THEN 'unique_suffix' WHEN t.n > 1 THEN 'ambiguous' WHEN NOT g.test THEN 'file_exists' ELSE 'hint' END AS resolution FROM refs r LEFT JOIN g ON r.repo = g.repo AND r.file = g.path LEFT JOIN tails t ON r.repo = t.repo AND r.file = t.file)
SELECT repo, ref, resolution, CASE WHEN resolution IN ('test_file', 'file_exists') THEN file WHEN resolution = 'unique_suffix' THEN one END AS path, function FROM x""",
    "anchor_forms": f"""WITH {_BASE}, g AS (SELECT repo, path, max(line_count) AS line_count FROM f WHERE path IS NOT NULL GROUP BY ALL),
a AS (SELECT DISTINCT repo, path, unnest([start_line || '-' || end_line, end_line || '-' || start_line, CAST(end_line AS VARCHAR), coalesce(symbol_name, 'intro')]) AS anchor FROM c WHERE path IS NOT NULL),
x AS (SELECT a.*, g.path IS NOT NULL AS known, g.line_count, TRY_CAST(regexp_extract(anchor, '^(\\d+)(-\\d+)?$', 1) AS BIGINT) AS p, TRY_CAST(regexp_extract(anchor, '^(?:\\d+-)?(\\d+)$', 1) AS BIGINT) AS q FROM a LEFT JOIN g ON a.repo = g.repo AND a.path = g.path)
SELECT repo, path, anchor, CASE WHEN NOT known THEN 'unresolved' WHEN p IS NULL THEN 'file_only' WHEN line_count IS NOT NULL AND NOT (p >= 1 AND q <= line_count AND p <= q) THEN 'file_only' WHEN p = q THEN 'line_only' ELSE 'exact_range' END AS confidence,
least(p, q) AS first_line, greatest(p, q) AS last_line FROM x""",
    "lane_totals": f"""WITH {_BASE}, asked AS (SELECT concat_ws('/', repo, path) AS section, 'file_anchor' AS lane, symbol_id AS request FROM s WHERE kind <> 'module' UNION ALL SELECT concat_ws('/', repo, path), 'symbol_anchor', symbol_id FROM s WHERE kind = 'class'
UNION ALL SELECT concat_ws('/', repo, path), 'test', path FROM {_TESTS}), got AS (SELECT 'file_anchor' AS lane, concat_ws('/', repo, path) AS section, request, hit FROM {_RANGED} UNION ALL SELECT 'symbol_anchor', concat_ws('/', repo, path), request, hit FROM {_MEMBERS} UNION ALL SELECT 'test', concat_ws('/', repo, path), path, hit FROM {_TEST_LANE} WHERE hit IS NOT NULL),
n AS (SELECT lane, section, request, count(DISTINCT hit) AS n FROM got GROUP BY ALL)
SELECT a.lane, count(*) AS requested, count(n.n) AS resolved, CAST(sum(coalesce(n.n, 0)) AS BIGINT) AS candidates, CASE WHEN sum(coalesce(n.n, 0)) > 0 THEN 'pass' ELSE 'miss' END AS status FROM asked a LEFT JOIN n ON a.lane = n.lane AND a.section = n.section AND a.request = n.request GROUP BY a.lane""",
}

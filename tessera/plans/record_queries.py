"""Derived records of symbols, chunks, sections and texts: ids, flags, spans, rankings, tallies and gates, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.chunking import text_lines
from tessera.operators.hierarchy import hierarchies, resolve_hierarchy
from tessera.operators.joins import first_per
from tessera.operators.tables import one_per_key
from tessera.plans import lane_queries as lanes
from tessera.plans.hierarchy_queries import _WALK
from tessera.plans.inventory_queries import _CLASS, _in
from tessera.plans.taxonomy import PROFILES
from tessera.session import checkpoint, table

# Parts of decorators, bases and names that mark a runtime surface.
ROUTE_MARKS = ("route", ".get", ".post", ".put", ".patch", ".delete", ".websocket", "app.", "router.", "blueprint", "api_view", "requestmapping", "getmapping", "postmapping")
WORKER_MARKS = ("task", "shared_task", "celery", "periodic", "cron", "scheduled", "rq.", "huey", "dramatiq")
CLI_MARKS = ("command", "click", "group", "argument", "option", "app.command")
MODEL_BASES = ("basemodel", "model", "schema", "table", "document", "dataclass", "namedtuple", "typeddict", "declarative_base")
CONFIG_SYMBOLS = ("settings", "config", "configuration", "appconfig", "basesettings")
# What unfinished or evasive text looks like.
PLACEHOLDERS = (
    r"(?i)\btodo\b", r"(?i)\btbd\b", r"(?i)\bfixme\b", r"\bxxx\b", r"(?i)needs?\s+citation", r"(?i)add\s+more\s+detail", r"(?i)placeholder", r"(?i)\[\s*(?:todo|tbd|fill in|insert)\b",
    r"(?i)\blorem ipsum\b", r"(?i)\bas an ai\b", r"(?i)\bi (?:cannot|can't|am unable to|was unable to)\b", r"(?i)\bi (?:apologize|'m sorry|am sorry)\b", r"(?i)\bi do not have (?:access|enough)\b",
)
# Token families of excerpts as name -> (pattern, group); what may not come before is consumed, as no engine needs to look behind.
FAMILIES = {
    "import_from": (r"(?m)^[ \t]*from[ \t]+([\w.]+)[ \t]+import[ \t]+", 1),
    "import_plain": (r"(?m)^[ \t]*import[ \t]+([\w.]+)(?:[ \t]+as[ \t]+\w+)?[ \t]*$", 1),
    "class_def": (r"\bclass[ \t]+([A-Za-z_]\w*)", 1),
    "func_def": (r"\b(?:async[ \t]+)?def[ \t]+([A-Za-z_]\w*)", 1),
    "method_path": (r"\b(?:GET|POST|PUT|DELETE|PATCH|HEAD|OPTIONS)[ \t]+(/[\w/{}.:-]*)", 1),
    "dotted": (r"\b[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+\b", 0),
    "slash": (r"(?:^|[^\w.])(/[A-Za-z0-9_./{}:-]+)", 1),
    "rel_path": (r"\b[\w.+-]+(?:/[\w.+-]+)+\.[A-Za-z0-9]{1,8}\b", 0),
    "rel_dir": (r"(?:^|[^\w./:-])([\w.+-]+(?:/[\w.+-]+)*/)", 1),
    "env_var": (r"\b[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+\b", 0),
}
LONG_UNIT, LONG_OVERLAP, TOP = 220, 15, 25
EVIDENCE_PER_CLAIM, MOST_CLAIMS = 3, 8


def _symbols(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "symbols"), "symbol_id", ["repo", "path", "name", "kind", "module", "parent_symbol_id", "span_id", "start_line", "end_line", "decorators", "bases"])


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "chunks"), "chunk_id", ["repo", "path", "start_line", "end_line", "chunk_type", "symbol_name", "text"])


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "sections"), "section_id", ["repo", "title", "section_role", "page_profile", "section_order", "parent_section_id", "markdown", "used_evidence_ids", "covered_topics", "coverage_labels"])


def _lower_all(column: str) -> Column:
    return F.lower(F.array_join(F.coalesce(F.col(column), F.expr("cast(array() as array<string>)")), " "))


def symbol_flags(spark: SparkSession, d: str) -> DataFrame:
    """Whether a symbol looks like a route, a worker, a command, a model or a configuration."""
    has = lambda c, marks: S.any_of([c.contains(m) for m in marks])
    low = F.lower(F.coalesce("name", F.lit("")))
    decs = _lower_all("decorators")
    return _symbols(spark, d).select(
        "symbol_id", has(decs, ROUTE_MARKS).alias("is_route"), has(decs, WORKER_MARKS).alias("is_worker"), has(decs, CLI_MARKS).alias("is_cli"),
        ((F.col("kind") == "class") & has(_lower_all("bases"), MODEL_BASES)).alias("is_model"), (low.isin(*CONFIG_SYMBOLS) | low.endswith("settings") | low.endswith("config")).alias("is_config"),
    )


def build_ids(spark: SparkSession, d: str) -> DataFrame:
    """P5: ids of symbols, spans and chunks rebuilt from their parts, and whether the stored ones agree."""
    s = _symbols(spark, d)
    mark = F.when(F.col("kind") == "class", "#").otherwise("().")
    own = F.when(F.col("kind") == "module", F.concat(F.lit("python "), "module", F.lit("/"))).otherwise(F.concat("parent_symbol_id", "name", mark))
    a = s.select(F.lit("symbol").alias("kind"), F.col("symbol_id").alias("id"), own.alias("built"))
    b = s.filter("span_id IS NOT NULL AND kind <> 'module'").select(F.lit("span").alias("kind"), F.col("span_id").alias("id"), F.format_string("span:%s:%d-%d:%s", "path", "start_line", "end_line", "kind").alias("built")).distinct()
    c = _chunks(spark, d).filter("path IS NOT NULL").select(F.lit("chunk").alias("kind"), F.col("chunk_id").alias("id"), F.format_string("chunk:%s/%s:%d-%d", "repo", "path", "start_line", "end_line").alias("built"))
    return a.unionByName(b).unionByName(c).withColumn("same", F.col("id").eqNullSafe(F.col("built")))


def all_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans of Python files (a header up to the first definition, and every symbol) and of other files (one for each chunk)."""
    s = _symbols(spark, d)
    n = one_per_key(table(spark, d, "files"), "file_id", ["repo", "path", "line_count"]).filter("path LIKE '%.py'").groupBy("repo", "path").agg(F.max("line_count").alias("n"))
    first = s.filter("kind <> 'module'").groupBy("repo", "path").agg(F.min("start_line").alias("at"))
    last = F.greatest(F.lit(1), F.least(F.coalesce(F.col("at") - 1, F.col("n")), F.coalesce("n", F.col("at") - 1)))
    head = s.filter("kind = 'module'").select("repo", "path").distinct().join(n, ["repo", "path"]).join(first, ["repo", "path"], "left").select("repo", "path", F.lit(1).cast("long").alias("first_line"), F.coalesce(last, F.lit(1)).cast("long").alias("last_line"), F.lit("module_header").alias("span_type"))
    own = s.filter("kind <> 'module'").select("repo", "path", F.col("start_line").cast("long").alias("first_line"), F.col("end_line").cast("long").alias("last_line"), F.col("kind").alias("span_type"))
    rest = _chunks(spark, d).filter("path NOT LIKE '%.py'").select("repo", "path", F.col("start_line").cast("long").alias("first_line"), F.col("end_line").cast("long").alias("last_line"), F.col("chunk_type").alias("span_type"))
    return head.unionByName(own).unionByName(rest).distinct()


def long_units(spark: SparkSession, d: str) -> DataFrame:
    """Units of more than 220 lines in overlapping parts with part numbers; all others whole."""
    s = _symbols(spark, d).filter("kind <> 'module' AND end_line >= start_line")
    step = LONG_UNIT - LONG_OVERLAP
    n = F.col("end_line") - F.col("start_line") + 1
    k = F.when(n <= LONG_UNIT, 1).otherwise(1 + F.ceil((n - LONG_UNIT) / step))
    x = s.withColumn("i", F.explode(F.sequence(F.lit(0), (k - 1).cast("int")))).withColumn("n", n)
    a = F.col("start_line") + F.col("i") * step
    part = F.when(F.col("n") > LONG_UNIT, F.col("i") + 1)
    return x.select("symbol_id", part.cast("long").alias("part"), a.cast("long").alias("first_line"), F.least(a + LONG_UNIT - 1, F.col("end_line")).cast("long").alias("last_line"))


def chunk_python(spark: SparkSession, d: str) -> DataFrame:
    """Python files by their symbols: module header, classes up to their first method, methods and top-level functions; long ones in parts.

    Units whose decorators declare a route are route handlers. Files without symbols are left to the line windows.
    """
    s = _symbols(spark, d).filter("path LIKE '%.py'")
    n = one_per_key(table(spark, d, "files"), "file_id", ["repo", "path", "line_count"]).groupBy("repo", "path").agg(F.max("line_count").alias("n"))
    first = s.filter("kind <> 'module'").groupBy("repo", "path").agg(F.min("start_line").alias("at"))
    head = s.filter("kind = 'module'").groupBy("repo", "path").agg(F.min("symbol_id").alias("symbol_id")).join(n, ["repo", "path"], "left").join(first, ["repo", "path"], "left")
    head = head.select("symbol_id", F.lit("module_header").alias("chunk_type"), F.lit(1).cast("long").alias("a"), F.greatest(F.lit(1), F.coalesce(F.col("at") - 1, F.col("n"), F.lit(1))).cast("long").alias("z"), F.lit(False).alias("long"))
    top = s.filter("kind <> 'module' AND parent_symbol_id LIKE '%/'")
    kids = s.filter("kind = 'method'").groupBy(F.col("parent_symbol_id").alias("symbol_id")).agg(F.min("start_line").alias("m"))
    cls = top.filter("kind = 'class'").join(kids, "symbol_id", "left")
    body = F.greatest("start_line", F.least(F.coalesce(F.col("m") - 1, F.col("end_line")), F.greatest("end_line", "start_line")))
    cls = cls.select("symbol_id", F.lit("class_header").alias("chunk_type"), F.col("start_line").cast("long").alias("a"), body.cast("long").alias("z"), F.lit(False).alias("long"))
    own = top.filter("kind = 'class'").select(F.col("symbol_id").alias("parent_symbol_id"))
    units = top.filter("kind <> 'class'").select("symbol_id", "kind", "decorators", "start_line", "end_line").unionByName(s.filter("kind = 'method'").join(own, "parent_symbol_id", "left_semi").select("symbol_id", "kind", "decorators", "start_line", "end_line"))
    route = F.exists(F.coalesce("decorators", F.expr("cast(array() as array<string>)")), lambda x: x.rlike(lanes._ROUTE))
    units = units.select("symbol_id", F.when(route, "route_handler").when(F.col("kind") == "method", "method").otherwise("function").alias("chunk_type"), F.col("start_line").cast("long").alias("a"), F.greatest("start_line", "end_line").cast("long").alias("z"), F.lit(True).alias("long"))
    x = head.unionByName(cls).unionByName(units)
    step, size = LONG_UNIT - LONG_OVERLAP, F.col("z") - F.col("a") + 1
    k = F.when(F.col("long") & (size > LONG_UNIT), 1 + F.ceil((size - LONG_UNIT) / step)).otherwise(1)
    x = x.withColumn("i", F.explode(F.sequence(F.lit(0), (k - 1).cast("int"))))
    parted = F.col("long") & (size > LONG_UNIT)
    return x.select("symbol_id", "chunk_type", F.when(parted, F.col("i") + 1).cast("long").alias("part"), (F.col("a") + F.col("i") * step).alias("first_line"), F.when(parted, F.least(F.col("a") + F.col("i") * step + LONG_UNIT - 1, F.col("z"))).otherwise(F.col("z")).alias("last_line"))


def validate_run(spark: SparkSession, d: str) -> DataFrame:
    """Named checks over the evidence of all module pages, each with its number of faults."""
    asked, got = (checkpoint(x) for x in lanes._hits(spark, d))
    spans = _symbols(spark, d).filter("span_id IS NOT NULL").select(F.col("span_id").alias("item")).distinct()
    chunks = _chunks(spark, d).select(F.col("chunk_id").alias("item"))
    pages = asked.select("section_id").distinct()
    n = lambda df: df.agg(F.count(F.lit(1)).alias("faults"))
    checks = {
        "all_pages_have_requests": n(got.select("section_id").distinct().join(pages, "section_id", "left_anti")),
        "requests_known": n(got.join(asked, ["section_id", "request", "lane"], "left_anti")),
        "requests_unique": n(asked.groupBy("section_id", "request").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")),
        "items_valid": n(got.filter("section_id IS NULL OR item IS NULL OR lane IS NULL")),
        "item_once_in_request": n(got.groupBy("section_id", "request", "rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")),
        "anchors_exist": n(got.select("item").distinct().join(spans.unionByName(chunks), "item", "left_anti")),
        "pages_without_evidence": n(pages.join(got.select("section_id").distinct(), "section_id", "left_anti")),
    }
    out = None
    for name, df in checks.items():
        part = df.select(F.lit(name).alias("check"), "faults", F.when(F.col("faults") == 0, "pass").when(F.lit(name) == "pages_without_evidence", "bad_plan").otherwise("bug").alias("verdict"))
        out = part if out is None else out.unionByName(part)
    return out


def rank_largest(spark: SparkSession, d: str) -> DataFrame:
    """Of each repository the 25 largest classes, most decorated symbols and heaviest test files."""
    s = _symbols(spark, d)
    a = s.filter("kind = 'class'").select("repo", F.lit("class").alias("ranking"), F.col("symbol_id").alias("id"), "path", F.greatest(F.lit(0), F.col("end_line") - F.col("start_line") + 1).cast("long").alias("n"))
    b = s.filter(F.size("decorators") > 0).select("repo", F.lit("decorated").alias("ranking"), F.col("symbol_id").alias("id"), "path", F.size("decorators").cast("long").alias("n"))
    t = s.filter((S.classify(F.col("path")) == "test") & F.col("kind").isin("function", "method")).groupBy("repo", "path").agg(F.count(F.lit(1)).alias("n")).select("repo", F.lit("tests").alias("ranking"), F.col("path").alias("id"), "path", "n")
    return first_per(a.unionByName(b).unionByName(t), ["repo", "ranking"], [F.desc("n"), F.col("path"), F.col("id")], TOP).select("repo", "ranking", "place", "id", "n")


def structure_counts(spark: SparkSession, d: str) -> DataFrame:
    """Symbols by module and classes, functions and methods by file."""
    s = _symbols(spark, d)
    a = s.filter("module <> ''").groupBy("repo", F.col("module").alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("symbols_by_module"))
    b = s.filter("kind <> 'module' AND path <> ''").groupBy("repo", F.col("path").alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("definitions_by_file"))
    return a.unionByName(b)


def test_summary(spark: SparkSession, d: str) -> DataFrame:
    """Test files, functions, classes and the frameworks they hint at, by folder."""
    f = one_per_key(table(spark, d, "files"), "file_id", ["repo", "path"]).filter(S.classify(F.col("path")) == "test").select("repo", "path").distinct()
    s = _symbols(spark, d)
    own = s.groupBy("repo", "path").agg(
        F.count_if(F.col("kind").isin("function", "method")).alias("functions"), F.count_if(F.col("kind") == "class").alias("classes"),
        F.max(_lower_all("bases").contains("testcase")).alias("unit"), F.max(_lower_all("decorators").contains("pytest")).alias("py"),
    )
    x = f.join(own, ["repo", "path"], "left").withColumn("directory", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("(root)"))
    unit, py = F.max(F.coalesce("unit", F.lit(False))), F.max(F.coalesce("py", F.lit(False)))
    hint = F.when(unit & py, "pytest+unittest").when(unit, "unittest").otherwise("pytest")
    return x.groupBy("repo", "directory").agg(F.count(F.lit(1)).alias("files"), F.sum(F.coalesce("functions", F.lit(0))).alias("functions"), F.sum(F.coalesce("classes", F.lit(0))).alias("classes"), hint.alias("frameworks"))


def tag_rows(spark: SparkSession, d: str) -> DataFrame:
    """One line of a tags file for each definition; sorting by it gives name, path, line."""
    letter = F.when(F.col("kind") == "class", "c").when(F.col("kind") == "method", "m").otherwise("f")
    s = _symbols(spark, d).filter("kind <> 'module' AND path IS NOT NULL AND name IS NOT NULL")
    return s.select("repo", F.concat_ws("\t", "name", "path", F.concat(F.col("start_line").cast("string"), F.lit(';"')), letter, F.concat(F.lit("line:"), F.col("start_line").cast("string"))).alias("tag")).distinct()


def topic_labels(spark: SparkSession, d: str) -> DataFrame:
    """Covered topics of a section against the labels asked for in its repository: exact, by case or none; labels that nothing covers are listed too."""
    s = _sections(spark, d)
    want = s.select("repo", F.explode("coverage_labels").alias("label")).filter("label IS NOT NULL").distinct()
    have = s.select("repo", F.explode("covered_topics").alias("topic")).filter("topic IS NOT NULL").distinct()
    whole = want.join(have.select("repo", F.col("topic").alias("label"), F.lit(True).alias("exact")), ["repo", "label"], "left")
    low = have.select("repo", F.lower("topic").alias("k")).distinct().withColumn("ci", F.lit(True))
    x = whole.withColumn("k", F.lower("label")).join(low, ["repo", "k"], "left")
    return x.select("repo", "label", F.when(F.col("exact"), "exact").when(F.col("ci"), "case").otherwise("none").alias("match"))


def page_defects(spark: SparkSession, d: str) -> DataFrame:
    """Sections with an unknown parent, on or below a loop, of an unknown profile or role, or without topics."""
    s = _sections(spark, d)
    ids = s.select(F.col("section_id").alias("parent_section_id"), F.lit(True).alias("known"))
    h = resolve_hierarchy(hierarchies({"sections": (table(spark, d, "sections"), "section_id", "parent_section_id")}), with_paths=False).filter("depth < 0").select(F.col("node").alias("section_id"), F.lit(True).alias("loop"))
    x = s.join(ids, "parent_section_id", "left").join(h, "section_id", "left")
    codes = F.array(
        F.when((F.coalesce("parent_section_id", F.lit("")) != "") & F.col("known").isNull(), "unresolved_parent"), F.when(F.col("loop"), "cycle"),
        F.when(F.col("page_profile").isNotNull() & ~F.col("page_profile").isin(*PROFILES), "unknown_profile"), F.when(F.col("section_role").isNull(), "no_role"),
        F.when(F.coalesce(F.size(F.array_compact("covered_topics")), F.lit(0)) <= 0, "no_topics"),
    )
    return x.select("section_id", F.explode(F.array_compact(codes)).alias("defect"))


def document_defects(spark: SparkSession, d: str) -> DataFrame:
    """Of each repository the sections without text, orders used twice, citations of nothing used and used evidence never cited."""
    s = _sections(spark, d)
    cited = s.select("repo", F.explode(F.regexp_extract_all("markdown", F.lit(r"\[(EV-\d+)\]"), F.lit(1))).alias("e")).distinct()
    used = s.select("repo", F.explode("used_evidence_ids").alias("e")).filter("e IS NOT NULL").distinct()
    empty = s.filter("coalesce(trim(markdown), '') = ''").select("repo", F.lit("no_text").alias("defect"))
    twice = s.filter("section_order IS NOT NULL").groupBy("repo", "parent_section_id", "section_order").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("repo", F.lit("order_twice").alias("defect"))
    lost = cited.join(used, ["repo", "e"], "left_anti").select("repo", F.lit("cited_not_used").alias("defect"))
    idle = used.join(cited, ["repo", "e"], "left_anti").select("repo", F.lit("used_not_cited").alias("defect"))
    return empty.unionByName(twice).unionByName(lost).unionByName(idle).groupBy("repo", "defect").agg(F.count(F.lit(1)).alias("n"))


def placeholder_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents and chunks that hold placeholders, by pattern."""
    docs = table(spark, d, "documents").filter("doc_id IS NOT NULL").select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("id"), F.regexp_replace("text", "\r", "").alias("text"))
    chunks = _chunks(spark, d).select(F.col("chunk_id").alias("id"), F.regexp_replace("text", "\r", "").alias("text"))
    lines = text_lines(docs.unionByName(chunks), ["id"], "text")
    hit = F.array_compact(F.array(*(F.when(F.col("line").rlike(p), F.lit(i)) for i, p in enumerate(PLACEHOLDERS))))
    return lines.select("id", F.col("line_no").cast("long").alias("line_no"), F.explode(hit).alias("pattern"))


def empty_headings(spark: SparkSession, d: str) -> DataFrame:
    """headings of documents with no text before the next heading of their level or above."""
    docs = table(spark, d, "documents").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.regexp_replace("text", "\r", "")).alias("text"))
    x = text_lines(docs, ["doc_id"], "text").filter(F.col("line").rlike(r"\S"))
    level = F.length(F.regexp_extract("line", r"^ {0,3}(#{1,6})[ \t]", 1))
    x = x.select("doc_id", "line_no", F.trim("line").alias("heading"), level.alias("level"))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(1, Window.unboundedFollowing)
    x = x.withColumn("body", F.min(F.when(F.col("level") == 0, F.col("line_no"))).over(w))
    for k in range(1, 7):
        x = x.withColumn(f"h{k}", F.min(F.when((F.col("level") > 0) & (F.col("level") <= k), F.col("line_no"))).over(w))
    stop = F.get(F.array(*(F.col(f"h{k}") for k in range(1, 7))), F.col("level") - 1)
    return x.filter("level > 0").filter(F.col("body").isNull() | (stop < F.col("body"))).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "heading")


def token_families(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of ten families in the texts of chunks, with the number of chunks that hold them."""
    src = _chunks(spark, d).select("chunk_id", F.regexp_replace("text", "\r", "").alias("text"))

    def named(family: str, pattern: str, group: int) -> Column:
        return F.transform(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))), lambda x: F.struct(F.lit(family).alias("family"), x.alias("token")))

    found = F.concat(*(named(k, p, g) for k, (p, g) in FAMILIES.items()))
    return src.select("chunk_id", F.explode(found).alias("t")).groupBy("t.family", "t.token").agg(F.count(F.lit(1)).alias("n_chunks"))


def unresolved_tallies(spark: SparkSession, d: str) -> DataFrame:
    """Requests of the lanes that came to nothing, by type and reason."""
    a = lanes.lane_file_chunks(spark, d).filter("reason <> ''").select(F.lit("file").alias("type"), "reason")
    b = lanes.lane_tests(spark, d).filter("reason <> ''").select(F.lit("test").alias("type"), "reason")
    c = lanes.contract_requests(spark, d).filter("resolution <> 'exact'").select(F.lit("contract").alias("type"), F.col("resolution").alias("reason"))
    e = lanes.resolve_symbol_forms(spark, d).filter("resolution IN ('ambiguous', 'no_match')").select(F.lit("symbol").alias("type"), F.col("resolution").alias("reason"))
    return a.unionByName(b).unionByName(c).unionByName(e).groupBy("type", "reason").agg(F.count(F.lit(1)).alias("n"))


def page_portfolio(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of each module page against the floor of the deep-dive profile: lanes of the floor, distinct items, verdict."""
    floor, least = PROFILES["subsystem-deep-dive"][2:]
    asked, got = lanes._hits(spark, d)
    n = got.filter(F.col("lane").isin(*floor)).groupBy("section_id").agg(F.countDistinct("lane").alias("lanes"), F.countDistinct("item").alias("items"))
    x = asked.select("section_id").distinct().join(n, "section_id", "left")
    verdict = F.when(F.col("items") >= least, "sufficient").when(F.col("items") > 0, "weak").otherwise("missing")
    return x.select("section_id", F.coalesce("lanes", F.lit(0)).cast("long").alias("lanes"), F.coalesce("items", F.lit(0)).cast("long").alias("items"), verdict.alias("verdict"))


def depth_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Claims a section's evidence asks for, one for three items and at most eight, against the distinct citations of its text."""
    s = _sections(spark, d)
    mapped = F.size(F.array_distinct(F.array_compact(F.coalesce("used_evidence_ids", F.expr("cast(array() as array<string>)")))))
    claims = F.coalesce(F.size(F.array_distinct(F.regexp_extract_all("markdown", F.lit(r"\[(EV-\d+)\]"), F.lit(1)))), F.lit(0))
    x = s.select("section_id", mapped.cast("long").alias("mapped"), F.greatest(claims, F.lit(0)).cast("long").alias("claims"))
    target = F.greatest(F.lit(1), F.least(F.ceil(F.col("mapped") / EVIDENCE_PER_CLAIM), F.lit(MOST_CLAIMS))).cast("long")
    return x.withColumn("target", target).withColumn("shallow", F.col("claims") < F.col("target"))


def vector_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows, distinct ids and usable vectors must agree and share one length; else the vectors are unavailable."""
    e = table(spark, d, "embeddings")
    x = e.agg(F.count(F.lit(1)).alias("built"), F.countDistinct("vec_id").alias("indexed"), F.count("embedding").alias("vectors"), F.countDistinct(F.size("embedding")).alias("lengths"))
    agree = (F.col("built") == F.col("indexed")) & (F.col("built") == F.col("vectors")) & (F.col("lengths") <= 1)
    return x.withColumn("state", F.when(F.col("built") == 0, "unavailable").when(agree, "verified").otherwise("inconsistent"))


def resolve_nodes(spark: SparkSession, d: str) -> DataFrame:
    """References to graph nodes by id, by id without its prefix, by label and by name: the first form with candidates decides, several are ambiguous."""
    s = _symbols(spark, d).filter("name IS NOT NULL")
    label = F.concat("name", F.lit(" ["), "kind", F.lit("]"))
    forms = F.array(F.struct(F.concat(F.lit("sym:"), "symbol_id").alias("ref"), F.lit(0).alias("level")), F.struct(F.col("symbol_id").alias("ref"), F.lit(1).alias("level")), F.struct(F.lower(label).alias("ref"), F.lit(2).alias("level")), F.struct(F.lower("name").alias("ref"), F.lit(3).alias("level")))
    al = s.select("repo", F.concat(F.lit("sym:"), "symbol_id").alias("node_id"), F.explode(forms).alias("f")).select("repo", "node_id", "f.ref", "f.level").distinct()
    n = al.groupBy("repo", "ref", "level").agg(F.count(F.lit(1)).alias("n"), F.min("node_id").alias("node_id"))
    best = n.groupBy("repo", "ref").agg(F.min(F.struct("level", "n", "node_id")).alias("b"))
    kind = F.when(F.col("chunk_type") == "class_header", "class").otherwise(F.col("chunk_type"))
    c = _chunks(spark, d).filter("symbol_name IS NOT NULL")
    refs = c.select("repo", F.explode(F.array(F.col("symbol_name"), F.concat("symbol_name", F.lit(" ["), kind, F.lit("]")))).alias("input")).unionByName(s.select("repo", F.col("symbol_id").alias("input"))).filter("input IS NOT NULL").distinct()
    ids = best.select("repo", F.col("ref").alias("input"), F.col("b").alias("own"))
    low = best.select("repo", F.col("ref").alias("k"), F.col("b").alias("by"))
    x = refs.join(ids, ["repo", "input"], "left").withColumn("k", F.lower("input")).join(low, ["repo", "k"], "left").withColumn("b", F.coalesce("own", "by"))
    verdict = F.when(F.col("b").isNull(), "no_match").when(F.col("b.n") > 1, "ambiguous").otherwise(F.element_at(F.array(*map(F.lit, ("exact", "prefix", "label", "unique_name"))), F.col("b.level") + 1))
    return x.select("repo", "input", verdict.alias("resolution"), F.when(F.col("b.n") == 1, F.col("b.node_id")).alias("node_id"))


_SY = "(SELECT symbol_id, max(repo) AS repo, max(path) AS path, max(name) AS name, max(kind) AS kind, max(module) AS module, max(parent_symbol_id) AS parent_symbol_id, max(span_id) AS span_id, max(start_line) AS start_line, max(end_line) AS end_line, max(decorators) AS decorators, max(bases) AS bases FROM symbols WHERE symbol_id IS NOT NULL GROUP BY symbol_id)"
_CH = "(SELECT chunk_id, max(repo) AS repo, max(path) AS path, max(start_line) AS start_line, max(end_line) AS end_line, max(chunk_type) AS chunk_type, max(symbol_name) AS symbol_name, max(text) AS text FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id)"
_SE = "(SELECT section_id, max(repo) AS repo, max(title) AS title, max(section_role) AS section_role, max(page_profile) AS page_profile, max(section_order) AS section_order, max(parent_section_id) AS parent_section_id, max(markdown) AS markdown, max(used_evidence_ids) AS used, max(covered_topics) AS topics, max(coverage_labels) AS labels FROM sections WHERE section_id IS NOT NULL GROUP BY section_id)"
_FI = "(SELECT file_id, max(repo) AS repo, max(path) AS path, max(line_count) AS line_count FROM files WHERE file_id IS NOT NULL GROUP BY file_id)"
_DEC, _BAS = "lower(array_to_string(coalesce(decorators, []), ' '))", "lower(array_to_string(coalesce(bases, []), ' '))"


def _any(column: str, marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{m}')" for m in marks) + ")"


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


_LINES = f"(SELECT id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT id, string_split(replace(text, chr(13), ''), chr(10)) AS ls FROM (SELECT 'doc:' || doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL UNION ALL SELECT chunk_id, text FROM {_CH})))"
_HITS = f"""WITH {lanes._BASE}, asked AS (SELECT concat_ws('/', repo, path) AS section_id FROM s WHERE kind <> 'module' OR kind = 'class' UNION SELECT concat_ws('/', repo, path) FROM {lanes._TESTS}),
got AS (SELECT 'file_anchor' AS lane, concat_ws('/', repo, path) AS section_id, hit FROM {lanes._RANGED} UNION ALL SELECT 'symbol_anchor', concat_ws('/', repo, path), hit FROM {lanes._MEMBERS} UNION ALL SELECT 'test', concat_ws('/', repo, path), hit FROM {lanes._TEST_LANE} WHERE hit IS NOT NULL)"""

QUERIES = {
    f.__name__: f
    for f in (
        symbol_flags, build_ids, all_spans, long_units, chunk_python, validate_run, rank_largest, structure_counts, test_summary, tag_rows, topic_labels, page_defects, document_defects,
        placeholder_lines, empty_headings, token_families, unresolved_tallies, page_portfolio, depth_verdicts, vector_counts, resolve_nodes,
    )
}

ORACLE = {
    "symbol_flags": f"SELECT symbol_id, {_any(_DEC, ROUTE_MARKS)} AS is_route, {_any(_DEC, WORKER_MARKS)} AS is_worker, {_any(_DEC, CLI_MARKS)} AS is_cli, coalesce(kind = 'class' AND {_any(_BAS, MODEL_BASES)}, false) AS is_model, lower(coalesce(name, '')) IN {_in(CONFIG_SYMBOLS)} OR suffix(lower(coalesce(name, '')), 'settings') OR suffix(lower(coalesce(name, '')), 'config') AS is_config FROM {_SY}",
    "build_ids": f"""WITH x AS (SELECT 'symbol' AS kind, symbol_id AS id, CASE WHEN kind = 'module' THEN 'python ' || module || '/' ELSE parent_symbol_id || name || CASE WHEN kind = 'class' THEN '#' ELSE '().' END END AS built FROM {_SY}
UNION ALL SELECT DISTINCT 'span', span_id, 'span:' || path || ':' || start_line || '-' || end_line || ':' || kind FROM {_SY} WHERE span_id IS NOT NULL AND kind <> 'module' UNION ALL SELECT 'chunk', chunk_id, 'chunk:' || repo || '/' || path || ':' || start_line || '-' || end_line FROM {_CH} WHERE path IS NOT NULL)
SELECT *, id IS NOT DISTINCT FROM built AS same FROM x""",
    "all_spans": f"""WITH s AS {_SY}, n AS (SELECT repo, path, max(line_count) AS n FROM {_FI} WHERE path LIKE '%.py' GROUP BY ALL), f AS (SELECT repo, path, min(start_line) AS a FROM s WHERE kind <> 'module' GROUP BY ALL)
SELECT DISTINCT m.repo, m.path, CAST(1 AS BIGINT) AS first_line, CAST(coalesce(greatest(1, least(coalesce(f.a - 1, n.n), coalesce(n.n, f.a - 1))), 1) AS BIGINT) AS last_line, 'module_header' AS span_type FROM s m JOIN n ON m.repo = n.repo AND m.path = n.path LEFT JOIN f ON m.repo = f.repo AND m.path = f.path WHERE m.kind = 'module'
UNION SELECT repo, path, start_line, end_line, kind FROM s WHERE kind <> 'module' UNION SELECT repo, path, start_line, end_line, chunk_type FROM {_CH} WHERE path NOT LIKE '%.py'""",
    "long_units": f"""WITH s AS (SELECT *, end_line - start_line + 1 AS n FROM {_SY} WHERE kind <> 'module' AND end_line >= start_line), p AS (SELECT s.*, unnest(range(0, CASE WHEN n <= {LONG_UNIT} THEN 1 ELSE 1 + (n - {LONG_UNIT} + {LONG_UNIT - LONG_OVERLAP - 1}) // {LONG_UNIT - LONG_OVERLAP} END)) AS i FROM s)
SELECT symbol_id, CASE WHEN n > {LONG_UNIT} THEN i + 1 END AS part, start_line + i * {LONG_UNIT - LONG_OVERLAP} AS first_line, least(start_line + i * {LONG_UNIT - LONG_OVERLAP} + {LONG_UNIT - 1}, end_line) AS last_line FROM p""",
    "chunk_python": rf"""WITH s AS (SELECT * FROM {_SY} WHERE path LIKE '%.py'), n AS (SELECT repo, path, max(line_count) AS n FROM {_FI} GROUP BY ALL), f AS (SELECT repo, path, min(start_line) AS a FROM s WHERE kind <> 'module' GROUP BY ALL),
top AS (SELECT * FROM s WHERE kind <> 'module' AND parent_symbol_id LIKE '%/'), kids AS (SELECT parent_symbol_id AS symbol_id, min(start_line) AS m FROM s WHERE kind = 'method' GROUP BY ALL),
units AS (SELECT * FROM top WHERE kind <> 'class' UNION ALL SELECT * FROM s WHERE kind = 'method' AND parent_symbol_id IN (SELECT symbol_id FROM top WHERE kind = 'class')),
x AS (SELECT m.symbol_id, 'module_header' AS chunk_type, 1 AS a, greatest(1, coalesce(f.a - 1, n.n, 1)) AS z, false AS long FROM (SELECT repo, path, min(symbol_id) AS symbol_id FROM s WHERE kind = 'module' GROUP BY ALL) m LEFT JOIN n ON m.repo = n.repo AND m.path = n.path LEFT JOIN f ON m.repo = f.repo AND m.path = f.path
UNION ALL SELECT t.symbol_id, 'class_header', start_line, greatest(start_line, least(coalesce(k.m - 1, end_line), greatest(end_line, start_line))), false FROM top t LEFT JOIN kids k ON t.symbol_id = k.symbol_id WHERE kind = 'class'
UNION ALL SELECT symbol_id, CASE WHEN len(list_filter(coalesce(decorators, []), lambda t: {lanes._ROUTED})) > 0 THEN 'route_handler' WHEN kind = 'method' THEN 'method' ELSE 'function' END, start_line, greatest(start_line, end_line), true FROM units),
p AS (SELECT *, long AND z - a + 1 > {LONG_UNIT} AS parted, unnest(range(0, CASE WHEN long AND z - a + 1 > {LONG_UNIT} THEN 1 + (z - a + 1 - {LONG_UNIT} + {LONG_UNIT - LONG_OVERLAP - 1}) // {LONG_UNIT - LONG_OVERLAP} ELSE 1 END)) AS i FROM x)
SELECT symbol_id, chunk_type, CASE WHEN parted THEN i + 1 END AS part, a + i * {LONG_UNIT - LONG_OVERLAP} AS first_line, CASE WHEN parted THEN least(a + i * {LONG_UNIT - LONG_OVERLAP} + {LONG_UNIT - 1}, z) ELSE z END AS last_line FROM p""",
    "validate_run": f"""WITH {lanes._BASE}, asked AS (SELECT concat_ws('/', repo, path) AS section_id, 'file_anchor|' || symbol_id AS request, 'file_anchor' AS lane FROM s WHERE kind <> 'module' UNION ALL SELECT concat_ws('/', repo, path), 'symbol_anchor|' || symbol_id, 'symbol_anchor' FROM s WHERE kind = 'class' UNION ALL SELECT concat_ws('/', repo, path), 'test|' || path, 'test' FROM {lanes._TESTS}),
got AS MATERIALIZED (SELECT concat_ws('/', repo, path) AS section_id, 'file_anchor|' || request AS request, 'file_anchor' AS lane, hit AS item, step * 100 + place AS rank FROM {lanes._RANGED} UNION ALL SELECT concat_ws('/', repo, path), 'symbol_anchor|' || request, 'symbol_anchor', hit, step * 100 + place FROM {lanes._MEMBERS} UNION ALL SELECT concat_ws('/', repo, path), 'test|' || path, 'test', hit, place FROM {lanes._TEST_LANE} WHERE hit IS NOT NULL),
k AS (SELECT 'all_pages_have_requests' AS "check", (SELECT count(DISTINCT section_id) FROM got WHERE section_id NOT IN (SELECT section_id FROM asked)) AS faults
UNION ALL SELECT 'requests_known', (SELECT count(*) FROM got ANTI JOIN asked USING (section_id, request, lane)) UNION ALL SELECT 'requests_unique', (SELECT count(*) FROM (SELECT 1 FROM asked GROUP BY section_id, request HAVING count(*) > 1))
UNION ALL SELECT 'items_valid', (SELECT count(*) FROM got WHERE section_id IS NULL OR item IS NULL) UNION ALL SELECT 'item_once_in_request', (SELECT count(*) FROM (SELECT 1 FROM got GROUP BY section_id, request, rank HAVING count(*) > 1))
UNION ALL SELECT 'anchors_exist', (SELECT count(DISTINCT item) FROM got WHERE item NOT IN (SELECT span_id FROM s WHERE span_id IS NOT NULL) AND item NOT IN (SELECT chunk_id FROM c))
UNION ALL SELECT 'pages_without_evidence', (SELECT count(DISTINCT section_id) FROM asked WHERE section_id NOT IN (SELECT section_id FROM got)))
SELECT *, CASE WHEN faults = 0 THEN 'pass' WHEN "check" = 'pages_without_evidence' THEN 'bad_plan' ELSE 'bug' END AS verdict FROM k""",
    "rank_largest": f"""WITH s AS {_SY}, r AS (SELECT repo, 'class' AS ranking, symbol_id AS id, path, greatest(0, end_line - start_line + 1) AS n FROM s WHERE kind = 'class' UNION ALL SELECT repo, 'decorated', symbol_id, path, len(decorators) FROM s WHERE len(decorators) > 0
UNION ALL SELECT repo, 'tests', path, path, count(*) FROM (SELECT repo, path, {_CLASS} AS k FROM s WHERE kind IN ('function', 'method')) WHERE k = 'test' GROUP BY repo, path)
SELECT repo, ranking, place, id, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY repo, ranking ORDER BY n DESC, path, id) AS place FROM r) WHERE place <= {TOP}""",
    "structure_counts": f"SELECT repo, module AS key, count(*) AS n, 'symbols_by_module' AS of FROM {_SY} WHERE module <> '' GROUP BY ALL UNION ALL SELECT repo, path, count(*), 'definitions_by_file' FROM {_SY} WHERE kind <> 'module' AND path <> '' GROUP BY ALL",
    "test_summary": f"""WITH f AS (SELECT DISTINCT repo, path FROM {_FI} WHERE path IS NOT NULL AND {_CLASS} = 'test'), o AS (SELECT repo, path, count(*) FILTER (kind IN ('function', 'method')) AS functions, count(*) FILTER (kind = 'class') AS classes, bool_or(contains({_BAS}, 'testcase')) AS u, bool_or(contains({_DEC}, 'pytest')) AS p FROM {_SY} GROUP BY ALL),
x AS (SELECT f.repo, CASE WHEN contains(f.path, '/') THEN regexp_replace(f.path, '/[^/]*$', '') ELSE '(root)' END AS directory, coalesce(functions, 0) AS fn, coalesce(classes, 0) AS cl, coalesce(u, false) AS u, coalesce(p, false) AS p FROM f LEFT JOIN o ON f.repo = o.repo AND f.path = o.path)
SELECT repo, directory, count(*) AS files, CAST(sum(fn) AS BIGINT) AS functions, CAST(sum(cl) AS BIGINT) AS classes, CASE WHEN bool_or(u) AND bool_or(p) THEN 'pytest+unittest' WHEN bool_or(u) THEN 'unittest' ELSE 'pytest' END AS frameworks FROM x GROUP BY ALL""",
    "tag_rows": f"SELECT DISTINCT repo, concat_ws(chr(9), name, path, start_line || ';\"', CASE kind WHEN 'class' THEN 'c' WHEN 'method' THEN 'm' ELSE 'f' END, 'line:' || start_line) AS tag FROM {_SY} WHERE kind <> 'module' AND path IS NOT NULL AND name IS NOT NULL",
    "topic_labels": f"""WITH s AS {_SE}, w AS (SELECT DISTINCT repo, label FROM (SELECT repo, unnest(labels) AS label FROM s) WHERE label IS NOT NULL), h AS (SELECT DISTINCT repo, topic FROM (SELECT repo, unnest(topics) AS topic FROM s) WHERE topic IS NOT NULL)
SELECT w.repo, w.label, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.repo = w.repo AND h.topic = w.label) THEN 'exact' WHEN EXISTS (SELECT 1 FROM h WHERE h.repo = w.repo AND lower(h.topic) = lower(w.label)) THEN 'case' ELSE 'none' END AS match FROM w""",
    "page_defects": _WALK
    + f""", s AS {_SE} SELECT section_id, 'unresolved_parent' AS defect FROM s WHERE coalesce(parent_section_id, '') <> '' AND parent_section_id NOT IN (SELECT section_id FROM s) UNION ALL SELECT node, 'cycle' FROM looped WHERE tree = 'sections'
UNION ALL SELECT section_id, 'unknown_profile' FROM s WHERE page_profile IS NOT NULL AND page_profile NOT IN {_in(tuple(PROFILES))} UNION ALL SELECT section_id, 'no_role' FROM s WHERE section_role IS NULL UNION ALL SELECT section_id, 'no_topics' FROM s WHERE len(list_filter(coalesce(topics, []), lambda x: x IS NOT NULL)) = 0""",
    "document_defects": f"""WITH s AS {_SE}, c AS (SELECT DISTINCT repo, unnest(regexp_extract_all(markdown, '\\[(EV-\\d+)\\]', 1)) AS e FROM s), u AS (SELECT DISTINCT repo, e FROM (SELECT repo, unnest(used) AS e FROM s) WHERE e IS NOT NULL),
x AS (SELECT repo, 'no_text' AS defect FROM s WHERE coalesce(trim(markdown), '') = '' UNION ALL SELECT repo, 'order_twice' FROM s WHERE section_order IS NOT NULL GROUP BY repo, parent_section_id, section_order HAVING count(*) > 1
UNION ALL SELECT repo, 'cited_not_used' FROM c ANTI JOIN u ON c.repo = u.repo AND c.e = u.e UNION ALL SELECT repo, 'used_not_cited' FROM u ANTI JOIN c ON c.repo = u.repo AND c.e = u.e) SELECT repo, defect, count(*) AS n FROM x GROUP BY ALL""",
    "placeholder_lines": "SELECT id, line_no, pattern FROM (" + " UNION ALL ".join(f"SELECT id, line_no, {i} AS pattern FROM {_LINES} WHERE regexp_matches(line, '{_q(p)}')" for i, p in enumerate(PLACEHOLDERS)) + ")",
    "empty_headings": """WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT doc_id, string_split(max(replace(text, chr(13), '')), chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id)),
x AS (SELECT doc_id, line_no, trim(line) AS heading, length(regexp_extract(line, '^ {0,3}(#{1,6})[ \\t]', 1)) AS level FROM l WHERE regexp_matches(line, '\\S'))
SELECT h.doc_id, h.line_no, h.heading FROM x h WHERE h.level > 0 AND NOT EXISTS (SELECT 1 FROM x b WHERE b.doc_id = h.doc_id AND b.line_no > h.line_no AND b.level = 0 AND NOT EXISTS (SELECT 1 FROM x m WHERE m.doc_id = h.doc_id AND m.line_no > h.line_no AND m.line_no < b.line_no AND m.level > 0 AND m.level <= h.level))""",
    "token_families": f"WITH c AS (SELECT chunk_id, replace(text, chr(13), '') AS text FROM {_CH}) SELECT family, token, count(*) AS n_chunks FROM (" + " UNION ALL ".join(f"SELECT chunk_id, '{k}' AS family, unnest(list_distinct(regexp_extract_all(text, '{_q(p)}', {g}))) AS token FROM c" for k, (p, g) in FAMILIES.items()) + ") GROUP BY ALL",
    "unresolved_tallies": f"""SELECT type, reason, count(*) AS n FROM (SELECT 'file' AS type, reason FROM ({lanes.ORACLE['lane_file_chunks']}) WHERE reason <> '' UNION ALL SELECT 'test', reason FROM ({lanes.ORACLE['lane_tests']}) WHERE reason <> ''
UNION ALL SELECT 'contract', resolution FROM ({lanes.ORACLE['contract_requests']}) WHERE resolution <> 'exact' UNION ALL SELECT 'symbol', resolution FROM ({lanes.ORACLE['resolve_symbol_forms']}) WHERE resolution IN ('ambiguous', 'no_match')) GROUP BY ALL""",
    "page_portfolio": f"""{_HITS}, n AS (SELECT section_id, count(DISTINCT lane) AS lanes, count(DISTINCT hit) AS items FROM got GROUP BY ALL)
SELECT a.section_id, coalesce(n.lanes, 0) AS lanes, coalesce(n.items, 0) AS items, CASE WHEN n.items >= 3 THEN 'sufficient' WHEN n.items > 0 THEN 'weak' ELSE 'missing' END AS verdict FROM asked a LEFT JOIN n USING (section_id)""",
    "depth_verdicts": f"""WITH x AS (SELECT section_id, len(list_distinct(list_filter(coalesce(used, []), lambda x: x IS NOT NULL))) AS mapped, coalesce(len(list_distinct(regexp_extract_all(markdown, '\\[(EV-\\d+)\\]', 1))), 0) AS claims FROM {_SE}),
y AS (SELECT *, greatest(1, least((mapped + {EVIDENCE_PER_CLAIM - 1}) // {EVIDENCE_PER_CLAIM}, {MOST_CLAIMS})) AS target FROM x) SELECT *, claims < target AS shallow FROM y""",
    "vector_counts": "WITH x AS (SELECT count(*) AS built, count(DISTINCT vec_id) AS indexed, count(embedding) AS vectors, count(DISTINCT len(embedding)) AS lengths FROM embeddings) SELECT *, CASE WHEN built = 0 THEN 'unavailable' WHEN built = indexed AND built = vectors AND lengths <= 1 THEN 'verified' ELSE 'inconsistent' END AS state FROM x",
    "resolve_nodes": f"""WITH s AS (SELECT * FROM {_SY} WHERE name IS NOT NULL), al AS (SELECT DISTINCT * FROM (SELECT repo, 'sym:' || symbol_id AS node_id, 'sym:' || symbol_id AS ref, 0 AS level FROM s UNION ALL SELECT repo, 'sym:' || symbol_id, symbol_id, 1 FROM s UNION ALL SELECT repo, 'sym:' || symbol_id, lower(name || ' [' || kind || ']'), 2 FROM s UNION ALL SELECT repo, 'sym:' || symbol_id, lower(name), 3 FROM s)),
n AS (SELECT repo, ref, level, count(*) AS n, min(node_id) AS node_id FROM al GROUP BY ALL), b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY repo, ref ORDER BY level) = 1),
refs AS (SELECT DISTINCT * FROM (SELECT repo, unnest([symbol_name, symbol_name || ' [' || CASE chunk_type WHEN 'class_header' THEN 'class' ELSE chunk_type END || ']']) AS input FROM {_CH} WHERE symbol_name IS NOT NULL UNION ALL SELECT repo, symbol_id FROM s) WHERE input IS NOT NULL),
x AS (SELECT r.repo, r.input, coalesce(o.level, y.level) AS level, coalesce(o.n, y.n) AS n, coalesce(o.node_id, y.node_id) AS node_id FROM refs r LEFT JOIN b o ON r.repo = o.repo AND r.input = o.ref LEFT JOIN b y ON r.repo = y.repo AND lower(r.input) = y.ref)
SELECT repo, input, CASE WHEN n IS NULL THEN 'no_match' WHEN n > 1 THEN 'ambiguous' ELSE ['exact', 'prefix', 'label', 'unique_name'][level + 1] END AS resolution, CASE WHEN n = 1 THEN node_id END AS node_id FROM x""",
}

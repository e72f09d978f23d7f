"""Property graph as two tables: nodes, edges, degrees, hubs and capped one-hop neighbourhoods.

``build_graph`` is the part that SQL can express (containment, inheritance from unique classes); ``whole_graph`` adds
what parsed files, decorators, tests and documents say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators.joins import first_per
from tessera.operators.references import import_targets, qualified, resolve_calls, unique_names
from tessera.session import checkpoint

# Edge types in the order neighbours are preferred.
PREFERENCE = ("CONTAINS", "INHERITS", "DECORATED_BY", "TESTS_APPROX", "CALLS_APPROX", "IMPORTS", "MENTIONS")


def build_graph(files: DataFrame, symbols: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node_id, type, repo, label) and edges (src, type, dst) of files, modules, classes, functions and repositories."""
    repo = files.select(F.concat(F.lit("repo:"), "repo").alias("node_id"), F.lit("repository").alias("type"), "repo", F.col("repo").alias("label")).distinct()
    file = files.select(F.concat(F.lit("file:"), "repo", F.lit("/"), "path").alias("node_id"), F.lit("file").alias("type"), "repo", F.col("path").alias("label"))
    sym = symbols.select(F.concat(F.lit("sym:"), "symbol_id").alias("node_id"), F.col("kind").alias("type"), "repo", F.concat_ws(" ", "name", F.concat(F.lit("["), "kind", F.lit("]"))).alias("label"))
    nodes = repo.unionByName(file).unionByName(sym).groupBy("node_id").agg(F.max("type").alias("type"), F.max("repo").alias("repo"), F.max("label").alias("label"))
    has = files.select(F.concat(F.lit("repo:"), "repo").alias("src"), F.lit("CONTAINS").alias("type"), F.concat(F.lit("file:"), "repo", F.lit("/"), "path").alias("dst"))
    mod = symbols.filter("kind = 'module'").select(F.concat(F.lit("file:"), "repo", F.lit("/"), "path").alias("src"), F.lit("CONTAINS").alias("type"), F.concat(F.lit("sym:"), "symbol_id").alias("dst"))
    kid = symbols.filter("parent_symbol_id <> '' AND parent_symbol_id <> symbol_id").select(F.concat(F.lit("sym:"), "parent_symbol_id").alias("src"), F.lit("CONTAINS").alias("type"), F.concat(F.lit("sym:"), "symbol_id").alias("dst"))
    classes = symbols.filter("kind = 'class'").groupBy("repo", "name").agg(F.count(F.lit(1)).alias("n"), F.min("symbol_id").alias("base_id")).filter("n = 1").select("repo", F.col("name").alias("base"), "base_id")
    inh = symbols.filter("kind = 'class'").select("repo", "symbol_id", F.explode("bases").alias("base")).join(classes, ["repo", "base"]).filter("symbol_id <> base_id")
    inh = inh.select(F.concat(F.lit("sym:"), "symbol_id").alias("src"), F.lit("INHERITS").alias("type"), F.concat(F.lit("sym:"), "base_id").alias("dst"))
    raw = has.unionByName(mod).unionByName(kid).unionByName(inh).distinct()
    ids = nodes.select("node_id")
    edges = raw.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    return nodes, edges.select("src", "type", "dst")


def _file(path: str = "path"):
    return F.concat(F.lit("file:"), "repo", F.lit("/"), F.col(path))


def _sym(column: str):
    return F.concat(F.lit("sym:"), F.col(column))


def whole_graph(files: DataFrame, symbols: DataFrame, parsed: DataFrame, tests: DataFrame, mentions: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes as in ``build_graph`` with test, configuration, dependency and document nodes, and edges (src, type, dst, line) of all types.

    ``parsed`` holds rows of ``parse_python`` with repo and path, ``tests`` (repo, path, target), ``mentions`` (doc_id,
    symbol_id) and ``documents`` (doc_id, repo). ``line`` is part of an edge's identity for imports of dependencies and calls, else null.
    """
    base_nodes, base_edges = build_graph(files, symbols)
    kind = files.select(_file().alias("node_id"), S.classify(F.col("path")).alias("category")).filter("node_id IS NOT NULL").distinct()
    typed = base_nodes.join(kind, "node_id", "left").withColumn("type", F.when(F.col("type") != "file", F.col("type")).when(F.col("category") == "test", "test").when(F.col("category").isin("config", "deployment"), "config").otherwise("file")).drop("category")
    docs = documents.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("repo").alias("repo")).select(F.concat(F.lit("doc:"), "doc_id").alias("node_id"), F.lit("document").alias("type"), "repo", F.concat(F.lit("document "), "doc_id").alias("label"))

    imports = checkpoint(import_targets(files, parsed))
    outside = imports.filter("target IS NULL AND root <> ''")
    dep = F.concat(F.lit("dep:"), "repo", F.lit("/"), "root")
    deps = outside.select(dep.alias("node_id"), F.lit("dependency").alias("type"), "repo", F.col("root").alias("label")).distinct()
    nodes = checkpoint(typed.unionByName(docs).unionByName(deps))
    none = F.lit(None).cast("int")

    modules = symbols.filter("kind = 'module'").groupBy("repo", "path").agg(F.min("symbol_id").alias("module_id"))
    external = outside.join(modules, ["repo", "path"], "left").select(F.coalesce(_sym("module_id"), _file()).alias("src"), F.lit("IMPORTS").alias("type"), dep.alias("dst"), F.col("start_line").alias("line"))
    internal = imports.filter("target <> path").select(_file().alias("src"), F.lit("IMPORTS").alias("type"), _file("target").alias("dst"), none.alias("line"))

    defs = symbols.filter("kind <> 'module'").select("repo", "path", "name", F.col("symbol_id").alias("target_id"), (~qualified("symbol_id").contains(".")).alias("top"))
    owner = symbols.filter("kind <> 'module'").groupBy("repo", "path", qualified("symbol_id").alias("caller")).agg(F.min("symbol_id").alias("caller_id"))
    calls = parsed.filter("kind = 'call'").select("repo", "path", F.col("scope").alias("caller"), "name", F.col("start_line").alias("line")).join(owner, ["repo", "path", "caller"])
    called = resolve_calls(calls, imports, defs).filter("target_id <> caller_id").select(_sym("caller_id").alias("src"), F.lit("CALLS_APPROX").alias("type"), _sym("target_id").alias("dst"), "line")

    names = unique_names(defs)
    classes = unique_names(symbols.filter("kind = 'class'").select("repo", "name", F.col("symbol_id").alias("target_id")))
    aliases = outside.groupBy("repo", "path", "alias").agg(F.max("root").alias("package"))

    def towards(refs: DataFrame, unique: DataFrame, kind: str) -> DataFrame:
        """Edges of (repo, path, symbol_id, name, origin): to the unique symbol, else to the package that name or origin stands for."""
        last = aliases.select("repo", "path", F.col("alias").alias("name"), F.col("package").alias("by_name"))
        first = aliases.select("repo", "path", F.col("alias").alias("origin"), F.col("package").alias("by_origin"))
        x = refs.join(unique, ["repo", "name"], "left").join(last, ["repo", "path", "name"], "left").join(first, ["repo", "path", "origin"], "left")
        away = F.concat(F.lit("dep:"), "repo", F.lit("/"), F.coalesce("by_name", "by_origin", "origin"))
        return x.select(_sym("symbol_id").alias("src"), F.lit(kind).alias("type"), F.coalesce(_sym("target_id"), away).alias("dst"), none.alias("line"))

    bare = F.regexp_replace("raw", r"[(\[][\s\S]*$", "")
    bases = symbols.filter("kind = 'class'").select("repo", "path", "symbol_id", F.explode("bases").alias("raw")).withColumns({"name": F.trim(F.substring_index(bare, ".", -1)), "origin": F.trim(F.substring_index(bare, ".", 1))})
    worn = F.trim(F.regexp_replace(F.regexp_replace("raw", r"^\s*@+", ""), r"[.(\[][\s\S]*$", ""))
    decorators = symbols.select("repo", "path", "symbol_id", F.explode("decorators").alias("raw")).withColumn("name", worn).withColumn("origin", F.col("name"))

    tested = symbols.filter("kind IN ('function', 'method') AND name LIKE 'test\\_%'").select("repo", "symbol_id", F.regexp_replace("name", "^test_", "").alias("name")).join(names, ["repo", "name"])
    tested = tested.select(_sym("symbol_id").alias("src"), F.lit("TESTS_APPROX").alias("type"), _sym("target_id").alias("dst"), none.alias("line"))
    test_files = tests.select(_file().alias("src"), F.lit("TESTS_APPROX").alias("type"), _file("target").alias("dst"), none.alias("line"))
    told = mentions.select(F.concat(F.lit("doc:"), "doc_id").alias("src"), F.lit("MENTIONS").alias("type"), _sym("symbol_id").alias("dst"), none.alias("line"))

    # only packages may be absent; the other ends exist by how they are made, and base edges are checked, distinct and of another type
    guessed = towards(bases, classes, "INHERITS").unionByName(towards(decorators, names, "DECORATED_BY"))
    held = guessed.filter("dst NOT LIKE 'dep:%'").unionByName(guessed.filter("dst LIKE 'dep:%'").join(deps.select(F.col("node_id").alias("dst")), "dst", "left_semi").select("src", "type", "dst", "line"))
    raw = held
    for more in (external, internal, called, tested, test_files, told):
        raw = raw.unionByName(more)
    contains = base_edges.filter("type = 'CONTAINS'").withColumn("line", none)
    return nodes, contains.unionByName(raw.filter("src <> dst").distinct()).select("src", "type", "dst", "line")


def hubs(edges: DataFrame, k: int = 30) -> DataFrame:
    """``(type, side, place, node_id, n)``: the ``k`` nodes with most edges of each type by source and by target, and of all types over both ends (type ``all``)."""
    ends = edges.select("type", F.explode(F.array(F.struct(F.lit("src").alias("side"), F.col("src").alias("node_id")), F.struct(F.lit("dst").alias("side"), F.col("dst").alias("node_id")))).alias("e")).select("type", "e.*")
    one = ends.groupBy("type", "side", "node_id").agg(F.count(F.lit(1)).alias("n"))
    every = one.groupBy("node_id").agg(F.sum("n").alias("n")).select(F.lit("all").alias("type"), F.lit("both").alias("side"), "node_id", "n")
    return first_per(one.unionByName(every), ["type", "side"], [F.desc("n"), F.col("node_id")], k).select("type", "side", "place", "node_id", "n")


def degrees(edges: DataFrame) -> DataFrame:
    """``(node_id, n_in, n_out)``; partial counts are formed before the shuffle."""
    ends = edges.select(F.col("src").alias("node_id"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(edges.select(F.col("dst").alias("node_id"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    return ends.groupBy("node_id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def neighbours(edges: DataFrame, seeds: DataFrame, cap: int = 8) -> DataFrame:
    """``(node_id, place, neighbour)``: up to ``cap`` neighbours of each seed over both directions, by edge type and id."""
    pref = F.element_at(F.create_map(*(F.lit(x) for i, t in enumerate(PREFERENCE) for x in (t, i))), F.col("type"))
    both = edges.select(F.col("src").alias("node_id"), "type", F.col("dst").alias("neighbour")).unionByName(edges.select(F.col("dst").alias("node_id"), "type", F.col("src").alias("neighbour")))
    near = both.join(seeds.select("node_id").distinct(), "node_id", "left_semi").groupBy("node_id", "neighbour").agg(F.min(F.coalesce(pref, F.lit(99))).alias("pref"))
    return first_per(near, ["node_id"], [F.col("pref"), F.col("neighbour")], cap).select("node_id", "place", "neighbour")

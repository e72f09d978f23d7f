"""A folder of artifacts as tables: tolerant and strict loading, capabilities, and writing results with a manifest.

Tables lie as JSON lines (a file or a folder of them), documents as one JSON object. Tolerant loading skips bad lines and
gives empty tables for what is absent; strict loading names the fault: a missing table, a malformed line, a missing or repeated key.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.jsonl import read_or_empty, read_strict, write_rows

_RANGE = "range struct<start_line:int,end_line:int>"
# Tables of a bundle as name -> (path, schema, key), and its documents.
TABLES = {
    "files": ("inventory/files.jsonl", "path string, name string, ext string, language string, category string, size_bytes long, line_count long, sha256 string, git_tracked boolean, is_generated boolean, is_vendor boolean, is_binary boolean, indexable boolean, top_dir string", "path"),
    "symbols": ("symbols/symbols.jsonl", f"symbol_id string, name string, kind string, path string, module string, signature string, parent_symbol_id string, docstring string, span_id string, {_RANGE}, decorators array<string>, bases array<string>, is_async boolean", "symbol_id"),
    "imports": ("symbols/imports.jsonl", "path string, kind string, module string, resolved_path string, lineno int, level int, names array<struct<name:string,asname:string>>, is_internal boolean", None),
    "occurrences": ("symbols/occurrences.jsonl", f"symbol_id string, path string, {_RANGE}, role string, name string, via string, from_symbol_id string, confidence string", None),
    "spans": ("rag/spans.jsonl", f"span_id string, path string, {_RANGE}, language string, category string, span_type string, symbol_id string, heading_path string, section_name string, sha256 string, text string", "span_id"),
    "chunks": ("rag/chunks.jsonl", f"chunk_id string, path string, {_RANGE}, chunk_type string, language string, category string, symbol_name string, parent_symbol string, decorators array<string>, docstring string, heading_path string, section_name string, token_estimate int, sha256 string, span_ids array<string>, text string", "chunk_id"),
    "hits": ("queries/results/rg.jsonl", "pack string, why string, path string, line int, text string", None),
    "nodes": ("static/nodes.jsonl", "node_id string, type string, name string, path string", "node_id"),
    "edges": ("static/edges.jsonl", "edge_id string, type string, src string, dst string, confidence string, basis string", "edge_id"),
    "test_files": ("tests/test-files.jsonl", "path string, language string, line_count int, test_functions int, test_classes int, fixtures int, framework_hint string", "path"),
    "section_plans": ("plan/section-plans.jsonl", "section_id string, title string, order int, parent_section_id string, page_profile string", "section_id"),
}
DOCUMENTS = {
    "coverage": "inventory/source-coverage.json",
    "run_metadata": "run-metadata.json",
    "openapi": "contracts/openapi.json",
    "document_plan": "plan/document-plan.json",
}


class BundleError(ValueError):
    """A bundle that strict loading refuses; ``category`` is missing_input, malformed_row, missing_key or duplicate_key."""

    def __init__(self, category: str, message: str) -> None:
        super().__init__(message)
        self.category = category


@dataclass
class Bundle:
    tables: dict[str, DataFrame]
    documents: dict[str, dict] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(name) from None


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _document(spark: SparkSession, path: str) -> dict:
    if not _exists(spark, path):
        return {}
    text = "\n".join(r.value for r in spark.read.option("wholetext", "true").text(path).collect())
    try:
        got = json.loads(text)
    except ValueError:
        return {}
    return got if isinstance(got, dict) else {}


def load_bundle(spark: SparkSession, root: str) -> Bundle:
    """All artifacts; what is absent or malformed is empty."""
    tables = {name: read_or_empty(spark, f"{root}/{path}", T._parse_datatype_string(schema)) for name, (path, schema, _) in TABLES.items()}
    missing = [name for name, (path, _, _) in TABLES.items() if not _exists(spark, f"{root}/{path}")]
    return Bundle(tables, {name: _document(spark, f"{root}/{path}") for name, path in DOCUMENTS.items()}, missing)


def load_strict(spark: SparkSession, root: str, required: tuple[str, ...] = ("files", "symbols", "chunks", "spans", "section_plans")) -> Bundle:
    """Required tables must be there, every line must parse, keys must be there and occur once.

    Rows carry their raw line, so that a section can be hashed as it was written.
    """
    tables, missing = {}, []
    for name, (path, schema, key) in TABLES.items():
        if not _exists(spark, f"{root}/{path}"):
            if name in required:
                raise BundleError("missing_input", f"{path} is missing")
            missing.append(name)
            tables[name] = spark.createDataFrame([], T._parse_datatype_string(schema))
            continue
        try:
            tables[name] = read_strict(spark, f"{root}/{path}", T._parse_datatype_string(schema))
        except ValueError as e:
            raise BundleError("malformed_row", str(e)) from e
        if key and name in required:
            faults = tables[name].groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).limit(3).collect()
            if faults:
                bad = faults[0]
                raise BundleError("missing_key" if bad[key] is None else "duplicate_key", f"{path}: {key} {bad[key]} occurs {bad.n} times")
    return Bundle(tables, {name: _document(spark, f"{root}/{path}") for name, path in DOCUMENTS.items()}, missing)


def capabilities(bundle: Bundle) -> dict[str, bool | str]:
    """Which surfaces have rows, and the mode of retrieval they allow."""
    has = {name: not df.isEmpty() for name, df in bundle.tables.items()}
    return {**has, "openapi": bool(bundle.documents.get("openapi", {}).get("paths")), "bm25": has["chunks"], "retrieval_mode": "lexical" if has["chunks"] else "none"}


def operations_of(openapi: dict) -> list[tuple[str, str]]:
    """``(METHOD, route)`` of an OpenAPI document, sorted by route."""
    verbs = ("get", "post", "put", "delete", "patch", "head", "options", "trace")
    return sorted(((m.upper(), route) for route, ops in (openapi.get("paths") or {}).items() if isinstance(ops, dict) for m in ops if m.lower() in verbs), key=lambda x: (x[1], x[0]))


def discover_openapi(files: DataFrame) -> DataFrame:
    """``(repo, path, n_paths)``: the JSON file of each repository that describes most routes, ties by path.

    Candidates bear the name of an API description or hold its marker in their first 4,000 characters. ``files`` is (repo, path, text).
    """
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    marked = F.substring("text", 1, 4000).rlike(r'"(?:openapi|swagger)"\s*:')
    c = files.filter(F.col("path").endswith(".json") & (name.isin("openapi.json", "swagger.json") | marked))
    n = F.size(F.map_keys(F.from_json(F.get_json_object("text", "$.paths"), "map<string,string>")))
    x = c.select("repo", "path", F.coalesce(n, F.lit(0)).alias("n_paths")).filter("n_paths > 0")
    return x.groupBy("repo").agg(F.min_by(F.struct("path", "n_paths"), F.struct((-F.col("n_paths")).alias("m"), F.col("path").alias("p"))).alias("b")).select("repo", "b.path", "b.n_paths")


def write_evidence(evidence: DataFrame, out: str, unresolved: DataFrame | None = None) -> dict:
    """Evidence rows by section and as one table, those unresolved, and a manifest with numbers and a verdict."""
    evidence.write.mode("overwrite").partitionBy("section_id").json(f"{out}/sections")
    n = write_rows(evidence, f"{out}/evidence.jsonl")
    lost = write_rows(unresolved, f"{out}/unresolved.jsonl") if unresolved is not None else 0
    manifest = {"schema_version": "1", "items": n, "sections": evidence.select("section_id").distinct().count(), "unresolved": lost, "status": "pass" if n else "empty"}
    _write_document(evidence.sparkSession, f"{out}/manifest.json", manifest)
    return manifest


def write_failure(spark: SparkSession, out: str, fault: BundleError) -> dict:
    """What stands in for results when the inputs are refused: a classified record of the failure."""
    record = {"schema_version": "1", "status": "fail", "category": fault.category, "message": str(fault)}
    _write_document(spark, f"{out}/validation.json", record)
    return record


def _write_document(spark: SparkSession, path: str, value: dict) -> None:
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)

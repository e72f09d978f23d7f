import json

import pytest

from tessera.sources.bundle import BundleError, capabilities, discover_openapi, load_bundle, load_strict, operations_of, write_evidence, write_failure


def bundle(root, **rows):
    paths = {"files": "inventory/files.jsonl", "symbols": "symbols/symbols.jsonl", "chunks": "rag/chunks.jsonl", "spans": "rag/spans.jsonl", "section_plans": "plan/section-plans.jsonl"}
    full = {"files": ['{"path": "a.py", "line_count": 3}'], "symbols": ['{"symbol_id": "s", "range": {"start_line": 1, "end_line": 2}}'], "chunks": ['{"chunk_id": "c", "text": "ü"}'], "spans": ['{"span_id": "p"}'], "section_plans": ['{"section_id": "x"}']} | rows
    for name, lines in full.items():
        if lines is not None:
            p = root / paths[name]
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text("\n".join(lines) + "\n")
    (root / "contracts").mkdir(exist_ok=True)
    (root / "contracts/openapi.json").write_text(json.dumps({"paths": {"/b": {"get": {}, "x-y": 1}, "/a": {"post": {}}, "/c": 1}}))
    return str(root)


def test_tolerant(spark, tmp_path):
    b = load_bundle(spark, bundle(tmp_path, symbols=None, files=['{"path": "a.py"}', "{bad", ""]))
    assert b.files.count() == 1 and b.symbols.count() == 0 and "symbols" in b.missing and b.documents["run_metadata"] == {}
    assert operations_of(b.documents["openapi"]) == [("POST", "/a"), ("GET", "/b")]
    caps = capabilities(b)
    assert caps["files"] and not caps["symbols"] and caps["openapi"] and caps["retrieval_mode"] == "lexical"
    with pytest.raises(AttributeError):
        b.nothing


def test_strict(spark, tmp_path):
    b = load_strict(spark, bundle(tmp_path / "ok"))
    assert b.section_plans.first().raw == '{"section_id": "x"}' and b.symbols.first()["range"].end_line == 2
    for name, lines, category in (("chunks", None, "missing_input"), ("spans", ["{bad"], "malformed_row"), ("symbols", ['{"name": "n"}'], "missing_key"), ("files", ['{"path": "a"}'] * 2, "duplicate_key")):
        with pytest.raises(BundleError) as e:
            load_strict(spark, bundle(tmp_path / category, **{name: lines}))
        assert e.value.category == category
    record = write_failure(spark, str(tmp_path / "out"), e.value)
    stored = json.loads("".join(f.read_text() for f in (tmp_path / "out/validation.json").glob("part-*")))
    assert stored == record and stored["status"] == "fail"


def test_writer(spark, tmp_path):
    ev = spark.createDataFrame([("s1", "e1"), ("s1", "e2"), ("s2", "e3")], "section_id string, evidence_id string")
    m = write_evidence(ev, str(tmp_path), ev.limit(1))
    assert (m["items"], m["sections"], m["unresolved"], m["status"]) == (3, 2, 1, "pass")
    assert sorted(p.name for p in (tmp_path / "sections").glob("section_id=*")) == ["section_id=s1", "section_id=s2"]
    assert write_evidence(ev.limit(0), str(tmp_path / "none"))["status"] == "empty"


def test_openapi_discovery(spark):
    two = json.dumps({"openapi": "3", "paths": {"/a": {}, "/b": {}}})
    rows = [("r", "x/openapi.json", json.dumps({"paths": {"/a": {}}})), ("r", "z.json", two), ("r", "y.json", two), ("r", "n.json", '{"paths": {"/q": 1}}'), ("q", "swagger.json", "{bad"), ("q", "openapi.json", None)]
    assert [tuple(r) for r in discover_openapi(spark.createDataFrame(rows, "repo string, path string, text string")).collect()] == [("r", "y.json", 2)]

"""Plans in free text, merges, near-citations, topic blocks and plan fields, against literal expectations."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import plan_fields as P
from tessera.operators.plan_text import PlanError, balanced, citation_faults, heading_slug, loads, malformed_citations, merge_plans, parse_plan, repair, topic_block

DOC = {"title": "T", "sections": [{"section_id": "a"}]}
ROWS = '{"section_id": "a", "x": 1}\n{"section_id": "b"}\n'


def fenced(*blocks):
    return "\n\n".join(f"{label}\n\n```{lang}\n{body.strip()}\n```" for label, lang, body in blocks)


def test_labelled_blocks():
    p = parse_plan("Here you are.\n\n" + fenced(("## Document plan", "json", json.dumps(DOC)), ("## Section plans", "jsonl", ROWS)))
    assert p.document == DOC and [r["section_id"] for r in p.sections] == ["a", "b"] and p.warnings == []


def test_quotes_missing_labels_bad_rows_and_arrays():
    smart = json.dumps(DOC).replace('"', "“", 1)
    p = parse_plan(fenced(("", "", smart), ("", "", ROWS + "{broken\n")))
    assert p.document == DOC and len(p.sections) == 2 and p.warnings == ["row 3 is malformed"]
    p = parse_plan(fenced(("", "json", json.dumps(DOC)), ("", "json", json.dumps([{"section_id": "z"}, 3]))))
    assert p.sections == [{"section_id": "z"}]


def test_ambiguity_and_absence():
    with pytest.raises(PlanError, match="several"):
        parse_plan(fenced(("", "json", json.dumps(DOC)), ("", "json", json.dumps(DOC))))
    assert parse_plan(fenced(("a document plan", "json", json.dumps(DOC)), ("", "json", json.dumps({"section_order": []})))).document == DOC
    for text in ("", "no plan", "```json\n{}\n```"):
        with pytest.raises(PlanError, match="no document"):
            parse_plan(text)


def test_heading_form():
    p = parse_plan("# Document Plan\n" + json.dumps(DOC, indent=1) + "\n# End\n")
    assert p.document == DOC and p.warnings


def test_balanced_and_repair():
    assert balanced('x {"a": "}", "b": {"c": "\\""}} y') == '{"a": "}", "b": {"c": "\\""}}' and balanced("{") is None and balanced("[1, [2]] 3", pair="[]") == "[1, [2]]"
    assert loads('{"gaps": [], "one gap", "b": 1}') == {"gaps": ["one gap"], "b": 1}
    assert repair('{"a": [], "x" "y"}') == '{"a": [], "x" "y"}'
    with pytest.raises(ValueError):
        loads("{")


def test_merge(spark):
    doc = spark.createDataFrame([("r", 1, "a", "A"), ("r", 2, "b", "Two"), ("r", 3, None, "two "), ("r", 4, "a", "A"), ("q", 1, "a", "A")], "part string, pos int, section_id string, title string")
    plans = spark.createDataFrame([("r", 1, "a", "?"), ("r", 2, "x", "TWO"), ("r", 3, "y", "two"), ("r", 4, "a", "other"), ("r", 5, None, None)], "part string, plan_no int, section_id string, title string")
    got = sorted((r.part, r.pos, r.plan_no, r.matched) for r in merge_plans(doc, plans).collect() if r.plan_no is not None)
    assert got == [("r", 1, 1, "id"), ("r", 2, 2, "title"), ("r", 3, 3, "title"), ("r", 5, 4, "appended"), ("r", 6, 5, "appended")]
    assert merge_plans(doc, plans).filter("matched = 'none'").count() == 2 and merge_plans(doc.limit(0), plans.limit(0)).count() == 0


FAULTS = {
    "[ev:a-b:0001] fine": [], "[ev:a:010]": [("wrong_ordinal_width", "ev:a:0010")], "[ev:a:]": [("missing_ordinal", None)], "[ev:a]": [("missing_ordinal_separator", None)], "[ev:a:0001:x]": [("extra_field", "ev:a:0001")],
    "[ev:A b:0001]": [("invalid_section_id", None)], "[ev:a:0001 x]": [("malformed_ordinal", "ev:a:0001")], "[ev:a:0001 and": [("dangling_opener", "ev:a:0001")], "see ev:a:7 here": [("unbracketed_token", "ev:a:0007")], "[ev:a:99999]": [("wrong_ordinal_width", None)],
}


def test_malformed_citations(spark):
    assert {t: [x[3:] for x in malformed_citations(t)] for t in FAULTS} == FAULTS
    assert [x[:3] for x in malformed_citations("ok\n ev:a:1 [ev:b:2]")] == [(2, 2, "ev:a:1"), (2, 9, "[ev:b:2]")]
    df = spark.createDataFrame([("k", "[ev:a:1]", 1), ("k", "[ev:a:1]", 1), ("n", None, 1), ("e", "", 1)], "id string, text string, line_no int")
    assert [(r.id, r.line_no, r.column_no, r.suggestion) for r in citation_faults(df, "id", "text").collect()] == [("k", 1, 1, "ev:a:0001")]


def test_topic_blocks():
    md = "# Top\nintro\n\n## Big Part (x)\nbody\n### Deep\nmore\n\n## Next\nA paragraph on queues.\n"
    assert heading_slug("## Big Part (x) ##") == "big-part-x" and heading_slug("text") is None
    assert topic_block(md, "?", "#big-part-x") == "## Big Part (x)\nbody\n### Deep\nmore" and topic_block(md, "deep") == "### Deep\nmore"
    assert topic_block(md, "queues") == "## Next\nA paragraph on queues." and topic_block(md, "none") is None and topic_block(None, "x") is None


def test_plan_fields(spark):
    df = spark.createDataFrame([("retrieval_needs.files[2]", "derived/planning-x.md:1-2", " Meta ", ["a"]), ("title", "src\\a.py", "overview", []), (None, None, None, None), ("a.b[x]", "docs/planning-gaps.md", "provenance-meta", None)], "f string, r string, s string, n array<string>")
    name, index = P.source_field(F.col("f"))
    rows = df.select(name, index, P.clean_reference(F.col("r")), P.context_artifact(F.col("r")), P.generated_context(F.col("r")), P.diagnostic_artifact(F.col("r")), P.section_role(F.col("s")), P.has_signal(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [
        ("files", 2, "derived/planning-x.md", "derived/planning-x.md", True, None, "provenance", True), ("title", -1, "src/a.py", None, False, None, "source", False),
        (None, -1, None, None, False, None, "source", False), (None, -1, "docs/planning-gaps.md", None, False, "docs/planning-gaps.md", "provenance", False),
    ]
    one = spark.range(1).select(P.pointer_parts(F.lit("/paths/~1a~0b/get")), P.pointer_parts(F.lit("x")), P.derived_contract(F.lit(None).cast("boolean"), F.lit(0)), P.derived_contract(F.lit(False), F.lit(2))).first()
    assert tuple(one) == (["paths", "/a~b", "get"], None, True, False)

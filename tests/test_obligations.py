from tessera.operators.obligations import obligations


def test_codes_and_precedence(spark):
    topics = spark.createDataFrame([("s", t, r) for t, r in (("ok", True), ("none", True), ("optional", False), ("empty", True), ("alias", True), ("invalid", True), ("broad", True), ("lanes", True), ("other", True), ("uncited", True), ("mixed", True), ("any", True))], "section_id string, topic string, required boolean")
    f = "retrieval_needs."
    rows = [
        ("ok", [f + "files[0]"], ["file_anchor"]), ("optional", [f + "files[0]"], []), ("empty", [], []), ("alias", ["evidence_needs.files[0]"], []), ("invalid", [f + "files[9]"], []), ("broad", [f + "search_hints[0]"], []),
        ("lanes", [f + "files[0]"], ["bm25"]), ("other", [f + "files[0]"], ["test"]), ("uncited", [f + "files[1]"], ["file_anchor"]), ("mixed", [f + "files[1]", f + "files[0]", f + "files[9]"], None), ("any", [f + "symbols[0]"], []), ("extra", None, None),
    ]
    req = spark.createDataFrame([("s", *r) for r in rows], "section_id string, topic string, source_fields array<string>, acceptable_lanes array<string>")
    needs = spark.createDataFrame([("s", "files", 0, True), ("s", "files", 1, False), ("s", "symbols", 0, None), ("s", "search_hints", 0, None)], "section_id string, field string, index int, citeable boolean")
    got = {}
    for r in obligations(topics, req, needs).collect():
        got.setdefault(r.topic, (r.status, set()))[1].add(r.defect)
    assert got == {
        "ok": ("complete", {None}), "any": ("complete", {None}), "none": ("incomplete", {"missing_requirement"}), "optional": ("not_applicable", {"not_required"}), "extra": ("not_applicable", {"not_required", "empty_source_fields"}),
        "empty": ("incomplete", {"empty_source_fields"}), "alias": ("incomplete", {"raw_alias_source_field"}), "invalid": ("incomplete", {"invalid_source_field"}), "broad": ("incomplete", {"broad_only_source_fields"}),
        "lanes": ("incomplete", {"broad_only_acceptable_lanes"}), "other": ("incomplete", {"lane_not_acceptable"}), "uncited": ("incomplete", {"source_not_citeable"}), "mixed": ("complete", {"invalid_source_field"}),
    }
    assert obligations(topics.limit(0), req.limit(0), needs).count() == 0

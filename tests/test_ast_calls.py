from tessera.plans.analysis_queries import ast_calls


def test_calls_of_imported_names(spark, tmp_path):
    texts = {1: ("a.py", "from b import go as g\ndef f():\n    g()\n    f()\n    x.go()\n"), 2: ("b.py", "def go(): pass\n"), 3: ("c.py", "def go(): pass\n")}
    spark.createDataFrame([(i, "r", p) for i, (p, _) in texts.items()], "file_id long, repo string, path string").write.parquet(str(tmp_path / "files.parquet"))
    spark.createDataFrame([(i, t) for i, (_, t) in texts.items()], "file_id long, text string").write.parquet(str(tmp_path / "file_texts.parquet"))
    assert {(r.caller, r.callee, r.start_line, r.confidence) for r in ast_calls(spark, str(tmp_path)).collect()} == {("f", "g", 3, "medium"), ("f", "go", 5, "unresolved")}

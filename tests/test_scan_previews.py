from tessera.plans.analysis_queries import scan_previews


def test_previews_of_all_packs_with_their_symbol(spark, tmp_path):
    tables = {
        "files": ("file_id long, repo string, path string", [(1, "r", "a.py"), (2, "r", "b.toml")]),
        "file_texts": ("file_id long, text string", [(1, "x\nclass A:\n    @w\n    def f(self):\n        os.getenv('K')\n\n"), (2, "[s]")]),
        "symbols": ("symbol_id string, repo string, path string, kind string, start_line int, end_line int, decorators array<string>", [("m/", "r", "a.py", "module", 1, 6, None), ("A#", "r", "a.py", "class", 2, 5, []), ("A#f().", "r", "a.py", "method", 4, 5, ["w"])]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {(r.file_id, r.pack, r.line_no, r.context, r.symbol_id) for r in scan_previews(spark, str(tmp_path)).collect()}
    assert got == {(1, "env_vars", 5, "    @w\n    def f(self):\n        os.getenv('K')\n\n", "A#f()."), (2, "config_file_keys", 1, "[s]", None)}

"""Every query with SQL equals DuckDB on small tables that hold nulls, repeats and clashes."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__
from tessera.plans import registry

TS = dt.datetime(2026, 1, 1)
TABLES = {
    "files": ("file_id long, repo string, path string, line_count long", [(1, "r", "src/a.py", 3), (1, "r", "src/a.py", 3), (2, "r", "docs/b.md", 7), (3, "r", "c.toml", 3), (4, "q", "d.yaml", None), (5, "q", "x/e.dockerfile", 3), (6, "r", "tests/test_a.py", 0), (None, "q", "x", 1), (7, "q", None, 1)]),
    "file_texts": ("file_id long, text string", [(1, "import os\nclass A:\n    pass\n"), (2, "# T\n\n## U\ntext\n```\n# no\n```"), (3, "a = 1\n[s]\nb = 2"), (4, "k:\n  v: 1\nm: 2\n"), (5, "FROM a AS b\nRUN x\nFROM c\n"), (6, ""), (7, "zz")]),
    "chunks": (
        "chunk_id string, repo string, path string, start_line int, end_line int, chunk_type string, symbol_name string, heading_path string, sha256 string, text string, indexed_at timestamp, loaded_at timestamp, decorators array<string>",
        [("c1", "r", "src/a.py", 1, 3, "class", "A", None, "s1", "class A parser list", TS, TS, ['app.get("/x/<id>")', "x"]), ("c1", "r", "src/a.py", 1, 3, "class", "A", None, "s1", "class A parser list", TS, TS + dt.timedelta(1), ['app.get("/x/<id>")', "x"]), ("c2", "r", "docs/b.md", 1, 4, "doc_section", None, "T > U", None, "release note parser", TS, TS, ['app.put("/x/<id>")', 'app.get("/none")']), ("c3", "q", None, None, None, "x", None, None, None, None, TS, TS, None), (None, "q", "x", 1, 1, "x", None, None, None, "t", TS, TS, [])],
    ),
    "symbols": (
        "symbol_id string, repo string, path string, name string, kind string, module string, parent_symbol_id string, bases array<string>, start_line int, end_line int, span_id string, decorators array<string>",
        [("m/", "r", "src/a.py", "a", "module", "a", None, [], 1, 3, "span:src/a.py:1-3:module", []), ("m/A#", "r", "src/a.py", "A", "class", "a", "m/", ["B"], 2, 3, "span:src/a.py:2-3:class", ['app.get("/x/<id>")', '@r.api.post("/v1/y")']), ("m/A#", "r", "src/a.py", "A", "class", "a", "m/", ["B"], 2, 3, "span:src/a.py:2-3:class", ['app.get("/x/<id>")', '@r.api.post("/v1/y")']), ("l1", "r", "z", "B", "class", "z", "l2", [], 1, 9, None, None), ("l2", "r", "z", "C", "class", "z", "l1", None, 1, 9, "sp2", [])],
    ),
    "sections": (
        "section_id string, repo string, title string, section_role string, priority string, parent_section_id string, markdown string, used_evidence_ids array<string>, covered_topics array<string>, page_profile string, section_order int, coverage_labels array<string>",
        [("s1", "r", "T", "x", None, None, "see [EV-1] and [EV-2]", ["EV-1", "EV-3"], ["Alpha ", "beta"], None, 1, ["x", "T"]), ("s2", "r", "", None, "p", "s1", "[EV-3]", ["EV-2"], ["alpha"], "p", 2, None), ("s3", "r", None, None, None, "s3", None, None, None, None, None, []), ("s4", "r", "U", "x", "p", "gone", "", [], [None], None, 3, [None])],
    ),
    "documents": (
        "doc_id long, text string, lang string, source string, repo string, path string, updated_at timestamp",
        [(1, "The release note and the parser", "en", "w", "r", "src/a.py", TS), (2, "# T\n`src/a.py` and `A` symbol table", None, "w", "r", "docs/b.md", TS), (3, None, "de", "w", "q", None, TS), (4, "", "", "v", "q", "no/such.py", None), (5, "evidence packet " * 40, "fr", "v", "q", "d.yaml", TS)],
    ),
    "embeddings": ("vec_id long, embedding array<float>, label int", [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (20, [0.0, 1.0], 2)]),
    "events": ("event_id long, event_type string, props string", [(1, "a", '{"k": 3}'), (2, "a", "{}"), (3, "b", None)]),
    "repos": ("repo string", [("r",)]),
}


@pytest.fixture(scope="module")
def tiny(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tiny")
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(d / f"{name}.parquet"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet/*.parquet')")
    return str(d), con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def show(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return "\0"
        return repr(round(x, 6)) if isinstance(x, float) else str(x)

    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) & set(registry.ORACLE)))
def test_equal_to_sql(spark, tiny, name):
    d, con = tiny
    df = registry.QUERIES[name](spark, d)
    got = con.execute(registry.ORACLE[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.collect(), df.columns) == canonical(got.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, tiny, name):
    registry.QUERIES[name](spark, tiny[0]).collect()


def test_entry_points():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

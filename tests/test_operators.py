import math
import random

from pyspark.sql import functions as F

from tessera.operators.chunking import boundary_sections, line_windows, markdown_sections, text_lines
from tessera.operators.graph import degrees, neighbours
from tessera.operators.joins import overlap_join, resolve, suffixes
from tessera.operators.patterns import digest, preview, scan
from tessera.operators.pyast import parse
from tessera.operators.ranking import allocate, assign_ids, capped, fold_hits, prefix_budget
from tessera.operators.search import bm25, cosine_top_k, fingerprint
from tessera.operators.tables import count_by, one_per_key


def windows(n, length, overlap):
    out, s = [], 1
    while s <= n:
        e = min(s + length - 1, n)
        out.append((s, e))
        if e == n:
            break
        s = e - overlap + 1
    return out


def test_windows_equal_the_loop(spark):
    sizes = [1, 2, 7, 8, 9, 13, 14, 15, 40, 161]
    df = spark.createDataFrame([(i, "\n".join(map(str, range(n)))) for i, n in enumerate(sizes)] + [(98, ""), (99, None)], "k int, text string")
    got = {}
    for r in line_windows(df, ["k"], "text", length=8, overlap=2).collect():
        got.setdefault(r.k, []).append((r.start_line, r.end_line))
    assert {k: sorted(v) for k, v in got.items()} == {i: windows(n, 8, 2) for i, n in enumerate(sizes)} | {98: [(1, 1)]}


def test_sections(spark):
    df = spark.createDataFrame([(1, "x\n[a]\n1\n[b]\n2")], "k int, text string")
    s = boundary_sections(text_lines(df, ["k"], "text"), ["k"], F.col("line").rlike(r"^\["), F.col("line"))
    assert sorted((r.title, r.start_line, r.end_line) for r in s.collect()) == [("(preamble)", 1, 1), ("[a]", 2, 3), ("[b]", 4, 5)]


def test_markdown_paths_respect_fences(spark):
    df = spark.createDataFrame([(1, "intro\n# A\n## B\n```\n# no\n```\n### C\n## D\n# E\n### F")], "k int, text string")
    got = [r.heading_path for r in markdown_sections(text_lines(df, ["k"], "text"), ["k"]).orderBy("start_line").collect()]
    assert got == ["(preamble)", "A", "A > B", "A > B > C", "A > D", "E", "E > F"]


def test_overlap_and_suffixes(spark):
    left = spark.createDataFrame([("p", 1, 5), ("p", 8, 9), (None, 1, 9)], "g string, l_start int, l_end int")
    right = spark.createDataFrame([("p", 5, 7, "a"), ("p", 9, 9, "b"), ("q", 1, 9, "c")], "g string, r_start int, r_end int, id string")
    assert sorted((r.l_start, r.id) for r in overlap_join(left, right, ["g"]).collect()) == [(1, "a"), (8, "b")]
    assert spark.range(1).select(suffixes(F.lit("a/b/c"))).first()[0] == ["a/b/c", "b/c", "c"]


def test_resolve_never_guesses(spark):
    refs = spark.createDataFrame([("r", "x"), ("r", "y"), ("r", "z"), (None, "x")], "repo string, ref string")
    al = spark.createDataFrame([("r", "x", "1", 0), ("r", "x", "2", 1), ("r", "y", "1", 1), ("r", "y", "2", 1)], "repo string, alias string, h string, level int")
    got = {(r.repo, r.ref): (r.verdict, r.h, r.candidates) for r in resolve(refs, ["repo", "ref"], al, ["repo", "alias"], "h").collect()}
    assert got == {("r", "x"): ("exact", "1", None), ("r", "y"): ("ambiguous", None, "1|2"), ("r", "z"): ("no_match", None, None), (None, "x"): ("no_match", None, None)}


def test_bm25_against_a_loop(spark):
    rnd = random.Random(4)
    docs = [(f"d{i}", " ".join(rnd.choice(["red", "green", "blue", "list items", "list", "items"]) for _ in range(rnd.randrange(1, 30)))) for i in range(25)] + [("e", ""), ("n", None)]
    queries = ["red green", "list_items", "red red", "nothing"]
    toks = {k: (t or "").split() for k, t in docs}
    avg = sum(map(len, toks.values())) / len(docs)
    want = {}
    for qi, q in enumerate(queries):
        score = {}
        for w in q.split():
            ph = w.split("_")
            f = {k: sum(ts[i : i + len(ph)] == ph for i in range(len(ts))) for k, ts in toks.items()}
            n = sum(v > 0 for v in f.values())
            idf = math.log((len(docs) - n + 0.5) / (n + 0.5))
            idf = idf if idf > 0 else 1e-6
            for k, v in f.items():
                if v:
                    score[k] = score.get(k, 0) - idf * v * 2.2 / (v + 1.2 * (0.25 + 0.75 * len(toks[k]) / avg))
        for place, (s, k) in enumerate(sorted((round(s, 6), k) for k, s in score.items())[:5], 1):
            want[qi, place] = (k, s)
    q = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    got = {(r.query_id, r.place): (r.id, r.score) for r in bm25(spark.createDataFrame(docs, "id string, text string"), "id", F.col("text"), q, 5).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_cosine_and_fingerprint(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 2.0]), (4, [2.0, 0.0])], "id int, e array<float>")
    got = [(r.place, r.id, r.score) for r in cosine_top_k(v, v.filter("id = 1"), "id", "e", 2).orderBy("place").collect()]
    assert got == [(1, 4, 1.0), (2, 2, 0.707107)]
    a = spark.createDataFrame([("r", "x", "1"), ("r", "y", None)], "repo string, k string, s string")
    one = fingerprint(a, "k", "s", ["repo"]).first().fingerprint
    assert fingerprint(a.orderBy(F.desc("k")).union(a), "k", "s", ["repo"]).first().fingerprint == one


HIT = "section_id string, dedupe_key string, coarse_key string, path string, start_line int, end_line int, lane string, confidence string, lane_rank int, is_span boolean"


def test_fold_upgrades_independently(spark):
    rows = [
        ("s", "span:1", "p:1-2", "p", 1, 2, "query_pack", "exact", None, True),
        ("s", "chunk:1", "p:1-2", "p", 1, 2, "file_anchor", "low", 1, False),
        ("s", "chunk:2", "p:5-6", "p", 5, 6, "bm25", "medium", 2, False),
        ("s", "chunk:2", "p:5-6", "p", 5, 6, "vector", "high", 1, False),
    ]
    got = {r.dedupe_key: (r.lane, r.confidence, r.lanes) for r in fold_hits(spark.createDataFrame(rows, HIT)).collect()}
    assert got == {"span:1": ("file_anchor", "exact", "file_anchor,query_pack"), "chunk:2": ("bm25", "high", "bm25,vector")}


def test_allocation_is_fair(spark):
    rows = [("s", f"a{i}", "file_anchor", i, ["file_anchor|x"]) for i in range(10)] + [("s", f"b{i}", "file_anchor", 20 + i, ["file_anchor|y"]) for i in range(10)] + [("s", f"r{i}", "bm25", 50 + i, []) for i in range(5)]
    got = allocate(spark.createDataFrame(rows, "section_id string, item string, lane string, place int, requests array<string>"), per_lane=4, total=6).collect()
    assert {r.item for r in got if r.step != "recall"} == {"a0", "b0", "a1", "b1"}
    assert sorted(r.item for r in got if r.step == "recall") == ["r0", "r1"]


def test_caps_ids_budget_counts(spark):
    df = spark.createDataFrame([("a", i, 3) for i in range(5)] + [("b", 1, 9)], "g string, x int, size int")
    assert sorted((r.g, r.x, r.total, r.truncated) for r in capped(df, ["g"], [F.col("x")], 2).collect()) == [("a", 0, 5, True), ("a", 1, 5, True), ("b", 1, 1, False)]
    assert [r.evidence_id for r in assign_ids(df.filter("g = 'a'"), "g", [F.col("x")]).orderBy("x").collect()][:2] == ["ev:a:0001", "ev:a:0002"]
    assert sorted((r.g, r.x) for r in prefix_budget(df, ["g"], [F.col("x")], "size", 7).collect()) == [("a", 0), ("a", 1)]
    assert [(r.key, r.n) for r in count_by(spark.createDataFrame([("x",), ("y",), ("x",), ("",), (None,), ("a",)], "k string"), "k", 2).collect()] == [("x", 2), ("a", 1)]
    assert one_per_key(spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string"), "k", ["v"]).collect() == [(1, "a")]


def test_graph(spark):
    e = spark.createDataFrame([("a", "CONTAINS", "b"), ("c", "IMPORTS", "a"), ("a", "IMPORTS", "d")], "src string, type string, dst string")
    assert {r.node_id: (r.n_in, r.n_out) for r in degrees(e).collect()} == {"a": (1, 2), "b": (1, 0), "c": (0, 1), "d": (1, 0)}
    s = spark.createDataFrame([("a",)], "node_id string")
    assert [(r.place, r.neighbour) for r in neighbours(e, s, 2).orderBy("place").collect()] == [(1, "b"), (2, "c")]


def test_patterns(spark):
    df = spark.createDataFrame([("a.py", "import os\nx = os.environ['A']\n\nif __name__ == '__main__':\n    main()"), ("build/a.py", "os.environ"), ("a.md", "os.environ")], "path string, text string")
    lines = text_lines(df, ["path"], "text")
    hits = scan(lines, ["path"], "path")
    assert {(r.pack, r.line_no) for r in hits.collect()} == {("env_vars", 2), ("entrypoints", 4)}
    assert digest(hits, ["path", "line_no"], 1).count() == 2
    assert preview(hits.filter("pack = 'entrypoints'"), lines, ["path"], 1).first().context == "\nif __name__ == '__main__':\n    main()"


def test_parse_python():
    rows = parse("import os\nfrom .a import b as c\n@app.get('/x')\nasync def f(a, *, b=1) -> int:\n    g(a)\n    def h():\n        k()\nclass A(B.C):\n    def m(self): self.f()\n")
    assert ("import", "os", "", 1, 1, None) in rows and ("import", ".a:b", "", 2, 2, "c") in rows
    assert ("function", "f", "", 4, 7, "async def f(a, *, b=1) -> int") in rows and ("route", "/x", "f", 4, 7, "GET") in rows
    assert {r[1:3] for r in rows if r[0] == "call"} == {("g", "f"), ("k", "f.h"), ("self.f", "A.m")}
    assert ("class", "A", "", 8, 9, "B.C") in rows and parse("def (")[0][0] == "error"

from tessera.operators.graph import build_graph, hubs, neighbours, whole_graph
from tessera.operators.pyast import parse_python

TEXTS = {
    1: ("src/pkg/a.py", "import os\nimport flask as fl\nfrom . import b\nfrom r.pkg.b import helper as h\nclass A(fl.View):\n    @fl.route('/x')\n    def run(self):\n        h()\n        h()\n"),
    2: ("src/pkg/b.py", "from os import path\ndef helper():\n    helper()\n"),
    3: ("tests/test_b.py", "def test_helper():\n    helper()\n"),
}
SYMBOLS = [
    ("m a/", "src/pkg/a.py", "a", "module", None, [], []), ("m a/A#", "src/pkg/a.py", "A", "class", "m a/", ["fl.View"], []), ("m a/A#run().", "src/pkg/a.py", "run", "method", "m a/A#", [], ["fl.route('/x')", "helper"]),
    ("m b/", "src/pkg/b.py", "b", "module", None, [], []), ("m b/helper().", "src/pkg/b.py", "helper", "function", "m b/", [], []),
    ("m t/test_helper().", "tests/test_b.py", "test_helper", "function", None, [], []),
]


def test_whole_graph(spark):
    files = spark.createDataFrame([(i, "r", p) for i, (p, _) in TEXTS.items()], "file_id long, repo string, path string")
    symbols = spark.createDataFrame([("r", *s) for s in SYMBOLS], "repo string, symbol_id string, path string, name string, kind string, parent_symbol_id string, bases array<string>, decorators array<string>")
    parsed = parse_python(spark.createDataFrame([(i, t) for i, (_, t) in TEXTS.items()], "file_id long, text string")).join(files, "file_id")
    tests = spark.createDataFrame([("r", "tests/test_b.py", "src/pkg/b.py")], "repo string, path string, target string")
    mentions = spark.createDataFrame([(7, "m b/helper().")], "doc_id long, symbol_id string")
    nodes, edges = whole_graph(files, symbols, parsed, tests, mentions, spark.createDataFrame([(7, "r"), (8, None)], "doc_id long, repo string"))
    assert {r.node_id: r.type for r in nodes.collect() if r.type in ("test", "dependency", "document")} == {"file:r/tests/test_b.py": "test", "dep:r/os": "dependency", "dep:r/flask": "dependency", "doc:7": "document", "doc:8": "document"}
    want = {
        ("sym:m a/", "IMPORTS", "dep:r/os", 1), ("sym:m a/", "IMPORTS", "dep:r/flask", 2), ("sym:m b/", "IMPORTS", "dep:r/os", 1), ("file:r/src/pkg/a.py", "IMPORTS", "file:r/src/pkg/b.py", None),
        ("sym:m a/A#run().", "CALLS_APPROX", "sym:m b/helper().", 8), ("sym:m a/A#run().", "CALLS_APPROX", "sym:m b/helper().", 9), ("sym:m t/test_helper().", "CALLS_APPROX", "sym:m b/helper().", 2),
        ("sym:m a/A#", "INHERITS", "dep:r/flask", None), ("sym:m a/A#run().", "DECORATED_BY", "dep:r/flask", None), ("sym:m a/A#run().", "DECORATED_BY", "sym:m b/helper().", None),
        ("sym:m t/test_helper().", "TESTS_APPROX", "sym:m b/helper().", None), ("file:r/tests/test_b.py", "TESTS_APPROX", "file:r/src/pkg/b.py", None), ("doc:7", "MENTIONS", "sym:m b/helper().", None),
    }
    got = {tuple(r) for r in edges.collect()}
    assert {r for r in got if r[1] != "CONTAINS"} == want
    assert {r[:3] for r in got if r[1] == "CONTAINS"} == {tuple(r) for r in build_graph(files, symbols)[1].collect()}
    top = {(r.type, r.side): (r.node_id, r.n) for r in hubs(edges).collect() if r.place == 1}
    assert top["CALLS_APPROX", "dst"] == ("sym:m b/helper().", 3) and top["CALLS_APPROX", "src"] == ("sym:m a/A#run().", 2) and top["all", "both"] == ("sym:m b/helper().", 7)
    assert [r.neighbour for r in neighbours(edges, nodes.filter("type = 'class'")).orderBy("place").collect()] == ["sym:m a/", "sym:m a/A#run().", "dep:r/flask"]

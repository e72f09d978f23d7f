from pyspark.sql import functions as F

from tessera.functions import scalars as S


def values(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expr).collect()]


def test_classify_takes_the_first_rule(spark):
    paths = ["a/b.png", "x/poetry.lock", "web/node_modules/a.js", "deploy/a.py", "tests/a.py", "docs/a.py", "conf/a.py", "a.toml", "a.py", "a.txt", "src/db/migrations/versions/1.py"]
    assert values(spark, S.classify(F.col("x")), paths) == ["asset", "generated", "vendor", "deployment", "test", "docs", "config", "config", "source", "other", "generated"]


def test_language_names_win(spark):
    p = F.col("x")
    assert values(spark, S.language_for(S.extension(p), S.base_name(p)), ["Dockerfile.dev", "go.sum", "Makefile", "a.tsx", "a.unknown", "noext"]) == ["dockerfile", "go-mod", "makefile", "tsx", "other", "other"]


def test_line_count(spark):
    assert values(spark, S.line_count(F.col("x")), ["", None, "a", "a\n", "a\nb", "\n\n"]) == [0, 0, 1, 1, 2, 2]


def test_module_dotted(spark):
    assert values(spark, S.module_dotted(F.col("x")), ["src/app/main.py", "app/api/__init__.py", "__init__.py", "a.pyx"]) == ["app.main", "app.api", "", "a"]


def test_clip_and_slug(spark):
    assert values(spark, S.clip(F.col("x"), 4, "~"), ["abcd", "ab  cd", None]) == ["abcd", "ab~", ""]
    assert values(spark, S.slug(F.col("x")), ["Hello, World_x/y", "--", "Ünï 1"]) == ["hello-world-x-y", "item", "ünï-1"]


def test_bounded(spark):
    assert values(spark, S.bounded(F.col("x"), "search"), ["research", "a Search b", "search_index", "x.search", None]) == [False, True, True, True, None]


def test_anchor(spark):
    assert values(spark, F.concat_ws("-", S.anchor_start(F.col("x")).cast("string"), S.anchor_end(F.col("x")).cast("string")), ["a:5", "a:9-3", "a"]) == ["5-5", "3-9", ""]


def test_signal_status(spark):
    df = spark.createDataFrame([(0, 0, 0), (3, 0, 0), (1, 4, 2), (0, 5, 0)], "f int, h int, s int")
    assert [r[0] for r in df.select(S.signal_status(F.col("f"), F.col("h"), F.col("s"))).collect()] == ["missing", "present", "low", "present"]

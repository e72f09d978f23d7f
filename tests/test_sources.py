import json

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.sources.jsonl import MalformedRows, read_lenient, read_or_empty, read_strict, write_rows
from tessera.sources.repository import read_repository
from tessera.streaming.reindex import stream_index

SCHEMA = StructType([StructField("id", IntegerType()), StructField("t", StringType())])


def test_readers(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "t": "x"}\n\n{"id": 2, "t": "ü"}\nnot json\n')
    assert read_lenient(spark, str(p), SCHEMA).count() == 2
    with pytest.raises(MalformedRows, match="not json"):
        read_strict(spark, str(p), SCHEMA)
    with pytest.raises(MalformedRows, match=r"a\.jsonl:4: not json"):
        read_strict(spark, str(p), SCHEMA)
    p.write_text('{"id": 1, "t": "x"}\n')
    assert read_strict(spark, str(p), SCHEMA).first().raw == '{"id": 1, "t": "x"}'
    assert read_or_empty(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_writer_counts(spark, tmp_path):
    assert write_rows(spark.createDataFrame([(1, "x"), (2, "ß")], SCHEMA), str(tmp_path / "o")) == 2
    lines = [json.loads(x) for f in (tmp_path / "o").glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(x["t"] for x in lines) == ["x", "ß"]


def test_repository(spark, tmp_path):
    for name, body in {"src/a.py": b"x = 1\n", "b.png": b"\x89PNG", "c.txt": b"a\0b", "node_modules/z.js": b"1", "docs/d.md": "# ü\nx".encode()}.items():
        f = tmp_path / "r" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(body)
    got = {r.path: r for r in read_repository(spark, str(tmp_path / "r"), "demo").collect()}
    assert set(got) == {"src/a.py", "b.png", "c.txt", "docs/d.md"}
    assert got["src/a.py"].text == "x = 1\n" and got["src/a.py"].line_count == 1 and got["src/a.py"].category == "source"
    assert got["b.png"].text is None and got["c.txt"].text is None and got["docs/d.md"].text == "# ü\nx"


def test_stream_index(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", "x x y"), ("a", "x x y"), ("b", None)], "chunk_id string, text string").write.parquet(src)
    q = stream_index(spark.readStream.schema("chunk_id string, text string").parquet(src), out, str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(spark.read.parquet(out).collect()) == [("a", "x", 2), ("a", "y", 1)]


def test_repository_prunes_by_metadata(spark, tmp_path, monkeypatch):
    """Ignored folders and files above the cap never reach the scan."""
    for name, size in {"a.py": 3, "node_modules/b.js": 4, ".git/objects/c": 5, "big.txt": 400}.items():
        f = tmp_path / "r" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"x" * size)
    monkeypatch.setattr("tessera.sources.repository.READ_CAP", 100)
    df = read_repository(spark, str(tmp_path / "r"), "demo")
    got = {r.path: (r.size_bytes, r.text, r.sha256 is None) for r in df.collect()}
    assert got == {"a.py": (3, "xxx", False), "big.txt": (400, None, True)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_metadata" in plan or "file_path" in plan


def test_stream_index_replaces_and_replays(spark, tmp_path):
    from tessera.streaming.reindex import index_batch, read_index, search_index

    out = str(tmp_path / "ix")
    frame = lambda rows: spark.createDataFrame(rows, "chunk_id string, text string")
    first, second = frame([("a", "x x y"), ("b", "y"), (None, "q")]), frame([("a", "z"), ("c", "x y")])
    for n, df in ((0, first), (1, second), (1, second), (2, frame([("b", None)]))):
        index_batch(df, n, out)
    ix = read_index(spark, out)
    assert sorted(ix.collect()) == [("a", "z", 1), ("c", "x", 1), ("c", "y", 1)]
    assert [(r.place, r.chunk_id) for r in search_index(ix, ["x", "z"]).collect()] == [(1, "a"), (2, "c")]

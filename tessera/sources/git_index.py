"""Tracked paths of a repository, read from its index file; no external program is run."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FIXED = 62  # bytes of an entry before its name


def index_paths(data: bytes) -> list[str] | None:
    """Paths of an index of version 2 or 3 in order, each once; None for other versions and broken files."""
    if len(data) < 12 or data[:4] != b"DIRC":
        return None
    version, count = struct.unpack(">II", data[4:12])
    if version not in (2, 3):
        return None
    out, at = [], 12
    for _ in range(count):
        if at + _FIXED > len(data):
            return None
        flags = struct.unpack(">H", data[at + 60 : at + 62])[0]
        begin = at + _FIXED + (2 if flags & 0x4000 else 0)
        end = data.find(b"\0", begin)
        if end < 0:
            return None
        out.append(data[begin:end].decode("utf-8", "replace"))
        at += ((end - at) // 8 + 1) * 8
    return list(dict.fromkeys(out))


def mark_tracked(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """``files`` with ``git_tracked``: whether the index at ``root`` lists the path; all true where there is no readable, non-empty index."""
    path = f"{root.rstrip('/')}/.git/index"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return files.withColumn("git_tracked", F.lit(True))
    paths = index_paths(bytes(spark.read.format("binaryFile").load(path).select("content").first().content))
    if not paths:
        return files.withColumn("git_tracked", F.lit(True))
    known = spark.createDataFrame([(x,) for x in paths], "path string").withColumn("t", F.lit(True))
    return files.join(known, "path", "left").withColumn("git_tracked", F.coalesce("t", F.lit(False))).drop("t")


def list_files(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """The tracked files if the index lists any, else all that the walk found."""
    marked = mark_tracked(spark, files, root)
    return marked.filter("git_tracked")

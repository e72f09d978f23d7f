"""A code repository on a file system as tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S

# Folders that are never listed.
IGNORED = (
    ".git",
    ".hg",
    ".svn",
    "__pycache__",
    ".mypy_cache",
    ".pytest_cache",
    ".ruff_cache",
    ".idea",
    ".vscode",
    "node_modules",
    ".venv",
    "venv",
    "env",
    ".env.d",
    "dist",
    "build",
    ".next",
    ".turbo",
    ".cache",
    "target",
    ".gradle",
    ".tox",
    "site-packages",
    ".eggs",
    "coverage",
    ".agents",
    ".github_cache",
)
#: Bytes above which a file is listed but not read.
READ_CAP = 64 << 20


def read_repository(spark: SparkSession, root: str, repo: str) -> DataFrame:
    """Files below ``root`` with derived fields; text is null for binary, oversized and NUL-holding files.

    Files in ignored folders and files above ``READ_CAP`` are dropped by their metadata, when the scan is planned, so they
    are never opened; oversized files keep a row without text and digest.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/") + "/"
    relative = lambda c: F.regexp_replace(c, "^(?:file:)?/*" + "\\Q" + base.lstrip("/") + "\\E", "")
    ignored = r"(?:^|/)(?:" + "|".join(re.escape(p) for p in IGNORED) + r")(?:/|$)"
    kept = raw.filter(~relative(F.col("_metadata.file_path")).rlike(ignored))
    small = kept.filter((F.col("_metadata.file_size") <= READ_CAP) & (F.col("length") <= READ_CAP)).select(relative(F.col("path")).alias("path"), F.col("length").alias("size_bytes"), "content")
    large = kept.filter((F.col("_metadata.file_size") > READ_CAP) & (F.col("length") > READ_CAP)).select(relative(F.col("path")).alias("path"), F.col("length").alias("size_bytes"), F.lit(None).cast("binary").alias("content"))
    x = small.unionByName(large)
    path = F.col("path")
    readable = ~S.extension(path).isin(*S.BINARY) & (F.col("size_bytes") <= S.TEXT_CAP) & (F.locate("00", F.regexp_replace(F.hex(F.substring("content", 1, 8000)), "(..)", "$1 ")) == 0)
    text = F.when(readable, F.decode("content", "UTF-8"))
    return x.select(
        F.lit(repo).alias("repo"),
        "path",
        S.base_name(path).alias("name"),
        S.extension(path).alias("ext"),
        S.language_for(S.extension(path), S.base_name(path)).alias("language"),
        S.classify(path).alias("category"),
        "size_bytes",
        S.line_count(text).alias("line_count"),
        F.sha2("content", 256).alias("sha256"),
        S.top_dir(path).alias("top_dir"),
        S.indexable(path, F.col("size_bytes")).alias("indexable"),
        text.alias("text"),
    )

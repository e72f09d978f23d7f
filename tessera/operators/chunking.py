"""Texts cut into line ranges: overlapping windows, and sections that run from one boundary line to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_ranges(n: Column, length: int, overlap: int) -> Column:
    """Array of (start_line, end_line) structs that cover lines 1..n; the last window ends at n."""
    step = length - overlap
    k = F.lit(1) + F.ceil(F.greatest(n - length, F.lit(0)) / step)
    return F.when(
        n > 0,
        F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda i: F.struct((1 + i * step).alias("start_line"), F.least(i * step + length, n).cast("int").alias("end_line"))),
    )


def line_windows(df: DataFrame, keys: list[str], text: str, *, length: int = 160, overlap: int = 15) -> DataFrame:
    """``keys``, start_line, end_line and text of each window; null texts give none, an empty text one empty line."""
    lines = F.split(F.col(text), "\n", -1)
    e = df.filter(F.col(text).isNotNull()).select(*keys, lines.alias("lines")).withColumn("r", F.explode(window_ranges(F.size("lines"), length, overlap)))
    body = F.array_join(F.slice("lines", F.col("r.start_line"), F.col("r.end_line") - F.col("r.start_line") + 1), "\n")
    return e.select(*keys, F.col("r.start_line").alias("start_line"), F.col("r.end_line").alias("end_line"), body.alias("text"))


def text_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, line_no (from 1) and line of each line."""
    return df.filter(F.col(text).isNotNull()).select(*keys, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def boundary_sections(lines: DataFrame, keys: list[str], boundary: Column, title: Column) -> DataFrame:
    """``keys``, section_no, title, start_line, end_line: sections begin at boundary lines; lines before the first are ``(preamble)``."""
    w = Window.partitionBy(*keys).orderBy("line_no")
    marked = lines.withColumn("section_no", F.sum(F.when(boundary, 1).otherwise(0)).over(w)).withColumn("title", F.when(boundary, title))
    return marked.groupBy(*keys, "section_no").agg(F.coalesce(F.max("title"), F.lit("(preamble)")).alias("title"), F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"))


def markdown_sections(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, heading_path, level, start_line, end_line of Markdown sections; headings inside fences are text."""
    w = Window.partitionBy(*keys).orderBy("line_no")
    fence = F.ltrim("line").startswith("```") | F.ltrim("line").startswith("~~~")
    pat = r"^(#{1,6})\s+(.*\S)\s*$"
    x = lines.withColumn("inside", (F.sum(F.when(fence, 1).otherwise(0)).over(w) % 2 == 1) | fence)
    x = x.withColumn("level", F.when(~F.col("inside") & F.col("line").rlike(pat), F.length(F.regexp_extract("line", pat, 1)))).withColumn("title", F.regexp_extract("line", pat, 2))
    x = x.withColumn("section_no", F.count("level").over(w))
    for k in range(1, 7):
        x = x.withColumn(f"h{k}", F.last(F.when(F.col("level") == k, F.struct("line_no", "title")), True).over(w))
    parts = []
    for k in range(1, 7):
        above = [F.coalesce(F.col(f"h{j}.line_no"), F.lit(0)) for j in range(1, k)]
        newest = F.greatest(*above, F.lit(0)) if len(above) else F.lit(0)
        parts.append(F.when((F.col("level") >= k) & (F.col(f"h{k}.line_no") > newest), F.col(f"h{k}.title")))
    x = x.withColumn("path", F.when(F.col("level").isNotNull(), F.concat_ws(" > ", *parts)))
    return x.groupBy(*keys, "section_no").agg(F.coalesce(F.max("path"), F.lit("(preamble)")).alias("heading_path"), F.max("level").alias("level"), F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line")).drop("section_no")

"""Splitting oversized texts at natural boundaries.

A text's size is ``(characters + 3) div 4`` tokens. For each oversized text the offsets of its possible
cuts are kept as sorted arrays, one per kind of boundary (blank line, line, sentence, white space), with
prefix sums of line starts for the line numbers. A piece ends at the last boundary under the limit, found
by binary search, in the strongest kind that still fills half of the limit; without any boundary the cut is
hard. The next piece starts ``overlap`` tokens before the cut, moved further back to a line start where one
lies within the same distance again.

Defined results: texts within the limit, empty texts included, are one piece; a null text is one piece
with null text and estimate 0; a null ``start_line`` gives null line numbers; repeated rows of a key, line and text
count once and rows that differ each give their pieces, null keys included; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of one token in the size estimate.
CHARS = 4
_KINDS = (re.compile(r"\n[ \t\r]*\n+"), re.compile(r"\n"), re.compile(r"[.!?。！？]['\")\]]*\s|[。！？]"), re.compile(r"[\s,;]"))


def token_size(text: Column) -> Column:
    """Size of a text in estimated tokens; 0 for null."""
    return F.floor((F.coalesce(F.length(text), F.lit(0)) + 3) / 4).cast("int")


def split_offsets(text: str, limit: int, overlap: int) -> list[tuple[int, int, bool]]:
    """``(start, end, hard)`` of each piece of ``text``; every piece has at most ``limit`` tokens."""
    if limit < 1 or overlap < 0 or overlap >= limit:
        raise ValueError("limit must be positive and overlap below it")
    n, room, back = len(text), limit * CHARS, overlap * CHARS
    if n <= room:
        return [(0, n, False)]
    bounds = [np.fromiter((m.end() for m in k.finditer(text)), dtype=np.int64) for k in _KINDS]
    lines = np.concatenate([[0], bounds[1]])
    out, start = [], 0
    while n - start > room:
        top, cut, hard = start + room, 0, True
        least = start + max(room // 2, back + 1)
        for low in (least, start + back + 1):
            for b in bounds:
                i = int(np.searchsorted(b, top, side="right")) - 1
                if i >= 0 and b[i] >= low:
                    cut, hard = int(b[i]), False
                    break
            if not hard:
                break
        if hard:
            cut = top
        out.append((start, cut, hard))
        nxt = cut - back
        if back:
            i = int(np.searchsorted(lines, nxt, side="right")) - 1
            if lines[i] > start and lines[i] >= nxt - back:
                nxt = int(lines[i])
        start = nxt
    out.append((start, n, False))
    return out


_SCHEMA = T.StructType(
    [
        T.StructField("piece_no", T.IntegerType()),
        T.StructField("n_pieces", T.IntegerType()),
        T.StructField("start_line", T.IntegerType()),
        T.StructField("end_line", T.IntegerType()),
        T.StructField("start_char", T.IntegerType()),
        T.StructField("end_char", T.IntegerType()),
        T.StructField("token_estimate", T.IntegerType()),
        T.StructField("hard_cut", T.BooleanType()),
        T.StructField("text", T.StringType()),
    ]
)


def _pieces(limit: int, overlap: int, with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, first, text in zip(pdf["key"], pdf["start_line"], pdf["text"]):
                cuts = split_offsets(text, limit, overlap)
                ends = np.fromiter((m.start() for m in re.finditer("\n", text)), dtype=np.int64)
                known = not pd.isna(first)
                for no, (s, e, hard) in enumerate(cuts, 1):
                    last = max(s, e - 1)
                    a = int(first) + int(np.searchsorted(ends, s, side="left")) if known else None
                    z = int(first) + int(np.searchsorted(ends, last, side="left")) if known else None
                    rows.append((key, no, len(cuts), a, z, s, e, (e - s + CHARS - 1) // CHARS, hard, text[s:e] if with_text else None))
            out = pd.DataFrame(rows, columns=["key", *_SCHEMA.fieldNames()])
            for c in ("start_line", "end_line"):
                out[c] = out[c].astype("Int32")
            yield out

    return run


def split_oversized(
    df: DataFrame, key: str = "chunk_id", text: str = "text", start_line: str = "start_line", *, limit: int = 1024, overlap: int = 64, only_oversized: bool = False, with_text: bool = True
) -> DataFrame:
    """``(key, piece_no, n_pieces, start_line, end_line, start_char, end_char, token_estimate, hard_cut, text)``.

    Only oversized texts reach Python; the others become one piece in the JVM. With ``only_oversized``
    the latter are left out, with ``with_text=False`` the pieces' texts are null and pieces, not texts, are shuffled.
    """
    src = df.select(df[key].alias("key"), df[start_line].cast("int").alias("start_line"), df[text].alias("text"))
    big = F.length("text") > limit * CHARS
    if with_text:
        src = src.filter(big) if only_oversized else src
        src = src.withColumns({"h": F.xxhash64("text"), "n": F.length("text")}).dropDuplicates(["key", "start_line", "h", "n"]).drop("h", "n")
    large = src.filter(big)
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), *_SCHEMA.fields])
    out = large.mapInPandas(_pieces(limit, overlap, with_text), schema)
    if not only_oversized:
        n = F.coalesce(F.length("text"), F.lit(0))
        newlines = n - F.length(F.replace("text", F.lit("\n"), F.lit("")))
        ends = F.when(F.col("text").endswith("\n"), newlines - 1).otherwise(F.coalesce(newlines, F.lit(0)))
        small = src.filter(~F.coalesce(big, F.lit(False))).select(
            "key",
            F.lit(1).alias("piece_no"),
            F.lit(1).alias("n_pieces"),
            "start_line",
            (F.col("start_line") + ends).cast("int").alias("end_line"),
            F.lit(0).alias("start_char"),
            n.cast("int").alias("end_char"),
            token_size(F.col("text")).alias("token_estimate"),
            F.lit(False).alias("hard_cut"),
            (F.col("text") if with_text else F.lit(None).cast("string")).alias("text"),
        )
        out = out.unionByName(small)
    if not with_text:
        out = out.distinct()
    return out.withColumnRenamed("key", key)

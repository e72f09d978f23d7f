"""Filling fixed-capacity containers by sum-of-squares packing.

Items are spread over shards by a hash of their key, so that a shard holds a bounded number of items
whatever the input, and each shard is a task of its own. In a shard they are placed online: one by one, in the order of
a second hash, which stands for an arrival that knows nothing of the sizes to come. The state is an array with the
number of partly filled containers at each fill level; an item goes to the level, or to a new container,
that minimises the sum of squares of that array (ties: the fullest level). Items above the capacity are
the only ones split: into full containers and a rest that is packed like any other item.

Defined results: items of size null, 0 or below need no space and get a row of size 0 with container null; equal keys
are different items; an empty input gives no rows; columns other than key and size are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_TAIL = "piece_no int, n_pieces int, size int, container string, fill_start int"


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container number and start offset of each item (sizes 1..capacity), placed in the given order."""
    levels = np.zeros(capacity + 1, dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, start = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    opened = 0
    for i, s in enumerate(sizes.tolist()):
        room = capacity - s
        best, pick = (2 * int(levels[s]) + 1 if s < capacity else 0), 0
        if room:
            have = levels[1 : room + 1]
            at = np.flatnonzero(have)
            if len(at):
                cost = 2 * (levels[at + 1 + s] - have[at]) + 2
                if at[-1] + 1 == room:
                    cost[-1] = 1 - 2 * have[at[-1]]
                j = len(cost) - 1 - int(np.argmin(cost[::-1]))
                if cost[j] <= best:
                    pick = int(at[j]) + 1
        if pick:
            bin_ = stacks[pick].pop()
            levels[pick] -= 1
        else:
            bin_, opened = opened, opened + 1
        where[i], start[i] = bin_, pick
        if pick + s < capacity:
            levels[pick + s] += 1
            stacks[pick + s].append(bin_)
    return where, start


def pack(df: DataFrame, key: str, size: str, *, capacity: int, shard_items: int = 25_000, n_items: int | None = None) -> DataFrame:
    """``(key, piece_no, n_pieces, size, container, fill_start)``: where each item, or piece of one, lies.

    ``n_items`` is the number of rows where the caller knows it, as from a table's footers; otherwise they are counted.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    src = df.select(df[key].alias("key"), df[size].cast("int").alias("size"))
    shards = max(1, math.ceil((src.count() if n_items is None else n_items) / shard_items))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["turn", "key", "size"], kind="stable")
        total = np.maximum(pdf["size"].fillna(0).to_numpy(dtype=np.int64), 0)
        pieces = np.maximum(1, -(-total // capacity))
        rows = np.repeat(np.arange(len(pdf)), pieces)
        no = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        part = np.minimum(capacity, total[rows] - no * capacity)
        order = np.flatnonzero(part > 0)
        where, start = np.full(len(rows), -1), np.full(len(rows), -1)
        where[order], start[order] = sum_of_squares(part[order], capacity)
        shard = int(pdf["shard"].iloc[0])
        return pd.DataFrame(
            {
                "key": pdf["key"].to_numpy()[rows],
                "piece_no": (no + 1).astype("int32"),
                "n_pieces": pieces[rows].astype("int32"),
                "size": part.astype("int32"),
                "container": [f"{shard:06d}-{b:07d}" if b >= 0 else None for b in where.tolist()],
                "fill_start": pd.array(np.where(start < 0, 0, start), dtype="Int32"),
            }
        )

    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), *T._parse_datatype_string(SCHEMA_TAIL).fields])
    placed = src.withColumns({"shard": F.pmod(F.xxhash64("key", F.lit(7)), F.lit(shards)), "turn": F.xxhash64("key", F.lit(8))}).repartition(shards, "shard")
    return placed.groupBy("shard").applyInPandas(run, schema).withColumnRenamed("key", key)

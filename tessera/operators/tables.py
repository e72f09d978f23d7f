"""One row per key of tables whose rows may be repeated or loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per non-null ``key``; of differing values in a column the largest holds."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*(F.max(c).alias(c) for c in columns))


def count_by(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """``(key, n)`` without null and empty keys, largest counts first, ties by key; at most ``n`` rows if given."""
    out = df.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return out if n is None else out.orderBy(F.desc("n"), "key").limit(n)

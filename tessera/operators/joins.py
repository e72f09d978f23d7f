"""Joins on line ranges, suffixes and aliases that never choose among several candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], *, how: str = "inner") -> DataFrame:
    """Pairs of ranges of one group that share a line. Both sides carry ``on``; ranges are l_start/l_end and r_start/r_end."""
    cond = (F.col("r_start") <= F.col("l_end")) & (F.col("l_start") <= F.col("r_end"))
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in on})
    for k in on:
        cond = cond & (F.col(k) == F.col(f"__{k}"))
    return left.join(renamed, cond, how).drop(*(f"__{k}" for k in on))


def first_per(df: DataFrame, part: list[str], order: list[Column], k: int, name: str = "place") -> DataFrame:
    """The first ``k`` rows of each group under a total order, numbered from 1."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k).withColumn(name, F.col(name).cast("long"))


def suffixes(path: Column) -> Column:
    """All trailing parts of a path, the whole path first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))


def resolve(refs: DataFrame, ref_keys: list[str], aliases: DataFrame, alias_keys: list[str], handle: str, *, cap: int = 25) -> DataFrame:
    """``ref_keys``, verdict, handle and candidates of each reference.

    ``aliases`` holds (alias_keys, handle, level); candidates of the lowest level that has any count. One candidate is
    exact, several are ambiguous and come sorted and capped without a choice, none is no_match.
    """
    a = aliases.select(*alias_keys, handle, "level").distinct()
    low = a.groupBy(*alias_keys).agg(F.min("level").alias("level"))
    top = a.join(low, [*alias_keys, "level"])
    # the cut comes before the gathering, so that an alias which thousands share never becomes one long row
    first = first_per(top, alias_keys, [F.col(handle)], cap).groupBy(*alias_keys).agg(F.array_sort(F.collect_list(handle)).alias("candidates"))
    best = top.groupBy(*alias_keys).agg(F.count(F.lit(1)).alias("n")).join(first, alias_keys)
    cond = [refs[r].eqNullSafe(best[b]) for r, b in zip(ref_keys, alias_keys)]
    joined = refs.join(best, cond, "left")
    verdict = F.when(F.col("n").isNull(), "no_match").when(F.col("n") == 1, "exact").otherwise("ambiguous")
    return joined.select(*(refs[r] for r in ref_keys), verdict.alias("verdict"), F.when(F.col("n") == 1, F.get("candidates", F.lit(0))).alias(handle), F.when(F.col("n") > 1, F.array_join("candidates", "|")).alias("candidates"))

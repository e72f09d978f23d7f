"""Caps with totals, folding of duplicates, request-aware allocation and budgets."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lanes and confidences, strongest first.
LANES = ("file_anchor", "symbol_anchor", "contract", "test", "query_pack", "graph_neighbors", "bm25", "vector")
CONFIDENCES = ("exact", "high", "medium", "low")


def order_of(values: tuple[str, ...], col: str):
    """Place of a value in an ordered enumeration, after all others if unknown."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for i, v in enumerate(values) for x in (v, i))), F.col(col)), F.lit(len(values)))


def capped(df: DataFrame, part: list[str], order: list, cap: int) -> DataFrame:
    """The first ``cap`` rows of each group with the group's uncapped total and a truncation flag."""
    total = df.groupBy(*part).agg(F.count(F.lit(1)).alias("total"))
    w = Window.partitionBy(*part).orderBy(*order)
    top = df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= cap)
    return top.join(total, part).withColumn("place", F.col("place").cast("long")).withColumn("truncated", F.col("total") > cap)


def hit_order() -> list:
    """Total order of hits: confidence, lane, rank in the lane (null last), path, start, dedupe key."""
    return [order_of(CONFIDENCES, "confidence"), order_of(LANES, "lane"), F.coalesce("lane_rank", F.lit(1_000_000)), F.coalesce("path", F.lit("")), F.coalesce("start_line", F.lit(0)), "dedupe_key"]


def fold_hits(hits: DataFrame) -> DataFrame:
    """One hit per (section, dedupe_key), then spans swallow chunks of the same (section, coarse_key).

    The survivor keeps its own anchor, takes the strongest confidence and the best lane of all members independently of
    each other, and the set of all lanes.
    """
    base = hits.withColumn("ord", F.struct(*[c.alias(f"o{i}") if not isinstance(c, str) else F.col(c).alias(f"o{i}") for i, c in enumerate(hit_order())]))
    base = base.withColumn("conf_rank", order_of(CONFIDENCES, "confidence")).withColumn("lane_place", order_of(LANES, "lane"))
    one = base.groupBy("section_id", "dedupe_key").agg(
        F.min_by(F.struct("path", "start_line", "end_line", "coarse_key", "is_span"), "ord").alias("rep"),
        F.min("ord").alias("ord"), F.min("conf_rank").alias("conf_rank"), F.min("lane_place").alias("lane_place"), F.array_sort(F.collect_set("lane")).alias("lanes"),
    ).select("section_id", "dedupe_key", "rep.*", "ord", "conf_rank", "lane_place", "lanes")
    key = ["section_id", "coarse_key"]
    span = one.filter("is_span").groupBy(*key).agg(F.min_by("dedupe_key", "ord").alias("target"))
    marked = one.join(span, key, "left").withColumn("owner", F.when(~F.col("is_span") & F.col("target").isNotNull(), F.col("target")).otherwise(F.col("dedupe_key")))
    joined = marked.groupBy("section_id", F.col("owner").alias("dedupe_key")).agg(
        F.max_by(F.struct("path", "start_line", "end_line", "is_span"), F.col("dedupe_key") == F.col("owner")).alias("rep"),
        F.min("conf_rank").alias("conf_rank"), F.min("lane_place").alias("lane_place"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("lanes")))).alias("lanes"),
    )
    conf = F.element_at(F.array(*map(F.lit, (*CONFIDENCES, None))), F.col("conf_rank") + 1)
    lane = F.element_at(F.array(*map(F.lit, (*LANES, None))), F.col("lane_place") + 1)
    return joined.select("section_id", "dedupe_key", "rep.*", conf.alias("confidence"), lane.alias("lane"), F.array_join("lanes", ",").alias("lanes"))


def assign_ids(df: DataFrame, part: str, order: list, prefix: str = "ev") -> DataFrame:
    """``evidence_id``: prefix, group and a four-digit number in the given order."""
    n = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return df.withColumn("evidence_id", F.format_string(f"{prefix}:%s:%04d", F.col(part), n))


def prefix_budget(df: DataFrame, part: list[str], order: list, size: str, budget: int) -> DataFrame:
    """The longest run from the front of each group whose sizes add up to at most ``budget``."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(size).over(w)).filter(F.col("used") <= budget)


def allocate(hits: DataFrame, *, per_lane: int = 8, total: int = 40) -> DataFrame:
    """Kept hits of each section under a section cap: one for every request, then balanced depth, then recall hits.

    ``hits`` has section_id, item, lane, place (total order in the section) and requests (array, empty for recall hits).
    Returns section_id, item, step. A section's hits are bounded by its requests and lane caps, so a group fits a task.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["place", "item"]).to_dict("records")
        kept: dict[str, str] = {}
        lanes: Counter[str] = Counter()
        pools: dict[str, list[dict]] = {}
        for r in rows:
            for q in r["requests"]:
                pools.setdefault(q, []).append(r)
        requests = sorted(pools)
        owners = Counter(q.split("|", 1)[0] for q in requests)
        covered: set[str] = set()

        def keep(r: dict, step: str) -> None:
            kept[r["item"]] = step
            lanes[r["lane"]] += 1
            covered.update(r["requests"])

        def fresh(q: str) -> dict | None:
            return next((r for r in pools[q] if r["item"] not in kept), None)

        for q in requests:
            r = None if q in covered else fresh(q)
            if r is not None and len(kept) < total:
                keep(r, "minimum")
        moved = True
        while moved and len(kept) < total:
            moved = False
            for q in requests:
                r = fresh(q)
                if r is None or len(kept) >= total or lanes[r["lane"]] >= max(per_lane, owners.get(r["lane"], 0)):
                    continue
                keep(r, "depth")
                moved = True
        recall: Counter[str] = Counter()
        for r in rows:
            if not len(r["requests"]) and r["item"] not in kept and len(kept) < total and recall[r["lane"]] < per_lane:
                recall[r["lane"]] += 1
                keep(r, "recall")
        return pd.DataFrame([(pdf["section_id"].iloc[0], i, s) for i, s in kept.items()], columns=["section_id", "item", "step"])

    return hits.groupBy("section_id").applyInPandas(run, "section_id string, item string, step string")

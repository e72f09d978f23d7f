"""Whether the topics that pages must cover are backed by evidence that can be cited, and what is wrong where they are not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.plan_fields import source_field

# Needs as the lanes that serve them; the exact ones can be cited, the others only recall.
EXACT_LANES = {"files": "file_anchor", "symbols": "symbol_anchor", "contracts": "contract", "tests": "test", "query_packs": "query_pack"}
BROAD_LANES = {"search_hints": "bm25", "graph_nodes": "graph_neighbors"}


def obligations(topics: DataFrame, requirements: DataFrame, needs: DataFrame) -> DataFrame:
    """``(section_id, topic, status, defect)`` of each topic, one row for each defect and one for a complete topic.

    ``topics`` is (section_id, topic, required), ``requirements`` (section_id, topic, source_fields, acceptable_lanes), ``needs``
    (section_id, field, index, citeable) with citeable null where it is not known. A topic is complete if one of its fields names an
    exact need of an acceptable lane that is not known to be uncitable; no list of lanes accepts all exact ones. Of the
    defects of fields that are all valid the first holds: only broad fields, only broad lanes, no acceptable lane, none citeable.
    """
    req = requirements.groupBy("section_id", "topic").agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("source_fields", F.expr("cast(array() as array<string>)"))))).alias("fields"), F.array_distinct(F.flatten(F.collect_list(F.coalesce("acceptable_lanes", F.expr("cast(array() as array<string>)"))))).alias("lanes"))
    name, index = source_field(F.col("source"))
    one = req.select("section_id", "topic", "lanes", F.explode_outer("fields").alias("source")).withColumns({"field": name, "index": index, "alias": F.coalesce(F.col("source").startswith("evidence_needs."), F.lit(False))})
    have = needs.select("section_id", "field", "index", "citeable", F.lit(True).alias("valid"))
    one = one.join(have, ["section_id", "field", "index"], "left")
    lane = F.element_at(F.create_map(*(F.lit(x) for kv in EXACT_LANES.items() for x in kv)), F.col("field"))
    valid = F.coalesce("valid", F.lit(False)) & ~F.col("alias")
    exact = valid & lane.isNotNull()
    accepted = exact & ((F.size("lanes") == 0) | F.array_contains("lanes", lane))
    told = one.groupBy("section_id", "topic").agg(
        F.count("source").alias("n"), F.max("alias").alias("alias"), F.max(~valid & ~F.col("alias") & F.col("source").isNotNull()).alias("invalid"), F.max(valid).alias("valid"), F.max(exact).alias("exact"),
        F.max(accepted).alias("accepted"), F.max(accepted & ~F.col("citeable").eqNullSafe(F.lit(False))).alias("good"), F.first("lanes").alias("lanes"),
    )
    x = topics.join(told, ["section_id", "topic"], "full")
    broad_lanes = (F.size("lanes") > 0) & ~F.arrays_overlap("lanes", F.array(*map(F.lit, EXACT_LANES.values())))
    first = F.when(~F.col("exact") & F.col("valid"), "broad_only_source_fields").when(broad_lanes, "broad_only_acceptable_lanes").when(F.col("exact") & ~F.col("accepted"), "lane_not_acceptable").when(F.col("accepted") & ~F.col("good"), "source_not_citeable")
    known = F.col("n").isNotNull()
    codes = F.array(
        F.when(F.coalesce("required", F.lit(False)) & ~known, "missing_requirement"), F.when(known & ~F.coalesce("required", F.lit(False)), "not_required"), F.when(F.col("n") == 0, "empty_source_fields"),
        F.when(F.col("alias"), "raw_alias_source_field"), F.when(F.col("invalid"), "invalid_source_field"), F.when(~F.coalesce("good", F.lit(False)), first),
    )
    x = x.withColumn("codes", F.array_compact(codes))
    status = F.when(~F.coalesce("required", F.lit(False)), "not_applicable").when(F.coalesce("good", F.lit(False)), "complete").otherwise("incomplete")
    return x.select("section_id", "topic", status.alias("status"), F.explode_outer("codes").alias("defect"))

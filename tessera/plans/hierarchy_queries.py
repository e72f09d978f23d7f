"""Queries and SQL of problem 4: parent-child links to full hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.hierarchy import descendant_counts, descendants, hierarchies, resolve_hierarchy
from tessera.session import checkpoint, ship_package, table


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return hierarchies(
        {
            "symbols": (table(spark, sf_dir, "symbols"), "symbol_id", "parent_symbol_id"),
            "sections": (table(spark, sf_dir, "sections"), "section_id", "parent_section_id"),
        }
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = resolve_hierarchy(_links(spark, sf_dir), with_paths=False)
    return h.filter("depth >= 4 OR depth < 0").select("tree", F.col("node").alias("node_id"), F.col("root").alias("root_id"), F.col("depth").cast("int").alias("depth"))


def p4_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = descendant_counts(checkpoint(resolve_hierarchy(_links(spark, sf_dir))))
    return h.select(
        "tree",
        F.col("node").alias("node_id"),
        F.col("root").alias("root_id"),
        F.col("depth").cast("int").alias("depth"),
        F.array_join("path", " > ").alias("path"),
        "n_descendants",
    )


def p4_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = descendants(resolve_hierarchy(_links(spark, sf_dir)))
    return d.select("tree", F.col("ancestor").alias("ancestor_id"), F.col("node").alias("node_id"), F.col("distance").cast("int").alias("distance"))


_WALK = """
WITH RECURSIVE raw AS (
  SELECT DISTINCT 'symbols' AS tree, symbol_id AS node, parent_symbol_id AS parent FROM symbols WHERE symbol_id IS NOT NULL
  UNION ALL
  SELECT DISTINCT 'sections', section_id, parent_section_id FROM sections WHERE section_id IS NOT NULL),
link AS (
  SELECT a.tree, a.node, min(b.node) AS parent
  FROM raw a LEFT JOIN (SELECT DISTINCT tree, node FROM raw) b ON a.tree = b.tree AND a.parent = b.node
  GROUP BY a.tree, a.node),
down AS (
  SELECT tree, node, node AS root, 0 AS depth, node AS path, [node] AS ids FROM link WHERE parent IS NULL
  UNION ALL
  SELECT l.tree, l.node, d.root, d.depth + 1, d.path || ' > ' || l.node, list_append(d.ids, l.node)
  FROM link l JOIN down d ON l.tree = d.tree AND l.parent = d.node),
lost AS (SELECT l.* FROM link l ANTI JOIN down d ON l.tree = d.tree AND l.node = d.node),
up AS (
  SELECT tree, node, parent AS cur, [node] AS seen FROM lost
  UNION ALL
  SELECT u.tree, u.node, l.parent, list_append(u.seen, u.cur)
  FROM up u JOIN lost l ON u.tree = l.tree AND u.cur = l.node WHERE NOT list_contains(u.seen, u.cur)),
looped AS (
  SELECT tree, node, list_min(list_slice(seen, list_position(seen, cur), len(seen))) AS root
  FROM up WHERE list_contains(seen, cur))
"""

QUERIES = {"p4_found": p4_found, "p4_hierarchy": p4_hierarchy, "p4_descendants": p4_descendants}

ORACLE = {
    "p4_found": _WALK
    + """SELECT tree, node AS node_id, root AS root_id, depth FROM down WHERE depth >= 4
UNION ALL SELECT tree, node, root, -1 FROM looped""",
    "p4_hierarchy": _WALK
    + """, pairs AS (SELECT tree, unnest(ids) AS anc, node FROM down),
cnt AS (SELECT tree, anc AS node, count(*) - 1 AS n FROM pairs GROUP BY ALL)
SELECT d.tree, d.node AS node_id, d.root AS root_id, d.depth, d.path, c.n AS n_descendants
FROM down d JOIN cnt c ON d.tree = c.tree AND d.node = c.node
UNION ALL SELECT tree, node, root, -1, NULL, NULL FROM looped""",
    "p4_descendants": _WALK
    + """, pairs AS (SELECT tree, unnest(ids) AS anc, generate_subscripts(ids, 1) AS i, len(ids) AS k, node FROM down)
SELECT tree, anc AS ancestor_id, node AS node_id, CAST(k - i AS INTEGER) AS distance FROM pairs WHERE anc <> node""",
}

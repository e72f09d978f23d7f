"""Parent-child rows to full hierarchies by tree contraction.

A round takes all leaves off (raking) and, in unary chains, splices out an independent set of nodes chosen by hashed
coins, whose single child is linked to the grandparent (compression). Every removed node is recorded with its link,
which after the round points to a node that outlives it. A chain of n nodes is therefore gone after O(log n) rounds,
and what never goes away is a loop, shrunk to one node that is its own parent. Reversing the records, one join a
round, gives root, depth and path of all nodes. Sizes shrink and grow by constant factors, so all rounds together read
and write a constant multiple of the input.

Once at most ``LOCAL_LINKS`` links are left, whatever the size of the input, one task takes them: it rakes them to
their loops and reverses in the same way, which saves the last rounds' jobs on next to no rows.

Defined results: a parent that is null, empty or not the id of any row makes its node a root (depth 0, path of
itself); nodes on a loop or below one have depth -1, the smallest id of the loop as root and a null path; rows
with a null node id are left out; repeated rows count once and of differing parents of one node the smallest
valid one holds; an empty table gives no rows; columns other than tree, node and parent are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.session import checkpoint, release, ship_package

_KEY = ("tree", "node")
_STATE = ("tree", "node", "parent", "w", "lo", "seg")
#: Links that one task may take: with ids of some 40 bytes about 10 MB.
LOCAL_LINKS = 50_000


def _coin(tree: str, node: str, salt: int):
    return F.pmod(F.xxhash64(F.col(tree), F.col(node), F.lit(salt)), F.lit(2)) == 1


def resolve_parents(links: DataFrame) -> DataFrame:
    """``(tree, node, parent)`` with one row a node and a null parent for roots."""
    rows = links.select("tree", F.col("node").cast("string").alias("node"), F.nullif(F.col("parent").cast("string"), F.lit("")).alias("parent")).filter(F.col("node").isNotNull())
    ids = rows.select("tree", F.col("node").alias("parent")).distinct()
    valid = rows.filter(F.col("parent").isNotNull()).join(ids, ["tree", "parent"], "left_semi").select("tree", "node", "parent")
    return valid.unionByName(rows.withColumn("parent", F.lit(None).cast("string"))).groupBy(*_KEY).agg(F.min("parent").alias("parent"))


def _contract(active: DataFrame, r: int, with_paths: bool) -> tuple[DataFrame, dict[str, int]]:
    """One round on the links that are left, written; status 1: raked leaf, 2: spliced, 0: stays. Also the counts."""
    kids = active.groupBy("tree", F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    unary = (F.col("kids") == 1) & (F.col("node") != F.col("parent")) & _coin("tree", "node", r) & ~_coin("tree", "parent", r)
    state = active.join(kids, list(_KEY), "left").withColumn("status", F.when(F.col("kids").isNull(), 1).when(unary, 2).otherwise(0)).drop("kids")
    gone = state.filter("status = 2").select("tree", F.col("node").alias("parent"), *(F.col(c).alias(f"g_{c}") for c in ("node", "parent", "w", "lo", "seg")))
    moved = F.col("g_parent").isNotNull()
    seg = F.when(moved, F.concat("g_seg", F.array("g_node"), "seg")).otherwise(F.col("seg")) if with_paths else F.col("seg")
    after = state.join(gone, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.coalesce("g_parent", "parent").alias("parent"),
        F.when(moved, F.col("w") + F.col("g_w")).otherwise(F.col("w")).alias("w"),
        F.when(moved, F.least("lo", "g_lo", "g_node")).otherwise(F.col("lo")).alias("lo"),
        seg.alias("seg"),
        "status",
    )
    seen = Observation()
    stays = F.col("status") == 0
    counted = after.observe(seen, F.count_if(stays & (F.col("node") != F.col("parent"))).alias("open"), F.count_if(stays).alias("left"))
    return checkpoint(counted), seen


def _solve(batches: Iterator[pd.DataFrame], with_paths: bool) -> Iterator[pd.DataFrame]:
    """Rakes the links of all batches to their loops, then reverses; parents that are no node here are roots."""
    link: dict[tuple[str, str], tuple] = {}
    for pdf in batches:
        for tree, node, parent, w, lo, seg in zip(pdf["tree"], pdf["node"], pdf["parent"], pdf["w"], pdf["lo"], pdf["seg"]):
            link[tree, node] = ((tree, parent), int(w), lo, [] if seg is None else list(seg))
    kids: dict[tuple[str, str], int] = {}
    for up, *_ in link.values():
        if up in link:
            kids[up] = kids.get(up, 0) + 1
    order = [k for k in link if k not in kids]
    for k in order:
        up = link[k][0]
        if up in link:
            kids[up] -= 1
            if not kids[up]:
                order.append(up)
    done: dict[tuple[str, str], tuple] = {}
    raked = set(order)
    for k in link:
        if k in raked or k in done:
            continue
        loop, at = [], k
        while not loop or at != k:
            loop.append(at)
            at = link[at][0]
        least = min((x for q in loop for x in (q[1], link[q][2]) if x is not None), key=lambda x: x.encode())
        for q in loop:
            done[q] = (least, -1, None)
    for k in reversed(order):
        up, w, _, seg = link[k]
        root, depth, path = done.get(up) or (up[1], 0, [up[1]])
        done[k] = (root, -1, None) if depth < 0 else (root, depth + w, [*path, *seg, k[1]] if with_paths else None)
    yield pd.DataFrame([(t, n, *v) for (t, n), v in done.items()], columns=["tree", "node", "root", "depth", "path"])


def resolve_hierarchy(links: DataFrame, *, with_paths: bool = True, max_rounds: int = 200, local_links: int = LOCAL_LINKS) -> DataFrame:
    """``(tree, node, root, depth[, path])`` of each node of ``links (tree, node, parent)``.

    ``path`` is the array of ids from the root to the node itself. The parts of the result are written tables but for
    the last round's, which is left to the caller's own job.
    """
    ship_package(links.sparkSession)
    empty = F.expr("cast(array() as array<string>)") if with_paths else F.lit(None).cast("array<string>")
    none = F.lit(None).cast("array<string>")
    seen = Observation()
    base = checkpoint(resolve_parents(links).observe(seen, F.count_if(F.col("parent").isNotNull()).alias("left")))
    path = F.array("node") if with_paths else none
    known = base.filter(F.col("parent").isNull()).select(*_KEY, F.col("node").alias("root"), F.lit(0).alias("depth"), path.alias("path"))
    active = base.filter(F.col("parent").isNotNull()).select("tree", "node", "parent", F.lit(1).alias("w"), F.lit(None).cast("string").alias("lo"), empty.alias("seg"))
    left = open_ = seen.get["left"]
    records: list[DataFrame] = []
    while open_ and left > local_links:
        if len(records) == max_rounds:
            raise RuntimeError("the contraction did not end")
        state, counts = _contract(active, len(records), with_paths)
        left, open_ = counts.get["left"], counts.get["open"]
        records.append(state)
        active = state.filter("status = 0").select(*_STATE)
    if open_:
        schema = "tree string, node string, root string, depth int, path array<string>"
        rest = active.coalesce(1).mapInPandas(lambda batches: _solve(batches, with_paths), schema)
    else:
        rest = active.select(*_KEY, F.least("node", "lo").alias("root"), F.lit(-1).alias("depth"), none.alias("path"))
    if left:
        known = known.unionByName(checkpoint(rest))
    spent: list[DataFrame] = []
    for n, state in enumerate(reversed(records)):
        up = known.select("tree", F.col("node").alias("parent"), "root", F.col("depth").alias("above"), F.col("path").alias("up_path"))
        down = (
            state.filter("status > 0")
            .join(up, ["tree", "parent"])
            .select(
                *_KEY,
                "root",
                F.when(F.col("above") < 0, F.lit(-1)).otherwise(F.col("above") + F.col("w")).alias("depth"),
                (F.concat("up_path", "seg", F.array("node")) if with_paths else none).alias("path"),
            )
        )
        known = known.unionByName(down)
        if n < len(records) - 1:
            known = checkpoint(known)
            release(state, *spent)
            spent = [known]
    return known if with_paths else known.drop("path")


def descendants(hierarchy: DataFrame) -> DataFrame:
    """``(tree, ancestor, node, distance)`` for each pair of a node and one of its proper ancestors."""
    e = hierarchy.filter(F.col("path").isNotNull()).select("tree", "node", "depth", F.posexplode("path").alias("at", "ancestor"))
    return e.filter("at < depth").select("tree", "ancestor", "node", (F.col("depth") - F.col("at")).alias("distance"))


def descendant_counts(hierarchy: DataFrame) -> DataFrame:
    """``hierarchy`` with ``n_descendants``; null for nodes on or below a loop."""
    n = descendants(hierarchy).groupBy("tree", F.col("ancestor").alias("node")).agg(F.count(F.lit(1)).alias("n_descendants"))
    out = hierarchy.join(n, ["tree", "node"], "left")
    return out.withColumn("n_descendants", F.when(F.col("depth") >= 0, F.coalesce("n_descendants", F.lit(0))).cast("long"))


def hierarchies(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Union of several tables' links: name -> (table, node column, parent column)."""
    out = None
    for name, (df, node, parent) in tables.items():
        part = df.select(F.lit(name).alias("tree"), df[node].cast("string").alias("node"), df[parent].cast("string").alias("parent"))
        out = part if out is None else out.unionByName(part)
    return out

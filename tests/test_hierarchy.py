import random

import pytest

from tessera.operators.hierarchy import descendant_counts, descendants, resolve_hierarchy


def brute(links):
    parent = {}
    for t, n, p in links:
        if n is not None:
            parent.setdefault((t, n), set()).add(p)
    valid = {k: min((p for p in v if p and (k[0], p) in parent), default=None) for k, v in parent.items()}
    out = {}
    for k in parent:
        path, cur = [], k[1]
        while cur is not None and cur not in path:
            path.append(cur)
            cur = valid[(k[0], cur)]
        if cur is None:
            out[k] = (path[-1], len(path) - 1, list(reversed(path)))
        else:
            out[k] = (min(path[path.index(cur) :]), -1, None)
    return out


def run(spark, links, **kw):
    df = spark.createDataFrame(links, "tree string, node string, parent string, path string, depth int".replace(", path string, depth int", ""))
    return {(r.tree, r.node): (r.root, r.depth, r.path) for r in resolve_hierarchy(df, **kw).collect()}


@pytest.mark.parametrize("seed, local", [(1, 0), (2, 0), (1, 10), (2, 50_000)])
def test_random_forests_with_loops(spark, seed, local):
    """Contracted to the end, to ten links, and taken by one task at once."""
    rnd = random.Random(seed)
    links = []
    for t in ("a", "b"):
        for i in range(60):
            p = rnd.choice([None, "", f"n{rnd.randrange(60)}", f"n{max(0, i - 1)}", "gone"])
            links.append((t, f"n{i}", p))
    links += links[:20] + [("a", None, "n1")]
    assert run(spark, links, local_links=local) == brute(links)


def test_long_chain_needs_few_rounds(spark):
    links = [("t", f"n{i:04d}", f"n{i - 1:04d}" if i else None) for i in range(300)]
    got = {(r.tree, r.node): (r.root, r.depth) for r in resolve_hierarchy(spark.createDataFrame(links, "tree string, node string, parent string"), with_paths=False, max_rounds=60, local_links=20).collect()}
    assert got[("t", "n0299")] == ("n0000", 299)


def test_loops_and_empty(spark):
    links = [("t", "a", "b"), ("t", "b", "c"), ("t", "c", "a"), ("t", "d", "a"), ("t", "e", "e"), ("t", "f", "e")]
    assert run(spark, links) == run(spark, links, local_links=0) == brute(links)
    assert run(spark, []) == {}


def test_descendants(spark):
    h = resolve_hierarchy(spark.createDataFrame([("t", "r", None), ("t", "a", "r"), ("t", "b", "a"), ("t", "x", "x")], "tree string, node string, parent string"))
    assert {(r.ancestor, r.node, r.distance) for r in descendants(h).collect()} == {("r", "a", 1), ("r", "b", 2), ("a", "b", 1)}
    assert {r.node: r.n_descendants for r in descendant_counts(h).collect()} == {"r": 2, "a": 1, "b": 0, "x": None}


def test_hot_parent_and_deep_paths(spark):
    links = [("t", f"n{i:03d}", f"n{i - 1:03d}" if i else None) for i in range(40)] + [("t", f"k{i:03d}", "n039") for i in range(200)]
    assert run(spark, links, local_links=5) == brute(links)


def test_shared_folder_is_needed_on_a_cluster(spark):
    from types import SimpleNamespace

    from tessera import session

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    df = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *_: None)))
    with pytest.raises(RuntimeError):
        session.checkpoint(df)


def test_written_tables_can_be_released(spark):
    from pathlib import Path

    from tessera import session

    t = session.checkpoint(spark.range(3).toDF("i"))
    path = Path(t._tessera_path.removeprefix("file:"))
    assert t.count() == 3 and path.exists()
    session.release(t)
    assert not path.exists()
    u = Path(session.checkpoint(spark.range(3).toDF("i"))._tessera_path.removeprefix("file:"))
    session.release_all(spark)
    assert not u.exists()

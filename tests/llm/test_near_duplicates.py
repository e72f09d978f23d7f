import collections
import itertools
import random
import re

import numpy as np
import pytest

from tessera.llm.near_duplicates import NearDuplicates, Shingler, connected, prefix_length


def shingles(t, k):
    w = re.findall("[a-z0-9_]+", (t or "").lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows, head = [], "license header shared by very many files of this collection"
    for i in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randrange(5, 60))]
        rows.append((f"d{i:03d}", " ".join(base)))
        for j in range(rnd.randrange(3)):
            v = list(base)
            for _ in range(rnd.randrange(3)):
                v[rnd.randrange(len(v))] = rnd.choice(words)
            rows.append((f"d{i:03d}v{j}", f"{head} {' '.join(v)}" if rnd.random() < 0.4 else " ".join(v)))
    return rows + [("e1", ""), ("e2", None), ("c1", rows[0][1].upper()), ("c2", rows[0][1] + " !"), rows[3], rows[3]]


@pytest.mark.parametrize("seed,width,t,least", [(1, 3, 0.6, 5), (2, 2, 0.5, 1), (3, 5, 0.8, 1)])
def test_equals_brute_force(spark, seed, width, t, least):
    rows = corpus(seed)
    sets = {k: s for k, x in rows if len(s := shingles(x, width)) >= least}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}
    df = spark.createDataFrame([(k, x, 1, 2) for k, x in rows], "chunk_id string, text string, sig int, n int")
    near = NearDuplicates(df, "chunk_id", "text", width=width, threshold=t, least=least)
    got = [(r.key_a, r.key_b) for r in near.key_pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == want
    g = {r.key: r for r in near.groups().collect()}
    assert set(g) == set(sets)
    for a, b in want:
        assert g[a].group_id == g[b].group_id
    assert sum(r.n_links for r in g.values()) >= len(want)


@pytest.mark.parametrize("cells", [2, 64])
def test_full_tables_lose_no_pair(spark, monkeypatch, cells):
    """Tables with far fewer cells than shared shingles only make the orders coarser."""
    rows = [r for r in corpus(4) if r[1]]
    df = spark.createDataFrame(rows, "chunk_id string, text string")
    pairs = lambda: {(r.key_a, r.key_b) for r in NearDuplicates(df, "chunk_id", "text", width=3, threshold=0.6, least=5).key_pairs().collect()}
    want = pairs()
    monkeypatch.setattr("tessera.llm.near_duplicates.CELLS", cells)
    assert want and pairs() == want


def test_tables_equal_the_counts(spark):
    from tessera.llm.near_duplicates import classes_of, frequency_classes

    tok = np.random.default_rng(1).integers(0, 1 << 48, 900)
    df = spark.createDataFrame([(int(t), 2 + i % 9) for i, t in enumerate(tok)], "token long, df long")
    table = frequency_classes(df, 1 << 17)
    want = np.ceil(np.log2(2 + np.arange(900) % 9)).astype(int)
    got = classes_of(tok.astype(np.uint64), table)
    assert (got >= want).all() and (got == want).mean() > 0.99
    assert (classes_of(np.random.default_rng(2).integers(0, 1 << 48, 900).astype(np.uint64), table) == 0).mean() > 0.99


def test_empty_and_bad_parameters(spark):
    df = spark.createDataFrame([], "chunk_id string, text string")
    assert NearDuplicates(df, "chunk_id", "text").key_pairs().count() == 0
    with pytest.raises(ValueError):
        NearDuplicates(df, "chunk_id", "text", threshold=0)


def test_prefix_length():
    assert [prefix_length(n, 0.6) for n in (1, 5, 10, 30)] == [1, 3, 5, 13]


def test_shingler_counts():
    tok, off = Shingler(3)(["a b c d", None, "a b c a b c", "x y"])
    assert [b - a for a, b in zip(off, off[1:])] == [2, 0, 3, 0]


def test_connected(spark):
    e = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11)]
    df = spark.createDataFrame(e + [(b, a) for a, b in e], "x long, y long")
    assert {r.x: r.component for r in connected(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10}


def phrases(seed, n):
    """Texts of few phrases: every pair shares shingles, next to none are similar; some are copied with one phrase changed."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    pool = [" ".join(rnd.choice(words) for _ in range(10)) for _ in range(60)]
    docs = [[rnd.choice(pool) for _ in range(12)] for _ in range(n)]
    docs += [[rnd.choice(pool), *d[1:]] for d in docs[::15]]
    return [(f"d{i:03d}", " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("cells,bits", [(1 << 16, 1 << 30), (2, 1 << 30), (64, 64)])
def test_only_similar_pairs_are_written(spark, monkeypatch, cells, bits):
    """Neither texts of common phrases nor full tables make the tables of tokens and candidates large."""
    import tessera.llm.near_duplicates as nd

    rows = phrases(1, 150) + [(f"u{i}", " ".join(f"u{i}x{j}" for j in range(60)) + " " + " ".join(f"w{j}" for j in range(60))) for i in range(20)]
    sets = {k: shingles(x, 3) for k, x in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]) - 1e-9}
    real, seen = nd._candidates, {}

    def watched(docs, *args):
        out = real(docs, *args)
        seen["tokens"], seen["pairs"] = docs.selectExpr("coalesce(sum(size(tokens)), 0)").first()[0], out.count()
        return out

    monkeypatch.setattr(nd, "_candidates", watched)
    monkeypatch.setattr(nd, "CELLS", cells)
    monkeypatch.setattr(nd, "FILTER_BITS", bits, raising=False)
    df = spark.createDataFrame(rows, "chunk_id string, text string")
    got = {(r.key_a, r.key_b) for r in NearDuplicates(df, "chunk_id", "text", width=3, threshold=0.6, least=5, orders=1).key_pairs().collect()}
    assert want and got == want
    assert seen["pairs"] <= 3 * len(want)
    if bits > 64:
        df_of = collections.Counter(s for x in sets.values() for s in x)
        assert seen["tokens"] <= 1.1 * sum(df_of[s] > 1 for x in sets.values() for s in x)


def test_bitmaps_keep_all_similar_pairs():
    from tessera.llm.near_duplicates import Bitmaps, parity_bitmaps

    rnd = np.random.default_rng(3)
    sets, off = [], [0]
    for size in (1, 40, 100, 255, 256, 257, 400, 600, 900, 2000, 5000):
        base = np.unique(rnd.integers(0, 1 << 48, size))
        for part in (1.0, 0.95, 0.8, 0.6, 0.0):
            k = int(len(base) * part)
            sets.append(np.unique(np.concatenate([base[:k], rnd.integers(0, 1 << 48, len(base) - k)])).astype(np.uint64))
            off.append(off[-1] + len(sets[-1]))
    raw = parity_bitmaps(np.concatenate(sets), np.array(off))
    assert raw[3] == parity_bitmaps(sets[3], np.array([0, len(sets[3])]))[0] and {len(x) * 8 for x in raw} == {512, 1024, 2048, 4096}
    i, j = (np.array(x) for x in zip(*itertools.combinations(range(len(sets)), 2)))
    apart = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j)])
    maps = Bitmaps(raw)
    assert len(maps.within(i, j, apart)) == len(i)
    n = np.array([len(s) for s in sets])
    close = (n[i] + n[j]) // 4
    kept = set(maps.within(i, j, close).tolist())
    assert {k for k in range(len(i)) if apart[k] <= close[k]} <= kept
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    foreign = np.flatnonzero((apart == n[i] + n[j]) & (small >= 40) & (large <= 2000) & (small >= 0.6 * large))
    assert len(foreign) and not kept & set(foreign.tolist())


def test_copies_are_shingled_once(spark, monkeypatch):
    """A collection repeated under other keys stores the tokens of each text once, and has all pairs of all copies."""
    import tessera.llm.near_duplicates as nd

    rows = [(f"{k}~{c}", x) for k, x in phrases(2, 30) for c in range(4)] + [("d000~0", "another text of a key that has two")]
    rows += [rows[0], rows[5], ("n", None), (None, rows[0][1])]
    sets = [(k, shingles(x, 3)) for k, x in rows if k and x]
    want = {tuple(sorted((a, b))) for (a, s), (b, t) in itertools.combinations(sets, 2) if a != b and len(s) >= 5 <= len(t) and len(s & t) >= 0.6 * len(s | t) - 1e-9}
    real, seen = nd._documents, []

    def watched(*args):
        seen.append(real(*args).filter("tokens IS NOT NULL").count())
        return real(*args)

    monkeypatch.setattr(nd, "_documents", watched)
    near = NearDuplicates(spark.createDataFrame(rows, "chunk_id string, text string"), "chunk_id", "text", width=3, threshold=0.6, least=5)
    assert {(r.key_a, r.key_b) for r in near.key_pairs().collect()} - {("d000~0", "d000~0")} == want
    assert 0 < seen[0] <= 1.2 * len({x for _, x in rows if x})

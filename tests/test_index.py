"""The stored index against a plain computation of its scores, and stems against published examples."""

import math

import pytest

from tessera.operators.index import build_index, ensure_index, index_state, phrases, search
from tessera.operators.stems import index_terms, stem

STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "communism": "commun", "activate": "activ",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "is": "is", "a1b": "a1b",
}


def test_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_terms_and_phrases():
    assert index_terms("Über list_items, RUNNING!") == ["uber", "list", "item", "run"] and index_terms(None) == []
    assert phrases("list_items: or __ jumping") == [["list", "item"], ["or"], ["jump"]] and phrases("!?") == []


def plain(rows, query, k):
    docs = {i: index_terms(t) for i, t in rows.items()}
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)
    score = dict.fromkeys(docs, 0.0)
    for p in phrases(query):
        f = {i: sum(d[j : j + len(p)] == p for j in range(len(d))) for i, d in docs.items()}
        df = sum(x > 0 for x in f.values())
        idf = math.log((n - df + 0.5) / (df + 0.5))
        idf = idf if idf > 0 else 1e-6
        for i, d in docs.items():
            if f[i]:
                score[i] -= idf * f[i] * 2.2 / (f[i] + 1.2 * (0.25 + 0.75 * len(d) / mean))
    got = sorted((round(s, 6), i) for i, s in score.items() if s)
    return [(place, i, s) for place, (s, i) in enumerate(got[:k], 1)]


def test_search_equals_plain_scores(spark, tmp_path):
    rows = {i: f"parsers {'parse ' * (i % 4)} the list items of {'chunk_index' if i % 3 else 'indexes chunk'} {'x ' * i}" for i in range(40)} | {90: "", 91: "list of items"}
    df = spark.createDataFrame([*rows.items(), (92, None), (None, "parser"), (0, rows[0])], "doc_id long, text string")
    rows[92] = None
    path = str(tmp_path / "ix")
    assert index_state(spark, path, df, "doc_id", "text") == "missing" and ensure_index(df, "doc_id", "text", path) == "missing"
    assert ensure_index(df, "doc_id", "text", path) == "verified" and index_state(spark, path, df.limit(3), "doc_id", "text") == "stale"
    for q in ("parsing", "list_items", "chunk_index parse", "nothing here", "x x"):
        got = [(r.place, r.doc_id, r.score) for r in search(spark, path, {"q": q}, "doc_id", 5).collect()]
        want = plain(rows, q, 5)
        assert [g[:2] for g in got] == [w[:2] for w in want] and all(a[2] == pytest.approx(b[2], abs=2e-6) for a, b in zip(got, want))
    plan = search(spark, path, {"q": "parsing"}, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan and "PartitionFilters" in plan


def test_empty_corpus(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    build_index(df, "doc_id", "text", str(tmp_path / "e"))
    assert search(spark, str(tmp_path / "e"), {"q": "a b"}).count() == 0

import pytest

from tessera.operators.claims import UnreadableReport, claim_faults, parse_readiness, render_claim, typed_in, typed_tokens

TOKENS = {"tok:a:0001": "app.run", "tok:a:0002": "/x/{id}"}


def test_render():
    assert render_claim("The  {{tok:a:0001}}\n serves {{tok:a:0002}} and {{tok:b:0009}}.", TOKENS, ["ev:a:0001", "ev:a:0002"]) == "The `app.run` serves `/x/{id}` and {{tok:b:0009}}. [ev:a:0001][ev:a:0002]"
    assert render_claim("", TOKENS, []) == "" and render_claim(None, {}, ["e"]) == "[e]"


def test_typed_tokens(spark):
    assert typed_tokens("Runs {{tok:a:0001}} in `main loop`, GET /a/b, pkg.mod.fn, src/a.py, MY_VAR and call() here. Plain words stay.") == ["main loop", "GET /a/b", "pkg.mod.fn", "src/a.py", "MY_VAR", "call()"]
    assert typed_tokens(None) == [] and typed_tokens("No tokens, e.g. none") == ["e.g"]
    df = spark.createDataFrame([(1, "x.y", "z"), (1, "x.y", "z"), (2, None, "z"), (3, "", "z")], "id long, text string, token string")
    assert [tuple(r) for r in typed_in(df, "id", "text").collect()] == [(1, "x.y")]


def test_claim_codes():
    ok = {"skeleton": "It uses {{tok:a:0001}}", "evidence_ids": ["e1"], "token_ids": ["tok:a:0001"], "required_topic": "t"}
    faults = lambda **kw: claim_faults(ok | kw, tokens=TOKENS, evidence={"e1"}, topics={"t"})
    assert faults() == [] and faults(required_topic=None) == []
    assert faults(skeleton=" ") == ["no_skeleton", "unused_token"] and faults(evidence_ids=None) == ["uncited"] and faults(evidence_ids=["e2"]) == ["unknown_evidence"]
    assert faults(skeleton="{{tok:z:0001}}") == ["unknown_token", "undeclared_token", "unused_token"] and faults(skeleton="{{tok:a:0001}} in a.b ...") == ["typed_token", "placeholder_text"]
    assert faults(required_topic="u") == ["unknown_topic"]


def test_readiness():
    assert parse_readiness("# Report\n**Status:** pass\n- Failures: 0\nWarnings : 3\n") == {"status": "PASS", "failures": 0, "warnings": 3}
    assert parse_readiness("status: FAIL\nfailures: 2")["warnings"] is None
    for text in ("", "Status: pass", "Failures: 1", None):
        with pytest.raises(UnreadableReport):
            parse_readiness(text)

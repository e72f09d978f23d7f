import random

from tessera.llm import language as A

STEMS = {
    "en": ("The {} was slower than the {}, so only some rows were kept.", "Please keep the {} short because readers of the {} have little time.", "Nobody knows why the {} changes before the {} is built."),
    "de": ("Der {} war langsamer als das {}, daher blieben nur wenige Zeilen.", "Bitte den {} kurz halten, denn wer die {} liest, hat wenig Zeit.", "Niemand weiß, warum sich der {} ändert, bevor die {} gebaut wird."),
    "fr": ("Le {} était plus lent que la {}, il ne restait donc que peu de lignes.", "Veuillez garder le {} court car ceux qui lisent la {} ont peu de temps.", "Personne ne sait pourquoi le {} change avant que la {} soit prête."),
}
NOUNS = {"en": "report queue table window note index".split(), "de": "Bericht Schlange Tabelle Fenster Notiz Verzeichnis".split(), "fr": "rapport file table fenêtre note répertoire".split()}


def text(rnd, code, n):
    return " ".join(rnd.choice(STEMS[code]).format(rnd.choice(NOUNS[code]), rnd.choice(NOUNS[code])) for _ in range(n))


def rows(seed=1, n=40):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        for code in STEMS:
            label = code if rnd.random() > 0.1 else rnd.choice(list(STEMS))
            out.append((len(out), text(rnd, code, rnd.randrange(2, 8)), label, code))
    return out


def test_labels():
    assert [A.label_code(x) for x in ("en-US", "German", "FR", " pt_BR", "und", "", None, "n/a", "xx")] == ["en", "de", "fr", "pt", None, None, None, None, None]


def test_held_out_accuracy():
    model = A.build_model((label, t) for _, t, label, _ in rows())
    s = model.scorer()
    held = rows(seed=9)
    right = sum([p[0] for p in A.parts(s.segments(t))] == [code] for _, t, _, code in held)
    assert right >= 0.97 * len(held)


def test_mixed_texts_and_single_quotes():
    s = A.build_model((label, t) for _, t, label, _ in rows()).scorer()
    rnd = random.Random(5)
    mixed = text(rnd, "en", 4) + "\n\n" + text(rnd, "de", 3)
    assert {p[0] for p in A.parts(s.segments(mixed))} == {"en", "de"}
    for a, z, code, conf, n in s.segments(mixed):
        assert mixed[a:z].strip() and 0 < conf <= 1 and n >= 2
    quoted = text(rnd, "en", 4) + "\n\n> " + text(rnd, "fr", 1) + "\n\n" + text(rnd, "en", 3)
    assert [p[0] for p in A.parts(s.segments(quoted))] == ["en"]
    code = text(rnd, "de", 3) + "\n```python\nthe_report = was_slower(than, the, queue)\n```\n"
    assert [p[0] for p in A.parts(s.segments(code))] == ["de"]
    assert s.segments("```\nx = 1\n```") == [] and s.segments("12 34") == []


def test_frame(spark):
    data = [(i, t, label) for i, t, label, _ in rows()] + [(900, None, "en"), (901, " \n", None), (902, "", None), (903, "```\nx\n```", None)]
    df = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, lang string, place int")
    model = A.fit(df, sample_docs=20)
    out = A.text_languages(df, model)
    assert out.select("doc_id").distinct().count() == len(data) - 4
    assert A.text_segments(df, model).filter("end_char <= start_char").count() == 0
    assert A.text_languages(df, A.fit(df.limit(0))).count() == 0
    assert A.text_languages(df.limit(0), model).count() == 0
    every = {r.doc_id: (r.lang_code, r.confidence, r.place) for r in A.text_languages(df, model, every_row=True).filter("place = 1").collect()}
    assert len(every) == len(data) and {every[i] for i in (900, 901, 902, 903)} == {(None, 0.0, 1)}


def test_unspaced_paragraph_with_a_slash_is_no_path():
    zh = "这个报告每天早上都会更新A/B测试的结果。团队会检查所有的仓库并且写下说明。"
    assert [x[2] for x in A.sentences(zh)][0].startswith("这个报告")
    assert A.sentences("src/app/main_file.py") == [] and A.sentences("docs/übersicht_neu.md") == []

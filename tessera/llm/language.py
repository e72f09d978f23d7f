"""Languages of texts and of their parts by compression.

For each language a zstandard raw-content dictionary is filled with sentences of labelled rows. A sentence costs, in a
language, the bytes it compresses to with that dictionary; the cheapest path through the sentences of a text, with a
price on each change of language, gives its segments. A segment counts as a part when it has at least two sentences in
a row; margins too narrow to decide give no language.

Fitting reads a bounded sample of labelled rows (``SAMPLE_DOCS`` texts of each language, chosen by a hash of the key).
Labels are wrong in part, so words first vote for the language whose labels they mostly come with, and a sentence enters
a dictionary only if its own words agree.

Every sentence is compressed with the dictionaries of all languages, whatever its script.

Defined results: null and blank texts have no language; code, identifiers, paths, citations and tables are passed over,
and a text of nothing else has no language; repeated rows each give their rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and codes of the languages that labels may use.
NAMES = {
    "en": "en eng english",
    "de": "de deu ger german deutsch",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano",
    "pt": "pt por portuguese português portugues",
    "it": "it ita italian italiano",
    "nl": "nl nld dut dutch nederlands",
    "ru": "ru rus russian русский",
    "zh": "zh zho chi chinese cmn 中文",
}
CODES = {w: code for code, words in NAMES.items() for w in words.split()}

#: Parameters of fitting and scoring.
SAMPLE_DOCS = 300
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
SWITCH_BYTES = 10
MARGIN = 0.02
LEAST_WORDS = 3
_CACHE = 300_000

_FENCE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)", re.S)
#: What is passed over: inline code, citations, tags, addresses, link targets, table rules; then identifiers and paths.
_SPANS = tuple(map(re.compile, (r"`[^`\n]*`", r"\[[A-Za-z]{1,5}[-:][\w:-]+\]", r"<[^<>\n]{1,200}>", r"https?://\S+", r"\]\([^()\s]*\)", r"\|[-:| ]+\|")))
#: Runs of ideographs are no paths: unspaced scripts write whole paragraphs without a blank.
_PATHLIKE = re.compile(r"(?<!\S)[^\s/_\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef]{0,200}[/_][^\s\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef]*")
_END = re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s|$)|[。！？]+[”」』]*")
_MARKER = re.compile(r"\s*(?:#{1,6}\s|[-*+•]\s|>|\||\d+[.)]\s)")
_HEADING = re.compile(r"\s*#{1,6}\s")
_LEAD = re.compile(r"^[\s#>*+•|\-–—:;,.\d]+")
_NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
_WORD = re.compile(r"[^\W\d_]+")
_INVISIBLE = re.compile("[​-‏‪-‮⁠-⁤﻿­]")
_IDEOGRAPHS = re.compile(r"[⺀-鿿豈-﫿]")


def label_code(lang: str | None) -> str | None:
    """Two-letter code of the language that a label names, null if it names none."""
    if not lang:
        return None
    return CODES.get(re.split(r"[-_ ]", lang.strip().lower())[0])


def label_code_column(lang: Column) -> Column:
    """``label_code`` as a column expression."""
    first = F.element_at(F.split(F.lower(F.trim(lang)), "[-_ ]"), 1)
    names = F.create_map(*(F.lit(x) for kv in CODES.items() for x in kv))
    return F.element_at(names, F.coalesce(first, F.lit("")))


def _blank(m: re.Match[str]) -> str:
    return " " * (m.end() - m.start())


def normalise(sentence: str) -> str:
    s = sentence
    if not s.isascii():
        s = _INVISIBLE.sub("", s)
        if not unicodedata.is_normalized("NFKC", s):
            s = unicodedata.normalize("NFKC", s)
    return " ".join(_NUMBER.sub("0", _LEAD.sub("", s.lower())).split())


def words_of(sentence: str) -> list[str]:
    """Words; of unspaced scripts the single characters."""
    found = _WORD.findall(sentence)
    if sentence.isascii() or not _IDEOGRAPHS.search(sentence):
        return found
    out: list[str] = []
    for w in found:
        out += list(w) if _IDEOGRAPHS.match(w) else [w]
    return out


def sentences(text: str) -> list[tuple[int, int, str, bool]]:
    """``(start, end, normalised, is_heading)`` of the sentences of a text, code and tables left out."""
    masked = _FENCE.sub(_blank, text)
    for span in _SPANS:
        masked = span.sub(_blank, masked)
    if "/" in masked or "_" in masked:
        masked = _PATHLIKE.sub(_blank, masked)
    out: list[tuple[int, int, str, bool]] = []
    blocks: list[tuple[int, int, bool]] = []
    at = 0
    for line in masked.splitlines(keepends=True):
        a, z = at, at + len(line)
        at = z
        if not line.strip():
            blocks.append((z, z, False))
        elif line.lstrip().startswith("|") and line.count("|") > 1 and len(words_of(line)) <= 2 * line.count("|"):
            blocks.append((z, z, False))
        elif _HEADING.match(line) and not _END.search(line):
            blocks += [(a, z, True), (z, z, False)]
        elif not blocks or blocks[-1][0] == blocks[-1][1] or blocks[-1][2] or _MARKER.match(line):
            blocks.append((a, z, False))
        else:
            blocks[-1] = (blocks[-1][0], z, False)
    for a, z, heading in blocks:
        s = a
        for m in _END.finditer(masked, a, z):
            out.append((s, m.end(), normalise(masked[s : m.end()]), heading))
            s = m.end()
        if s < z:
            out.append((s, z, normalise(masked[s:z]), heading))
    return [x for x in out if x[2] and _WORD.search(x[2])]


@dataclass(frozen=True)
class Model:
    """Raw dictionary contents of each language."""

    contents: dict[str, bytes]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Costs of sentences; one per Python worker."""

    def __init__(self, model: Model) -> None:
        self.langs = sorted(model.contents)
        self.compress = []
        for code in self.langs:
            d = zstandard.ZstdCompressionDict(model.contents[code], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        self.cache: dict[str, tuple[int, ...] | None] = {}

    def cost(self, s: str) -> tuple[int, ...] | None:
        """Bytes of a normalised sentence in each language; null if it is too short to tell."""
        got = self.cache.get(s, 0)
        if got != 0:
            return got
        out: tuple[int, ...] | None = None
        if self.compress and len(words_of(s)) >= LEAST_WORDS:
            raw = s.encode("utf-8")
            out = tuple([len(compress(raw)) for compress in self.compress])
        if len(self.cache) > _CACHE:
            self.cache.clear()
        self.cache[s] = out
        return out

    def segments(self, text: str) -> list[tuple[int, int, str, float, int]]:
        """``(start, end, language, confidence, sentences)`` of the segments of a text, in order."""
        found = sentences(text)
        body = [x for x in found if not x[3]] or found
        units = [(a, z, c) for a, z, s, _ in body if (c := self.cost(s)) is not None]
        if not units:
            units = [(a, z, c) for a, z, s, _ in found if (c := self.cost(s)) is not None]
        if not units:
            joined = normalise(" ".join(x[2] for x in found))
            c = self.cost(joined) if joined else None
            if c is None:
                return []
            units = [(found[0][0], found[-1][1], c)]
        k = range(len(self.langs))
        lows = {c.index(min(c)) for _, _, c in units}
        if len(lows) == 1:
            return self._rows([[units[0][0], units[-1][1], lows.pop(), [sum(x) for x in zip(*(c for _, _, c in units))], len(units)]])
        total = list(units[0][2])
        back: list[list[int]] = []
        for _, _, c in units[1:]:
            low = min(k, key=total.__getitem__)
            step = [i if total[i] <= total[low] + SWITCH_BYTES else low for i in k]
            total = [min(total[i], total[low] + SWITCH_BYTES) + c[i] for i in k]
            back.append(step)
        at = min(k, key=total.__getitem__)
        path = [at]
        for step in reversed(back):
            at = step[at]
            path.append(at)
        path.reverse()
        out: list[list] = []
        for (a, z, c), i in zip(units, path):
            if out and out[-1][2] == i:
                out[-1][1] = z
                out[-1][3] = [x + y for x, y in zip(out[-1][3], c)]
                out[-1][4] += 1
            else:
                out.append([a, z, i, list(c), 1])
        return self._rows(out)

    def _rows(self, found: list[list]) -> list[tuple[int, int, str, float, int]]:
        result = []
        for a, z, i, c, n in found:
            second = min((x for j, x in enumerate(c) if j != i), default=2 * c[i])
            margin = (second - c[i]) / max(1, second)
            if margin >= MARGIN:
                result.append((a, z, self.langs[i], round(min(1.0, margin), 4), n))
        return result


def parts(segments: list[tuple[int, int, str, float, int]]) -> list[tuple[str, float, int]]:
    """``(language, confidence, sentences)`` of each language of a text, the one with most sentences first.

    A language counts if a segment of it has two sentences or more; if none has, the longest segment's counts.
    """
    best: dict[str, list[float]] = {}
    for _, _, code, conf, n in segments:
        b = best.setdefault(code, [0, 0.0, 0])
        b[0] = max(b[0], n)
        b[1] += conf * n
        b[2] += n
    ranked = sorted(((code, b[1] / b[2], b[2]) for code, b in best.items() if b[0] >= 2), key=lambda x: (-x[2], x[0]))
    if not ranked and segments:
        a, z, code, conf, n = max(segments, key=lambda s: s[1] - s[0])
        ranked = [(code, conf, n)]
    return [(c, round(x, 4), int(n)) for c, x, n in ranked]


def build_model(rows: Iterable[tuple[str, str]]) -> Model:
    """Dictionaries from ``(label code, text)`` rows whose labels may be wrong in part."""
    pools: dict[str, dict[str, None]] = defaultdict(dict)
    for code, text in rows:
        for _, _, s, _ in sentences(text):
            if len(words_of(s)) >= LEAST_WORDS:
                pools[code].setdefault(s)
    counts: dict[str, Counter[str]] = defaultdict(Counter)
    sizes: Counter[str] = Counter()
    for code, pool in pools.items():
        for s in pool:
            for w in set(words_of(s)):
                counts[w][code] += 1
                sizes[code] += 1
    vote: dict[str, str] = {}
    for w, c in counts.items():
        rates = {code: n / sizes[code] for code, n in c.items()}
        top = max(sorted(rates), key=rates.__getitem__)
        if sum(c.values()) >= 3 and 2 * rates[top] >= sum(rates.values()):
            vote[w] = top
    contents = {}
    for code, pool in pools.items():
        kept = []
        for s in pool:
            v = Counter(vote[w] for w in words_of(s) if w in vote)
            if v and 2 * v[code] >= sum(v.values()) and v[code] == max(v.values()):
                kept.append(s)
        raw = "\n".join(kept).encode("utf-8")[-DICTIONARY_BYTES:]
        if len(raw) > 256:
            contents[code] = raw
    return Model(contents)


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", *, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Model from at most ``sample_docs`` labelled texts of each language."""
    src = df.select(df[key].alias("key"), df[text].alias("text"), label_code_column(df[lang]).alias("code")).filter("code IS NOT NULL AND length(trim(text)) > 0")
    n = {r.code: r.n for r in src.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return Model({})
    share = F.element_at(F.create_map(*(F.lit(x) for c, k in sorted(n.items()) for x in (c, min(1.0, 1.3 * sample_docs / k)))), F.col("code"))
    rank = F.pmod(F.xxhash64("key", F.lit(9)), F.lit(1_000_003))
    rows = src.withColumn("rank", rank).filter(F.col("rank") < share * 1_000_003).select("code", "rank", "key", "text").toLocalIterator()
    taken: dict[str, list] = defaultdict(list)
    for r in rows:
        taken[r.code].append((r["rank"], str(r.key), r.text))
    return build_model((code, t) for code in sorted(taken) for _, _, t in sorted(taken[code])[:sample_docs])


def _scored(df: DataFrame, model: Model, key: str, text: str, fields: list[T.StructField], rows_of, blank: bool = False) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model.contents)
    holder: dict[str, Scorer] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = holder.setdefault("scorer", Scorer(Model(shared.value)))
        for pdf in batches:
            rows = [(k, *r) for k, t in zip(pdf["key"], pdf["text"]) for r in rows_of(scorer.segments(t))]
            yield pd.DataFrame(rows, columns=["key", *(f.name for f in fields)])

    src = df.select(df[key].alias("key"), F.coalesce(df[text], F.lit("")).alias("text"))
    if not blank:
        src = src.filter("length(trim(text)) > 0")
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), *fields])
    return src.mapInPandas(run, schema).withColumnRenamed("key", key)


def text_segments(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, segment_no, start_char, end_char, lang_code, confidence, n_sentences)``."""
    fields = [T.StructField("segment_no", T.IntegerType()), T.StructField("start_char", T.IntegerType()), T.StructField("end_char", T.IntegerType()), T.StructField("lang_code", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("n_sentences", T.IntegerType())]
    return _scored(df, model, key, text, fields, lambda segs: [(i, *s) for i, s in enumerate(segs, 1)])


def text_languages(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", *, every_row: bool = False) -> DataFrame:
    """``(key, lang_code, confidence, n_sentences, n_languages, place)``: each language of each text, the main one at place 1.

    With ``every_row`` a text without a decided language, null and blank ones included, has one row with a null language
    and confidence 0; otherwise it has none.
    """
    fields = [T.StructField("lang_code", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("n_sentences", T.IntegerType()), T.StructField("n_languages", T.IntegerType()), T.StructField("place", T.IntegerType())]

    def rows_of(segs):
        found = parts(segs)
        return [(*p, len(found), i) for i, p in enumerate(found, 1)] or [(None, 0.0, 0, 0, 1)] * every_row

    return _scored(df, model, key, text, fields, rows_of, blank=every_row)

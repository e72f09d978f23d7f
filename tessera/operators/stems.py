"""Porter's suffix stripping (M. F. Porter, 1980) and the words of a text as an index holds them."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

_WORD = re.compile(r"[^\W_]+")

# The suffix tables of steps 2, 3 and 4 of the published algorithm.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """One letter for each of the word's: c for consonants, v for vowels; y is a vowel behind a consonant."""
    out = ""
    for ch in word:
        out += "v" if ch in "aeiou" or ch == "y" and out[-1:] == "c" else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _ends_cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _replace(word: str, table: dict[str, str]) -> str:
    for end in sorted(table, key=len, reverse=True):
        if word.endswith(end):
            stem = word[: -len(end)]
            return stem + table[end] if _measure(stem) > 0 else word
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """Stem of a word in lower case; words of one or two letters and words with other signs stay."""
    if len(word) <= 2 or not (word.isascii() and word.isalpha()):
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        cut = next((word[: -len(e)] for e in ("ed", "ing") if word.endswith(e)), None)
        if cut is not None and "v" in _shape(cut):
            if cut.endswith(("at", "bl", "iz")) or _measure(cut) == 1 and _ends_cvc(cut):
                word = cut + "e"
            else:
                word = cut[:-1] if _doubled(cut) and cut[-1] not in "lsz" else cut
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(_replace(word, STEP2), STEP3)
    for end in sorted(STEP4, key=len, reverse=True):
        if word.endswith(end):
            cut = word[: -len(end)]
            if _measure(cut) > 1 and (end != "ion" or cut[-1:] in ("s", "t")):
                word = cut
            break
    if word.endswith("e") and (_measure(word[:-1]) > 1 or _measure(word[:-1]) == 1 and not _ends_cvc(word[:-1])):
        word = word[:-1]
    return word[:-1] if _doubled(word) and word[-1] == "l" and _measure(word) > 1 else word


def index_terms(text: str | None) -> list[str]:
    """Stems of the words of a text in order: letters and digits, lower case, without marks over letters."""
    if not text:
        return []
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return [stem(w) for w in _WORD.findall(text.lower())]

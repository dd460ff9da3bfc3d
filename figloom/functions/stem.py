"""The English stemmer published as Porter2 (Snowball)."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F

#: Fixed values of the published algorithm.
_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"),
    ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"),
    ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
]
_STEP3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = sorted("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split(), key=len, reverse=True)
_VOWEL, _DOUBLE, _LI = "aeiouy", ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"), "cdeghkmnrt"


def _region(word: str, start: int = 0) -> int:
    m = re.search("[aeiouy][^aeiouy]", word[start:])
    return start + m.end() if m else len(word)


def _short_syllable(s: str) -> bool:
    return bool(re.search("[^aeiouy][aeiouy][^aeiouywxY]$", s) or re.fullmatch("[aeiouy][^aeiouy]", s))


@lru_cache(1 << 16)
def stem(word: str) -> str:
    """The stem of a lower-case English word."""
    if len(word) <= 2:
        return word
    if word in _SPECIAL:
        return _SPECIAL[word]
    w = word.replace("’", "'").lstrip("'")
    w = re.sub("^y|(?<=[aeiouy])y", "Y", w)
    prefix = re.match("gener|commun|arsen", w)
    r1 = prefix.end() if prefix else _region(w)
    r2 = _region(w, r1)
    w = re.sub("('s'|'s|')$", "", w)
    # plurals
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search("[aeiouy].+s$", w):
        w = w[:-1]
    if w in _AFTER_1A:
        return w
    # past and present forms
    m = re.search("(eedly|ingly|edly|eed|ing|ed)$", w)
    if m:
        if m[0] in ("eed", "eedly"):
            if m.start() >= r1:
                w = w[: m.start()] + "ee"
        elif re.search("[aeiouy]", w[: m.start()]):
            w = w[: m.start()]
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif w.endswith(_DOUBLE):
                w = w[:-1]
            elif r1 >= len(w) and _short_syllable(w):
                w += "e"
    w = re.sub("(?<=.)(?<![aeiouy])[yY]$", "i", w) if len(w) > 2 else w
    for end, new in _STEP2:
        if w.endswith(end):
            if len(w) - len(end) >= r1:
                w = w[: -len(end)] + new
            break
    else:
        if w.endswith("ogi"):
            w = w[:-1] if len(w) - 3 >= r1 and w[-4:-3] == "l" else w
        elif w.endswith("li") and len(w) - 2 >= r1 and w[-3] in _LI:
            w = w[:-2]
    for end, new in _STEP3:
        if w.endswith(end):
            if len(w) - len(end) >= r1:
                w = w[: len(w) - len(end)] + new
            break
    else:
        if w.endswith("ative") and len(w) - 5 >= r2:
            w = w[:-5]
    for end in _STEP4:
        if w.endswith(end):
            if len(w) - len(end) >= r2:
                w = w[: -len(end)]
            break
    else:
        if w.endswith("ion") and len(w) - 3 >= r2 and w[-4:-3] in ("s", "t"):
            w = w[:-3]
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable(w[:-1]))):
        w = w[:-1]
    elif w.endswith("l") and len(w) - 1 >= r2 and w[-2] == "l":
        w = w[:-1]
    return w.lower()


def _stems(word: pd.Series) -> pd.Series:
    known = {x: stem(x) for x in word.dropna().unique()}
    return word.map(known, na_action="ignore")


def stem_of(word: Column) -> Column:
    """The stem of each word; NULL stays NULL."""
    return F.pandas_udf(_stems, "string")(word)

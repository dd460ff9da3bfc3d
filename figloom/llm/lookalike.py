"""Problem 10: texts that a reader could not tell apart get one and the same form.

The form is the composed one after selected compatibility mappings, computed per distinct value.
TESTDATA.md draws the line: what looks different stays different. So the method's full case
folding is off by default (case is visible; ``fold_case=True`` adds it), and of the compatibility
mappings those for raised, lowered, circled and squared-off signs, fractions, and letters of another
style (script, bold, long s, Greek symbol variants) aren't applied.

- Wide, narrow, joined, contextual and doubled-up compatibility forms become ordinary letters.
- Every blank (tab and all space separators) becomes a space, one for one. A line break of any
  kind becomes LF; it's no blank.
- Control, format and other default-ignorable characters go (and the four noncharacters used within). Joiners stay where they show: inside
  emoji sequences, and next to letters of joining scripts; so do variation selectors of emoji.
- Cyrillic and Greek letters drawn like Latin ones become these, accents apart.

NULL stays NULL. Empty text is the empty form.
"""

from __future__ import annotations

import unicodedata

import regex
from pyspark.sql import DataFrame, functions as F

#: Letters drawn alike, by script, in code point order; each stands for the Latin letter below it.
_CYRILLIC = "ЅІЈАВЕКМНОРСТУХаеорсухѕіјһԁԚԛԜԝ"
_CYRILLIC_AS = "SIJABEKMHOPCTYXaeopcyxsijhdQqWw"
_GREEK = "ͿΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοϳ"
_GREEK_AS = "JABEZHIKMNOPTYXvoj"
#: Ranges of characters that print nothing, besides controls and format characters.
_IGNORABLE = [(0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0xE0000, 0xE0FFF)]
#: Compatibility tags whose characters look like what they decompose to.
_SAME_LOOK = {"<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<compat>"}
#: Ranges with the tag <compat> that look different all the same: long s, Greek symbols, parenthesised signs.
_OWN_LOOK = [(0x017F, 0x017F), (0x03D0, 0x03D6), (0x03F0, 0x03F9), (0x1E9B, 0x1E9B), (0x2474, 0x24B5), (0x3200, 0x33FF)]
_BREAKS = "\n\r\x0b\x0c\x85\u2028\u2029"
_LETTERS = dict(zip(_CYRILLIC + _GREEK, _CYRILLIC_AS + _GREEK_AS))

_JOINING = "".join(rf"\p{{{x}}}" for x in "Arabic Syriac Mongolian Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala Khmer".split())
_SHOWN = regex.compile(
    "(?<=\\p{Extended_Pictographic}[\\ufe0f\U0001f3fb-\U0001f3ff]?)\\u200d(?=\\p{Extended_Pictographic})"
    "|(?<=\\p{Extended_Pictographic})[\\ufe0e\\ufe0f]"
    f"|(?<=[{_JOINING}])[\\u200c\\u200d](?=\\p{{L}})"
)
#: Stand-ins for shown joiners while the rest are removed: noncharacters, which no exchanged text has.
_HOLD = {"‌": "﷐", "‍": "﷑", "︎": "﷒", "️": "﷓"}
_RELEASE = {ord(v): k for k, v in _HOLD.items()}
_RELEASED = [chr(c) for c in _RELEASE]
_NOT_TEXT = dict.fromkeys(_RELEASE)


class _Map(dict):
    """Per code point, filled when first met: what it looks like."""

    def __missing__(self, c: int) -> str:
        ch = chr(c)
        kind = unicodedata.category(ch)
        if c in _RELEASE:
            out = ch
        elif ch in _BREAKS:
            out = "\n"
        elif ch == "\t" or kind == "Zs":
            out = " "
        elif kind in ("Cc", "Cf") or any(a <= c <= b for a, b in _IGNORABLE):
            out = ""
        else:
            tag, _, rest = unicodedata.decomposition(ch).partition(" ")
            if tag in _SAME_LOOK and not any(a <= c <= b for a, b in _OWN_LOOK) and not rest.startswith("0020"):
                out = "".join(self[ord(x)] for x in "".join(chr(int(x, 16)) for x in rest.split()))
            else:
                out = ch
        self[c] = out
        return out


_map = _Map()
_letters = str.maketrans(_LETTERS)


def form(text: str, fold_case: bool = False) -> str:
    """The one form of all texts that look like ``text``. Applying it again changes nothing."""
    if text.isascii() and text.isprintable():
        return text.casefold() if fold_case else text
    held = text.translate(_NOT_TEXT) if any(c in text for c in _RELEASED) else text
    held = held.replace("\r\n", "\n")
    shown = any(c in held for c in _HOLD)
    if shown:
        held = _SHOWN.sub(lambda m: _HOLD[m[0]], held)
    plain = unicodedata.normalize("NFD", held.translate(_map)).translate(_letters)
    out = unicodedata.normalize("NFC", plain)
    if shown:
        out = out.translate(_RELEASE)
    return unicodedata.normalize("NFC", out.casefold()) if fold_case else out


def _forms(texts: list[str | None], fold_case: bool) -> list[str | None]:
    done = {t: form(t, fold_case) for t in set(texts) if t is not None}
    return [None if t is None else done[t] for t in texts]


def with_form(df: DataFrame, text: str = "text", out: str = "form", fold_case: bool = False) -> DataFrame:
    """``df`` with the column ``out``; other columns, also of clashing names, stay as they are.

    Text of printable ASCII and line feeds is its own form: it is told natively and doesn't go to Python.
    """

    @F.pandas_udf("string")
    def udf(s):
        import pandas as pd

        return pd.Series(_forms(s.tolist(), fold_case), index=s.index, dtype=object)

    once = udf.asNondeterministic()  # so that a filter on the form doesn't make it a second time
    plain = F.col(text).rlike(r"\A[\n -~]*\z")
    own = F.lower(F.col(text)) if fold_case else F.col(text)
    return df.withColumn(out, F.when(plain, own).otherwise(once(F.when(~plain, F.col(text)))))


def look_keys(df: DataFrame, key: str, text: str, fold_case: bool = False) -> DataFrame:
    """key, look, own: 128-bit hashes (hex) of the form and of the text itself.

    Left out: NULL texts and texts with nothing visible (no form but blanks and line breaks).
    """
    formed = with_form(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", "_form", fold_case)
    return formed.where(F.trim(F.col("_form"), F.lit(" \n")) != "").select(F.col("_key").alias(key), F.md5("_form").alias("look"), F.md5("_text").alias("own"))


def look_pairs(keys: DataFrame, key: str) -> DataFrame:
    """key_a < key_b of rows with equal ``look`` and different ``own``.

    Copies are classes first: pairs are formed between the different texts of a look, and only
    these are expanded to rows. A hot text without look-alikes forms no pair at all.
    """
    classes = keys.groupBy("look", "own").agg(F.count(F.lit(1)).alias("n"))
    several = classes.groupBy("look").agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1")
    hot = classes.join(several, "look", "left_semi")
    a, b = hot.select("look", F.col("own").alias("own_a")), hot.select("look", F.col("own").alias("own_b"))
    met = a.join(b, "look").where("own_a < own_b")
    rows = [keys.select("look", F.col("own").alias(f"own_{c}"), F.col(key).alias(c)) for c in "ab"]
    pairs = met.join(rows[0], ["look", "own_a"]).join(rows[1], ["look", "own_b"]).where("a != b")
    return pairs.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b"))

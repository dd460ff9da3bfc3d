"""Text analysis that walks token by token: relations, labels in context, page labels.

Plain Python functions on one text, and Arrow-batched column functions over them. Nothing here
depends on rows other than its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, functions as F

from figloom.functions import vocabulary as V

_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[A-Za-z0-9]+(?:[-/][A-Za-z0-9]+)*")
_LABEL_TOKEN = re.compile(r"\b[0-9A-Za-z]+['′]?\b")
_SENTENCES = re.compile(r"(?<=[.;:])\s+|\n+")
_NUMBER = re.compile(r"^0*([0-9]{1,4})([A-Z]{0,2})(?:-0*([0-9]{1,4})([A-Z]{0,2}))?$")


_RELATIONS = [(label, stem, re.compile(rx, re.I)) for label, stem, rx in V.RELATIONS]
_PHRASES = re.compile("|".join(rf"\b{p}\b" for p in V.RELATION_PHRASES), re.I)


def clean(s: str | None) -> str:
    return _SPACE.sub(" ", (s or "").strip())


def canonical_number(s: str | None) -> str:
    m = _NUMBER.match((s or "").strip().upper().replace(" ", ""))
    if not m:
        return ""
    first = str(int(m[1])) + m[2]
    return first if m[3] is None else f"{first}-{int(m[3])}{m[4]}"


def _stripped(words: list[str], leading: Iterable[str], trailing: Iterable[str]) -> list[str]:
    low, high = 0, len(words)
    while low < high and words[low].lower() in leading:
        low += 1
    while high > low and words[high - 1].lower() in trailing:
        high -= 1
    return words[low:high]


def _side(tokens: list[re.Match], text: str, at: int, step: int, edge: int, most: int = 8) -> str:
    """The phrase from token ``at`` outwards (step -1: to the left), next to the relation's ``edge``."""
    words: list[str] = []
    while 0 <= at < len(tokens) and len(words) < most:
        token = tokens[at]
        word = token[0].lower()
        gap = text[token.end() : edge] if step < 0 else text[edge : token.start()]
        if word in V.CLAUSE_BREAKS or word in V.RELATION_BOUNDS or any(c in V.HARD_PUNCTUATION for c in gap):
            break
        if word not in V.AUXILIARIES:
            words.append(token[0])
        edge = token.start() if step < 0 else token.end()
        at += step
    if step < 0:
        words.reverse()
    return " ".join(_stripped(_stripped(words, V.LEADING_FILLERS, V.TRAILING_FILLERS), V.RELATION_STOPS, V.RELATION_STOPS))


def short_side(words: Sequence[str], tail: bool, limit: int = 4) -> list[str]:
    """At most ``limit`` words from the end (``tail``) or the beginning of a side, without outer stop words; from the beginning only up to a relation's word."""
    stops = V.RELATION_STOPS
    kept = _stripped(list(words), () if tail else stops, stops if tail else ())
    kept = kept[-limit:] if tail else kept[:limit]
    if not tail:
        kept = kept[: next((i for i, w in enumerate(kept) if w.lower() in V.RELATION_BOUNDS), len(kept))]
    return _stripped(kept, stops, stops)


def _entities(phrase: str) -> list[str]:
    """A phrase of numbered things joined by and/or as its two or three things; any other phrase as it is."""
    if len(phrase.split()) > 2:
        parts = [p for p in (x.strip(" ,") for x in re.split(r"\b(?:and|or)\b", phrase)) if p]
        if len(parts) in (2, 3) and any(c.isdigit() for c in phrase):
            bare = [" ".join(_stripped(p.split(), V.LEADING_FILLERS, V.TRAILING_FILLERS)) for p in parts]
            return [b for b in bare if b] or [phrase]
    return [phrase]


def relations(text: str | None, most: int = 4) -> list[str]:
    """At most ``most`` statements "left relation right", distinct without regard to case; else bare phrases; else none.

    Sentences in order, in each the relations in the vocabulary's order, in each the matches in order.
    """
    text = text or ""
    found: dict[str, str] = {}
    for sentence in filter(None, (s.strip() for s in _SENTENCES.split(text))):
        low, tokens = sentence.lower(), None
        for label, stem, rx in _RELATIONS:
            if stem not in low:
                continue
            for m in rx.finditer(sentence):
                tokens = tokens or list(_TOKEN.finditer(sentence))
                before = sum(1 for t in tokens if t.end() <= m.start())
                after = next((i for i, t in enumerate(tokens) if t.start() >= m.end()), len(tokens))
                left, right = _side(tokens, sentence, before - 1, -1, m.start()), _side(tokens, sentence, after, 1, m.end())
                if not left and not right:
                    continue
                for a in _entities(left):
                    for b in _entities(right):
                        snippet = " ".join(x for x in (a, label, b) if x)
                        found.setdefault(snippet.lower(), snippet)
                        if len(found) >= most:
                            return list(found.values())
    if not found:
        for m in _PHRASES.finditer(text):
            found.setdefault(clean(m[0].lower()), clean(m[0].lower()))
            if len(found) >= most:
                break
    return list(found.values())


def _prefixes(text: str, label: str | None) -> list[str]:
    m = re.search(r"\bfig(?:\.|ure)?\s*(\d+)([A-Za-z]?)\b", label or text, re.I)
    return [] if not m else [m[1] + m[2].upper(), m[1]] if m[2] else [m[1]]


def _label_pattern(prefixes: Sequence[str]) -> re.Pattern:
    return re.compile(rf"\b((?:{'|'.join(prefixes)})(?:\d+[A-Za-z]*|[A-Za-z]+\d+)(?:[-/][0-9A-Za-z]+)*)(['′](?=\w))?\b", re.I)


def _bare(rx: re.Pattern, text: str, most: int) -> list[str]:
    out: dict[str, None] = {}
    for m in rx.finditer(text):
        label = m[1].upper()
        if not label.lower().endswith(V.ORDINALS):
            out.setdefault(label + (m[2] or ""))
            if len(out) >= most:
                break
    return list(out)


def _near(tokens: list[re.Match], text: str, at: int, step: int, most: int = 4) -> list[str]:
    """Up to ``most`` content words next to token ``at``, in text order."""
    words: list[str] = []
    i = at + step
    while 0 <= i < len(tokens) and len(words) < most:
        low, high = (tokens[i], tokens[i + 1]) if step < 0 else (tokens[i - 1], tokens[i])
        word = tokens[i][0].lower()
        if any(c in ".;:?!\n" for c in text[low.end() : high.start()]) or word in V.LABEL_BREAKS or word in V.RELATION_BOUNDS:
            break
        if word not in V.LABEL_SKIPS:
            words.append(tokens[i][0])
        i += step
    return words[::-1] if step < 0 else words


def labels(text: str | None, fig_label: str | None = None, most: int = 100) -> list[str]:
    """Reference numerals of a figure.

    A paragraph that names the figure gives its and the next paragraph's bare numerals. Otherwise
    numerals with up to four words before them (or after, if none), and the bare ones that none of
    these begins or ends with, each once: always finite.
    """
    text = text or ""
    prefixes = _prefixes(text, fig_label)
    if not text or not prefixes:
        return []
    rx = _label_pattern(prefixes)
    named = re.compile(rf"\bfig(?:\.|ure)?\s*(?:{'|'.join(prefixes)})\b", re.I)
    paragraphs = [p for p in re.split(r"\r?\n\s*\r?\n", text) if p.strip()]
    for i, p in enumerate(paragraphs):
        if named.search(p):
            if found := _bare(rx, "\n\n".join(paragraphs[i : i + 2]), most):
                return found
            break
    tokens = list(_LABEL_TOKEN.finditer(text))
    place = {t.start(): i for i, t in enumerate(tokens)}
    out: dict[str, str] = {}
    for m in rx.finditer(text):
        label = m[1].upper() + (m[2] or "")
        at = place.get(m.start())
        if at is None or m[1].lower().endswith(V.ORDINALS):
            continue
        last = at
        while last + 1 < len(tokens) and tokens[last + 1].start() < m.end():
            last += 1
        left = _near(tokens, text, at, -1)
        snippet = clean(" ".join([*left, label] if left else [label, *_near(tokens, text, last, 1)]))
        out.setdefault(snippet.lower(), snippet)
        if len(out) >= most:
            break
    context = list(out)
    for b in _bare(rx, text, most):
        low = b.lower()
        if context and not any(c.endswith(low) or c.startswith(low) for c in context):
            out.setdefault(low, b)
    return list(out.values())[:most]


_WORD = re.compile(r"[A-Za-z][A-Za-z\-]+")
_STOPS, _STARTS = frozenset(V.KEYWORD_STOPS), tuple(V.KEYWORD_STARTS)


def keywords(text: str | None, k: int = 14) -> list[str]:
    """The k most frequent keywords, ties by first occurrence; the same as ``plans.pipeline.top_keywords`` row by row."""
    words = (w.lower() for w in _WORD.findall(text or ""))
    kept = Counter(w for w in words if len(w) > 2 and w not in _STOPS and not w.startswith(_STARTS) and not w.endswith("ing"))
    return [w for w, _ in kept.most_common(k)]


_DASHES = str.maketrans(dict.fromkeys(V.DASHES, "-"))
_INDICATOR = re.compile(r"(?:FIGURE|FIG)(?![^\W\d_])(.*)", re.I | re.S)
_PARTIAL = re.compile(r"[0-9]{1,4}(?:[A-Z]{1,2}|-[0-9]{0,4})?|[0-9]{1,4}[A-Z]{1,2}-[0-9]{0,4}")
_COMPLETE = re.compile(r"[0-9]{1,4}[A-Z]{0,2}(?:-[0-9]{1,4})?")


def _inline(word: str) -> str | None:
    """What follows FIG or FIGURE in one word; NULL if the word is no such indicator."""
    token = word.translate(_DASHES).strip().lstrip("\"'([{").rstrip("\"')]}.,;!?")
    m = _INDICATOR.fullmatch(token)
    return None if not m else m[1].lstrip(".:- ").replace(" ", "").upper()


def page_labels(words: Sequence[dict]) -> list[dict]:
    """Figure labels in a page's words (text, x, y, w, h, cx, cy), in order.

    A number may be spread over the next six words of the line. A word counts as a whole or not at
    all: prose after a number ends it and leaves it intact.
    """
    out = []
    inline = [_inline(w["text"] or "") for w in words]
    for i, w in enumerate(words):
        if inline[i] is None or (inline[i] and not _PARTIAL.fullmatch(inline[i])):
            continue
        number, last = inline[i], i
        for j in range(i + 1, min(len(words), i + 7)):
            other = words[j]
            if inline[j] is not None or abs(other["cy"] - w["cy"]) > 1.8 * max(w["h"], other["h"]):
                break
            bit = (other["text"] or "").translate(_DASHES).strip().strip(V.LABEL_TRIM).replace(" ", "").upper()
            if not bit or (not number and bit in "-:"):
                continue
            if not _PARTIAL.fullmatch(number + bit):
                break
            number, last = number + bit, j
        if _COMPLETE.fullmatch(number):
            part = words[i : last + 1]
            x1, y1 = min(p["x"] for p in part), min(p["y"] for p in part)
            x2, y2 = max(p["x"] + p["w"] for p in part), max(p["y"] + p["h"] for p in part)
            cx, cy = int((x1 + x2) / 2), int((y1 + y2) / 2)
            out.append({"label": f"FIG. {number}", "num": number, "x": x1, "y": y1, "w": x2 - x1, "h": y2 - y1, "cx": cx, "cy": cy, "row_y": cy, "col_x": cx})
    return out


WORD = "struct<text:string,x:int,y:int,w:int,h:int,cx:int,cy:int>"
LABEL = "struct<label:string,num:string,x:int,y:int,w:int,h:int,cx:int,cy:int,row_y:int,col_x:int>"


def _relations(text: pd.Series) -> pd.Series:
    return text.map(relations)


def _keywords(text: pd.Series) -> pd.Series:
    return text.map(lambda t: ", ".join(keywords(t)))


def _labels(text: pd.Series, label: pd.Series) -> pd.Series:
    return pd.Series([labels(t, f) for t, f in zip(text, label)], index=text.index, dtype=object)


def _page_labels(words: pd.Series) -> pd.Series:
    return words.map(lambda w: page_labels(list(w)) if w is not None else [])


def relation_phrases(text: Column) -> Column:
    """``relations`` joined by commas; ``unspecified`` if there are none."""
    found = F.pandas_udf(_relations, "array<string>")(text)
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(V.UNKNOWN)


def keyword_phrase(text: Column) -> Column:
    """``keywords`` joined by commas, of one row's text and without a shuffle."""
    return F.pandas_udf(_keywords, "string")(text)


def label_phrases(text: Column, label: Column) -> Column:
    """``labels`` joined by commas; ``if present`` if there are none."""
    found = F.pandas_udf(_labels, "array<string>")(text, label)
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(V.NO_LABELS)


def labels_of_page(words: Column) -> Column:
    """Array of labels; NULL words give the empty array."""
    return F.pandas_udf(_page_labels, f"array<{LABEL}>")(words)

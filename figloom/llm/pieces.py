"""Problem 7: items over a size limit become pieces within it, cut where the text allows.

Agglomerative: a text starts as atoms (sentences and lines; words of a sentence that doesn't fit;
cuts inside a word only where a word doesn't fit). Neighbours sit in a heap by the strength of the
boundary between them, then by place, which fills pieces from the left. The weakest boundary is
merged first, as long as the joint size plus the overlap stays within the limit.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Strengths of boundaries, weakest first.
INSIDE_WORD, WORD, SENTENCE, LINE, PARAGRAPH = range(5)
_SENTENCE_END = re.compile(r"[.!?;:]+[\"')\]\u2019\u201d]*\s+|[\u3002\uff01\uff1f]+\s*|\n\s*")
_SPACE = re.compile(r"\s+")


def _atoms(text: str, most: int) -> tuple[list[int], list[int]]:
    """Start of each atom, and the strength of the boundary before it (the first one's doesn't count)."""
    starts, strengths = [0], [PARAGRAPH]

    def add(at: int, strength: int) -> None:
        if starts[-1] < at < len(text):
            starts.append(at)
            strengths.append(strength)

    def fill(low: int, high: int) -> None:
        """Cuts low..high, an atom of its own, into words and words into bits of at most ``most``."""
        if high - low <= most:
            return
        cuts = [m.end() for m in _SPACE.finditer(text, low, high) if m.end() < high] + [high]
        for cut in cuts:
            while cut - starts[-1] > most:
                at = starts[-1] + most
                while at > starts[-1] + 1 and unicodedata.combining(text[at]):
                    at -= 1
                add(at, INSIDE_WORD)
            if cut < high:
                add(cut, WORD)

    low = 0
    for m in _SENTENCE_END.finditer(text):
        gap = m[0]
        fill(low, m.end())
        add(m.end(), PARAGRAPH if gap.count("\n") > 1 else LINE if "\n" in gap else SENTENCE)
        low = m.end()
    fill(low, len(text))
    return starts, strengths


def cut(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, core start, end) of the pieces of ``text`` in code points.

    The cores are the text, without gap or repeat; text[start:core start] repeats the end of the
    piece before, at most ``overlap`` characters, from a word's beginning if there is one. No
    piece is longer than ``limit``. A text within the limit is one piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    if len(text) <= limit:
        return [(0, 0, len(text))]
    most = limit - overlap
    starts, strengths = _atoms(text, most)
    n = len(starts)
    ends = starts[1:] + [len(text)]
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(strengths[i + 1], i, ends[i + 1] - starts[i], i + 1) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, i, size, j = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j]) or after[i] != j or ends[j] - starts[i] != size or size > most:
            continue
        alive[j], ends[i], after[i] = False, ends[j], after[j]
        if after[i] < n:
            before[after[i]] = i
            heapq.heappush(heap, (strengths[after[i]], i, ends[after[i]] - starts[i], after[i]))
        if before[i] >= 0:
            heapq.heappush(heap, (strengths[i], before[i], ends[i] - starts[before[i]], i))
    out: list[tuple[int, int, int]] = []
    for i in range(n):
        if alive[i]:
            core, start = starts[i], starts[i]
            if out and overlap:
                low = max(core - overlap, out[-1][0])
                start = low
                if low and not text[low - 1].isspace():
                    word = _SPACE.search(text, low, core)
                    start = word.end() if word and word.end() < core else low
            out.append((start, core, ends[i]))
    return out


def pieces(items: DataFrame, limit: int, overlap: int) -> DataFrame:
    """item_field, item_key, item_md5, piece_no (from 1), start, core_start, end, piece of the items longer than ``limit``.

    ``items``: item_field, item_key, text (strings). item_md5 is the whole text's, and tells texts of one key apart. NULL texts are no items, repeated rows count
    once, a NULL key is kept. Lengths are code points; only the longer items reach Python.
    """
    names = ["item_field", "item_key", "item_md5", "piece_no", "start", "core_start", "end", "piece"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for field, key, own, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                rows += [(field, key, own, i, s, c, e, text[s:e]) for i, (s, c, e) in enumerate(cut(text, limit, overlap), 1)]
            kinds = [pa.string()] * 3 + [pa.int32()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    long = items.where(F.length("text") > limit).select("item_field", "item_key", F.md5("text").alias("item_md5"), "text")
    once = long.dropDuplicates(["item_field", "item_key", "item_md5"])
    return once.mapInArrow(run, "item_field string, item_key string, item_md5 string, piece_no int, start int, core_start int, end int, piece string")

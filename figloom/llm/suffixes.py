"""Suffix arrays over concatenated texts, word by word, with numpy.

Texts of many partitions are handled at once: a suffix is known by its partition first, so suffixes
of different partitions never have a common prefix. Words are 64-bit hashes; any order of them gives
a suffix array. Ranks are made by prefix doubling and kept for every depth, so that the common
prefix of any two suffixes is found by halving.
"""

from __future__ import annotations

import numpy as np


class SuffixArray:
    """``order``: suffixes (word numbers) sorted; ``doc``: the text of each word; ``end``: where its text ends."""

    def __init__(self, doc: np.ndarray, word: np.ndarray, part: np.ndarray):
        """``doc``, ``word``: text number and hash of each word, text by text; ``part``: the partition of each text."""
        n = len(word)
        self.doc = doc
        lengths = np.bincount(doc, minlength=len(part))
        self.end = np.cumsum(lengths)[doc]
        _, letter = np.unique(word, return_inverse=True)
        _, rank = np.unique(part[doc] * (int(letter.max(initial=0)) + 1) + letter, return_inverse=True)
        self.ranks = [rank]
        width, longest = 1, int(lengths.max(initial=0))
        while width < longest and int(rank.max(initial=0)) < n - 1:
            there = np.arange(n) + width
            after = np.where(there < self.end, rank[np.minimum(there, n - 1)] + 1, 0)
            _, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
            self.ranks.append(rank)
            width *= 2
        self.order = np.argsort(rank, kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the common prefix of each suffix in ``a`` with the one in ``b``."""
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            at = np.flatnonzero(got < most)
            p, q = a[at] + got[at], b[at] + got[at]
            same = at[self.ranks[k][p] == self.ranks[k][q]]
            got[same] = np.minimum(got[same] + (1 << k), most[same])
            # ranks of the last depth are taken again: texts may agree further than it reaches
            while k == len(self.ranks) - 1 and len(same):
                at = same[got[same] < most[same]]
                same = at[self.ranks[k][a[at] + got[at]] == self.ranks[k][b[at] + got[at]]]
                got[same] = np.minimum(got[same] + (1 << k), most[same])
        return got

    def cross(self, side: np.ndarray) -> np.ndarray:
        """For each suffix, the longest common prefix with its nearest neighbours of the other side (``side`` of each text: 0 or 1)."""
        best = np.zeros(len(self.doc), np.int64)
        for order in (self.order, self.order[::-1]):
            s, place = side[self.doc[order]], np.arange(len(order))
            last = [np.maximum.accumulate(np.where(s == x, place, -1)) for x in (0, 1)]
            other = np.where(s == 0, last[1], last[0])
            met = np.flatnonzero(other >= 0)
            own = order[met]
            best[own] = np.maximum(best[own], self.common(own, order[other[met]]))
        return best

    def intervals(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(interval, text), each once: the intervals of suffixes that share ``depth`` words, and the texts that have one in it."""
        new = np.ones(len(self.order), np.int64)
        new[1:] = self.common(self.order[1:], self.order[:-1]) < depth
        number = np.cumsum(new)
        whole = self.end[self.order] - self.order >= depth
        n_texts = int(self.doc.max(initial=0)) + 1
        found = np.unique(number[whole] * n_texts + self.doc[self.order][whole])
        return found // n_texts, found % n_texts


def merged(at: np.ndarray, length: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretches that the spans of ``length`` from ``at`` cover together, of ``n`` words."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + length, -1)
    inside = np.concatenate([[0], (np.cumsum(step) > 0).astype(np.int8)])
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

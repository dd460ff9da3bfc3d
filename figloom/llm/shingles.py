"""Word shingles of many texts at once, as 64-bit hashes, with numpy.

Words are the maximal runs of ASCII letters and digits of the lower-cased text, a shingle is
three consecutive words, and a text of fewer than 30 words is similar to nothing. All of a
batch's bytes are hashed together; no Python loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE_WORDS = 3
LEAST_WORDS = 30
#: Texts are hashed in groups of about so many bytes, which bounds the arrays.
CHUNK_BYTES = 2_000_000
#: 64-bit words of a set's parity signature.
SIGNATURE_LANES = 8

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1)]] = True
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MUL = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * _MUL[0]
    h = (h ^ (h >> np.uint64(27))) * _MUL[1]
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """The first ``n`` powers of the odd step."""
    global _powers
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _STEP)]))
    return _powers[:n]


def words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word, in order."""
    parts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts])
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = np.flatnonzero(_IS_WORD[raw])
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(inside, prepend=-2) != 1)
    length = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, length)
    h = np.add.reduceat(_BYTE[raw[inside]] * _power(int(length.max()))[place], first)
    return np.searchsorted(ends, inside[first], side="right"), mixed(h ^ length.astype(np.uint64))


def shingles(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash) of each shingle in order; word count and sequence key of each text.

    Texts of fewer than ``LEAST_WORDS`` words have no shingles.
    """
    doc, h = words(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    keys = _sequence_keys(doc, h, len(texts))
    if len(h) < SHINGLE_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), n_words, keys
    whole = (doc[:-2] == doc[2:]) & (n_words[doc[:-2]] >= LEAST_WORDS)
    three = mixed(h[:-2] + mixed(h[1:-1] * _MUL[2] + mixed(h[2:] + _STEP)))
    return doc[:-2][whole], three[whole], n_words, keys


def ordered(doc: np.ndarray, h: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles, ordered by (rank, hash), with their ranks (uint8, a function of the hash).

    One unstable sort of a packed 64-bit key; texts must be numbered below 65,536 and in order. Where
    different hashes have equal keys, the sort is done again by whole hashes.
    """
    key = (doc.astype(np.uint64) << np.uint64(48)) | (rank.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
    order = np.argsort(key)
    if np.any((key[order][1:] == key[order][:-1]) & (h[order][1:] != h[order][:-1])):
        order = np.lexsort((h, key))
    doc, h, rank = doc[order], h[order], rank[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new], rank[new]


def sequence_keys(texts: Sequence[str | None]) -> np.ndarray:
    """One value per text that equal word sequences share: the sum of its words' hashes, each scrambled with its place."""
    return _sequence_keys(*words(texts), len(texts))


def _sequence_keys(doc: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    out = np.zeros(n_texts, np.uint64)
    if len(doc):
        n = np.bincount(doc, minlength=n_texts)
        at = (np.arange(len(h)) - (np.cumsum(n) - n)[doc]).astype(np.uint64)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[first]] = np.add.reduceat(mixed(h ^ mixed((at + np.uint64(1)) * _STEP)), first)
    return mixed(out)


def signatures(doc: np.ndarray, h: np.ndarray, n_texts: int, lanes: int = SIGNATURE_LANES) -> np.ndarray:
    """Parity of the set's elements over 64 * lanes cells, one row per text.

    Two sets differ in at least as many elements as their parities differ in cells, which bounds
    their overlap from above and never from below: no pair is lost.
    """
    out = np.zeros((n_texts, lanes), np.uint64)
    if len(doc):
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        bit = np.uint64(1) << ((h >> np.uint64(7)) & np.uint64(63))
        lane = ((h >> np.uint64(13)) % np.uint64(lanes)).astype(np.int64)
        for k in range(lanes):
            out[doc[first], k] = np.bitwise_xor.reduceat(np.where(lane == k, bit, np.uint64(0)), first)
    return out


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, Sequence[str | None]]]:
    """(number of the first, texts): groups of consecutive texts of about CHUNK_BYTES, at least one each."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and (total + len(t or "") > CHUNK_BYTES or i - start >= 1 << 16):
            yield start, texts[start:i]
            start, total = i, 0
        total += len(t or "")
    if start < len(texts):
        yield start, texts[start:]


def jaccard(a: Sequence[str | None], b: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(common, either): distinct shingles of each pair of texts, counted exactly."""
    n = len(a)
    common, either = np.zeros(n, np.int64), np.zeros(n, np.int64)
    sizes = np.cumsum([len(x or "") + len(y or "") for x, y in zip(a, b)])
    group = sizes // CHUNK_BYTES + np.arange(n) // (1 << 15)
    for first in np.flatnonzero(np.diff(group, prepend=-1)):
        last = int(np.searchsorted(group, group[first], side="right"))
        at, both = slice(first, last), last - first
        doc, h = [], []
        for side in (a[at], b[at]):
            d, s, *_ = shingles(side)
            d, s, _ = ordered(d, s, np.zeros(len(d), np.uint8))
            doc.append(d)
            h.append(s)
        d, s = np.concatenate(doc), np.concatenate(h)
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        twice = (d[1:] == d[:-1]) & (s[1:] == s[:-1])
        c = np.bincount(d[1:][twice], minlength=both)
        common[at] = c
        either[at] = np.bincount(d, minlength=both) - c
    return common, either

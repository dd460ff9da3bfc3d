import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from figloom.llm import meetings as M, neardup as N, overlap as O, queries_text as Q, rarity as R, shingles as S, suffixes as X
from figloom.shared import written

WORD = re.compile("[a-z0-9]+")


def shingle_set(text):
    w = WORD.findall((text or "").lower())
    return {" ".join(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 30 else set()


def similar(a, b, t=0.6):
    x, y = shingle_set(a), shingle_set(b)
    return bool(x and y) and len(x & y) >= t * len(x | y)


def corpus(n, seed=0, hot=0.3):
    """Random texts over few words, edited copies of earlier ones, exact copies, boilerplate, and odd cases."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    boiler = " ".join(rnd.choice(vocabulary) for _ in range(25))
    out = [None, "", "  ", "too short", "a " * 40, "É" * 50, boiler + " " + boiler, "x " * 5000]
    texts = []
    for _ in range(n):
        if texts and rnd.random() < 0.5:
            w = (texts[0] if rnd.random() < hot else rnd.choice(texts)).split()
            for _ in range(rnd.randrange(7)):
                i = rnd.randrange(len(w))
                w[i : i + rnd.randrange(2)] = [rnd.choice(vocabulary) for _ in range(rnd.randrange(3))]
            if rnd.random() < 0.3:
                k = rnd.randrange(len(w))
                w = w[k:] + w[:k]
            texts.append(rnd.choice([" ", ", ", "\n"]).join(w))
        else:
            w = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 90))]
            texts.append((boiler + " " if rnd.random() < 0.5 else "") + " ".join(w))
        if rnd.random() < 0.2:
            texts.append(texts[-1].upper())
    return out + texts


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abA1 .,é\n", max_size=200), min_size=1, max_size=5))
def test_words_and_shingles(texts):
    doc, h = S.words(texts)
    want = [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t.lower())]
    assert doc.tolist() == [i for i, _ in want]
    seen = {}
    for (_, w), x in zip(want, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    d, g, n, keys = S.shingles(texts)
    assert n.tolist() == [len(WORD.findall(t.lower())) for t in texts]
    for i, t in enumerate(texts):
        assert len(set(g[d == i].tolist())) == len(shingle_set(t))
        for j, u in enumerate(texts):
            assert (keys[i] == keys[j]) == (WORD.findall(t.lower()) == WORD.findall(u.lower()))


def test_jaccard_is_exact():
    texts = corpus(80, 3)
    rnd = random.Random(1)
    pairs = [(rnd.choice(texts), rnd.choice(texts)) for _ in range(300)]
    common, either = S.jaccard(*zip(*pairs))
    for (a, b), c, e in zip(pairs, common, either):
        assert (c, e) == (len(shingle_set(a) & shingle_set(b)), len(shingle_set(a) | shingle_set(b)))


def test_signature_bound_never_loses_a_pair():
    texts = [t for t in corpus(60, 4) if shingle_set(t)]
    doc, h, *_ = S.shingles(texts)
    doc, h, _ = S.ordered(doc, h, np.zeros(len(doc), np.uint8))
    sig = S.signatures(doc, h, len(texts))
    for i in range(0, len(texts), 3):
        for j in range(len(texts)):
            x, y = shingle_set(texts[i]), shingle_set(texts[j])
            assert int(np.bitwise_count(sig[i] ^ sig[j]).sum()) <= len(x ^ y)


def as_rows(spark, texts, space=lambda i: 0):
    data = [(space(i), f"k{i:04d}", t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(data + data[:20], "space int, key string, text string, cls string").repartition(3)


@pytest.mark.parametrize("seed, hot", [(1, 0.3), (2, 0.9)])
def test_near_duplicates_against_brute_force(spark, seed, hot):
    texts = corpus(160, seed, hot)
    space = lambda i: i % 7 == 0 and 1 or 0
    members, links = N.near_duplicates(as_rows(spark, texts, space))
    got = {(r.key_a, r.key_b) for r in Q.key_pairs(members, links).collect()}
    want = {(f"k{i:04d}", f"k{j:04d}") for i in range(len(texts)) for j in range(i + 1, len(texts)) if space(i) == space(j) and similar(texts[i], texts[j])}
    assert got == want and len(want) > 50
    assert members.select("key").distinct().count() == sum(len(WORD.findall((t or "").lower())) >= 30 for t in texts)


def test_cells_pick_up_dense_regions():
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base[:k] + ["x"] + base[k + 1 :]) for k in range(20)]
    far = [" ".join(f"f{i}_{j}".replace("_", "q") for j in range(50)) for i in range(10)]
    pivots = N.pick_pivots(near + far)
    assert len(pivots) == 1 and len(pivots[0]) == 58
    assert N.pick_pivots(far) and N.pick_pivots([]) == [] and N.pick_pivots(["short"]) == []


def test_groups(spark):
    texts = corpus(120, 9)
    members, links = N.near_duplicates(as_rows(spark, texts))
    rows = Q.groups(members, links).collect()
    parent = {f"k{i:04d}": f"k{i:04d}" for i in range(len(texts))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if similar(texts[i], texts[j]):
                a, b = sorted((find(f"k{i:04d}"), find(f"k{j:04d}")))
                parent[b] = a
    assert {r.key: r.group_key for r in rows} == {f"k{i:04d}": find(f"k{i:04d}") for i, t in enumerate(texts) if len(WORD.findall((t or "").lower())) >= 30}


def test_nothing_in_nothing_out(spark):
    rows = spark.createDataFrame([], "space int, key string, text string")
    members, links = N.near_duplicates(rows)
    assert members.count() == links.count() == Q.groups(members, links).count() == 0
    members, links = N.near_duplicates(spark.createDataFrame([(0, "a", None), (0, None, "short")], rows.schema))
    assert members.count() == links.count() == 0


def test_cross_split_overlap_against_brute_force(spark):
    texts = corpus(160, 5)
    space = lambda i: int(i % 4 == 0)
    members, links, spans = O.overlaps(as_rows(spark, texts, space))
    own = {}
    for r in members.collect():
        own.setdefault(r.cls, set()).add(r.key)
    got = {tuple(sorted((a, b))) for r in links.collect() for a in own[r.x] for b in own[r.y]}
    want = {(f"k{i:04d}", f"k{j:04d}") for i in range(len(texts)) for j in range(i + 1, len(texts)) if space(i) != space(j) and similar(texts[i], texts[j])}
    assert got == want and want
    assert {(r.x, r.y) for r in links.collect()} == {(r.x, r.y) for r in links.distinct().collect()}
    assert {r.y for r in spans.collect()} >= {r.y for r in links.collect()}


def test_pairs_report_and_hashes(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [("a", "train", "h1", text, "s"), ("b", "test", "h1", None, "s"), ("c", "validation", None, text + " x", None), ("d", None, "h1", text, "s"), ("e", "test", "h2", "short", "s"), ("b", "test", "h1", None, "s")]
    spark.createDataFrame(rows, "id string, split string, sha256 string, prompt string, source string").write.parquet(str(tmp_path / "train.parquet"))
    assert {tuple(r) for r in O.p3_found(spark, str(tmp_path)).collect()} == {("a", "b"), ("a", "c")}
    report = {(r.split, r.source): tuple(r)[2:] for r in O.p3_report(spark, str(tmp_path)).collect()}
    assert report == {("test", "s"): (3, 2, 0, 2), ("validation", None): (1, 0, 1, 1)}
    assert {r.id: r.longest for r in O.p3_coverage(spark, str(tmp_path)).collect()} == {"c": 40}


def test_spans_are_of_one_training_text(spark):
    texts = [t for t in corpus(120, 11) if len(WORD.findall((t or "").lower())) >= 30]
    texts += ["p q r s t u " * 60, "p q r s t u " * 70 + "end"]
    # each half of the last is in another training text, and no text has both
    halves = [[f"h{side}{i}" for i in range(20)] for side in "ab"]
    texts += [" ".join([*halves[0], *(f"m{i}" for i in range(20))]), " ".join([*(f"n{i}" for i in range(20)), *halves[1]]), " ".join([*halves[0], *halves[1]])]
    space = [int(i % 4 == 0) for i in range(len(texts))]
    space[-5:] = [0, 1, 0, 0, 1]
    rows = as_rows(spark, texts, lambda i: space[i])
    bits = R.table_bits(rows)
    scanned = written(R.scan(rows, bits, 2), "scan")
    got = {r.cls: (r.covered, r.longest) for r in O.spans(rows, R.rarity(scanned, bits, 2), bits).collect()}
    own = {r.key: r.cls for r in scanned.where("cls IS NOT NULL").collect()}
    words = [WORD.findall(t.lower()) for t in texts]
    for i in (i for i, s in enumerate(space) if s):
        best = [0] * len(words[i])
        for j in (j for j, s in enumerate(space) if not s):
            below = [0] * (len(words[j]) + 1)
            for a in reversed(range(len(words[i]))):
                below = [below[b + 1] + 1 if words[i][a] == words[j][b] else 0 for b in range(len(words[j]))] + [0]
                best[a] = max(best[a], *below)
        hit = {x for a, n in enumerate(best) if n >= 3 for x in range(a, a + n)}
        want = (round(len(hit) / len(words[i]), 4), max(n for n in best)) if hit else (0, 0)
        assert got.get(own[f"k{i:04d}"], (0, 0)) == want
    assert got[own[f"k{len(texts) - 1:04d}"]] == (1.0, 20)


def test_suffix_array_against_sorting():
    rnd = random.Random(3)
    texts = [[rnd.choice("abcd") for _ in range(rnd.randrange(1, 40))] for _ in range(24)] + [list("ab" * 30), list("ab" * 30 + "c")]
    part, side = np.array([i // 3 for i in range(26)]), np.array([int(i % 3 == 0) for i in range(26)])
    doc, word = np.repeat(np.arange(26), [len(t) for t in texts]), np.array([hash(w) % 1000003 for t in texts for w in t])
    array = X.SuffixArray(doc, word, part)
    start = np.cumsum([0, *map(len, texts)])
    at = [(i, k) for i, t in enumerate(texts) for k in range(len(t))]
    tail = [tuple(int(x) for x in word[start[i] + k : start[i + 1]]) for i, k in at]
    keys = [(part[at[p][0]], tail[p]) for p in array.order]
    order = {w: r for r, w in enumerate(sorted(set(word.tolist())))}
    assert keys == sorted(keys, key=lambda x: (x[0], [order[w] for w in x[1]]))

    def prefix(p, q):
        if part[at[p][0]] != part[at[q][0]]:
            return 0
        n = 0
        for x, y in zip(tail[p], tail[q]):
            if x != y:
                break
            n += 1
        return n

    a, b = np.array([rnd.randrange(len(at)) for _ in range(500)]), np.array([rnd.randrange(len(at)) for _ in range(500)])
    assert array.common(a, b).tolist() == [prefix(p, q) for p, q in zip(a, b)]
    best = array.cross(side)
    for p in range(len(at)):
        assert best[p] == max([prefix(p, q) for q in range(len(at)) if side[at[q][0]] != side[at[p][0]]], default=0)
    interval, text = array.intervals(3)
    groups = {}
    for i, t in zip(interval.tolist(), text.tolist()):
        groups.setdefault(i, set()).add(t)
    want = {}
    for (i, k), t in zip(at, tail):
        if len(t) >= 3:
            want.setdefault((part[i], t[:3]), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_partitions_are_compared_exactly():
    texts = [t for t in corpus(60, 8) if shingle_set(t)]
    space = np.array([int(i % 5 == 0) for i in range(len(texts))])
    batch = O.compare(np.arange(len(texts)) // 5, space, np.arange(len(texts)), texts).to_pylist()
    for r in batch:
        if r["x"] is not None:
            x, y = shingle_set(texts[r["x"]]), shingle_set(texts[r["y"]])
            assert (r["common"], r["either"]) == (len(x & y), len(x | y))
    assert sum(r["x"] is None for r in batch) == int(space.sum())
    copy = O.compare(np.zeros(2, int), np.array([0, 1]), np.array([7, 8]), [texts[0], texts[0]]).to_pylist()
    n = len(WORD.findall(texts[0].lower()))
    assert [r["spans"] for r in copy if r["x"] is None] == [[0, n, n]]


@pytest.mark.parametrize("cross", [False, True])
def test_hot_keys_are_split_and_lose_no_pair(monkeypatch, cross):
    monkeypatch.setattr(M, "HOT", 8)
    n, rnd = 100, np.random.default_rng(1)
    cls, h = S.mixed(np.arange(n, dtype=np.uint64) + np.uint64(5)), np.full(n, 77, np.uint64)
    side = rnd.integers(0, 2, n) if cross else np.zeros(n, np.int64)
    own, other = (np.bincount(side, minlength=2)[x] for x in (side, 1 - side))
    e, key, group = M.split_hot(h, cls, own.astype(float), side if cross else None, other.astype(float), hot=8)
    z = np.zeros(len(e), np.int64)
    b = M.batch_of(key, cls[e], z + 40, z, z == 0, z == 0, side[e], group, z)
    k, c, m, f = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    order = np.argsort(k)
    got = [tuple(sorted(p)) for batch in M.met(k[order], c[order], m[order], f[order], cross, 0.6) for p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    signed = cls.view(np.int64).tolist()
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(n) for j in range(i) if not cross or side[i] != side[j]}
    assert len(got) == len(set(got)) and set(got) == want
    assert max(np.unique(key, return_counts=True)[1]) < 60


_ = Counter, F

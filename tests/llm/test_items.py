import math
import os
import random
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from figloom.llm import lookalike as L, packing as K, pieces as C, tokens as T

# pieces


@settings(max_examples=250, deadline=None)
@given(st.text(alphabet="ab. \n!é́字。", max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_pieces_hold_the_whole_text(text, limit, overlap):
    got = C.cut(text, limit, overlap)
    assert "".join(text[c:e] for _, c, e in got) == text
    for (s, c, e), before in zip(got, [None, *got]):
        assert e - s <= limit and s <= c <= s + overlap and (before is None or before[0] <= s <= before[2] == c)
    if len(text) <= limit:
        assert len(got) == 1


def test_pieces_cut_at_the_strongest_boundary():
    text = "One two three. Four five six.\n\nSeven eight nine. Ten eleven twelve."
    assert [text[c:e] for _, c, e in C.cut(text, 40, 0)] == ["One two three. Four five six.\n\n", "Seven eight nine. Ten eleven twelve."]
    assert all(("word " * 10)[c:e].endswith(" ") for _, c, e in C.cut("word " * 10, 12, 0))
    assert [e - c for _, c, e in C.cut("x" * 25, 10, 0)] == [10, 10, 5]
    assert len(C.cut("a b. " * 40000, 2400, 200)) < 130
    with pytest.raises(ValueError):
        C.cut("x", 5, 5)


def test_pieces_are_few():
    rnd = random.Random(1)
    text = " ".join("w" * rnd.randrange(2, 9) + (". " if rnd.random() < 0.1 else "") for _ in range(3000))
    assert len(C.cut(text, 1000, 100)) <= 2 * math.ceil(len(text) / 900)


def test_pieces_of_a_table(spark):
    rows = [("f", "a", "x " * 30), ("f", "a", "x " * 30), ("f", None, "y " * 30), ("f", "b", "short"), ("f", "c", None), ("f", "d", "")]
    got = C.pieces(spark.createDataFrame(rows, "item_field string, item_key string, text string").withColumn("piece_no", F.lit("clash")), 20, 4).collect()
    assert {r.item_key for r in got} == {"a", None} and sorted(r.piece_no for r in got if r.item_key == "a") == list(range(1, 1 + sum(r.item_key == "a" for r in got)))
    assert C.pieces(spark.createDataFrame([], "item_field string, item_key string, text string"), 20, 4).count() == 0


# tokens

VOCABULARY = f"{T.TOKENIZERS}/{T.VOCABULARY}"
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")
ODD = ["", " ", "Hello world", "<|endoftext|> x", "a  b\n\n c\t", "naïve 字字 👨‍🔧", "I'll they've", "x" * 3000, "́​", "１２３", "fig. 3A—302/304", "\r\n \r\n"]


@pytest.fixture(scope="module")
def bpe():
    with open(VOCABULARY, "rb") as f:
        return T.Bpe(f.read())


@needs_vocabulary
@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=120))
def test_ids_equal_two_public_encoders_and_decode(text):
    import base64

    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("tokenizers")
    if "own" not in _cache:
        with open(VOCABULARY, "rb") as f:
            raw = f.read()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        _cache["own"] = T.Bpe(raw)
        _cache["one"] = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _cache["two"] = tokenizers.Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
        _cache["two"].encode_special_tokens = True
        _cache["words"] = _cache["own"].decoder()
    for t in (text, *ODD[:3]):
        ids = _cache["own"].encode(t)
        assert ids == _cache["one"].encode_ordinary(t) == _cache["two"].encode(t, add_special_tokens=False).ids
        assert T.decode(ids, _cache["words"]) == t


_cache = {}


@needs_vocabulary
def test_odd_texts(bpe):
    words = bpe.decoder()
    assert [T.decode(bpe.encode(t), words) for t in ODD] == ODD and bpe.encode(None) == [] and len(bpe.encode("<|endoftext|>")) > 1


@needs_vocabulary
def test_token_tables(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (4, "Hello world", "x")], "doc_id long, text string, ids string")
    rows = {r.doc_id: r.ids for r in T.token_ids(df, "doc_id", "text").collect()}
    assert rows[2] == rows[3] == [] and rows[1] == rows[4] and len(rows[1]) == 2
    assert {r.doc_id: r.n_tokens for r in T.token_counts(df, ["doc_id", "ids"], "text").collect()} == {1: 2, 2: 0, 3: 0, 4: 2}
    assert {r.doc_id: r.text for r in T.decoded(T.token_ids(df, "doc_id", "text"), "doc_id").collect()}[1] == "Hello world"
    assert T.token_ids(df.limit(0), "doc_id", "text").count() == 0


# containers


def items(n, seed=0):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["hot"] * 3 + ["b", None]), rnd.choice([0, 1, 5, rnd.randrange(1, 130), 100, 250, rnd.randrange(1, 40)])) for i in range(n)]


@pytest.mark.parametrize("window", [4, 512])
def test_containers(spark, window):
    data = items(600) + [(9999, "b", None)]
    placed = K.pack(spark.createDataFrame(data, "doc_id long, source string, n_tokens int"), 100, window).collect()
    tokens, boxes = {}, {}
    for r in placed:
        tokens.setdefault(r.doc_id, []).append((r.part_no, r.start, r.size))
        if r.size:
            boxes.setdefault(r.container_id, []).append((r.place, r.size))
    for i, _, n in data:
        parts = sorted(tokens[i])
        assert sum(s for *_, s in parts) == (n or 0) and [p for p, *_ in parts] == list(range(len(parts)))
        assert len(parts) == max(1, math.ceil((n or 0) / 100)) and [s for _, s, _ in parts] == [100 * k for k in range(len(parts))]
    for parts in boxes.values():
        end = 0
        for place, size in sorted(parts):
            assert place == end
            end += size
        assert end <= 100
    fewest = math.ceil(sum(n or 0 for *_, n in data) / 100)
    assert len(boxes) <= fewest * (1.06 if window == 4 else 1.02) + 1


def test_windows_hold_the_mixture(spark):
    parts = K.split_items(spark.createDataFrame([(i, "a" if i % 4 else "b", 10) for i in range(2000)], "doc_id long, source string, n_tokens int"), 100)
    share = {}
    for r in K.windows(parts, 100, 10).groupBy("window_no", "source").agg(F.sum("size").alias("n")).collect():
        share[r.window_no, r.source] = r.n
    assert {w for w, _ in share} == set(range(20))
    assert all(abs(share[w, "a"] - 750) <= 10 and abs(share[w, "b"] - 250) <= 10 for w in range(20))
    wanted = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, share double")
    got = K.windows(parts, 100, 10, wanted)
    first = {r.source: r.n for r in got.where("window_no = 0").groupBy("source").agg(F.sum("size").alias("n")).collect()}
    assert first == {"a": 500, "b": 500} and got.count() == 2000


def test_mixture_reaches_its_targets_and_carries_the_rest(spark):
    rows = [(i, "a" if i % 4 else None, 7) for i in range(3000)]
    parts = K.split_items(spark.createDataFrame(rows, "doc_id long, source string, n_tokens int"), 100)
    shares = spark.createDataFrame([("a", 2.0), (None, 1.0), ("other", 5.0)], "source string, share double")
    got = K.mixture(parts, 100, shares, 10).collect()
    assert sum(r.n_tokens for r in got) == 21000 and {r.source for r in got} == {"a", None}
    for r in got:
        assert abs(r.target - (2 / 3 if r.source else 1 / 3)) < 1e-5
        if r.all_left:
            assert abs(r.reached - r.target) <= 2 * 7 / 1000 and abs(r.carried) <= 7
    assert sum(r.all_left for r in got) >= 10
    placed = K.pack(spark.createDataFrame(rows, "doc_id long, source string, n_tokens int"), 100, 10, shares)
    assert placed.agg(F.sum("size")).first()[0] == 21000 and placed.select("container_id").distinct().count() <= 21000 / 98 * 1.01 + 1
    assert K.mixture(parts.limit(0), 100, shares).count() == 0


def test_no_items(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, n_tokens int")
    assert K.pack(empty, 100).count() == 0
    assert K.pack(spark.createDataFrame([(1, None, 0)], empty.schema), 100).first().container_id is None


# look-alikes

SAME = [
    ("ＦＩＧ．３", "FIG.3"), ("café", "café"), ("Å", "Å"), ("Ω", "Ω"), ("µm", "μm"), ("ﬁn", "fin"), ("a​b­", "ab"), ("a b　c\td", "a b c d"),
    ("АВ", "AB"), ("ѕсоре", "scope"), ("ον", "ov"), ("ё", "ë"), ("a\r\nb", "a\nb"), ("﻿x", "x"), ("ǆ", "dž"), ("ｶﾞ", "ガ"), ("a⁠‎b", "ab"),
]
DIFFERENT = [("A", "a"), ("é", "e"), ("m²", "m2"), ("½", "1/2"), ("a  b", "a b"), ("a\nb", "a b"), ("\U0001d49c", "A"), ("\U0001f468‍\U0001f527", "\U0001f468\U0001f527"), ("0", "O"), ("ſ", "s"), ("①", "1"), ("x₂", "x2"), ("क्‍ष", "क्ष"), ("a ", "a")]


@pytest.mark.parametrize("a, b", SAME)
def test_same_look(a, b):
    assert L.form(a) == L.form(b)


@pytest.mark.parametrize("a, b", DIFFERENT)
def test_different_look(a, b):
    assert L.form(a) != L.form(b)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40))
def test_form_is_stable(text):
    once = L.form(text)
    assert L.form(once) == once and unicodedata.normalize("NFC", once) == once
    assert L.form(unicodedata.normalize("NFD", text)) == L.form(unicodedata.normalize("NFC", text))


def test_fold_case():
    assert L.form("Straße", True) == L.form("STRASSE", True) and L.form("FIG", True) == "fig"


def test_look_pairs(spark):
    texts = ["fig a", "fig a", "fig​ a", "fig a", "Fig a", "other", "other", "", "​", " \n", None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("look", F.lit("clash"))
    keys = L.look_keys(df, "doc_id", "text")
    got = {tuple(r) for r in L.look_pairs(keys, "doc_id").collect()}
    want = {(i, j) for i in range(4) for j in range(i + 1, 4) if texts[i] != texts[j]}
    assert got == want
    assert L.look_pairs(L.look_keys(df.limit(0), "doc_id", "text"), "doc_id").count() == 0
    formed = L.with_form(df).orderBy("doc_id").collect()
    assert formed[1].form == "fig a" and formed[10].form is None and formed[7].form == "" and formed[0].look == "clash"


def test_very_long_text():
    assert L.form("ａ​" * 200_000) == "a" * 200_000

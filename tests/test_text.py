import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from figloom.functions import phrases as P, text as X, vocabulary as V
from figloom.functions.stem import stem
from figloom.plans import pipeline


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, want", [("003A", "3A"), ("3-4", "3-4"), ("3A1", ""), ("12345", ""), ("3-4-5", ""), ("0", "0"), ("A3", ""), ("3abc", ""), (" 3 a ", "3A"), ("", ""), (None, "")])
def test_figure_number(spark, raw, want):
    assert one(spark, raw, X.figure_number) == want
    assert P.canonical_number(raw) == want


@given(st.from_regex(r"0{0,2}[0-9]{1,4}[a-zA-Z]{0,2}(-[0-9]{1,3})?", fullmatch=True))
def test_figure_number_is_idempotent(raw):
    once = P.canonical_number(raw)
    assert P.canonical_number(once) == once


@pytest.mark.parametrize("label, want", [("FIG. 3A", "3A"), ("Figure 07", "7"), ("fig-2", "2"), ("FIG: 3/4", "34"), ("3A", None), ("FIG.", None), (None, None)])
def test_label_number(spark, label, want):
    assert one(spark, label, X.label_number) == want


@pytest.mark.parametrize("raw, want", [("FIG_3A", "FIG3A"), ("FIG 3-4", "FIG_3_4"), ("***", "UNLABELED"), (None, "UNLABELED"), ("é/x", "é_x")])
def test_file_token(spark, raw, want):
    assert one(spark, raw, X.file_token) == want


def test_figure_numbers(spark):
    texts = ["FIG. 10 and fig-2; FIGS. 3", None, "Figure 3a. FIG. 1234, FIG. 1-3", "FIG. 1AB"]
    assert one(spark, texts, X.figure_numbers, "array<string>") == ["1", "10", "2", "3A"]


@pytest.mark.parametrize("text, kind", [("a block diagram of memory", "flowchart"), ("controller and bus", "block diagram"), ("gear and shaft", "mechanical"), ("", "line art"), (None, "line art"), ("op-amp", "electrical schematic"), ("X axis", "graph"), ("3D", "perspective"), ("plan view", "orthographic"), ("businesses", "line art")])
def test_diagram_class(spark, text, kind):
    assert one(spark, text, X.diagram_class) == kind


def test_view_and_text_helpers(spark):
    assert one(spark, "A Top  View, then isometric", X.view_cue) == "top view"
    assert one(spark, None, X.view_cue) == "unspecified"
    assert one(spark, " a \n b ", X.clean) == "a b"
    assert one(spark, "a–b－c", X.plain_dashes) == "a-b-c"
    assert one(spark, "One. Two; three: four\n\nfive 1. 2", X.sentences) == ["One.", "Two;", "three:", "four", "five 1.", "2"]
    assert one(spark, "oops", X.string_list) == [] and one(spark, '["a"]', X.string_list) == ["a"] and one(spark, None, X.string_list) == []
    assert one(spark, "x" * 400, X.shortened) == "x" * 359 + "…"
    assert one(spark, "a-D00000.tiff", X.is_cover_sheet) and not one(spark, None, X.is_cover_sheet)
    assert one(spark, "FIGURE 3", X.figure_display) == "FIG. 3" and one(spark, None, X.figure_display) == "{unknown}"


def test_keywords_native_and_python_agree(spark):
    texts = ["The pump pumps water. Water enters the pump housing.", "", None, "zeta alpha zeta alpha beta beta", "system moving ab a"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    native = {r.i: r.keywords for r in pipeline.top_keywords(df, "i", "t", 14).collect()}
    assert native.get(0) == "pump, water, pumps, enters"
    for i, t in enumerate(texts):
        assert native.get(i, "") == ", ".join(P.keywords(t))


@pytest.mark.parametrize("text, want", [
    ("The processor 100 is connected to the memory 110.", ["processor 100 connected to memory 110"]),
    ("A bus 120 extends between the processor 100 and the memory 110.", ["between processor 100", "between memory 110", "bus 120 extends between processor 100", "bus 120 extends between memory 110"]),
    ("Connected to.", ["connected to"]), ("nothing here", []), ("", []), (None, []),
    ("The lid; mounted on the frame.", ["mounted to frame"]),
])
def test_relations(text, want):
    assert P.relations(text) == want


@pytest.mark.parametrize("text, label, want", [
    ("FIG. 3 shows pump 302 and valve 304.", "FIG. 3", ["302", "304"]),
    ("FIGS. 3 and 4 show pump 302 and valve 304.", "FIG. 3", ["pump 302", "pump 302 and valve 304"]),
    ("FIG. 3 shows the 33rd row, 302A/302B and 3A1.", "FIG. 3", ["302A/302B", "3A1"]),
    ("no figure 302", None, []), ("", "FIG. 3", []), (None, None, []),
])
def test_labels(text, label, want):
    assert P.labels(text, label) == want


@settings(max_examples=60)
@given(st.text(alphabet="FIG. 3042AB,and pump\n", max_size=120))
def test_labels_end_and_native_bare_labels_are_bounded(text):
    assert len(P.labels(text, "FIG. 3")) <= 100


def test_bare_labels_native(spark):
    df = spark.createDataFrame([("FIG. 3 shows pump 302, 33rd, 302 and 304a.", "FIG. 3"), ("none", None), (None, None)], "t string, l string")
    got = [r[0] for r in df.select(X.bare_labels(F.col("t"), X.figure_prefixes(F.col("l"), F.col("t")))).collect()]
    assert got == [["302", "304A"], None, None]


PARAGRAPHS = ["FIG. 1 is a view.", "It has a pump 10.", "FIG. 2 is another.", "FIG. 1 again."]


def plain_figure_text(paragraphs, captions, number):
    """The paragraphs on one figure: from the first that refers to it to the next that refers to others only, two at least.

    Without a usable number or without any mention: the first two paragraphs; without paragraphs the first two captions.
    """
    paragraphs = [p for p in paragraphs if p and p.strip()] if paragraphs is not None else []
    captions = [c for c in captions if c and c.strip()] if captions is not None else []
    target = P.canonical_number(number)
    if not paragraphs:
        return " ".join(captions[:2])
    if not target:
        return " ".join(paragraphs[:2])
    refs = [{c for c in map(P.canonical_number, re.findall(V.FIGURE, p, re.I)) if c} for p in paragraphs]
    start = next((i for i, r in enumerate(refs) if target in r), None)
    if start is None:
        flat = target.replace("-", "")
        squeezed = (re.sub(r"[ .,\-]", "", p.upper()) for p in paragraphs)
        start = next((i for i, p in enumerate(squeezed) if "FIG" in p and flat in p), None)
    if start is None:
        return " ".join(paragraphs[:2])
    end = next((i for i in range(start + 1, len(paragraphs)) if refs[i] and target not in refs[i]), len(paragraphs))
    chosen = paragraphs[start:end]
    if len(chosen) < 2 and start + 1 < len(paragraphs) and paragraphs[start + 1] not in chosen:
        chosen.append(paragraphs[start + 1])
    return " ".join(chosen)


@pytest.mark.parametrize("paragraphs, captions, number, want", [
    (PARAGRAPHS, [], "1", " ".join(PARAGRAPHS[:2])), (PARAGRAPHS, [], "2", " ".join(PARAGRAPHS[2:])), (PARAGRAPHS, [], None, " ".join(PARAGRAPHS[:2])),
    ([], ["a", " ", "b", "c"], "1", "a b"), (None, None, "1", ""), (["x FIG11 y", "z"], [], "1", "x FIG11 y z"), (PARAGRAPHS, [], "9", " ".join(PARAGRAPHS[:2])),
])
def test_figure_text(spark, paragraphs, captions, number, want):
    assert plain_figure_text(paragraphs, captions, number) == want
    assert native_figure_texts(spark, [(paragraphs, captions, number)]) == [want]


def native_figure_texts(spark, rows):
    none = F.array().cast("array<string>")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p array<string>, c array<string>, n string")
    df = df.select("i", *[F.filter(F.coalesce(F.col(x), none), lambda t: F.trim(t) != "").alias(x) for x in "pc"], X.figure_number(F.col("n")).alias("n")).withColumn("r", X.figure_refs(F.col("p")))
    return [r.t for r in X.with_figure_text(df, "p", "r", "c", "n", "t").orderBy("i").collect()]


def test_figure_text_natively_as_plainly(spark):
    rnd = random.Random(5)
    bits = ["FIG. 1 shows a pump.", "FIG. 2A is a view.", "In FIGS. 3 and 4 the rod", "FIG. 11 too", "fig-1 again", "no figure here", " ", "Figure 003", "FIG 3-1.", "FIG. 2A and FIG. 1", None]
    rows = [([rnd.choice(bits) for _ in range(rnd.randrange(7))], [rnd.choice(bits) for _ in range(rnd.randrange(4))], rnd.choice(["1", "2A", "3", "11", "", "3-1", "x", None, "9"])) for _ in range(300)]
    assert native_figure_texts(spark, rows) == [plain_figure_text(*r) for r in rows]


def word(text, x, y=0):
    return {"text": text, "x": x, "y": y, "w": 10, "h": 10, "cx": x + 5, "cy": y + 5}


@pytest.mark.parametrize("words, want", [
    (["FIG.", "3A"], ["3A"]), (["FIGS.", "3"], []), (["FIG.3"], ["3"]), (["Fig", "–", "3", "-", "4"], ["3-4"]), (["FIG.", "3", "shows"], ["3"]), (["FIG.", "3-"], []),
    (["FIG.", "1", "FIG.", "2"], ["1", "2"]), (["FIG.", "12345"], []), (["FIGURE", "(7)"], ["7"]), ([], []), (["FIG."], []),
])
def test_page_labels(words, want):
    assert [x["num"] for x in P.page_labels([word(t, 20 * i) for i, t in enumerate(words)])] == want


def test_page_labels_box_and_line():
    found = P.page_labels([word("FIG.", 0), word("3A", 20), word("shows", 40)])
    assert found[0] == {"label": "FIG. 3A", "num": "3A", "x": 0, "y": 0, "w": 30, "h": 10, "cx": 15, "cy": 5, "row_y": 5, "col_x": 15}
    assert P.page_labels([word("FIG.", 0), word("3", 20, 100)]) == []


@pytest.mark.parametrize("w, h, want", [(3000, 1500, (2048, 1024, 0, 512)), (1500, 1200, (1500, 1200, 274, 424)), (2048, 2048, (2048, 2048, 0, 0)), (100000, 1, (2048, 1, 0, 1023))])
def test_letterbox(spark, w, h, want):
    m = spark.createDataFrame([(w, h)], "w int, h int").select(X.letterbox(F.col("w"), F.col("h")).alias("m")).first().m
    assert (m.resized_width, m.resized_height, m.offset_x, m.offset_y) == want and m.scale <= 1


def test_letterbox_of_nothing(spark):
    rows = spark.createDataFrame([(0, 5), (None, 5)], "w int, h int").select(X.letterbox(F.col("w"), F.col("h")).alias("m")).collect()
    assert [r.m for r in rows] == [None, None]


def test_prompt(spark):
    df = spark.createDataFrame([("FIG. 3 shows the pump 302 coupled to the valve 304.", "FIG 3", "A pump"), (None, None, None)], "fig_text string, fig_label string, claims_subset string")
    full, empty = [r.prompt for r in pipeline.with_prompt(df).collect()]
    assert "Figure: FIG. 3." in full and "Type: mechanical" in full and "Labels: 302, 304" in full and full.endswith("Constraints: A pump.")
    assert "Figure: {unknown}" in empty and "Objects: {unspecified}" in empty and "Labels: if present" in empty


@pytest.mark.parametrize("word_, want", [("connected", "connect"), ("generically", "generic"), ("ponies", "poni"), ("running", "run"), ("national", "nation"), ("happy", "happi"), ("hoping", "hope"), ("sky", "sky"), ("consisting", "consist"), ("valves", "valv")])
def test_stem(word_, want):
    assert stem(word_) == want


def test_short_side():
    words = "the pump of the large red valve is connected to".split()
    assert P.short_side(words, tail=False) == ["pump", "of", "the", "large"]
    assert P.short_side(["connected", "pump"], tail=False) == [] and P.short_side(words, tail=True) == ["red", "valve", "is", "connected"] and P.short_side([], tail=True) == []


def test_relations_of_all_sections(spark, tmp_path):
    from figloom import queries

    text = "The lid is connected to the box."
    spark.createDataFrame([("a", "caption", text), ("b", "claim", text), ("c", None, text), ("c", None, text)], "doc_id string, section string, content string").write.parquet(str(tmp_path / "text_fts.parquet"))
    rows = queries.relations(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.section) for r in rows) == [("a", "caption"), ("b", "claim"), ("c", None)]
    assert len({str(r.relations) for r in rows}) == 1 and rows[0].relations

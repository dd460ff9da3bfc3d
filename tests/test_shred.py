import random
import xml.etree.ElementTree as ET

from hypothesis import given, settings, strategies as st

from figloom.operators import metadata as M, shred as S

BODY = """<?xml version="1.0"?><n:doc xmlns:n="u" lang="EN" file="A.XML"><bibliographic-data><document-id><country>US</country><doc-number>7</doc-number><kind>A1</kind></document-id>
<invention-title>A <b>fine</b> lid</invention-title></bibliographic-data>
<drawings><figure num="1"><img file="a.tif"/><figcaption>FIG. 1 &amp; more</figcaption></figure><figure num="2"/></drawings>
<description><p id="p1">One &lt;x&gt; two</p><text>FIG. 2A shows<figref>it</figref></text><p/></description>
<n:claims><n:claim id="c1" claim-type="independent"><n:claim-text id="t1">1. A lid:<n:claim-text>part one<n:claim-text id="t3">deep</n:claim-text></n:claim-text><n:claim-text>part two</n:claim-text></n:claim-text></n:claim>
<n:claim><n:claim-text>2. The lid of <claim-ref>1</claim-ref>, a method.</n:claim-text></n:claim><n:claim/></n:claims></n:doc>"""


def brute(body):
    root, out, claims = ET.fromstring(body), [], 0
    name = lambda e: e.tag.rpartition("}")[2]
    for claim in (e for e in root.iter() if name(e) == "claim"):
        claims += 1
        n = 0
        stack = [(claim, 0)]
        while stack:
            e, parent = stack.pop()
            if e is not claim and name(e) == "claim-text":
                n += 1
                out.append((claims, n, parent))
                parent = n
            stack.extend((c, parent) for c in reversed(e))
    return out


def tree(depth, rnd):
    inner = "".join(tree(depth - 1, rnd) for _ in range(rnd.randrange(3))) if depth else ""
    return rnd.choice([f"<claim-text>{inner}</claim-text>", f"<b>{inner}</b>", f"<claim-text>x{inner}</claim-text>"])


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6))
def test_round_trip_of_any_tree(seed):
    rnd = random.Random(seed)
    body = "<d><claims>" + "".join(f"<claim>{''.join(tree(4, rnd) for _ in range(rnd.randrange(4)))}</claim>" for _ in range(rnd.randrange(4))) + "</claims></d>"
    for texts in (False, True):
        assert [x[:3] for x in S.claim_tree(S.shred_body(body, texts))] == brute(body)


def test_levels():
    assert S.levels([(1, "a"), (2, "b"), (3, "c"), (2, None), (1, "d")], 2) == ([0, 2, 1], [3, 2, 1], ["b", None, None])
    assert S.levels([], 1) == ([0], [0], [None])
    assert S.nodes([0, 2, 1], [3, 2, 1], 2) == [1, 2, 2, 1]


def test_flat_tables(spark):
    bodies = [("a", BODY), ("b", "<d/>"), ("c", "<d>"), ("d", None), ("e", ""), ("f", "<d>&nope;</d>"), ("a", BODY)]
    shredded = S.shred(spark.createDataFrame([(k, b, 1) for k, b in bodies], "xml_path string, body string, leaf int"), "xml_path", "body", texts=True)
    of = lambda name: sorted({tuple(r) for r in S.assembled(shredded, name).collect()}, key=str)
    docs = {r[0]: r[1:] for r in of("documents")}
    assert docs["a"] == (None, "doc", "EN", "A.XML", "A fine lid", "US", "7", "A1")
    assert docs["b"][:2] == (None, "d") and all(docs[k][0] for k in "cdef")
    assert of("figures") == [("a", 1, "1", "a.tif", "FIG. 1 & more"), ("a", 2, "2", None, None)]
    assert of("paragraphs") == [("a", 1, "p1", None, "One <x> two"), ("a", 2, None, None, "FIG. 2A shows it"), ("a", 3, None, None, "")]
    assert [r[:4] for r in of("claims")] == [("a", 1, "c1", "independent"), ("a", 2, None, None), ("a", 3, None, None)]
    parts = of("claim_parts")
    assert [r[1:5] for r in parts] == [(1, 1, 0, "t1"), (1, 2, 1, None), (1, 3, 2, "t3"), (1, 4, 1, None), (2, 1, 0, None)]
    assert [r[5] for r in parts] == ["1. A lid: part one deep part two", "part one deep", "deep", "part two", "2. The lid of 1 , a method."]
    assert {tuple(r) for r in S.claim_nodes(S.shred(spark.createDataFrame([("a", BODY)], "xml_path string, body string"), "xml_path", "body")).collect()} == {r[:4] for r in parts}


def test_empty_table_and_long_body(spark):
    empty = spark.createDataFrame([], "xml_path string, body string")
    assert S.assembled(S.shred(empty, "xml_path", "body", texts=True), "claims").count() == 0
    deep = "<d><claim>" + "<claim-text>x" * 300 + "</claim-text>" * 300 + "</claim></d>"
    assert len(S.claim_tree(S.shred_body(deep, texts=False))) == 300
    wide = "<d><claim>" + "<claim-text>word </claim-text>" * 20000 + "</claim></d>"
    assert len(S.claim_tree(S.shred_body(wide))) == 20000


def test_metadata(spark):
    body = """<d><description><brief-description-of-drawings><description-of-drawings><p>FIG. 1 is a view.</p></description-of-drawings></brief-description-of-drawings><paragraph>See FIG. 2a.</paragraph><p/></description>
    <drawings><figure><figcaption>FIG. 10</figcaption></figure><p> </p></drawings><figures><figure><caption>cap</caption></figure></figures>
    <claims><claim> </claim><claim type="dependent"><claim-text>2. A lid, not a <b>methodical</b> one.</claim-text><claim-text>method</claim-text></claim><claim><claim-text>A Method of use.</claim-text></claim></claims></d>"""
    rows = M.with_metadata(spark.createDataFrame([("a", body), ("b", "<d>"), ("c", None)], "k string, body string"), "k", "body").collect()
    a, b, c = rows
    assert a.paragraphs == ["FIG. 1 is a view.", "See FIG. 2a.", ""] and a.titles == ["FIG. 1 is a view.", "FIG. 10", "cap"]
    assert a.figure_nums == ["1", "10", "2A"] and a.first_claim == "" and a.method_claim == "A Method of use."
    assert a.claims == "2. A lid, not a methodical one. method A Method of use." and [x.independent for x in a.claim_list] == [True, False, True]
    assert b.error and c.error and b.claims == "" and b.method_claim is None and b.figure_nums == []
    sections = M.text_sections(M.with_metadata(spark.createDataFrame([("a", body)], "k string, body string"), "k", "body"), "k").collect()
    assert {r.section: r.content for r in sections}["caption"] == "FIG. 1 is a view.\nFIG. 10\ncap"


def test_every_leaf_comes_out(spark):
    body = """<d><parties><applicants><applicant sequence="1"><orgname>Lid Co</orgname></applicant><applicant sequence="2"><addressbook><country>DE</country></addressbook></applicant></applicants></parties>
    <drawings><figure num="1"><img file="a.tif" he="9"/><img file="b.tif"/><caption>one</caption><p>two</p></figure></drawings>
    <description><p id="p1">See <figref idref="f1">FIG. 1</figref> now</p><n:p xmlns:n="u" n:num="2"/></description>
    <claims><claim num="1"><claim-text>A<b>x<claim-text>deep</claim-text></b></claim-text></claim><claim num="2"><claim-text>Lid of <claim-ref idref="c1">claim 1</claim-ref></claim-text></claim></claims></d>"""
    rows = [r[1:] for r in S.leaves(spark.createDataFrame([("a", body), ("b", "<d>"), ("c", None)], "xml_path string, body string"), "xml_path", "body").collect()]
    name = lambda t: t.rpartition("}")[2]
    want = []

    def visit(e, path):
        path = [*path, name(e.tag)]
        texts = " ".join(x for x in (str(t).strip() for t in [e.text or "", *(c.tail or "" for c in e)]) if x)
        want.append(("/".join(path), texts or None))
        want.extend(("/".join([*path, "@" + name(k)]), v) for k, v in e.attrib.items())
        for c in e:
            visit(c, path)

    visit(ET.fromstring(body), [])
    assert [(r[6], r[9]) for r in rows] == want
    at = {(r[6].rpartition("d/")[2], r[9]): r for r in rows}
    assert at["drawings/figure/img/@file", "b.tif"][2] == 1 and at["drawings/figure/p", "two"][2] == 1
    assert at["description/p/figref/@idref", "f1"][3] == 1 and at["description/p/@num", "2"][3] == 2
    assert at["claims/claim/claim-text/claim-ref/@idref", "c1"][4:6] == (2, 1) and at["claims/claim/@num", "2"][4:6] == (2, 0)
    assert at["claims/claim/claim-text/b/claim-text", "deep"][4:6] == (1, 2)
    assert [r[7:9] for r in rows if r[6].endswith("applicant/@sequence")] == [(0, 5), (3, 5)]
    assert all(r[1] < r[0] for r in rows)


def test_p6_found_takes_the_full_shredding(spark, tmp_path, monkeypatch):
    from figloom import p_general

    spark.createDataFrame([("a", BODY)], "xml_path string, body string").write.parquet(str(tmp_path / "xml_files.parquet"))
    seen = []
    monkeypatch.setattr(S, "claim_nodes", lambda shredded, nodes=S.claim_nodes: seen.append(shredded) or nodes(shredded))
    assert p_general.p6_found(spark, str(tmp_path)).count() == 5
    assert {"claim", "paragraph", "figure/caption"} <= {c.leaf for r in seen[0].collect() for c in r["columns"]}

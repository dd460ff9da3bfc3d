import io
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from figloom.functions import images as I
from figloom.operators import fts
from figloom.operators.store import Store, latest, merged, session_info
from figloom.plans import pipeline
from figloom.shared import new_path
from figloom.sources import bundles as B, pages, sinks
from figloom.streaming.ingest import ingest


def tiff(page, bits=8):
    h, w = page.shape
    raw = page.astype(np.uint8).tobytes() if bits == 8 else np.packbits(page > 127, axis=1).tobytes()
    tags = [(256, 4, w), (257, 4, h), (258, 3, bits), (259, 3, 1), (262, 3, 1), (273, 4, 8 + 2 + 12 * 8 + 4), (277, 3, 1), (279, 4, len(raw))]
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHI", t, k, 1) + (struct.pack("<I", v) if k == 4 else struct.pack("<HH", v, 0)) for t, k, v in tags) + struct.pack("<I", 0)
    return b"II*\0" + struct.pack("<I", 8) + ifd + raw


PAGE = np.full((30, 50), 255, np.uint8)
PAGE[10:20, 10:30] = 0
XML = "<d><description><p>FIG. 1 shows a pump 10 coupled to the valve 12.</p></description><claims><claim><claim-text>1. A pump.</claim-text></claim></claims></d>"


def bundle(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members:
            z.writestr(name, content)


@pytest.fixture()
def raw(tmp_path):
    page = tiff(PAGE)
    root = tmp_path / "raw"
    bundle(root / "us-1.zip", [("x/US1.XML", XML), ("x/US1-D00001.TIF", page), ("x/US1-D00000.TIF", page)])
    bundle(root / "deep/down/US2.ZIP", [("US2.xml", XML), ("a.tif", b"broken"), ("b.tiff", page)])
    bundle(root / "two.zip", [("a.xml", XML), ("b.xml", XML), ("a.tif", page)])
    bundle(root / "none.zip", [("a.tif", page)])
    bundle(root / "bare.zip", [("a.xml", XML)])
    bundle(root / "mol.zip", [("a.xml", XML), ("a.tif", page), ("a.MOL", b"")])
    bundle(root / "again/us-1.zip", [("US1.XML", "<d/>"), ("z.tif", page)])
    (root / "bad.zip").write_bytes(b"PK nothing")
    return str(root)


def test_bundles(spark, raw):
    scanned = B.scan_bundles(spark, raw)
    names = {r.path.rsplit("/", 1)[-1]: r for r in B.members(scanned).withColumn("ok", B.is_bundle(F.col("names"))).collect()}
    assert len(names) == 7 and names["bad.zip"].names is None and not names["bad.zip"].ok and not names["two.zip"].ok and not names["mol.zip"].ok and names["US2.ZIP"].ok
    docs = {r.doc_id: r for r in B.index_bundles(scanned).collect()}
    assert docs.keys() == {"US1", "US2"} and docs["US1"].tiffs == ["data/work/extracted/US1/z.tif"]
    forced = {r.doc_id: r for r in B.index_bundles(scanned, force=True).collect()}
    assert forced["US1"].tiffs == ["data/work/extracted/US1/US1-D00000.TIF", "data/work/extracted/US1/US1-D00001.TIF"]
    known = spark.createDataFrame([("US1",)], "doc_id string")
    assert [r.doc_id for r in B.index_bundles(scanned, known).collect()] == ["US2"]
    assert B.index_bundles(scanned, known, force=True).count() == 2


def test_index_is_incremental_and_streaming_agrees(spark, raw, tmp_path):
    batch, stream = Store(spark, f"file://{tmp_path}/a"), Store(spark, f"file://{tmp_path}/b")
    pipeline.index(spark, raw, batch)
    pipeline.index(spark, raw, batch)
    for _ in range(2):
        ingest(spark, raw, stream, f"file://{tmp_path}/ck")
    assert sorted(map(str, batch.read("docs").collect())) == sorted(map(str, stream.read("docs").collect())) and batch.read("docs").count() == 2


def test_build_end_to_end(spark, raw, tmp_path):
    def ocr(page):
        assert page.mean() >= 127
        return [{"text": t, "x": 10 * i, "y": 0, "w": 8, "h": 8, "cx": 10 * i + 4, "cy": 4} for i, t in enumerate(["FIG.", " ", "1"])]

    store, out = Store(spark, f"file://{tmp_path}/db"), str(tmp_path / "rows")
    only = spark.createDataFrame([("US2",)], "doc_id string")
    told = pipeline.build(spark, raw, store, out, ocr=ocr, split=only).first()
    assert tuple(told) == (1, 2, 1)
    row = json.loads(next((tmp_path / "rows").glob("part-*.json")).read_text())
    assert row["id"] == "US2:US2_b_FIG_1.png".replace("FIG_1", "FIG__1") and row["label_in_xml"] and row["bbox"] == [0, 0, 50, 30] and "coupled to" in row["prompt"]
    assert row["resize_meta"]["canvas_size"] == 2048 and row["prompt"].endswith("Constraints: 1. A pump..")
    assert store.read("figures").count() == 1 and store.read("text_fts").count() == 3
    pipeline.build(spark, raw, store, out, ocr=ocr, split=only)
    assert {r.relname: r.n_rows for r in store.counts().collect()} == {"docs": 0, "figures": 1, "text_fts": 3}
    assert fts.search(pipeline.text_index(store), "pumps").count() >= 1


def test_pages_that_fail_are_kept(spark):
    df = spark.createDataFrame([("ok", tiff(PAGE)), ("bit", tiff(PAGE, 1)), ("bad", b"II*"), ("null", None)], "page_id string, content binary")
    got = {r.page_id: r for r in pages.process_pages(df, canvas=64).collect()}
    assert (got["ok"].width, got["ok"].height) == (50, 30) and got["ok"].png[:4] == b"\x89PNG" and got["bit"].width == 50
    assert got["bad"].png is None and got["null"].width is None
    assert pages.labelled(pages.process_pages(df, canvas=64), 64).count() == 2


def test_single_figure(spark):
    df = spark.createDataFrame([(["3"],), (["3", "4"],), ([],), (None,), (["3", "3"],)], "n array<string>")
    labels = F.transform("n", lambda x: F.struct(x.alias("num")))
    assert [tuple(r.f) for r in df.select(pages.single_figure(labels).alias("f")).collect()] == [(True, "FIG. 3"), (False, None), (True, None), (True, None), (True, "FIG. 3")]


def test_image_functions():
    assert set(np.unique(I.binarized(PAGE))) == {0, 255} and I.dark_on_light(255 - PAGE).mean() > 127
    made = I.padded(PAGE, 64)
    assert made.shape == (64, 64) and (made[17:47, 7:57] == PAGE).all()
    small = I.padded(PAGE, 25)
    assert small.shape == (25, 25) and abs(int(small[:5].mean()) - 255) < 2
    edge = I.edges(PAGE)
    assert edge[10, 15] or edge[9, 15] and not edge[15, 20] and not edge[0, 0]
    tilted = I.deskewed(np.where(np.add.outer(np.arange(80), -0.1 * np.arange(120)).astype(int) % 20 < 2, 0, 255).astype(np.uint8))
    assert tilted.shape == (80, 120)
    assert I.grown_box(PAGE, (15, 12, 20, 15), step=4, margin=2) == (5, 6, 34, 23) or I.grown_box(PAGE, (15, 12, 20, 15), step=4, margin=2)[0] < 10
    for bad in (b"", b"PK", tiff(PAGE)[:20]):
        with pytest.raises(ValueError):
            I.read_tiff(bad)
    with pytest.raises(ValueError):
        I.padded(np.zeros((0, 5), np.uint8))
    assert (I.read_tiff(tiff(PAGE)) == PAGE).all() and (I.read_tiff(tiff(PAGE, 1)) == PAGE).all()


def test_png_is_read_by_the_engine(spark, tmp_path):
    (tmp_path / "p.png").write_bytes(I.write_png(PAGE))
    row = pages.read_images(spark, f"file://{tmp_path}").select("image.*").first()
    assert (I.grey(bytes(row.data), row.height, row.width, row.nChannels) == PAGE).all()


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/db")
    store.create()
    docs = spark.createDataFrame([("a", "x", ["1", "2"]), ("b", "y", None)], "doc_id string, xml string, tiffs array<string>")
    store.upsert("docs", docs)
    store.upsert("docs", docs.limit(1).withColumn("xml", F.lit("new")).withColumn("extra", F.lit(1)))
    store.create()
    assert {r.doc_id: r.xml for r in store.read("docs").collect()} in ({"a": "new", "b": "y"}, {"a": "x", "b": "new"})
    assert {r.doc_id: r.tiff_count for r in store.overview().collect()} == {"a": 2, "b": 0} and spark.table("doc_overview").count() == 2
    store.upsert("text_fts", spark.createDataFrame([("a", "claim", "c"), ("z", "claim", None)], "doc_id string, section string, content string"))
    assert {r.relname: (r.n_rows, r.n_orphans) for r in store.integrity().collect()} == {"docs": (2, 0), "figures": (0, 0), "text_fts": (2, 1)}
    store.delete_documents(spark.createDataFrame([("a",), ("a",), (None,)], "doc_id string"))
    assert [r.doc_id for r in store.read("docs").collect()] == ["b"] and [r.doc_id for r in store.read("text_fts").collect()] == ["z"]
    store.vacuum()
    store.clear()
    assert all(r.n_rows == 0 for r in store.counts().collect())
    assert session_info(spark).count() == 1


def test_latest_and_merge(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, None, "n"), (None, 1, "m")], "k string, o int, v string")
    assert {r.k: r.v for r in latest(df, ["k"], [F.col("o")]).collect()} == {"a": "z", None: "m"}
    new = spark.createDataFrame([("a", 0, "q"), ("b", 0, "r")], "k string, o int, v string")
    once = merged(df, new, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, merged(once, new, ["k"]).collect()))
    assert {r.k: r.v for r in once.collect()}["a"] == "q"
    assert latest(df.limit(0), ["k"], [F.col("o")]).count() == 0


def test_text_index(spark):
    df = spark.createDataFrame([("a", "claim", "The valves and the valve; gear"), ("b", "claim", "gear"), ("c", "claim", None), ("d", "claim", "")], "doc_id string, section string, content string")
    found = fts.index(df)
    assert {(r.term, r.doc_id): (r.n, r.first_position) for r in found.collect()} == {("valv", "a"): (2, 1), ("gear", "a"): (1, 5), ("gear", "b"): (1, 0)}
    assert [r.doc_id for r in fts.search(found, "gears valve").collect()] == ["a"] and fts.search(found, "the").count() == 0 and fts.search(found, "").count() == 0


def test_sinks(spark, tmp_path):
    images = tmp_path / "img"
    images.mkdir()
    (images / "a.png").write_bytes(b"x")
    rows = spark.createDataFrame([("img/a.png", "cap é"), ("img/b.png", "two"), ("", "no"), ("img/a.png", " "), (None, None)], "image_path string, prompt string")
    pairs = sinks.caption_pairs(rows)
    told = sinks.export_captions(pairs, [str(tmp_path)], str(tmp_path / "out")).first()
    assert (told.written, told.missing, told.first_missing) == (1, 1, ["img/b.png"]) and (tmp_path / "out/a.txt").read_text() == "cap é"
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.png").write_bytes(b"y")
    both = sinks.caption_pairs(spark.createDataFrame([("img/a.png", "one"), ("two/a.png", "two")], "image_path string, prompt string"))
    assert sinks.export_captions(both, [str(tmp_path)], str(tmp_path / "out2")).first().written == 2
    assert len(list((tmp_path / "out2").glob("*_a.png"))) == len(list((tmp_path / "out2").glob("*_a.txt"))) == 2
    there = spark.createDataFrame([("/y/p",), ("/y/p",), ("/x/r",), ("/y/r",)], "path string")
    df = spark.createDataFrame([("p",), ("/abs",), ("q",), ("r",), (None,), ("p",)], "p string")
    assert sorted((str(r.p), r.resolved) for r in sinks.resolve_paths(df, "p", ["/x", "/y"], there).collect()) == [("/abs", "/abs"), ("None", None), ("p", "/y/p"), ("p", "/y/p"), ("q", "/x/q"), ("r", "/x/r")]
    out = new_path(spark, "rows")
    sinks.write_rows(rows, out)
    assert sinks.read_rows(spark, out, rows.schema).count() == 5 and all("prompt" in r.value for r in spark.read.text(out).collect())
    assert sinks.export_files(spark.createDataFrame([("a.bin", b"1"), ("b.bin", None)], "n string, c binary"), "n", "c", str(tmp_path / "bin")) == 1
    assert [r.line for r in sinks.tab_lines(spark.createDataFrame([(1, None, "x")], "a int, b string, c string")).collect()] == ["1\t\tx"]


def test_captions_job(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"x")
    out = new_path(spark, "rows")
    sinks.write_rows(spark.createDataFrame([("1", "a.png", "cap")], "id string, image_path string, prompt string"), out)
    assert pipeline.captions(spark, out, str(tmp_path / "o"), [str(tmp_path)]).first().written == 1


def test_command_line(spark, raw, tmp_path, capsys, monkeypatch):
    from figloom.__main__ import main
    from figloom.session import warehouse

    monkeypatch.delenv("FIGLOOM_WAREHOUSE", raising=False)
    with pytest.raises(ValueError):
        warehouse()
    monkeypatch.setenv("FIGLOOM_WAREHOUSE", f"file://{tmp_path}/db")
    for command in (["init"], ["index", raw], ["fts", raw], ["counts"], ["integrity"], ["vacuum"], ["overview"], ["info"]):
        main(command)
    shown = capsys.readouterr().out
    assert "text_fts" in shown and "tiff_count" in shown and Store(spark, warehouse()).read("docs").count() == 2
    main(["clear"])
    assert Store(spark, warehouse()).read("docs").count() == 0


_ = io


def test_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/db")
    store.create()
    rows = [(f"D{i}", f"x{i}", [f"t{i}", None]) for i in range(200)]
    schema = "doc_id string, xml string, tiffs array<string>"
    store.upsert("docs", spark.createDataFrame(rows + rows[:3] + [(None, "n", None)], schema))
    before = store.versions("docs")
    store.upsert("docs", spark.createDataFrame([("D7", "new", None)], schema))
    after = store.versions("docs")
    assert sum(before[k] != after[k] for k in after) == 1 and before.keys() == after.keys()
    got = {r.doc_id: r.xml for r in store.read("docs").collect()}
    assert len(got) == 201 and got["D7"] == "new" and got["D8"] == "x8" and got[None] == "n" and store.read("docs").count() == 201
    store.vacuum()
    assert store.read("docs").count() == 201
    store.upsert("docs", spark.createDataFrame([], schema))
    assert store.read("docs").count() == 201 and store.statistics().where("relname = 'docs'").first().n_rows == 201


def test_made_images_come_back():
    import numpy as np

    from figloom.functions import images as I

    page = np.random.default_rng(1).integers(0, 256, (7, 5), dtype=np.uint8)
    assert (I.read_tiff(I.write_tiff(page)) == page).all() and (I.read_png(I.write_png(page)) == page).all()
    import struct
    import zlib

    rows, above = b"", np.zeros(5, np.uint8)
    for y, line in enumerate(page):  # every filter
        how, left = y % 5, np.concatenate([[0], line[:-1]]).astype(int)
        corner = np.concatenate([[0], above[:-1]]).astype(int)
        up = above.astype(int)
        guess = [left * 0, left, up, (left + up) // 2, np.array([min((a, b, c), key=lambda v: abs(a + b - c - v)) for a, b, c in zip(left, up, corner)])][how]
        rows += bytes([how]) + ((line.astype(int) - guess) % 256).astype(np.uint8).tobytes()
        above = line
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 7, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
    assert (I.read_png(png) == page).all()
    with pytest.raises(ValueError):
        I.read_png(b"x")

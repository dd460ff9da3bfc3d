"""The jobs: index bundles, build the dataset, fill the text index, export captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.functions import phrases as P, text as X
from figloom.functions.names import stem
from figloom.operators import fts, metadata
from figloom.operators.store import Store
from figloom.shared import written
from figloom.sources import bundles as B, pages, sinks

#: The prompt's own wording; every field is filled by one text function.
TEMPLATE = ("Clean black line drawing of a technical figure on white. Figure: ", ". Type: ", ". View: ", ". Objects: ", ". Relations: ", ". Labels: ", ". Avoid: grey tones, colour, photo look.")
KEYWORDS = 14


def top_keywords(df: DataFrame, key: str, text: str, k: int = KEYWORDS) -> DataFrame:
    """key, keywords: the k most frequent keywords, ties by first occurrence, comma-joined. Only rows with a keyword.

    ``key`` must be unique. Counting combines on the map side; a group of the window is one text's distinct words.
    """
    words = df.select(key, F.posexplode(F.transform(X.words(F.col(text)), F.lower)).alias("pos", "word")).where(X.is_keyword(F.col("word")))
    counted = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "word")))
    return counted.groupBy(key).agg(F.array_join(F.transform(F.slice(ranked, 1, k), lambda x: x.word), ", ").alias("keywords"))


def with_prompt(rows: DataFrame, text: str = "fig_text", label: str = "fig_label", claims: str | None = "claims_subset") -> DataFrame:
    """Adds ``prompt``. Each Python function runs once per row; the others are native on the same cleaned text."""
    base = rows.withColumn("_t", X.clean(F.col(text)))
    base = base.withColumn("_relations", P.relation_phrases(F.col("_t"))).withColumn("_labels", P.label_phrases(F.col("_t"), F.col(label))).withColumn("_objects", P.keyword_phrase(F.col("_t")))
    objects = F.coalesce(F.nullif(F.col("_objects"), F.lit("")), F.lit("{unspecified}"))
    fields = [X.figure_display(F.col(label)), X.diagram_class(F.col("_t")), X.view_cue(F.col("_t")), objects, F.col("_relations"), F.col("_labels")]
    parts = [x for t, f in zip(TEMPLATE, fields) for x in (F.lit(t), f)] + [F.lit(TEMPLATE[-1])]
    if claims:
        parts.append(F.when(F.length(claims) > 0, F.concat(F.lit(" Constraints: "), F.col(claims), F.lit("."))).otherwise(""))
    return base.withColumn("prompt", F.concat(*parts)).drop("_t", "_relations", "_labels", "_objects")


def figure_rows(figures: DataFrame, meta: DataFrame) -> DataFrame:
    """Figures (doc_id, tiff_path, fig_label, width, height, ...) as dataset rows.

    Kept: pages that aren't cover sheets and whose label's number is named in the document's
    text. ``meta``: the output of ``with_metadata`` by doc_id, parsed once per document.
    """
    number = X.label_number(F.col("fig_label"))
    known = figures.where(~X.is_cover_sheet(F.col("tiff_path"))).withColumn("fig_num", number).where("fig_num IS NOT NULL")
    met = known.join(meta.drop("error"), "doc_id").where(F.array_contains("figure_nums", F.col("fig_num")))
    met = met.withColumns({f"_{c}": F.filter(c, lambda x: F.trim(x) != "") for c in ("paragraphs", "titles")}).withColumn("_refs", X.figure_refs(F.col("_paragraphs")))
    met = X.with_figure_text(met, "_paragraphs", "_refs", "_titles", "fig_num").drop("_paragraphs", "_titles", "_refs")
    kind = X.diagram_class(F.col("fig_text"))
    met = with_prompt(met.withColumn("claims_subset", X.claims_source(kind, F.col("method_claim"), F.col("first_claim"), F.col("claims"))))
    name = F.concat(F.col("doc_id"), F.lit("_"), stem(F.col("tiff_path")), F.lit("_"), X.file_token(F.col("fig_label")))
    file = F.concat(name, F.lit(".png"))
    whole = F.array(F.lit(0), F.lit(0), F.col("width"), F.col("height"))
    return met.select(
        F.concat(F.col("doc_id"), F.lit(":"), file).alias("id"), F.concat(F.lit("data/work/images/"), file).alias("image_path"), F.concat(F.lit("data/work/control/"), name, F.lit("_canny.png")).alias("control_path"),
        "prompt", F.col("source_xml"), "doc_id", F.col("sha256"), whole.alias("bbox"), whole.alias("bbox_initial"), F.array("width", "height").alias("original_size"),
        X.letterbox(F.col("width"), F.col("height")).alias("resize_meta"), "fig_label", F.col("tiff_path").alias("tiff_source"), F.lit(True).alias("label_in_xml"),
    )


def index(spark: SparkSession, raw: str, store: Store, force: bool = False) -> DataFrame:
    """Scans ``raw`` for bundles and upserts the new ones (all with ``force``) into docs. Returns what it added."""
    store.create()
    new = B.index_bundles(B.scan_bundles(spark, raw), store.read("docs"), force)
    store.upsert("docs", new)
    return new


def load_sections(store: Store, meta: DataFrame) -> None:
    """Fills text_fts from metadata by doc_id."""
    store.upsert("text_fts", metadata.text_sections(meta))


def build(spark: SparkSession, raw: str, store: Store, out: str, ocr=None, split: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
    """Bundles to dataset rows: parses each document once, reads its pages, writes sections, figures and JSON lines.

    ``split``: doc_id of the documents to build; NULL builds all. ``words``: what an OCR run found before, by
    page_id (the page's path; ``pages.with_words``), instead of ``ocr``. Returns one row of counts.
    """
    files = B.extract(B.scan_bundles(spark, raw))
    if split is not None:
        files = files.join(split.select("doc_id").distinct(), "doc_id", "left_semi")
    files = written(files, "members")  # the archives are opened once
    xml = files.where("kind = 'xml'").groupBy("doc_id").agg(F.min_by(F.struct("name", F.decode("content", "utf-8").alias("body")), "path").alias("x"))
    meta = written(metadata.with_metadata(xml.select("doc_id", "x.body"), "doc_id", "body"), "meta")
    store.create()
    load_sections(store, meta)
    named = xml.select("doc_id", F.concat(F.lit("data/work/extracted/"), "doc_id", F.lit("/"), "x.name").alias("source_xml"))
    path = F.concat(F.lit("data/work/extracted/"), F.col("doc_id"), F.lit("/"), F.col("name"))
    tiffs = files.where("kind = 'tiff'").withColumn("tiff_path", path).where(~X.is_cover_sheet(F.col("tiff_path")))
    todo = tiffs.join(meta.where("size(figure_nums) > 0").select("doc_id"), "doc_id", "left_semi")
    page = todo.groupBy("tiff_path").agg(F.min_by(F.struct("doc_id", "content"), "path").alias("p")).select(F.col("tiff_path").alias("page_id"), "p.doc_id", "p.content")
    made = pages.process_pages(page.select("page_id", "content"), ocr=ocr)
    seen = pages.labelled(made if words is None else pages.with_words(made, words))
    figures = seen.where("fig_label IS NOT NULL").join(page.select("page_id", "doc_id"), "page_id").join(named, "doc_id").withColumn("tiff_path", F.col("page_id")).withColumn("sha256", F.sha2("png", 256))
    rows = figure_rows(figures.select("doc_id", "tiff_path", "fig_label", "width", "height", "source_xml", "sha256"), meta)
    sinks.write_rows(rows, out)
    done = sinks.read_rows(spark, out)
    box = [F.col("bbox")[i].alias(f"bbox_{c}") for i, c in enumerate(("x1", "y1", "x2", "y2"))]
    store.upsert("figures", done.select("id", "doc_id", F.col("tiff_source").alias("tiff_path"), "fig_label", *box))
    return run_summary(xml.select("doc_id"), page, done)


def run_summary(docs: DataFrame, pages_: DataFrame, figures: DataFrame) -> DataFrame:
    one = [t.groupBy().agg(F.count(F.lit(1)).alias(n)).withColumn("_k", F.lit(1)) for t, n in ((docs, "n_docs"), (pages_, "n_pages"), (figures, "n_figures"))]
    return one[0].join(one[1], "_k").join(one[2], "_k").drop("_k")


def text_index(store: Store) -> DataFrame:
    return fts.index(store.read("text_fts"))


def captions(spark: SparkSession, rows_path: str, out: str, bases: list[str]) -> DataFrame:
    """JSON lines to images with captions beside them; one row of counts."""
    return sinks.export_captions(sinks.caption_pairs(sinks.read_rows(spark, rows_path)), bases, out)

"""Queries of the reference's own operators over the test tables, each over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from figloom.functions import phrases as P, text as X
from figloom.functions.names import document_key, family_key, stem
from figloom.operators import fts, metadata, store
from figloom.plans import pipeline
from figloom.sources import sinks
from figloom.sources.tables import spread, table

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _sections(spark: SparkSession, d: str) -> DataFrame:
    """text_fts with exact repeats dropped."""
    return table(spark, d, "text_fts").distinct()


def _lines(content) -> object:
    return F.filter(F.split(F.coalesce(content, F.lit("")), "\n"), lambda s: F.trim(s) != "")


@query
def document_profile(spark, d):
    """Per document text: figure numbers, class, view and keywords."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    keywords = pipeline.top_keywords(docs, "doc_id", "text")
    nums = F.array_join(X.figure_numbers(F.array("text")), ",")
    return docs.select("doc_id", nums.alias("figure_nums"), X.diagram_class(F.col("text")).alias("diagram_class"), X.view_cue(F.col("text")).alias("view")).join(keywords, "doc_id", "left")


@query
def doc_id_norm(spark, d):
    return table(spark, d, "docs").select("xml", document_key(stem(F.col("xml"))).alias("doc_key"))


@query
def filename_token(spark, d):
    return table(spark, d, "figures").select("id", X.file_token(F.col("fig_label")).alias("token"))


@query
def canonical_fig(spark, d):
    return table(spark, d, "figures").select("id", "fig_label", X.label_number(F.col("fig_label")).alias("fig_num"))


@query
def clean_ws(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean(F.col("text")).alias("cleaned"))


@query
def plain_dashes(spark, d):
    return table(spark, d, "figures").select("id", X.plain_dashes(F.col("fig_label")).alias("label"))


@query
def fig_numbers(spark, d):
    return _sections(spark, d).select("doc_id", "section", F.array_join(X.figure_numbers(_lines(F.col("content"))), ",").alias("nums"))


@query
def diagram_class(spark, d):
    return spread(table(spark, d, "text_fts")).select("doc_id", "section", X.diagram_class(F.col("content")).alias("diagram_class"))


@query
def class_counts(spark, d):
    return diagram_class(spark, d).groupBy("section", "diagram_class").agg(F.count(F.lit(1)).alias("n"))


@query
def view_cue(spark, d):
    return table(spark, d, "text_fts").select("doc_id", "section", X.view_cue(F.col("content")).alias("view"))


@query
def keywords_topk(spark, d):
    return pipeline.top_keywords(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")


@query
def sentences(spark, d):
    found = _sections(spark, d).select("doc_id", "section", F.posexplode(X.sentences(F.col("content"))).alias("no", "sentence"))
    return found


@query
def relations(spark, d):
    return _sections(spark, d).select("doc_id", "section", P.relation_phrases(X.clean(F.col("content"))).alias("relations"))


@query
def ref_labels(spark, d):
    s = _sections(spark, d).withColumn("t", X.clean(F.col("content")))
    labels = X.bare_labels(F.col("t"), X.figure_prefixes(F.lit(None).cast("string"), F.col("t")))
    return s.select("doc_id", "section", F.coalesce(F.nullif(F.array_join(labels, ", "), F.lit("")), F.lit("if present")).alias("labels"))


@query
def context_labels(spark, d):
    return _sections(spark, d).select("doc_id", "section", P.label_phrases(X.clean(F.col("content")), F.lit(None).cast("string")).alias("labels"))


def _document_lines(spark, d):
    """Per document key: the lines of its paragraphs with the figures they name, those of its captions, and its claims.

    Repeated sections are taken together in order of their content; nothing is left out.
    """
    s = _sections(spark, d).select(document_key(F.col("doc_id")).alias("doc_key"), "section", "content").where("doc_key IS NOT NULL AND content IS NOT NULL").distinct()
    ordered = lambda name: F.sort_array(F.collect_list(F.when(F.col("section") == name, F.col("content"))))
    by = s.groupBy("doc_key").agg(*[ordered(n).alias(n) for n in ("paragraph", "caption", "claim")])
    lines = by.select("doc_key", *[F.flatten(F.transform(n, _lines)).alias(n) for n in ("paragraph", "caption")], F.array_join(F.filter("claim", lambda c: F.trim(c) != ""), " ").alias("claims"))
    return lines.withColumn("refs", X.figure_refs(F.col("paragraph")))


def _figures(spark, d):
    """The last row of each figure that has a number."""
    figures = store.latest(table(spark, d, "figures"), ["id"], [F.col("recorded_at")])
    return figures.select("id", document_key(F.col("doc_id")).alias("doc_key"), "fig_label", X.label_number(F.col("fig_label")).alias("fig_num")).where("fig_num IS NOT NULL")


def _figure_texts(spark, d, figures, *more):
    """doc_key, fig_num, fig_text, claims and ``more`` of the distinct figures of each document; a document without text gives the empty text.

    A document's text meets the list of its figures once, and only what was chosen for a figure goes on.
    """
    none = F.array().cast("array<string>")
    asked = figures.where("doc_key IS NOT NULL").groupBy("doc_key").agg(F.collect_set(F.struct("fig_num", *more)).alias("asked"))
    met = asked.join(_document_lines(spark, d), "doc_key", "left").select("doc_key", "paragraph", "refs", "caption", "claims", F.inline("asked"))
    whole = met.select("doc_key", "fig_num", *more, "claims", *[F.coalesce(c, none).alias(c) for c in ("paragraph", "caption")], F.coalesce("refs", F.array().cast("array<array<string>>")).alias("refs"))
    return X.with_figure_text(whole, "paragraph", "refs", "caption", "fig_num").select("doc_key", "fig_num", *more, "fig_text", "claims")


@query
def figure_text(spark, d):
    """Figures with a number and a document key, with their text."""
    figures = _figures(spark, d)
    return figures.join(_figure_texts(spark, d, figures), ["doc_key", "fig_num"]).select("id", "fig_num", "fig_text")


@query
def prompt_row(spark, d):
    """The prompt of each figure; made once per document, number and label."""
    figures = _figures(spark, d)
    prompts = pipeline.with_prompt(spread(_figure_texts(spark, d, figures, "fig_label")), claims="claims").select("doc_key", "fig_num", "fig_label", "prompt")
    return figures.join(prompts, ["doc_key", "fig_num", "fig_label"]).select("id", "prompt")


@query
def figure_display(spark, d):
    return table(spark, d, "figures").select("id", X.figure_display(F.col("fig_label")).alias("shown"))


@query
def shortened(spark, d):
    return table(spark, d, "documents").select("doc_id", X.shortened(F.col("text")).alias("short"))


def _meta(spark, d):
    files = store.latest(table(spark, d, "xml_files"), ["xml_path"], [F.col("extracted_at")])
    return metadata.with_metadata(files, "xml_path", "body")


@query
def xml_metadata(spark, d):
    return _meta(spark, d).select("xml_path", F.col("error").isNull().alias("well_formed"), F.size("paragraphs").alias("n_paragraphs"), F.size("titles").alias("n_titles"), F.array_join("figure_nums", ",").alias("figure_nums"))


@query
def claims_first(spark, d):
    return _meta(spark, d).select("xml_path", "first_claim", F.length("claims").alias("claims_chars"))


@query
def claims_method(spark, d):
    return _meta(spark, d).select("xml_path", "method_claim")


@query
def claims_independent(spark, d):
    return _meta(spark, d).select("xml_path", F.size("claim_list").alias("n_claims"), F.size(F.filter("claim_list", lambda c: c.independent)).alias("n_independent"))


@query
def claims_source(spark, d):
    m = _meta(spark, d)
    return m.select("xml_path", X.claims_source(X.diagram_class(F.array_join("titles", " ")), F.col("method_claim"), F.col("first_claim"), F.col("claims")).alias("claims_subset"))


@query
def text_sections(spark, d):
    return metadata.text_sections(_meta(spark, d), "xml_path")


@query
def figures_upsert(spark, d):
    """The figures after all their rows were upserted in order of recording."""
    return store.latest(table(spark, d, "figures"), ["id"], [F.col("recorded_at")])


@query
def docs_incremental(spark, d):
    """Documents named by figures that no docs row has yet: what an incremental run would index."""
    new = table(spark, d, "figures").select(document_key(F.col("doc_id")).alias("doc_key")).where("doc_key IS NOT NULL").distinct()
    return new.join(table(spark, d, "docs").select(document_key(F.col("doc_id")).alias("doc_key")), "doc_key", "left_anti")


@query
def cascade_delete(spark, d):
    """Sections that remain when documents whose every row was removed are deleted."""
    key = document_key(F.col("doc_id")).alias("doc_key")
    docs = table(spark, d, "docs").groupBy(key).agg(F.bool_and(F.col("removed_at").isNotNull()).alias("gone"))
    sections = table(spark, d, "text_fts").select(key, "doc_id", "section", F.length("content").alias("n_chars"))
    return sections.join(docs.where("gone"), "doc_key", "left_anti").select("doc_id", "section", "n_chars")


@query
def doc_pages(spark, d):
    """Pages of documents, cover sheets and NULLs left out."""
    pages = table(spark, d, "docs").select("doc_id", F.posexplode("tiffs").alias("page_no", "tiff"))
    return pages.where(F.col("tiff").isNotNull() & ~X.is_cover_sheet(F.col("tiff")))


@query
def doc_page_match(spark, d):
    """Figures whose number the document's captions name."""
    key = document_key(F.col("doc_id")).alias("doc_key")
    nums = table(spark, d, "text_fts").where("section = 'caption'").select(key, F.explode(X.figure_numbers(F.array("content"))).alias("fig_num")).distinct()
    figures = table(spark, d, "figures").select("id", key, X.label_number(F.col("fig_label")).alias("fig_num"))
    return figures.join(nums, ["doc_key", "fig_num"], "left_semi")


@query
def doc_overview(spark, d):
    return store.doc_overview(table(spark, d, "docs"))


@query
def top_documents(spark, d):
    """The ten documents with most figures: a top-k report."""
    by = table(spark, d, "figures").groupBy(document_key(F.col("doc_id")).alias("doc_key"))
    return by.agg(F.count(F.lit(1)).alias("n_figures")).orderBy(F.desc("n_figures"), F.asc_nulls_last("doc_key")).limit(10)


@query
def table_counts(spark, d):
    return store.table_counts({t: table(spark, d, t) for t in ("docs", "figures", "text_fts")})


@query
def integrity(spark, d):
    return store.integrity({t: table(spark, d, t).withColumn("doc_id", document_key(F.col("doc_id"))) for t in ("docs", "figures", "text_fts")})


@query
def letterbox_meta(spark, d):
    fit = X.letterbox(F.col("original_size")[0], F.col("original_size")[1])
    return table(spark, d, "train").select("id", fit.alias("m")).select("id", "m.orig_width", "m.orig_height", "m.resized_width", "m.resized_height", "m.offset_x", "m.offset_y", F.round("m.scale", 9).alias("scale"))


@query
def bbox_union(spark, d):
    """The box around all of a document's figures."""
    return table(spark, d, "figures").groupBy(document_key(F.col("doc_id")).alias("doc_key")).agg(F.min("bbox_x1").alias("x1"), F.min("bbox_y1").alias("y1"), F.max("bbox_x2").alias("x2"), F.max("bbox_y2").alias("y2"))


@query
def page_label_filter(spark, d):
    """Pages with at most one figure number, and their label."""
    figures = table(spark, d, "figures").where("tiff_path IS NOT NULL").select("tiff_path", X.label_number(F.col("fig_label")).alias("num"))
    pages = figures.groupBy("tiff_path").agg(F.min("num").alias("low"), F.max("num").alias("high"))
    return pages.where("low IS NULL OR low = high").select("tiff_path", F.concat(F.lit("FIG. "), F.col("low")).alias("fig_label"))


@query
def content_hash(spark, d):
    return table(spark, d, "page_files").select("file_id", F.sha2("payload", 256).alias("computed"))


@query
def family_label(spark, d):
    """Split label by a hash of the family, or of the document where there is none: tenths 0 to 7, 8 and 9."""
    key = F.coalesce(family_key(F.col("family_id")), document_key(F.col("doc_id")))
    tenth = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % 10
    return table(spark, d, "docs").select("doc_id", F.when(tenth < 8, "train").when(tenth == 8, "validation").otherwise("test").alias("split")).distinct()


@query
def fts_index(spark, d):
    return fts.index(_sections(spark, d).where("content IS NOT NULL"), stemmed=False)


@query
def fts_index_stemmed(spark, d):
    return fts.index(_sections(spark, d).where("content IS NOT NULL"))


@query
def fts_search(spark, d):
    return fts.search(fts_index(spark, d), "gear valve", stemmed=False)


@query
def json_lists(spark, d):
    """Page lists through JSON and back; NULL as the empty list."""
    docs = table(spark, d, "docs")
    return docs.select("doc_id", "indexed_at", F.array_join(F.filter(X.string_list(F.to_json("tiffs")), lambda x: x.isNotNull()), "|").alias("pages"))


@query
def caption_pairs(spark, d):
    return sinks.caption_pairs(table(spark, d, "train"))


@query
def tab_lines(spark, d):
    return sinks.tab_lines(table(spark, d, "applicants").select("applicant_id", "applicant_name", "country"))


@query
def run_summary(spark, d):
    docs = table(spark, d, "docs")
    return pipeline.run_summary(docs.select("doc_id").distinct(), docs.select(F.explode("tiffs")), table(spark, d, "figures"))


@query
def row_paths(spark, d):
    """Ids and paths as the dataset builder makes them."""
    f = table(spark, d, "figures").where("tiff_path IS NOT NULL AND doc_id IS NOT NULL").withColumn("doc_id", document_key(F.col("doc_id")))
    name = F.concat("doc_id", F.lit("_"), stem(F.col("tiff_path")), F.lit("_"), X.file_token(F.col("fig_label")))
    return f.select(F.concat("doc_id", F.lit(":"), name, F.lit(".png")).alias("row_id"), F.concat(F.lit("data/work/control/"), name, F.lit("_canny.png")).alias("control_path"))

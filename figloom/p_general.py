"""Queries of the general training-data problems: 1, 4 and 6."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from figloom.functions.names import canonical_path
from figloom.operators import consolidate as C, orphans as O, shred as S
from figloom.shared import new_path
from figloom.sources.tables import setting, spread, table


def _store(spark: SparkSession, folder: str) -> DataFrame:
    return C.consolidate(spark, f"{folder}/page_files.parquet", new_path(spark, "store"), setting(spark, folder, "bundle_bytes"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of page_files that the consolidated store left out."""
    kept = _store(spark, folder).select(F.explode("members.file_id").alias("file_id"))
    return table(spark, folder, "page_files").select("file_id").join(kept, "file_id", "left_anti")


def p1_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """The store's bundles: how many files and bytes each holds."""
    return _store(spark, folder).select("applicant_id", "bundle_no", "n_files", "n_bytes")


def p1_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """page_files as it is, rewritten as few files without a shuffle, and read from these."""
    final = new_path(spark, "compact")
    C.compact_files(spark, f"{folder}/page_files.parquet", final)
    return spark.read.parquet(final).select("file_id", "path", "kind", "applicant_id", "n_bytes", "sha256", F.sha2("payload", 256).alias("computed"), "written_at", "removed_at")


def p1_named(spark: SparkSession, folder: str) -> DataFrame:
    """Of the files that train and docs name: how many distinct paths per field, and how many of them page_files has."""
    train, docs = table(spark, folder, "train"), table(spark, folder, "docs")
    named = (
        train.select(F.lit("train.image_path").alias("field"), canonical_path(F.col("image_path")).alias("path"))
        .unionAll(train.select(F.lit("train.control_path"), canonical_path(F.col("control_path"))))
        .unionAll(docs.select(F.lit("docs.tiffs"), F.explode("tiffs").alias("path")).withColumn("path", canonical_path(F.col("path"))))
        .where("path IS NOT NULL")
        .distinct()
    )
    there = table(spark, folder, "page_files").select(canonical_path(F.col("path")).alias("path"), F.lit(1).alias("here")).where("path IS NOT NULL").distinct()
    return named.join(there, "path", "left").groupBy("field").agg(F.count(F.lit(1)).alias("n_paths"), F.count("here").alias("n_here"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Direct orphans, step 0 of the cascade: table, field and id of the referring row."""
    found = O.cascade(O.drawing_graph(spark, folder)).where("step = 0 AND tab != 'docs'")
    return found.select(F.col("tab").alias("ref_table"), "ref_field", "ref_key").distinct()


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Direct orphans per table, field and month of recording."""
    return O.report(O.drawing_references(spark, folder), O.cascade(O.drawing_graph(spark, folder)))


def p4_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Direct and inherited orphans per table and month, by the step of the cascade that found them."""
    return O.cascade_report(O.cascade(O.drawing_graph(spark, folder)))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every claim-text inside a claim, with its number and its parent's."""
    levels = S.shred(spread(table(spark, folder, "xml_files").select("xml_path", "body")), "xml_path", "body", texts=True)
    return S.claim_nodes(levels).select("xml_path", "claim_no", "node_no", "parent_no").distinct()


def p6_documents(spark: SparkSession, folder: str) -> DataFrame:
    return S.flat_table(spark, folder, "documents")


def p6_figures(spark: SparkSession, folder: str) -> DataFrame:
    return S.flat_table(spark, folder, "figures")


def p6_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return S.flat_table(spark, folder, "paragraphs")


def p6_claims(spark: SparkSession, folder: str) -> DataFrame:
    return S.flat_table(spark, folder, "claims")


def p6_claim_parts(spark: SparkSession, folder: str) -> DataFrame:
    return S.flat_table(spark, folder, "claim_parts")


def p6_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the five flat tables, all assembled from one shredding."""
    made = S.flat_tables(spark, folder)
    return reduce(DataFrame.unionAll, (df.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows") for name, df in made.items()))


def p6_leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Every element and attribute of the bodies, also those that the five flat tables have no column for."""
    return S.leaves(S.named_bodies(spark, folder), "xml_path", "body")


QUERIES = {f.__name__: f for f in (p1_found, p1_bundles, p1_compacted, p1_named, p4_found, p4_report, p4_cascade, p6_found, p6_documents, p6_figures, p6_paragraphs, p6_claims, p6_claim_parts, p6_tables, p6_leaves)}

"""Full-text index over sections: an inverted table instead of an index structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from figloom.functions import vocabulary as V
from figloom.functions.stem import stem, stem_of


def tokens(content: Column) -> Column:
    """Lower-case runs of letters and digits, in order; NULL gives none."""
    return F.regexp_extract_all(F.lower(F.coalesce(content, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def index(text_fts: DataFrame, stemmed: bool = True) -> DataFrame:
    """term, doc_id, section, n, first_position: one row per term and section, stop words left out.

    Stems are computed per distinct word of a section, and once per batch of them; nothing is joined on a word. Sections without words have no row.
    Repeated rows of a section count again; make sections unique first where that matters.
    """
    words = text_fts.select("doc_id", "section", F.posexplode(tokens(F.col("content"))).alias("position", "word")).where(~F.col("word").isin(*V.INDEX_STOPS))
    found = words.groupBy("word", "doc_id", "section").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first_position"))
    if not stemmed:
        return found.withColumnRenamed("word", "term")
    return found.withColumn("term", stem_of(F.col("word"))).groupBy("term", "doc_id", "section").agg(F.sum("n").alias("n"), F.min("first_position").alias("first_position"))


def search(inverted: DataFrame, query: str, stemmed: bool = True) -> DataFrame:
    """doc_id, section, score of the sections with all words of the query, score = occurrences. No words: no rows."""
    terms = sorted({stem(w) if stemmed else w for w in query.lower().split() if w not in V.INDEX_STOPS})
    hit = inverted.where(F.col("term").isin(*terms)) if terms else inverted.limit(0)
    return hit.groupBy("doc_id", "section").agg(F.count_distinct("term").alias("terms"), F.sum("n").alias("score")).where(F.col("terms") == len(terms)).drop("terms")

"""Queries of problems 7 to 10 (pieces, tokens, containers, look-alikes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from figloom.llm import lookalike, packing, pieces, tokens
from figloom.shared import written
from figloom.sources.tables import setting, spread, table


def p7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all contents and prompts over their limits."""
    fts, train = table(spark, folder, "text_fts"), table(spark, folder, "train")
    contents = fts.select(F.lit("content").alias("item_field"), F.concat("doc_id", F.lit(":"), "section").alias("item_key"), F.col("content").alias("text"))
    prompts = train.select(F.lit("prompt").alias("item_field"), F.col("id").alias("item_key"), F.col("prompt").alias("text"))
    of = {name: (setting(spark, folder, f"{name}_chars"), setting(spark, folder, f"{name}_overlap")) for name in ("content", "prompt")}
    return pieces.pieces(contents, *of["content"]).unionByName(pieces.pieces(prompts, *of["prompt"]))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Items that had to be cut: those with a second piece."""
    return p7_pieces(spark, folder).where("piece_no = 2 AND item_key IS NOT NULL").select("item_field", "item_key").distinct()


def p7_rejoined(spark: SparkSession, folder: str) -> DataFrame:
    """The items that were cut, put together again from their pieces without the repeats: hash and length."""
    core = F.expr("substring(piece, core_start - start + 1)")
    parts = F.array_sort(F.collect_list(F.struct("piece_no", core.alias("core"))))
    text = p7_pieces(spark, folder).where("item_key IS NOT NULL").groupBy("item_field", "item_key", "item_md5").agg(F.array_join(F.transform(parts, lambda p: p.core), "").alias("text"))
    return text.select("item_field", "item_key", F.md5("text").alias("rejoined"), F.length("text").alias("n_chars"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.token_ids(spread(table(spark, folder, "documents").select("doc_id", "text")), "doc_id", "text")


def p8_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text as decoding its token ids gives it: hash and bytes."""
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    back = tokens.decoded(tokens.token_ids(documents, "doc_id", "text"), "doc_id")
    return back.select("doc_id", F.md5("text").alias("decoded"), F.octet_length("text").alias("n_bytes"))


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(spread(table(spark, folder, "documents").select("doc_id", "source", "text")), ["doc_id", "source"], "text")


def p9_placements(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document's tokens lie."""
    return packing.pack(_counts(spark, folder), setting(spark, folder, "container_tokens"))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of the deficit round-robin with every source at the same target share, whatever its share of the corpus: targets, what was reached, deficits carried."""
    counts = written(_counts(spark, folder).withColumn("source", F.col("source").cast("string")), "counts")
    shares = counts.select("source").distinct().withColumn("share", F.lit(1.0))
    room = setting(spark, folder, "container_tokens")
    return packing.mixture(packing.split_items(counts.where("n_tokens > 0"), room), room, shares)


def p9_broken(spark: SparkSession, folder: str) -> DataFrame:
    """What must not be: documents of which tokens are missing or placed twice, or which were split though they fit; containers over the capacity. No row."""
    room = setting(spark, folder, "container_tokens")
    counts = written(_counts(spark, folder), "counts")
    placed = written(packing.pack(counts, room), "placed")
    own = placed.groupBy("doc_id").agg(F.sum("size").alias("size"), F.count("container_id").alias("n_parts"), F.count_distinct("start").alias("n_starts"))
    wrong = counts.join(own, "doc_id", "left").where(~F.col("size").eqNullSafe(F.col("n_tokens")) | (F.col("n_parts") != F.ceil(F.col("n_tokens") / room)) | (F.col("n_starts") < F.col("n_parts")))
    over = placed.where("container_id IS NOT NULL").groupBy("container_id").agg(F.sum("size").alias("n")).where(F.col("n") > room)
    return wrong.select(F.lit("document").alias("kind"), F.col("doc_id").alias("number")).unionAll(over.select(F.lit("container"), "container_id"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Per container: its parts, its tokens and the share of its room that is used."""
    room = setting(spark, folder, "container_tokens")
    placed = p9_placements(spark, folder).where("container_id IS NOT NULL")
    return placed.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_parts"), F.sum("size").alias("n_tokens"), F.round(F.sum("size") / room, 4).alias("used"))


def p9_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Containers against the fewest possible, ceil(tokens / capacity)."""
    room = setting(spark, folder, "container_tokens")
    return p9_containers(spark, folder).agg(
        F.count(F.lit(1)).alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("most_tokens"), F.ceil(F.sum("n_tokens") / room).alias("fewest_possible")
    )


def p10_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text in its one form."""
    return lookalike.with_form(spread(table(spark, folder, "documents").select("doc_id", "text"))).select("doc_id", "form")


def p10_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The form without pairs: every document with something visible, the smallest doc_id of those that look the same, and how many other texts do."""
    keys = written(lookalike.look_keys(spread(table(spark, folder, "documents").select("doc_id", "text")), "doc_id", "text"), "looks")
    texts = keys.groupBy("look", "own").agg(F.min("doc_id").alias("first")).groupBy("look").agg(F.min("first").alias("class_doc_id"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return keys.join(texts, "look").select("doc_id", "class_doc_id", "n_links")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents whose texts differ and look the same."""
    keys = lookalike.look_keys(spread(table(spark, folder, "documents").select("doc_id", "text")), "doc_id", "text")
    return lookalike.look_pairs(written(keys, "looks"), "doc_id").distinct()


QUERIES = {f.__name__: f for f in (p7_found, p7_pieces, p7_rejoined, p8_ids, p8_round_trip, p9_placements, p9_containers, p9_summary, p9_mixture, p9_broken, p10_found, p10_classes, p10_forms)}

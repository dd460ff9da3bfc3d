"""Queries of problems 3 and 5 (similar texts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from figloom.llm import meetings, neardup
from figloom.llm.forest import spanning_forest
from figloom.shared import written
from figloom.sources.tables import table

#: Spaces of problem 5: only texts of one space are compared.
SPACES = {0: "prompt", 1: "content", 2: "content"}


def edited_texts(spark: SparkSession, folder: str) -> DataFrame:
    """space, key, text: prompts of train (0), paragraphs (1) and claims (2) of text_fts. Rows without a key are left out."""
    prompts = table(spark, folder, "train").select(F.lit(0).alias("space"), F.col("id").alias("key"), F.col("prompt").alias("text"))
    space = F.when(F.col("section") == "paragraph", 1).when(F.col("section") == "claim", 2)
    contents = table(spark, folder, "text_fts").select(space.alias("space"), F.concat("doc_id", F.lit(":"), "section").alias("key"), F.col("content").alias("text"))
    return prompts.unionAll(contents.where("space IS NOT NULL")).where("key IS NOT NULL AND text IS NOT NULL")


def key_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """space, key_a, key_b of all pairs of different keys whose classes are linked or the same. Rows of classes without any partner don't move."""
    several = members.groupBy("cls").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select(F.col("cls").alias("x"), F.col("cls").alias("y"))
    pairs = written(links.select("x", "y").unionAll(several), "class_pairs")
    own = meetings.by_keys(members.select("space", "key", "cls"), meetings.named_classes(pairs), ["cls"]).distinct()
    a, b = own.select("space", F.col("key").alias("a"), F.col("cls").alias("x")), own.select(F.col("key").alias("b"), F.col("cls").alias("y"))
    met = pairs.join(a, "x").join(b, "y").where((F.col("x") != F.col("y")) | (F.col("a") < F.col("b"))).where("a != b")
    return met.select("space", F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of near-duplicate contents and prompts."""
    members, links = neardup.near_duplicates(edited_texts(spark, folder))
    field = F.when(F.col("space") == 0, "prompt").otherwise("content")
    return key_pairs(members, links).select(field.alias("field"), "key_a", "key_b").distinct()


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """space, key, class_key, group_key, n_links: a row per key and class; n_links counts its class's links to other classes.

    A class are the texts with the same words, class_key is its smallest key. Groups are what links connect,
    directly or through others; group_key is the smallest key. A text without any link is a group with its exact copies.
    """
    nodes, _ = spanning_forest(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    degree = links.select(F.col("x").alias("cls")).unionAll(links.select("y")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    classes = members.groupBy("cls").agg(F.min("key").alias("class_key")).join(nodes.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    first = classes.groupBy("root").agg(F.min("class_key").alias("group_key"))
    told = classes.join(first, "root").join(degree, "cls", "left").select("cls", "class_key", "group_key", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return members.select("space", "key", "cls").distinct().join(told, "cls").select("space", "key", "class_key", "group_key", "n_links")


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every content and prompt of 30 words or more with its class of equal texts, its group, and the number of linked classes."""
    found = groups(*neardup.near_duplicates(edited_texts(spark, folder)))
    return found.select(F.when(F.col("space") == 0, "prompt").when(F.col("space") == 1, "paragraph").otherwise("claim").alias("field"), "key", "class_key", "group_key", "n_links")


QUERIES = {f.__name__: f for f in (p5_found, p5_groups)}

"""Warehouse tables: one Parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from figloom.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the cluster runs tasks, for work that is heavy per row.

    A table of many files stays as it is; only one that would leave slots idle is redistributed.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def setting(spark: SparkSession, folder: str, name: str, default: int | None = None) -> int:
    """One amount of ``size_limits`` (six rows by definition)."""
    row = table(spark, folder, "size_limits").where(f"setting = '{name}'").select("amount").first()
    if row is None or row.amount is None:
        if default is None:
            raise ValueError(f"size_limits has no {name}")
        return default
    return int(row.amount)


def jdbc_table(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A table of a relational database; with an integer ``key`` and its ``bounds``, read by ``partitions`` tasks."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    return reader.load()

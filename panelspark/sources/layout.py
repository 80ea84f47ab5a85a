"""Observations on disk: folders by source and UTC day for scans that prune, folders by key for commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import exists


def replace_folders(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write rows in folders by columns; folders that rows fall into are replaced, the others stay."""
    rows.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_days(points: DataFrame, path: str, slot: str = "slot") -> None:
    """Points in folders source=.../day=..., in order of their slots within a file; given days are replaced whole.

    A day's points meet in one task and file: rows of a source and a day are at most its slots."""
    days = points.withColumn("day", F.to_date(slot))
    replace_folders(days.repartition("source", "day").sortWithinPartitions("source", "day", slot), path, ["source", "day"])


def scan_days(spark: SparkSession, path: str, schema: T.StructType, source: str, after: Column | None = None, through: Column | None = None, slot: str = "slot") -> DataFrame:
    """A source's observations after a cursor and through a slot. Folders of other sources and days aren't listed for
    reading: the bounds are given for the day too, which is a folder."""
    stored = T.StructType([f for f in schema if f.name != "source"] + [T.StructField("source", T.StringType()), T.StructField("day", T.DateType())])
    out = spark.read.schema(stored).parquet(path).where(F.col("source") == source)
    if after is not None:
        out = out.where((F.col("day") >= F.to_date(after)) & (F.col(slot) > after))
    if through is not None:
        out = out.where((F.col("day") <= F.to_date(through)) & (F.col(slot) <= through))
    return out.select(*schema.names)


def commit_new(spark: SparkSession, rows: DataFrame, path: str, keys: list[str]) -> None:
    """Commit rows whose keys aren't committed yet, each key in a folder of its own; rows of a key come together.

    What is there is told by folders, without reading a row. A retry changes nothing; a key that two writers commit at
    the same time is replaced by the later one as a whole, so it's never there twice."""
    fresh = rows
    if exists(spark, path):
        there = committed(spark, rows.schema, path).select(*keys).distinct()
        fresh = rows.join(there, keys, "left_anti")
    replace_folders(fresh.repartition(*keys), path, keys)


def committed(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """All that is committed at path, in the columns of schema."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)

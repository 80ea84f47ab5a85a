"""State by key across batches: a registry in hash buckets of which a batch rewrites what it touches, and first sights."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import exists

#: Keeps streaming state on disk, so that it isn't bounded by an executor's memory.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert(spark: SparkSession, path: str, new: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], key: str, buckets: int) -> list[int]:
    """Merge rows by key into a table in hash buckets; returns the buckets rewritten.

    Only buckets that hold a key of `new` are read, and only they are replaced, by dynamic partition overwrite; files of
    the others stay. merge(old, rows) must not mind rows that it has seen: a batch that runs again after a crash between
    two buckets then gives the same table. Buckets are as many as make one a few files long; the driver sees numbers of
    buckets only."""
    rows = new.withColumn("bucket", bucket_of(key, buckets)).persist()
    try:
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # `buckets` at most
        if not touched:
            return []
        old = spark.read.parquet(path).where(F.col("bucket").isin(touched)).drop("bucket") if exists(spark, path) else None
        merged = merge(old, rows.drop("bucket")).withColumn("bucket", bucket_of(key, buckets))
        merged.repartition(F.col("bucket")).write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        return touched
    finally:
        rows.unpersist()


def merge_registry(old: DataFrame | None, rows: DataFrame) -> DataFrame:
    """(entity, owners, first_seen, last): a registry with new snapshot rows; `last` is the last written end.

    Rows that come again change nothing."""
    owners = F.collect_set(F.when(F.col("owner") != "", F.col("owner")))
    new = rows.groupBy("entity").agg(owners.alias("owners"), F.min("slot").alias("first_seen"), F.max(F.struct("slot", "end_date")).alias("last"))
    both = new if old is None else old.unionByName(new)
    return both.groupBy("entity").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("owners")))).alias("owners"), F.min("first_seen").alias("first_seen"), F.max("last").alias("last"))


def registry_sink(spark: SparkSession, path: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Each batch merged into the registry at path."""

    def sink(batch: DataFrame, number: int) -> None:
        upsert(spark, path, batch, merge_registry, "entity", buckets)

    return sink


def registry_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def first_sights(stream: DataFrame, key: str = "entity", at: str = "slot") -> DataFrame:
    """(key, first): keys that this batch sees for the first time, or earlier than any batch before.

    State is one time per key and lies in the state store, which with keyed_state() is on disk: no table of all keys is
    read or written per batch. Run in update mode; the least `first` of a key counts if rows come late."""
    arrived = stream.select(key, at, F.current_timestamp().alias("arrived"))  # the same for a batch, also when it runs again
    seen = arrived.groupBy(key).agg(F.min(F.struct(at, "arrived")).alias("s"), F.max("arrived").alias("now"))
    return seen.where(F.col("s.arrived") == F.col("now")).select(key, F.col(f"s.{at}").alias("first"))


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)

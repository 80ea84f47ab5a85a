"""Jump consistent hashing: shards for stable keys without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES

#: Rows of a slice of a shard, about.
SLICE = 20_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, all keys at once: jump ahead until the next place lies beyond the last shard."""
    key = keys.astype(np.uint64).copy()
    out, at = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        out[live] = at[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        at[live] = ((at[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.int64) + 1))).astype(np.int64)
        live = live[at[live] < shards]
    return out


def shard_column(key, shards: int):
    """Column of shards 0 to shards - 1 for a long key column; a null key counts as the key 0."""

    @F.pandas_udf(T.IntegerType())
    def of(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy(np.int64), shards).astype(np.int32))

    return of(F.xxhash64(F.coalesce(key, F.lit(0).cast("long"))))


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot (gapless in its shard), grown_shard (one shard more).

    doc_id and the number of shards alone decide the shard, so equal ids meet in one shard, a hot source changes
    nothing, and one shard more takes rows only into itself. Null text: size 1, checksum 0. A null doc_id is placed as
    the id 0. Rows that agree in everything get different slots in any order. Slots are counted in two steps, so that
    no task orders a whole shard: rows are numbered in each of `parts` slices of a shard, and a table of shards x parts
    counts gives each slice its start. parts follows the number of rows (one for about SLICE of them), which is
    counted first if it isn't given. Texts of any length are read whole, and never shuffled. An empty table gives no
    rows."""
    parts = parts or max(1, -(-docs.count() // (SLICE * shards)))
    key = F.col(id_col).cast("long")
    rows = docs.select(
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumns({"shard": shard_column(F.col("doc_id"), shards), "grown_shard": shard_column(F.col("doc_id"), shards + 1), "part": F.pmod(F.xxhash64(F.col("doc_id"), F.col("text_crc32"), F.lit(7)), F.lit(parts)).cast("int")})
    own = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    start = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("start"))
    # one row for SLICE rows of the input: broadcast up to a size
    return (
        rows.withColumn("within", F.row_number().over(own) - 1)
        .join(F.broadcast(start) if shards * parts * 24 <= BROADCAST_BYTES else start, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("within")).alias("slot"), "grown_shard")
    )

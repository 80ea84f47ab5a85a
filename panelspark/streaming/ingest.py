"""Structured Streaming: slots, late rows, one result per slot, flows per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.points import SLOT, flows, slot_of


def expiry(observed: str, slot: str, late: int = SLOT, early: int = 60):
    """expired if an observation comes a slot late or over a minute early; such rows are not filled in later."""
    lag = F.unix_seconds(observed) - F.unix_seconds(slot)
    return F.when((lag >= late) | (lag < -early), "expired").otherwise("on time")


def slotted(stream: DataFrame, at: str, seconds: int = SLOT) -> DataFrame:
    return stream.withColumn("slot", slot_of(F.col(at), seconds))


def once_per_slot(stream: DataFrame, keys: list[str], at: str, delay: str = "15 minutes") -> DataFrame:
    """One row per key: later ones within the watermark are dropped."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def slot_counts(stream: DataFrame, at: str, seconds: int, keys: list[str], delay: str = "15 minutes") -> DataFrame:
    """Tumbling counts; a window is given out once the watermark has passed it."""
    w = F.window(at, f"{seconds} seconds")
    return stream.withWatermark(at, delay).groupBy(w, *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("bin"), *keys, "n")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Work off what is there, batch by batch, and stop; the checkpoint is the cursor."""
    q: StreamingQuery = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch in a folder of its own number, so that a batch that runs again replaces its own rows only."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return sink


def flow_sink(spark: SparkSession, state: str, out: str, seconds: int) -> Callable[[DataFrame, int], None]:
    """Arrivals and departures per batch, against the last snapshot that the batch before kept.

    State and results of batch n lie in folders n, so a repeated batch reads the same state again."""

    def sink(batch: DataFrame, number: int) -> None:
        rows = batch.select("slot", "entity").distinct()
        first = rows.agg(F.min("slot").alias("first"))
        if number:
            rows = rows.union(spark.read.parquet(f"{state}/{number - 1}"))
        rows = rows.persist()
        f = flows(rows, seconds, seconds).crossJoin(F.broadcast(first)).where("slot >= first").drop("first")
        f.write.mode("overwrite").parquet(f"{out}/batch={number}")
        last = F.broadcast(rows.agg(F.max("slot").alias("slot")))
        rows.join(last, "slot", "left_semi").write.mode("overwrite").parquet(f"{state}/{number}")
        rows.unpersist()

    return sink

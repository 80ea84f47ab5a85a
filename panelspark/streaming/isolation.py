"""One streaming query per source, run side by side: a source that fails neither stops nor undoes the others."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Sink = Callable[[DataFrame, int], None]
ATTEMPTS = "source string, run long, status string, error string"


@dataclass
class Source:
    """A source's stream, its own sink and its own cursor."""

    stream: DataFrame
    sink: Sink
    checkpoint: str


def error_name(text: str) -> str:
    """The class of the error that a stream's failure names, innermost of a Python traceback; the message is dropped."""
    named = re.findall(r"^\s*(?:: |Caused by: )?(?:[\w$]+\.)*(\w*(?:Error|Exception))\b", text, re.MULTILINE)
    return named[-1] if named else "StreamingQueryException"


def began(s: Source) -> StreamingQuery:
    return s.stream.writeStream.foreachBatch(s.sink).option("checkpointLocation", s.checkpoint).trigger(availableNow=True).start()


def run_isolated(sources: dict[str | None, Source], run: int) -> list[tuple]:
    """Work off what each source has, all at once; rows of ATTEMPTS, one per source.

    success: rows were taken in; nothing new: there were none; failed: with the class of the error only, as messages can
    hold rows. A failed source's earlier results and its cursor stay, so its next run goes on where it stopped; a source
    that can't even be started is a failed one too."""
    queries, out = {}, []
    for name, s in sources.items():
        try:
            queries[name] = began(s)
        except Exception as e:  # whatever it is, it's this source's
            out.append((name, run, "failed", error_name(str(e))))
    for name, q in queries.items():
        try:
            q.awaitTermination()
            took = any(p.numInputRows for p in q.recentProgress)
            out.append((name, run, "success" if took else "nothing new", None))
        except Exception as e:
            out.append((name, run, "failed", error_name(str(e))))
    return out


def record_attempts(spark: SparkSession, attempts: list[tuple], path: str) -> None:
    """Attempts of one run in a partition of its own; one that is recorded again replaces itself."""
    df = spark.createDataFrame(attempts, ATTEMPTS).coalesce(1)
    df.write.partitionBy("run").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def source_states(attempts: DataFrame) -> DataFrame:
    """(source, runs, failures, last_status, last_success, error): each source by its attempts; error only while its last
    attempt failed."""
    last = F.max(F.struct("run", "status", "error"))
    g = attempts.groupBy("source").agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "failed").alias("failures"), last.alias("l"), F.max(F.when(F.col("status") != "failed", F.col("run"))).alias("last_success"))
    return g.select("source", "runs", "failures", F.col("l.status").alias("last_status"), "last_success", F.col("l.error").alias("error"))

"""Structured Streaming (ST), each run with availableNow over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import history
from ..sources.shared import exists, shared_folder
from ..sources.views import ROSTER_SLOT, duck, view
from ..streaming import ingest, isolation, registry
from .history_queries import COLS, ST, states
from .panel_queries import FLOWS
from .registry import query, secs, text

#: Increments in which the roster arrives.
CUTS = ["2024-01-11", "2024-01-21", "2100-01-01"]


def events(spark: SparkSession, d: str) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    # a pattern, as the stream source takes a single file by pattern only
    return spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))


def arriving(spark: SparkSession, rows: DataFrame, sink, checkpoint: str, mode: str = "append", then=lambda s: s) -> None:
    """Rows arrive in increments of time; after each one the same query goes on from its checkpoint."""
    path, low = shared_folder(spark, "arriving"), "1900-01-01"
    for high in CUTS:
        rows.where((F.col("slot") >= F.lit(low).cast("timestamp")) & (F.col("slot") < F.lit(high).cast("timestamp"))).write.mode("append").parquet(path)
        ingest.run_available(then(spark.readStream.schema(rows.schema).parquet(path)), sink, checkpoint, mode)
        low = high


@query(" UNION ALL ".join(f"SELECT {n} AS width, CAST(floor(epoch(ts) / {n}) * {n} AS BIGINT) AS bin, event_type, count(*) AS n FROM events GROUP BY 2, 3" for n in (900, 3600, 86400)))
def st1_st9_tumbling_bins(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows of three sizes over the stream of events."""
    out = None
    for n in (900, 3600, 86400):
        path, checkpoint = shared_folder(spark, "bins"), shared_folder(spark, "cursor")
        ingest.run_available(ingest.slot_counts(events(spark, d), "ts", n, ["event_type"]), ingest.append_sink(path), checkpoint, "complete")
        last = spark.read.parquet(path)
        last = last.join(F.broadcast(last.agg(F.max("batch").alias("batch"))), "batch", "left_semi").select(F.lit(n).alias("width"), secs("bin"), "event_type", "n")
        out = last if out is None else out.union(last)
    return out


@query("SELECT event_id, CASE WHEN CAST(floor(epoch(ts)) AS BIGINT) % 900 + event_id % 700 >= 900 THEN 'expired' ELSE 'on time' END AS state FROM events")
def st2_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that come a slot late or more go to a side output; here each row arrives some time after its event."""
    path = shared_folder(spark, "late")
    s = ingest.slotted(events(spark, d), "ts").withColumn("arrived", F.timestamp_seconds(F.unix_seconds("ts") + F.col("event_id") % 700))
    s = s.select("event_id", ingest.expiry("arrived", "slot").alias("state"))
    ingest.run_available(s, ingest.append_sink(path), shared_folder(spark, "cursor"))
    return spark.read.parquet(path).select("event_id", "state")


def event_types(spark: SparkSession, d: str) -> list[str | None]:
    """The sources, a handful of values (null too): the driver starts a query for each."""
    return [r[0] for r in spark.read.parquet(f"{d}/events.parquet").select("event_type").distinct().collect()]


def slot_stream(s: DataFrame) -> DataFrame:
    s = ingest.slotted(s, "ts").select(F.col("event_type").alias("source"), "slot", "ts")
    return ingest.once_per_slot(s, ["source", "slot"], "ts").select("source", "slot")


def stored_slots(spark: SparkSession, paths: list[str]) -> DataFrame:
    """What the sources have stored, put together on read only; a source without any result yet has none."""
    got = "source string, slot timestamp"
    out = spark.createDataFrame([], got)
    for p in paths:
        if exists(spark, p):
            out = out.union(spark.read.schema(got).parquet(p).select("source", "slot"))
    return out


@query("SELECT DISTINCT event_type AS source, CAST(floor(epoch(ts) / 900) * 900 AS BIGINT) AS slot FROM events")
def st3_st7_once_per_slot(spark: SparkSession, d: str) -> DataFrame:
    """One result per slot, with a query of its own for each source (null too); outputs meet on read only."""
    names = event_types(spark, d)
    paths = {n: shared_folder(spark, "slots") for n in names}
    of = lambda n: slot_stream(events(spark, d).where(F.col("event_type").eqNullSafe(F.lit(n))))
    failed = [a for a in isolation.run_isolated({n: isolation.Source(of(n), ingest.append_sink(p), shared_folder(spark, "cursor")) for n, p in paths.items()}, 0) if a[2] == "failed"]
    if failed:
        raise RuntimeError(f"sources failed: {failed}")
    return stored_slots(spark, list(paths.values())).select("source", secs("slot"))


ISOLATED = """, cuts AS (SELECT * FROM (VALUES (1, TIMESTAMP '2024-01-11'), (2, TIMESTAMP '2024-01-21'), (3, TIMESTAMP '2100-01-01')) t(run, high)),
s AS (SELECT DISTINCT event_type AS source, CAST(floor(epoch(ts) / 900) * 900 AS BIGINT) AS slot FROM events), bad AS (SELECT min(event_type) AS source FROM events),
k AS (SELECT DISTINCT source FROM s) SELECT k.source, CAST(run AS BIGINT) AS run, CASE WHEN run = 2 AND k.source = bad.source THEN 'failed' ELSE 'success' END AS status, CASE WHEN run = 2 AND k.source = bad.source THEN 'ValueError' END AS error,
(SELECT count(*) FROM s WHERE s.source IS NOT DISTINCT FROM k.source AND slot < epoch(CASE WHEN run = 2 AND k.source = bad.source THEN TIMESTAMP '2024-01-11' ELSE high END)) AS slots FROM k, cuts, bad"""


@query("WITH e AS (SELECT 1)" + ISOLATED)
def st7_source_isolation(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over increments; in the second one source's sink fails. The others' results are complete after each
    run, the failed one's stay as they were, and its third run takes in both increments from its own cursor."""
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    names, arriving_at = event_types(spark, d), shared_folder(spark, "arriving")
    bad = min(n for n in names if n is not None)
    paths, cursors = {n: shared_folder(spark, "slots") for n in names}, {n: shared_folder(spark, "cursor") for n in names}
    attempts, counts, low = shared_folder(spark, "attempts"), None, "1900-01-01"

    def refusing(batch: DataFrame, number: int) -> None:
        raise ValueError("the source is not to be had")

    for run, high in enumerate(CUTS, 1):
        rows.where((F.col("ts") >= F.lit(low).cast("timestamp")) & (F.col("ts") < F.lit(high).cast("timestamp"))).write.mode("append").parquet(arriving_at)
        stream = lambda n: slot_stream(spark.readStream.schema(rows.schema).parquet(arriving_at).where(F.col("event_type").eqNullSafe(F.lit(n))))
        sources = {n: isolation.Source(stream(n), refusing if run == 2 and n == bad else ingest.append_sink(paths[n]), cursors[n]) for n in names}
        isolation.record_attempts(spark, isolation.run_isolated(sources, run), attempts)
        now = stored_slots(spark, list(paths.values())).groupBy("source").agg(F.count("*").alias("slots")).withColumn("run", F.lit(run).cast("long"))
        path = shared_folder(spark, "counts")  # as they are now
        now.write.parquet(path)
        now = spark.read.parquet(path)
        counts, low = now if counts is None else counts.union(now), high
    a = spark.read.schema(isolation.ATTEMPTS).parquet(attempts).alias("a")
    met = a.join(counts.alias("c"), F.col("a.source").eqNullSafe(F.col("c.source")) & (F.col("a.run") == F.col("c.run")), "left")
    return met.select("a.source", "a.run", "status", "error", F.coalesce("slots", F.lit(0)).cast("long").alias("slots"))


@query(duck("roster", FLOWS + " SELECT CAST(epoch(slot) AS BIGINT) AS slot, arrivals, departures FROM flows"))
def st4_stream_flows(spark: SparkSession, d: str) -> DataFrame:
    """Arrivals and departures over increments: each batch starts from the snapshot that the one before kept."""
    out = shared_folder(spark, "flows")
    sink = ingest.flow_sink(spark, shared_folder(spark, "state"), out, ROSTER_SLOT)
    arriving(spark, view(spark, d, "roster").select("slot", "entity"), sink, shared_folder(spark, "cursor"))
    return spark.read.parquet(out).select(secs("slot"), "arrivals", "departures")


@query(duck("roster", "SELECT entity, coalesce(string_agg(DISTINCT owner, ',' ORDER BY owner) FILTER (owner <> ''), '') AS owners, CAST(epoch(min(slot)) AS BIGINT) AS first_seen, CAST((list(end_date ORDER BY slot DESC))[1] AS VARCHAR) AS end_date FROM roster GROUP BY 1"))
def st5_st6_incremental_registry(spark: SparkSession, d: str) -> DataFrame:
    """The registry, with each id's first sight, refreshed increment by increment in its touched buckets, equals a full
    rebuild."""
    path = shared_folder(spark, "registry")
    arriving(spark, view(spark, d, "roster"), registry.registry_sink(spark, path), shared_folder(spark, "cursor"))
    last = registry.registry_table(spark, path)
    return last.select("entity", F.array_join("owners", ",").alias("owners"), secs("first_seen"), F.col("last.end_date").cast("string").alias("end_date"))


@query(duck("roster", ", f AS (SELECT entity, min(slot) AS slot FROM roster GROUP BY 1), n AS (SELECT slot, count(*) AS new FROM f GROUP BY 1) SELECT CAST(epoch(slot) AS BIGINT) AS slot, new, CAST(sum(new) OVER (ORDER BY slot) AS BIGINT) AS seen FROM n"))
def st5_first_sights(spark: SparkSession, d: str) -> DataFrame:
    """New ids by slot and ids seen so far, from a state of one time per id that streaming keeps."""
    path = shared_folder(spark, "sights")
    with registry.keyed_state(spark):
        arriving(spark, view(spark, d, "roster").select("slot", "entity"), ingest.append_sink(path), shared_folder(spark, "cursor"), "update", registry.first_sights)
    first = spark.read.parquet(path).groupBy("entity").agg(F.min("first").alias("slot")).groupBy("slot").agg(F.count("*").alias("new"))
    return first.select(secs("slot"), "new", F.sum("new").over(Window.orderBy("slot")).alias("seen"))  # a row per snapshot


@query(duck("roster", ST + " SELECT CAST(CAST(slot AS DATE) AS VARCHAR) AS day, count(*) AS entries, count_if(first) AS checkpoint_rows FROM lg GROUP BY 1"))
def st8_daily_reset(spark: SparkSession, d: str) -> DataFrame:
    """Change logs start anew each UTC day: rows logged against nothing, and all, by day."""
    log = history.change_log(states(spark, d), COLS)
    return log.groupBy(text("day")).agg(F.count("*").alias("entries"), F.count_if("first").alias("checkpoint_rows"))

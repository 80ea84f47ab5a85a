"""Sinks: the nested panel, quality gate, CSV history, exports by case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the columns of the published history and of the whole export, in their order
HISTORY = ["source", "unit", "slot", "observed_at", "finished_at", "source_updated_at", "population", "arrivals", "departures", "comparison_minutes", "listed_people", "listed_records", "charge_rows", "people_or_bookings_seen"]
EXPORT = ["source", "slot", "observed_at", "finished_at", "source_updated_at", "population", "arrivals", "departures", "listed_people", "listed_records", "charge_rows"]
KINDS = {"source": "string", "unit": "string", "slot": "timestamp", "observed_at": "timestamp", "finished_at": "timestamp", "source_updated_at": "timestamp", "comparison_minutes": "double"}
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def nested_panel(spans: DataFrame, ends: DataFrame, entity: str = "entity") -> DataFrame:
    """One row per entity with its spans and end dates as sorted arrays, for export only."""
    s = spans.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("span_start", "span_end"))).alias("spans"))
    e = ends.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("at", "end_date"))).alias("end_history"))
    return s.join(e, entity, "left")


def gate(mismatches: DataFrame) -> None:
    """Refuse to write or read a panel whose population check failed."""
    if not mismatches.limit(1).isEmpty():
        raise ValueError("the panel does not reproduce the archived populations")


def write_panel(panel: DataFrame, mismatches: DataFrame, path: str, entity: str = "entity") -> None:
    """JSON lines in order of the entities, over all files too."""
    gate(mismatches)
    panel.orderBy(entity).write.mode("overwrite").json(path)


def read_panel(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def kind_of(column: str) -> str:
    return KINDS.get(column, "bigint")


def history_rows(points: DataFrame, cutoff: Column | None = None, bookings: Sequence[str] = ("purchase",)) -> DataFrame:
    """The fixed columns of the aggregate history from a time on: what a source doesn't measure is null, other fields are
    left out, and the unit follows from the source."""
    unit = F.when(F.col("source").isin(*bookings), "bookings").otherwise("people")
    return columns_of(points.withColumn("unit", unit) if cutoff is None else points.withColumn("unit", unit).where(F.col("observed_at") >= cutoff), HISTORY)


def columns_of(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    return points.select(*[(F.col(c) if c in points.columns else F.lit(None)).cast(kind_of(c)).alias(c) for c in columns])


def write_history(points: DataFrame, path: str, cutoff: Column | None = None) -> None:
    """The published history as CSV with a heading."""
    history_rows(points, cutoff).write.mode("overwrite").csv(path, header=True, timestampFormat=STAMP)


def write_export(points: DataFrame, path: str) -> None:
    """All observations, however old, as CSV with a heading, in order of sources and slots over all files."""
    columns_of(points, EXPORT).orderBy("source", "slot").write.mode("overwrite").csv(path, header=True, timestampFormat=STAMP)


def read_history(spark: SparkSession, path: str, columns: Sequence[str] = tuple(HISTORY)) -> DataFrame:
    schema = ", ".join(f"{c} {kind_of(c)}" for c in columns)
    return spark.read.schema(schema).csv(path, header=True, timestampFormat=STAMP, enforceSchema=False)


def exported_details(details: DataFrame, at: Column | None = None, entity: int | None = None, case=None) -> DataFrame:
    """The last version of each entity, or as of a time, for one entity and/or one case, with the time of the check."""
    d = details if at is None else details.where(F.col("seen_at") <= at)
    rest = [c for c in d.columns if c not in ("entity", "seen_at")]
    last = d.groupBy("entity").agg(F.max(F.struct("seen_at", *rest)).alias("x")).select("entity", "x.*")
    last = last if entity is None else last.where(F.col("entity") == entity)
    return last if case is None else last.where(F.array_contains("cases", case))


def exported_reports(reports: DataFrame, revisions: DataFrame, key: str | None = None, as_of: int | None = None, all_versions: bool = False) -> DataFrame:
    """Rows of each family's latest report, or as of a version, or of all versions, for one key in either of two
    columns. A file that was not parsed stays visible as one row of nulls with its status, whatever the key."""
    r = revisions if as_of is None else revisions.where(F.col("version") <= as_of)
    if not all_versions:
        r = r.join(r.groupBy("family").agg(F.max("version").alias("version")), ["family", "version"], "left_semi")
    rows = r.where("status = 'parsed'").join(reports, ["family", "version"])
    if key is not None:
        rows = rows.where(F.coalesce(F.nullif("entity", F.lit("")), "case_no") == key)
    return rows.unionByName(r.where("status <> 'parsed'"), allowMissingColumns=True)

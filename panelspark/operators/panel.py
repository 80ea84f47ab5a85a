"""The longitudinal panel in long form: presence spans, value histories, versions, the population check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import local_date
from .points import sequence


def first_last(rows: DataFrame, entity: str = "entity", at: str = "slot") -> DataFrame:
    return rows.groupBy(entity).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("n"))


def presence_spans(rows: DataFrame, entity: str = "entity", slot: str = "slot") -> DataFrame:
    """(entity, start_seq, end_seq, span_start, span_end): runs of successive snapshots that list the entity.

    A slot that was never observed does not split a span; an observed one without the entity does."""
    seq = F.broadcast(sequence(rows, [], slot).select(slot, "seq"))
    here = rows.select(entity, slot).distinct().join(seq, slot)
    island = F.col("seq") - F.row_number().over(Window.partitionBy(entity).orderBy("seq"))
    return here.withColumn("island", island).groupBy(entity, "island").agg(F.min("seq").alias("start_seq"), F.max("seq").alias("end_seq"), F.min(slot).alias("span_start"), F.max(slot).alias("span_end")).drop("island")


def changes(rows: DataFrame, value: str, keep_first_null: bool = False, entity: str = "entity", at: str = "slot") -> DataFrame:
    """(entity, at, value) where the value differs from the one last seen; a null at first is no change."""
    w = Window.partitionBy(entity).orderBy(at)
    before = F.lag(F.struct(value)).over(w)
    new = ~F.struct(value).eqNullSafe(before)
    each = rows.withColumns({"_first": F.row_number().over(w) == 1, "_new": new})
    ok = F.col("_new") & (F.lit(keep_first_null) | ~F.col("_first") | F.col(value).isNotNull())
    return each.where(ok).select(entity, F.col(at).alias("at"), value)


def current_value(history: DataFrame, value: str, entity: str = "entity") -> DataFrame:
    """The last value of each history and since when; a struct, so that a last null wins too."""
    return history.groupBy(entity).agg(F.max(F.struct("at", value)).alias("v")).select(entity, f"v.{value}", F.col("v.at").alias("listed_at"))


def owners_of(rows: DataFrame, entity: str = "entity", owner: str = "owner") -> DataFrame:
    return rows.groupBy(entity).agg(F.array_sort(F.collect_set(F.when(F.col(owner) != "", F.col(owner)))).alias("owners"))


def build_panel(rows: DataFrame, zone: str = "UTC", entity: str = "entity", slot: str = "slot", owner: str = "owner", end: str = "end_date") -> DataFrame:
    """One row per entity: first and last seen, spans, reappearances, current end date, flags and outcome.

    released: the end date is not after the local day of the last snapshot; held: on the last snapshot; else
    disappeared."""
    coverage = F.broadcast(rows.agg(F.min(slot).alias("first_slot"), F.max(slot).alias("last_slot")))
    spans = presence_spans(rows, entity, slot).groupBy(entity).agg(F.count("*").alias("spans"))
    ends = current_value(changes(rows, end, False, entity, slot), end, entity)
    base = first_last(rows, entity, slot).join(spans, entity).join(ends, entity, "left").join(owners_of(rows, entity, owner), entity).crossJoin(coverage)
    today = local_date(F.col("last_slot"), zone)
    on_latest = F.col("last_seen") == F.col("last_slot")
    outcome = F.when(F.col(end) <= today, "released").when(on_latest, "held").otherwise("disappeared")
    return base.select(entity, "first_seen", "last_seen", "spans", (F.col("spans") - 1).alias("reappearances"), end, "listed_at", "owners", (F.col("first_seen") == F.col("first_slot")).alias("left_truncated"), on_latest.alias("on_latest"), outcome.alias("outcome"))


def versions(details: DataFrame, facts: list[str], known: DataFrame | None = None, entity: str = "entity", at: str = "at") -> DataFrame:
    """Detail versions whose facts differ from the version before; entities outside `known` are left out."""
    if known is not None:
        details = details.join(known, entity, "left_semi")
    now = F.struct(*facts)
    before = F.lag(now).over(Window.partitionBy(entity).orderBy(at))
    return details.withColumn("_new", ~now.eqNullSafe(before)).where("_new").drop("_new")


def field_changes(details: DataFrame, facts: list[str], entity: str = "entity", at: str = "at") -> DataFrame:
    """(field, changes): how often each fact differs between consecutive versions."""
    w = Window.partitionBy(entity).orderBy(at)
    later = F.row_number().over(w) > 1
    flags = {f: (later & ~F.struct(f).eqNullSafe(F.lag(F.struct(f)).over(w))).cast("int") for f in facts}
    wide = details.select(*[c.alias(f) for f, c in flags.items()]).agg(*[F.sum(f).alias(f) for f in facts])
    return wide.unpivot([], facts, "field", "changes")


def held_rows(rows: DataFrame, zone: str = "UTC", entity: str = "entity", slot: str = "slot", owner: str = "owner", end: str = "end_date") -> DataFrame:
    """(entity, seq, slot, owner, end): each snapshot of each span with the values in effect then.

    Spans become the snapshots they had, change points are put between them, and one window per entity carries the last
    value on; its rows are the entity's snapshots and changes, nothing beyond a span."""
    seq = sequence(rows, [], slot).select(slot, "seq")
    present = presence_spans(rows, entity, slot).select(entity, F.explode(F.sequence("start_seq", "end_seq")).alias("seq"))
    of = {owner: changes(rows, owner, True, entity, slot), end: changes(rows, end, False, entity, slot)}
    kinds = {c: rows.schema[c].dataType for c in of}

    def points(name: str) -> DataFrame:
        h = of[name].withColumnRenamed("at", slot).join(seq, slot)
        return h.select(entity, "seq", F.lit(False).alias("_here"), *[(F.struct(F.col(c).alias("v")) if c == name else F.lit(None).cast(f"struct<v:{kinds[c].simpleString()}>")).alias(f"_{c}") for c in of])

    here = present.select(entity, "seq", F.lit(True).alias("_here"), *[F.lit(None).cast(f"struct<v:{kinds[c].simpleString()}>").alias(f"_{c}") for c in of])
    each = here.union(points(owner)).union(points(end)).groupBy(entity, "seq").agg(F.max("_here").alias("_here"), *[F.max(f"_{c}").alias(f"_{c}") for c in of])
    w = Window.partitionBy(entity).orderBy("seq")
    held = each.withColumns({c: F.last(f"_{c}", ignorenulls=True).over(w) for c in of}).where("_here")
    return held.join(seq, "seq").select(entity, "seq", slot, F.col(f"{owner}.v").alias(owner), F.col(f"{end}.v").alias(end))


def held_at(slot: Column, end: Column, zone: str = "UTC") -> Column:
    """Held: no end date, or one after the local day."""
    return end.isNull() | (end > local_date(slot, zone))


def check_populations(rows: DataFrame, populations: DataFrame, zone: str = "UTC") -> DataFrame:
    """Snapshots whose population, recomputed from spans and histories, differs from the archived one."""
    held = held_rows(rows, zone)
    again = held.where((F.col("owner") != "") & held_at(F.col("slot"), F.col("end_date"), zone)).groupBy("slot").agg(F.count_distinct("owner").alias("recomputed"))
    both = populations.join(again, "slot", "left").withColumn("recomputed", F.coalesce("recomputed", F.lit(0)))
    return both.where(F.col("population") != F.col("recomputed"))

"""Change events and intervals between versions and between visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Kinds of change in the order of their rules.
KINDS = ("newly assessed", "recognizance entered", "reduced", "increased", "cleared")


def classified_changes(versions: DataFrame, complete: Column, amount: str, kinds: str, assessed: str, recognizance: str, entity: str = "entity", at: str = "seen_at") -> DataFrame:
    """(entity, at, kind, before, after) between consecutive complete versions, by the first rule that fits: the
    assessed type appears, the recognizance type appears, the amount moves between two values above 0, or goes to 0."""
    w = Window.partitionBy(entity).orderBy(at)
    v = versions.where(complete).withColumns({"_a": F.lag(amount).over(w), "_k": F.lag(kinds).over(w)}).where("_k is not null")
    new = lambda x: F.array_contains(kinds, x) & ~F.array_contains("_k", x)
    old, now = F.coalesce("_a", F.lit(0)), F.coalesce(amount, F.lit(0))
    moved = F.when(now < old, KINDS[2]).when(now > old, KINDS[3])
    kind = F.when(new(assessed), KINDS[0]).when(new(recognizance), KINDS[1]).when((old > 0) & (now > 0), moved).when(old > 0, KINDS[4])
    return v.select(entity, F.col(at), kind.alias("kind"), F.col("_a").alias("before"), F.col(amount).alias("after")).where("kind is not null")


def first_of_kind(changes: DataFrame, entity: str = "entity", at: str = "seen_at") -> DataFrame:
    return changes.groupBy(entity, "kind").agg(F.min(F.struct(at, "before", "after")).alias("x")).select(entity, "kind", f"x.{at}", "x.before", "x.after")


def follow_up(changes: DataFrame, ends: DataFrame, snapshot: Column, entity: str = "entity", at: str = "seen_at", end: str = "end_date", gone: Column | None = None, last_day: Column | None = None) -> DataFrame:
    """Adds event and duration: days from a change to the end by the snapshot. Without one an entity that is `gone` is
    censored on its last day, the others at the snapshot. duration is null if the change was seen after that."""
    day = F.col(at).cast("date")
    event = F.coalesce(F.col(end) <= snapshot, F.lit(False))
    until = F.when(event, F.col(end)).when(F.lit(False) if gone is None else gone, F.lit(None).cast("date") if last_day is None else last_day).otherwise(snapshot)
    j = changes.join(ends, entity, "left").withColumns({"event": event, "duration": F.datediff(until, day)})
    return j.withColumn("duration", F.when(F.col("duration") >= 0, F.col("duration")))


def date_moves(versions: DataFrame, date: str = "next_date", entity: str = "entity", at: str = "seen_at") -> DataFrame:
    """(entity, at, kind, days): how a planned date moves between versions. first and removed: it appears or goes;
    passed: the old date had come; earlier or reset: it moves before it came."""
    w = Window.partitionBy(entity).orderBy(at)
    v = versions.withColumns({"_b": F.lag(date).over(w), "_r": F.row_number().over(w)}).where(~F.col(date).eqNullSafe(F.col("_b")) & (F.col("_r") > 1))
    seen = F.col(at).cast("date")
    kind = F.when(F.col("_b").isNull(), "first").when(F.col(date).isNull(), "removed").when(F.col("_b") <= seen, "passed").when(F.col(date) < F.col("_b"), "earlier").otherwise("reset")
    return v.select(entity, at, kind.alias("kind"), F.datediff(date, "_b").alias("days"))


def conflicted_owners(owners: DataFrame, entity: str = "entity") -> DataFrame:
    """Owners of any entity that does not have exactly one; owners is an array column."""
    return owners.where(F.size("owners") != 1).select(F.explode("owners").alias("owner")).distinct()


def unconflicted(visits: DataFrame, owners: str = "owners", allowed_none: bool = False) -> DataFrame:
    """Visits with one owner, in `owner`, who is in no visit of several owners (nor, unless allowed, in one without)."""
    one = F.size(owners) == 1
    bad = visits.where(~one if not allowed_none else F.size(owners) > 1).select(F.explode(owners).alias("owner")).distinct()
    return visits.where(one).withColumn("owner", F.col(owners)[0]).join(bad, "owner", "left_anti")


def visit_gaps(visits: DataFrame, owner: str = "owner", entity: str = "entity", start: str = "start_date", end: str = "end_date", days: int = 32) -> DataFrame:
    """(owner, entity, kind, days) for each visit after an owner's first: the days from the end of the one before.

    missing: no end before, or any start of the owner is missing; invalid: the visit before starts no earlier, ends
    before its start, or ends after this start. Visits are put in order within buckets of `days` days; a bucket's first
    goes on from the last of the owner's bucket before, told from one row per owner and bucket. So no task orders all
    dated visits of an owner, however many it has."""
    v = visits.where(F.col(owner) != "").withColumn("_b", F.coalesce(F.floor(F.unix_date(start) / days).cast("int"), F.lit(-(1 << 31))))
    within, over = Window.partitionBy(owner, "_b").orderBy(start, entity), Window.partitionBy(owner)
    v = v.withColumns({"_end": F.lag(end).over(within), "_start": F.lag(start).over(within), "_r": F.row_number().over(within)})
    edges = v.groupBy(owner, "_b").agg(F.max(F.struct(F.col(start).alias("start"), F.col(entity).alias("entity"), F.col(end).alias("end"))).alias("_last"), F.max(F.col(start).isNull()).alias("_none"))
    edges = edges.select(owner, "_b", F.lag("_last").over(over.orderBy("_b")).alias("_before"), F.max("_none").over(over).alias("_void"))
    v = v.join(edges, [owner, "_b"]).where((F.col("_r") > 1) | F.col("_before").isNotNull())
    later = F.col("_r") > 1
    v = v.withColumns({"_end": F.when(later, F.col("_end")).otherwise(F.col("_before.end")), "_start": F.when(later, F.col("_start")).otherwise(F.col("_before.start"))})
    wrong = (F.col("_start") >= F.col(start)) | (F.col("_end") < F.col("_start")) | (F.col("_end") > F.col(start))
    kind = F.when(F.col("_void") | F.col("_end").isNull(), "missing").when(wrong, "invalid").otherwise("measured")
    return v.select(owner, entity, kind.alias("kind"), F.when(kind == "measured", F.datediff(start, "_end")).alias("days"))


def visit_registry(rows: DataFrame, entity: str = "entity", owner: str = "owner", at: str = "slot", end: str = "end_date") -> DataFrame:
    """Union of owners, first sight and last written end date per entity; a null written last wins."""
    return rows.groupBy(entity).agg(F.array_sort(F.collect_set(F.when(F.col(owner) != "", F.col(owner)))).alias("owners"), F.min(at).alias("first_seen"), F.max(F.struct(F.col(at), F.col(end))).alias("_l")).select(entity, "owners", "first_seen", F.col(f"_l.{end}").alias(end))

"""Reconciliation of two sources: aligned versions, sets of entities, and the latest version field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import band, local_date, set_relation
from . import joins

# fixed values: inclusive upper bounds of days and their labels
AGES = [(1, "1 day or less"), (7, "2-7 days"), (30, "8-30 days"), (365, "31-365 days"), (None, "more than a year")]
#: Counts of a version of which by_day() gives medians.
BY_DAY = ["second", "held", "shared", "only_second", "second_listed_ended", "only_first"]


def aligned(versions: DataFrame, slots: DataFrame, seconds: int) -> DataFrame:
    """(version, slot): each version of the second source with the first's snapshot nearest in time, null beyond
    `seconds`, the earlier one at a tie."""
    return joins.nearest(versions, slots, "version", "slot", seconds).select("version", "slot")


def entity_sets(first: DataFrame, second: DataFrame, al: DataFrame, seen: DataFrame) -> DataFrame:
    """(version, slot, entity, listed, held, in_second, first_seen): entities of either source at the aligned versions.

    first: slot, entity, held; second: version, entity (any number of rows); seen: entity, first_seen. Both sides are
    joined on (version, entity), so a version's entities spread over all tasks."""
    met = al.where("slot is not null")
    held = met.join(first.groupBy("slot", "entity").agg(F.max("held").alias("held")), "slot").select("version", "entity", "held", F.lit(True).alias("listed"))
    there = second.select("version", "entity").distinct().join(met.select("version"), "version").withColumn("in_second", F.lit(True))
    both = held.join(there, ["version", "entity"], "full_outer").join(met, "version").join(seen, "entity", "left")
    is_ = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return both.select("version", "slot", "entity", is_("listed"), is_("held"), is_("in_second"), "first_seen")


def version_counts(sets: DataFrame, recent: int) -> DataFrame:
    """Per aligned version: entities in the second source, held, listed, shared, and those of one side only, split by
    whether the first source has listed them by then, or has first listed them within `recent` seconds."""
    listed, held, second = F.col("listed"), F.col("held"), F.col("in_second")
    absent, lone = held & ~second, second & ~listed
    counts = {
        "second": second, "held": held, "listed": listed, "shared": second & held, "only_second": lone, "only_second_seen_before": lone & (F.col("first_seen") <= F.col("slot")),
        "second_listed_ended": second & listed & ~held, "only_first": absent, "only_first_recent": absent & (F.unix_seconds("first_seen") >= F.unix_seconds("version") - recent),
    }
    return sets.groupBy("version", "slot").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def latest_aligned(al: DataFrame) -> DataFrame:
    """The one row of the newest version that has a snapshot."""
    return al.where("slot is not null").agg(F.max(F.struct("version", "slot")).alias("v")).where("v is not null").select("v.version", "v.slot")


def field_classes(rows: DataFrame, details: DataFrame) -> DataFrame:
    """(entity, book_date, cases, hold, court): how a record of the first source agrees with the second's rows.

    rows: entity, case_no, book_date, hold, court_date, many of an entity; details: entity, start_date, cases, hold,
    hearings, one of an entity. An entity without a record has that class in every field."""
    named = F.when(F.col("case_no") != "", F.col("case_no"))
    s = rows.groupBy("entity").agg(F.collect_set("book_date").alias("days"), F.collect_set(named).alias("cases"), F.max(F.coalesce("hold", F.lit(False))).alias("hold"), F.min("court_date").alias("court"))
    j = s.alias("s").join(details.withColumn("known", F.lit(True)).alias("d"), "entity", "left")
    day, start = F.element_at("s.days", 1), F.col("d.start_date")
    date = F.when((F.size("s.days") == 0) | start.isNull(), "date missing on one side").when(F.size("s.days") > 1, "several dates").when(day == start, "same date").when(day > start, "second later").otherwise("second earlier")
    a, b = F.col("s.hold"), F.coalesce(F.col("d.hold"), F.lit(False))
    hold = F.when(a & b, "both").when(~a & ~b, "neither").when(a, "only second").otherwise("only first")
    theirs, ours = F.col("s.court"), F.array_min("d.hearings")
    court = F.when(theirs.isNull() & ours.isNull(), "neither lists a date").when(theirs.isNull() | ours.isNull(), "only one lists a date").when(theirs == ours, "same earliest date").otherwise("other earliest date")
    of = {"book_date": date, "cases": set_relation(F.col("s.cases"), F.col("d.cases")), "hold": hold, "court": court}
    return j.select("entity", *[F.when(F.col("known"), c).otherwise("no record").alias(n) for n, c in of.items()])


def long_counts(df: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """(part, section, label, value): rows by label of each column, all columns in one pass."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(c.replace("_", " ")).alias("section"), F.col(c).alias("label")) for c in columns])).alias("x"))
    return each.groupBy(F.lit(part).alias("part"), "x.section", "x.label").agg(F.count("*").cast("double").alias("value"))


def second_only_traits(rows: DataFrame, today: Column) -> DataFrame:
    """(entity, authority, age, hold) of rows of entities that only the second source lists: the commonest authority
    (blank: not listed; the least label at a tie), the band of days since the earliest date, any hold."""
    authority = F.coalesce(F.nullif(F.trim("authority"), F.lit("")), F.lit("not listed"))
    modal = joins.modal(rows.select("entity", authority.alias("authority")), ["entity"], "authority")
    g = rows.groupBy("entity").agg(F.min("book_date").alias("booked"), F.max(F.coalesce("hold", F.lit(False))).alias("any"), F.max(today).alias("today"))
    days = F.datediff("today", "booked")
    days = F.when(days < 0, 0).otherwise(days)  # null stays
    return g.join(modal, "entity").select("entity", "authority", F.coalesce(band(days, AGES), F.lit("date missing")).alias("age"), F.when(F.col("any"), "hold").otherwise("no hold").alias("hold"))


def by_day(counts: DataFrame, zone: str) -> DataFrame:
    """Per local day of the versions: how many were compared, and the median of each count."""
    return counts.groupBy(local_date(F.col("version"), zone).alias("day")).agg(F.count("*").alias("versions"), *[F.median(c).alias(c) for c in BY_DAY])


def reconciliation(first: DataFrame, second: DataFrame, details: DataFrame, zone: str, seconds: int = 1200, recent: int = 7200) -> DataFrame:
    """(part, section, label, value): the whole comparison of two sources in one long table.

    first: slot, entity, held. second: version, entity, case_no, book_date, hold, court_date, authority, many rows of an
    entity. details: the first source's records, see field_classes(), and location. Parts: versions (all, aligned,
    unaligned), latest (counts of the newest aligned version), by day (medians), field agreement (of entities held and in
    the second source), second only, first only. The newest version's rows are picked before anything is compared."""
    al = aligned(second.select("version").distinct(), first.select("slot").distinct(), seconds)
    seen = first.groupBy("entity").agg(F.min("slot").alias("first_seen"))
    counts = version_counts(entity_sets(first, second, al, seen), recent)
    newest = latest_aligned(al)
    sets = entity_sets(first, second, newest, seen)
    rows = second.join(newest.select("version"), "version")
    of = lambda c: rows.join(sets.where(c).select("entity"), "entity", "left_semi")
    row = lambda part, section, df, columns: df.select(F.explode(F.array(*[F.struct(F.lit(part).alias("part"), section.alias("section"), F.lit(c.replace("_", " ")).alias("label"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")).select("x.*")
    versions = al.agg(F.count("*").alias("versions"), F.count("slot").alias("aligned"), (F.count("*") - F.count("slot")).alias("unaligned"))
    out = row("versions", F.lit("all"), versions, versions.columns)
    latest = counts.join(newest.select("version"), "version", "left_semi")
    out = out.union(row("latest", F.lit("all"), latest, counts.columns[2:]))
    out = out.union(row("by day", F.col("day").cast("string"), by_day(counts, zone), ["versions", *BY_DAY]))
    out = out.union(long_counts(field_classes(of("held and in_second"), details), "field agreement", ["book_date", "cases", "hold", "court"]))
    out = out.union(long_counts(second_only_traits(of("in_second and not listed"), local_date(F.col("version"), zone)), "second only", ["authority", "age", "hold"]))
    lone = sets.where("held and not in_second").select("entity").join(details.select("entity", F.coalesce(F.nullif("location", F.lit("")), F.lit("not listed")).alias("location")), "entity", "left")
    return out.union(long_counts(lone.select(F.coalesce("location", F.lit("no record")).alias("location")), "first only", ["location"]))

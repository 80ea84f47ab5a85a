"""Point metrics of snapshots: slots, populations, arrivals and departures, gaps, bins, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import local_date

#: Seconds of a slot, and by how much two observations may lie apart to be compared.
SLOT, APART = 900, 1200


def slot_of(instant: Column, seconds: int = SLOT) -> Column:
    """Start of the UTC slot that holds an instant."""
    s = F.unix_seconds(instant)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds)))


def sequence(slots: DataFrame, keys: list[str], slot: str = "slot") -> DataFrame:
    """(keys, slot, seq, before): the distinct slots in order with their number and the slot before.

    One row per snapshot, so the window is as long as the history, not the data."""
    w = Window.partitionBy(*keys).orderBy(slot)
    return slots.select(*keys, slot).distinct().withColumns({"seq": F.row_number().over(w), "before": F.lag(slot).over(w)})


def snapshot_metrics(rows: DataFrame, zone: str = "UTC", slot: str = "slot", entity: str = "entity", owner: str = "owner", end: str = "end_date") -> DataFrame:
    """Per snapshot: active and listed owners, rows, entities, owners that are listed but not active.

    An owner is active if any of its rows has no end date or one after the local day; blank owners are nobody."""
    active = F.col(end).isNull() | (F.col(end) > local_date(F.col(slot), zone))
    # one row per owner first, so that the last metric is a difference of sets
    per = rows.groupBy(slot, owner).agg(F.max(active).alias("active"), F.count("*").alias("n"))
    named = F.col(owner) != ""
    owners = per.groupBy(slot).agg(
        F.count_if(named & F.col("active")).alias("population"),
        F.count_if(named).alias("listed_owners"),
        F.sum("n").alias("n_rows"),
        F.count_if(named & ~F.col("active")).alias("seen_not_active"),
    )
    return owners.join(rows.groupBy(slot).agg(F.count_distinct(entity).alias("entities")), slot)


def flows(rows: DataFrame, seconds: int = SLOT, apart: int = APART, keys: tuple[str, ...] = (), slot: str = "slot", entity: str = "entity", observed: str | None = None) -> DataFrame:
    """Per slot: arrivals and departures against the slot before, null unless the two are adjacent, and the minutes
    between them (half-even to 0.1). Sets are compared by an outer join on (entity, number of the slot)."""
    keys = list(keys)
    seq = sequence(rows, keys, slot)
    if observed:
        seq = seq.join(rows.groupBy(*keys, slot).agg(F.min(observed).alias("at")), [*keys, slot])
    else:
        seq = seq.withColumn("at", F.col(slot))
    seq = seq.withColumn("at_before", F.lag("at").over(Window.partitionBy(*keys).orderBy("seq")))
    here = rows.select(*keys, slot, entity).distinct().join(F.broadcast(seq.select(*keys, slot, "seq")), [*keys, slot]).select(*keys, "seq", entity)
    gone = here.withColumn("seq", F.col("seq") + 1).withColumn("was", F.lit(1))
    both = here.withColumn("is", F.lit(1)).join(gone, [*keys, "seq", entity], "full_outer")
    moved = both.groupBy(*keys, "seq").agg(F.count_if(F.col("was").isNull()).alias("came"), F.count_if(F.col("is").isNull()).alias("left"))
    gap = F.unix_seconds("at") - F.unix_seconds("at_before")
    near = (F.unix_seconds(slot) - F.unix_seconds("before") == seconds) & (gap > 0) & (gap <= apart)
    return seq.join(moved, [*keys, "seq"], "left").select(
        *keys,
        slot,
        F.when(near, F.coalesce("came", F.lit(0))).alias("arrivals"),
        F.when(near, F.coalesce("left", F.lit(0))).alias("departures"),
        F.when(near, F.bround(gap / 60, 1)).alias("comparison_minutes"),
    )


def cumulative_seen(rows: DataFrame, slot: str = "slot", entity: str = "entity", keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct entities seen up to each snapshot: new ones per slot, then a running sum over the slots."""
    keys = list(keys)
    new = rows.groupBy(*keys, entity).agg(F.min(slot).alias(slot)).groupBy(*keys, slot).agg(F.count("*").alias("new"))
    all_slots = rows.select(*keys, slot).distinct().join(new, [*keys, slot], "left")
    return all_slots.select(*keys, slot, F.sum(F.coalesce("new", F.lit(0))).over(Window.partitionBy(*keys).orderBy(slot)).alias("seen"))


def missing_slots(points: DataFrame, keys: list[str], seconds: int = SLOT, slot: str = "slot") -> DataFrame:
    """Slots between the first and the last of each group that have no observation."""
    span = points.groupBy(*keys).agg(F.min(slot).alias("a"), F.max(slot).alias("z"))
    every = span.select(*keys, F.explode(F.sequence("a", "z", F.expr(f"INTERVAL {seconds} SECONDS"))).alias(slot))
    return every.join(points.select(*keys, slot).distinct(), [*keys, slot], "left_anti")


def change_bins(changes: DataFrame, seconds: int, keys: tuple[str, ...] = (), at: str = "slot") -> DataFrame:
    """Arrivals and departures summed per bin; slots without a comparison don't count, empty bins are absent."""
    return changes.where("arrivals is not null").groupBy(*keys, slot_of(F.col(at), seconds).alias("bin")).agg(F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures"))


def gap_broken(points: DataFrame, keys: list[str], value: str, seconds: int = SLOT, slot: str = "slot") -> DataFrame:
    """The series with a null point one slot before each point that follows a gap."""
    gap = F.unix_seconds(slot) - F.unix_seconds(F.lag(slot).over(Window.partitionBy(*keys).orderBy(slot))) > seconds
    here = F.struct(F.col(slot), F.col(value).cast("long").alias(value))
    hole = F.struct((F.col(slot) - F.expr(f"INTERVAL {seconds} SECONDS")).alias(slot), F.lit(None).cast("long").alias(value))
    return points.withColumn("gap", gap).select(*keys, F.explode(F.when(F.col("gap"), F.array(hole, here)).otherwise(F.array(here))).alias("p")).select(*keys, f"p.{slot}", f"p.{value}")


def hourly_alignment(points: DataFrame, sources: list[str], value: str = "population", slot: str = "slot") -> DataFrame:
    """The last value in each hour, one column per source."""
    return points.groupBy(F.date_trunc("hour", slot).alias("hour")).pivot("source", sources).agg(F.max_by(value, slot))


def view_range(points: DataFrame, days: int, now: Column, at: str = "observed_at") -> DataFrame:
    """Observations of the last 1, 7, 30 or 90 days; any other number counts as 7."""
    return points.where(F.col(at) >= now - F.expr(f"INTERVAL {days if days in (1, 7, 30, 90) else 7} DAYS"))


def last_n(points: DataFrame, n: int, keys: list[str], at: str = "slot") -> DataFrame:
    return points.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(at)))).where(F.col("_r") <= n).drop("_r")


def source_health(last: Column, failed: Column, complete: Column, now: Column, overdue: int = 1800) -> Column:
    """no data, failed, overdue, incomplete or ok: the first that holds."""
    return F.when(last.isNull(), "no data").when(failed, "failed").when(F.unix_seconds(now) - F.unix_seconds(last) > overdue, "overdue").when(~complete, "incomplete").otherwise("ok")


def health_rollup(health: DataFrame) -> DataFrame:
    """The worst class, the earliest last success if every source has one, and the sources' classes joined."""
    rank = {"ok": 0, "incomplete": 1, "overdue": 2, "failed": 3, "no data": 4}
    severity = F.element_at(F.create_map(*[F.lit(x) for kv in rank.items() for x in kv]), F.col("health"))
    return health.withColumn("severity", severity).agg(
        F.max_by("health", "severity").alias("worst"),
        F.when(F.count("last") == F.count("*"), F.min("last")).alias("last_success"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "source", "health"))), "; ").alias("detail"),
    )


def scan_completeness(pages: DataFrame, scan: str, first: str, last: str, rows: str, total: str, distinct: str) -> DataFrame:
    """Whether a scan's pages run on from row 1, hold the rows that they announce, and reach the total once each."""
    w = Window.partitionBy(scan).orderBy(first)
    each = pages.withColumns({"follows": F.coalesce(F.lag(last).over(w), F.lit(0)) + 1 == F.col(first), "fits": F.col(last) - F.col(first) + 1 == F.col(rows)})
    return each.groupBy(scan).agg(F.bool_and("follows").alias("contiguous"), F.bool_and("fits").alias("ranges_fit"), (F.sum(rows) == F.max(total)).alias("total_met"), (F.sum(rows) == F.sum(distinct)).alias("no_duplicates"))

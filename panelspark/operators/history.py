"""Snapshot history as multiset change logs: states, differences, reconstruction, fingerprints, repair, replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import row_hash
from .points import sequence


def canonical_states(rows: DataFrame, columns: Sequence[str], slot: str = "slot", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, slot, row_hash, the columns, multiplicity): each snapshot as a multiset of rows without order."""
    hashed = rows.withColumn("row_hash", row_hash(columns))
    return hashed.groupBy(*keys, slot, "row_hash").agg(*[F.any_value(c).alias(c) for c in columns], F.count("*").alias("multiplicity"))


def change_log(states: DataFrame, columns: Sequence[str], slot: str = "slot") -> DataFrame:
    """(slot, seq, day, row_hash, the columns, delta): rows whose multiplicity differs from the snapshot before.

    The first snapshot of a UTC day is logged against nothing, so a day's log rebuilds each of its snapshots alone."""
    seq = sequence(states, [], slot).withColumns({"day": F.to_date(slot), "first": F.coalesce(F.to_date("before") != F.to_date(slot), F.lit(True))})
    seq = F.broadcast(seq.select(slot, "seq", "day", "first"))
    here = states.join(seq, slot)
    was = here.select((F.col("seq") + 1).alias("seq"), "row_hash", F.col("multiplicity").alias("was"), *[F.col(c).alias(f"_{c}") for c in columns])
    # rows that a checkpoint does not compare are dropped before the join
    was = was.join(F.broadcast(seq.where("not first").select("seq")), "seq", "left_semi")
    now = here.select("seq", "row_hash", "multiplicity", *columns)
    both = now.join(was, ["seq", "row_hash"], "full_outer")
    delta = F.coalesce("multiplicity", F.lit(0)) - F.coalesce("was", F.lit(0))
    out = both.select("seq", "row_hash", *[F.coalesce(c, f"_{c}").alias(c) for c in columns], delta.alias("delta")).where("delta <> 0")
    return out.join(seq, "seq").select(slot, "seq", "day", "first", "row_hash", *columns, "delta")


def state_at(log: DataFrame, at: Column, columns: Sequence[str], slot: str = "slot") -> DataFrame:
    """The multiset of a snapshot from its day's log: sums of deltas up to it; one row for each repetition."""
    upto = log.where((F.col("day") == F.to_date(at)) & (F.col(slot) <= at))
    m = upto.groupBy("row_hash").agg(*[F.any_value(c).alias(c) for c in columns], F.sum("delta").alias("m")).where("m > 0")
    return m.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("m").cast("int")))).select(*columns)


def all_states(log: DataFrame, slots: DataFrame, slot: str = "slot") -> DataFrame:
    """(slot, row_hash, multiplicity) of every snapshot, by running sums within a day."""
    w = Window.partitionBy("day", "row_hash").orderBy("seq")
    s = log.withColumns({"m": F.sum("delta").over(w), "until": F.lead("seq").over(w)})
    seq = sequence(slots, [], slot).withColumn("day", F.to_date(slot)).select(F.col(slot), F.col("seq").alias("q"), F.col("day").alias("d"))
    # a version holds until the next one of its day
    hit = (F.col("d") == F.col("day")) & (F.col("q") >= F.col("seq")) & (F.col("until").isNull() | (F.col("q") < F.col("until")))
    return s.select("day", "seq", "row_hash", "m", "until").where("m > 0").join(F.broadcast(seq), hit).select(slot, "row_hash", F.col("m").alias("multiplicity"))


def patch_faults(before: DataFrame, patch: DataFrame) -> DataFrame:
    """(row_hash, fault) of a patch's bad entries: a count that is not positive, a removal of what is not there, an
    entry that is listed twice or both added and removed. patch: (row_hash, kind added or removed, count)."""
    p = patch.withColumn("_n", F.count("*").over(Window.partitionBy("row_hash")))
    j = p.join(before.select("row_hash", "multiplicity"), "row_hash", "left")
    fault = F.when(F.col("count") <= 0, "count not positive").when(F.col("_n") > 1, "duplicate entry").when((F.col("kind") == "removed") & (F.coalesce("multiplicity", F.lit(0)) < F.col("count")), "removes too many")
    return j.select("row_hash", fault.alias("fault")).where("fault is not null")


def fingerprints(states: DataFrame, slot: str = "slot") -> DataFrame:
    """(slot, n, total): an order-free digest of each snapshot: how many rows, and the sum of their hashes."""
    h = F.conv(F.substring("row_hash", 1, 15), 16, 10).cast("decimal(38,0)")
    return states.groupBy(slot).agg(F.sum("multiplicity").alias("n"), F.sum(h * F.col("multiplicity")).cast("decimal(38,0)").alias("total"))


def entry_kinds(states: DataFrame, log: DataFrame, slot: str = "slot") -> DataFrame:
    """checkpoint (first of its UTC day, or a delta as large as the state), unchanged or delta, for each snapshot."""
    f = fingerprints(states, slot)
    w = Window.orderBy(slot)  # one row per snapshot
    sizes = log.where("not first").groupBy(slot).agg(F.count("*").alias("changed"))
    f = f.join(sizes, slot, "left").withColumns({"_d": F.coalesce(F.to_date(F.lag(slot).over(w)) != F.to_date(slot), F.lit(True)), "_same": F.struct("n", "total").eqNullSafe(F.lag(F.struct("n", "total")).over(w))})
    kind = F.when(F.col("_d"), "checkpoint").when(F.col("_same"), "unchanged").when(F.col("changed") >= F.col("n"), "checkpoint").otherwise("delta")
    return f.select(slot, "n", F.coalesce("changed", F.lit(0)).alias("changed"), kind.alias("kind"))


def chain_breaks(entries: DataFrame, slot: str = "slot") -> DataFrame:
    """Entries whose `before` fingerprint is not the `state` of the entry before."""
    w = Window.orderBy(slot)
    return entries.withColumn("_p", F.lag("state").over(w)).where("_p is not null and not (before <=> _p)").drop("_p")


def repaired(rows: DataFrame, heading: Column, slot: str = "slot", entity: str = "entity") -> DataFrame:
    """(slot, removed, n_rows, population) after heading rows are left out of every snapshot."""
    return rows.groupBy(slot).agg(F.count_if(heading).alias("removed"), F.count_if(~heading).alias("n_rows"), F.count_distinct(F.when(~heading, F.col(entity))).alias("population"))


def latest_projection(points: DataFrame, source: str = "source", at: str = "slot") -> DataFrame:
    """The current state per source."""
    rest = [c for c in points.columns if c not in (source, at)]
    return points.groupBy(source).agg(F.max(F.struct(at, *rest)).alias("x")).select(source, "x.*")

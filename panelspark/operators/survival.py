"""Kaplan-Meier survival by group, as grouped aggregates and windows over distinct durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kaplan_meier(obs: DataFrame, keys: Sequence[str], duration: str = "duration", event: str = "event", z: float = 1.959963984540054) -> DataFrame:
    """(keys, time, at_risk, events, censored, survival, lower, upper) per distinct duration.

    Rows are counted per (group, duration) before any window, so a group's window is as long as its days. At ties
    events come before censoring; negative or null durations don't count. Limits are log-log with Greenwood's
    variance; null where survival is 0 or 1."""
    keys = list(keys)
    counts = obs.where(F.col(duration) >= 0).groupBy(*keys, F.col(duration).alias("time")).agg(F.count_if(event).alias("events"), F.count_if(~F.col(event)).alias("censored"))
    w = Window.partitionBy(*keys).orderBy("time")
    down = Window.partitionBy(*keys).orderBy(F.desc("time"))
    c = counts.withColumn("at_risk", F.sum(F.col("events") + F.col("censored")).over(down))
    c = c.withColumn("survival", F.product(1 - F.col("events") / F.col("at_risk")).over(w))
    term = F.when(F.col("events") == F.col("at_risk"), None).otherwise(F.col("events") / (F.col("at_risk") * (F.col("at_risk") - F.col("events"))))
    c = c.withColumns({"_sum": F.sum(term).over(w), "_void": F.max(F.col("events") == F.col("at_risk")).over(w)})
    s = F.col("survival")
    half = z * F.sqrt("_sum") / F.log(s)
    ok = (s > 0) & (s < 1) & ~F.col("_void")
    return c.select(*keys, "time", "at_risk", "events", "censored", "survival", F.when(ok, F.pow(s, F.exp(-half))).alias("lower"), F.when(ok, F.pow(s, F.exp(half))).alias("upper"))


def survival_at(km: DataFrame, keys: Sequence[str], days: Sequence[int]) -> DataFrame:
    """(keys, day, survival, lower, upper): 1 before the first row, null beyond the longest duration."""
    keys = list(keys)
    each = km.withColumn("day", F.explode(F.array(*[F.lit(x) for x in days])))
    past = F.col("time") <= F.col("day")
    at = F.max_by(F.when(past, F.struct("survival", "lower", "upper")), F.when(past, F.col("time")))
    g = each.groupBy(*keys, "day").agg(at.alias("at"), F.max("time").alias("longest"))
    beyond = F.col("day") > F.col("longest")
    value = F.when(~beyond, F.coalesce("at.survival", F.lit(1.0)))
    return g.select(*keys, "day", value.alias("survival"), F.when(~beyond, F.col("at.lower")).alias("lower"), F.when(~beyond, F.col("at.upper")).alias("upper"))


def at_risk_at(km: DataFrame, keys: Sequence[str], days: Sequence[int]) -> DataFrame:
    """Still followed after a day."""
    each = km.withColumn("day", F.explode(F.array(*[F.lit(x) for x in days])))
    n = F.sum(F.when(F.col("time") > F.col("day"), F.col("events") + F.col("censored")).otherwise(0))
    return each.groupBy(*keys, "day").agg(n.alias("at_risk"))


def event_quantiles(km: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """First time by which a share had the event; null if it never is."""
    each = km.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    return each.groupBy(*keys, "share").agg(F.min(F.when(F.col("survival") <= 1 - F.col("share") + 1e-12, F.col("time"))).alias("time"))


def step_curve(km: DataFrame) -> DataFrame:
    return km.where("events > 0")


def group_summary(obs: DataFrame, keys: Sequence[str], duration: str = "duration", event: str = "event", days: Sequence[int] = ()) -> DataFrame:
    """n, events, censored, longest follow-up, quartiles of the event time; for each of `days` the survival with its
    limits and how many are followed longer (still_, lower_, upper_ and at_risk_ with the day)."""
    keys = list(keys)
    km = kaplan_meier(obs, keys, duration, event)
    n = km.groupBy(*keys).agg(F.sum(F.col("events") + F.col("censored")).alias("n"), F.sum("events").alias("events"), F.sum("censored").alias("censored"), F.max("time").alias("longest"))
    q = event_quantiles(km, keys, (0.25, 0.5, 0.75)).groupBy(*keys).agg(*[F.max(F.when(F.col("share") == s, F.col("time"))).alias(name) for s, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    out = n.join(q, keys)
    if days:
        at = survival_at(km, keys, days).join(at_risk_at(km, keys, days), [*keys, "day"])
        wide = [F.max(F.when(F.col("day") == d, F.col(c))).alias(f"{name}_{d}") for d in days for c, name in (("survival", "still"), ("lower", "lower"), ("upper", "upper"), ("at_risk", "at_risk"))]
        out = out.join(at.groupBy(*keys).agg(*wide), keys)
    return out


def build_stays(entities: DataFrame, start: Column, first_seen: Column, end: Column, last_known: Column, early: int = 7, gone: Column | None = None, last_seen: Column | None = None) -> DataFrame:
    """Adds origin, from_start, reason (why a stay is left out), duration in days and event.

    The origin is the start date, else the day first seen. Left out: a start more than `early` days before the first
    sight or after it, an end of follow-up before the origin. Without an end by the last known day a stay is censored:
    on the day last seen if it is `gone`, else on the last known day."""
    origin = F.coalesce(start, first_seen)
    event = F.coalesce(end <= last_known, F.lit(False))
    until = F.when(event, end).when(F.lit(False) if gone is None else gone, last_known if last_seen is None else last_seen).otherwise(last_known)
    reason = F.when(origin < F.date_sub(first_seen, early), "start too early").when(origin > first_seen, "start after first seen").when(until < origin, "end before origin")
    out = entities.withColumns({"origin": origin, "from_start": start.isNotNull(), "reason": reason, "event": event, "_until": until})
    return out.withColumn("duration", F.when(F.col("reason").isNull(), F.datediff("_until", "origin"))).drop("_until")


def stacked_groups(stays: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each stay once for every grouping, and once for all: (dimension, label, duration, event)."""
    pairs = [F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("label"))] + [F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("label")) for c in columns]
    return stays.select("duration", "event", F.explode(F.array(*pairs)).alias("g")).select("g.dimension", "g.label", "duration", "event")


def readiness(follow_up_days: Column, needed: int) -> Column:
    return follow_up_days >= needed


def event_shares(at: DataFrame) -> DataFrame:
    """Shares with the event: the complement of survival, its limits swapped."""
    return at.withColumns({"share": 1 - F.col("survival"), "share_lower": 1 - F.col("upper"), "share_upper": 1 - F.col("lower")}).drop("survival", "lower", "upper")


def published_rows(groups: DataFrame, label: str, order: Sequence[str], size: str, values: Sequence[str], least: int = 10) -> DataFrame:
    """Groups in a fixed order, absent ones too; values of a group under `least` are hidden."""
    named = groups.sparkSession.createDataFrame([(i, x) for i, x in enumerate(order)], f"ord int, {label} string")
    out = F.broadcast(named).join(groups, label, "left").withColumn(size, F.coalesce(F.col(size), F.lit(0)))
    small = F.col(size) < least
    shown = F.when(F.col(size).between(1, least - 1), F.lit(f"<{least}")).otherwise(F.col(size).cast("string"))
    return out.select("ord", label, shown.alias(size), *[F.when(~small, F.col(v)).alias(v) for v in values])

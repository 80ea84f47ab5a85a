"""Products: profile, trends, usage cost, alerts, queues, publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import suppressed

#: Days of a month on average.
MONTH = 30.44


def stacked_profile(rows: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(dimension, label, n): all distributions in one pass, each row once for every dimension."""
    pairs = [F.struct(F.lit(k).alias("dimension"), c.cast("string").alias("label")) for k, c in dimensions.items()]
    return rows.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.dimension", "p.label").agg(F.count("*").alias("n"))


def compared_dates(long: DataFrame, metric: str = "metric", value: str = "value", as_of: str = "as_of") -> DataFrame:
    """(metric, before, after, change) between the last two dates, where both have the metric."""
    w = Window.partitionBy(metric).orderBy(F.desc(as_of))
    last = long.withColumn("_r", F.row_number().over(w)).where("_r <= 2")
    g = last.groupBy(metric).agg(F.max(F.when(F.col("_r") == 2, F.col(value))).alias("before"), F.max(F.when(F.col("_r") == 1, F.col(value))).alias("after"))
    return g.withColumn("change", F.col("after") - F.col("before"))


def monthly(usage: DataFrame, item: str = "item", amount: str = "amount") -> DataFrame:
    """Quantities of a month from mean daily usage."""
    return usage.groupBy(item).agg((F.avg(amount) * MONTH).alias("quantity"))


def cost(quantities: DataFrame, prices: DataFrame, item: str = "item") -> DataFrame:
    """(item, quantity, gross, net, allowance_used): cost without and with the monthly allowance. prices: (item,
    price, free) with one row per item of a price list."""
    j = quantities.join(F.broadcast(prices), item)
    over = F.greatest(F.lit(0.0), F.col("quantity") - F.col("free"))
    return j.select(item, "quantity", F.bround(F.col("quantity") * F.col("price"), 4).alias("gross"), F.bround(over * F.col("price"), 4).alias("net"), F.try_divide("quantity", "free").alias("allowance_used"))


def cost_alert(totals: DataFrame, target: float) -> DataFrame:
    """near: at least 80% of the target; over without allowance: only the allowance keeps it under."""
    kind = F.when(F.col("net") >= 0.8 * target, "near target").when(F.col("gross") > target, "over without allowance").otherwise("fine")
    return totals.withColumn("alert", kind)


def storage_outlook(used: Column, growth_per_day: Column, limit: float, price: float) -> dict[str, Column]:
    """Months until the limit at linear growth (null without growth), and the cost in twelve months."""
    in_a_year = used + growth_per_day * MONTH * 12
    return {"months_to_limit": F.when(growth_per_day > 0, F.greatest(F.lit(0.0), (limit - used) / (growth_per_day * MONTH))), "cost_in_a_year": F.greatest(F.lit(0.0), in_a_year - limit) * price}


def published(df: DataFrame, counts: Sequence[str], allowed: Sequence[str], least: int = 10) -> DataFrame:
    """Only the allowed columns leave, and small counts only as such."""
    return df.select(*[suppressed(F.col(c), least).alias(c) if c in counts else F.col(c) for c in allowed])


def shown_change(before: Column, after: Column, least: int = 10) -> Column:
    """A change of counts where neither side is suppressed, with its sign."""
    small = before.between(1, least - 1) | after.between(1, least - 1)
    return F.when(~small, F.format_string("%+d", after - before))


def refresh_queue(rows: DataFrame, now: Column, n: int, key: str = "entity", checked: str = "checked_at", failed: str = "failed_at", changed: str = "changed", live: str = "live", fresh_hours: int = 24, early_hours: int = 6) -> DataFrame:
    """The next rows to refetch: changed, new, overdue, then early ones; the oldest check first, live before ended.

    changed counts for rows that have been checked; the others are new. Fresh unchanged rows are left out, and rows that
    failed within the last hour."""
    age = (F.unix_seconds(now) - F.unix_seconds(checked)) / 3600
    priority = F.when(F.col(changed) & F.col(checked).isNotNull(), 0).when(F.col(checked).isNull(), 1).when(age >= fresh_hours, 2).when(age >= fresh_hours - early_hours, 3)
    cool = F.col(failed).isNull() | (F.unix_seconds(now) - F.unix_seconds(failed) >= 3600)
    due = rows.withColumn("priority", priority).where(F.col("priority").isNotNull() & cool)
    return due.orderBy("priority", F.col(checked).asc_nulls_first(), F.desc(live), key).limit(n)


def fair_queue(files: DataFrame, family: str = "family", modified: str = "modified", name: str = "name") -> DataFrame:
    """Newest first within a family, families in turn."""
    w = Window.partitionBy(family).orderBy(F.desc(modified), F.desc(name))
    return files.withColumn("turn", F.row_number().over(w)).orderBy("turn", family)

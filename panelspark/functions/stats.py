"""Grouped statistics: the three kinds of median, index quantiles, counts over label lists, thresholds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


def high_median(value: str) -> Column:
    """The upper of the middle two: the middle from above, exactly."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")


#: Different values up to which a group is put in order as it is, and ranges in which a larger one is cut (a square).
WHOLE, RANGES = 20_000, 1024


def range_of(cuts: str, value: str, ranges: int) -> Column:
    """How many of the ordered cuts lie below value: first among every side-th of them, then in one stretch."""
    side = int(ranges**0.5)
    below = lambda xs: F.size(F.filter(xs, lambda x: x < F.col(value)))
    coarse = below(F.transform(F.sequence(F.lit(1), F.lit(side - 1)), lambda i: F.get(cuts, i * side - 1)))
    return coarse * side + below(F.slice(cuts, coarse * side + 1, F.lit(side - 1)))


def ordered_entries(df: DataFrame, keys: Sequence[str], value: str, entries: dict[float, Callable[[Column], Column]], least: int = 1, whole: int = WHOLE, ranges: int = RANGES, times: str | None = None) -> DataFrame:
    """(keys, share, value): for each share the entry of a group's sorted values whose number its function gives from the
    number of values, null where there is none.

    value is a number; nulls don't count; groups under `least` give null. Values are counted first. A group of at most
    `whole` different values is put in order. A larger one is cut at approximate percentiles of its different values, so
    that its ranges hold about as many of them whatever their size; ranges are counted, and only within the one that
    holds the entry values are put in order: no task orders a whole large group, also without keys. Counts are stored in
    the shared folder, as they are read several times. A row stands for as many values as its column `times` says."""
    keys = list(keys)
    spread = lambda df, c: df.crossJoin(c) if not keys else df.join(c, keys)
    asked = F.array(*[F.struct(F.lit(float(s)).alias("share"), f(F.col("_n")).cast("long").alias("at")) for s, f in entries.items()])
    of = lambda test: F.explode(F.filter(asked, lambda x: test(x["at"]))).alias("_e")
    running = lambda df, c, by, order: df.withColumn("_to", F.sum(c).over(Window.partitionBy(*by).orderBy(order)))
    inside = lambda c: lambda at: (at < F.col("_to")) & (at >= F.col("_to") - F.col(c))
    counts = stored(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg((F.sum(times) if times else F.count("*")).alias("_c")), "counts")
    groups = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count("*").alias("_d"))
    known = spread(counts, groups).where(F.col("_n") >= least)
    none = groups.select(*keys, of(lambda at: (F.col("_n") < least) | (at >= F.col("_n")))).select(*keys, "_e.share", F.lit(None).cast(df.schema[value].dataType).alias(value))
    small = running(known.where(F.col("_d") <= whole), "_c", keys, value)
    hits = small.select(*keys, value, of(inside("_c"))).select(*keys, "_e.share", value).union(none)
    if not groups.where(F.col("_d") > whole).isEmpty():
        large = known.where(F.col("_d") > whole)
        cuts = large.groupBy(*keys).agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 20 * ranges).alias("_cuts"))
        large = spread(large, cuts).withColumn("_part", range_of("_cuts", value, ranges)).drop("_cuts")
        parts = running(large.groupBy(*keys, "_n", "_part").agg(F.sum("_c").alias("_in")), "_in", keys, "_part")  # `ranges` rows of a group
        held = parts.withColumn("_e", of(inside("_in"))).select(*keys, "_part", "_e.share", (F.col("_e.at") - F.col("_to") + F.col("_in")).alias("_at"))
        run = running(large.join(held, [*keys, "_part"]), "_c", [*keys, "_part", "share"], value)
        hits = hits.union(run.where((F.col("_to") > F.col("_at")) & (F.col("_to") - F.col("_c") <= F.col("_at"))).select(*keys, "share", value))
    return hits.select(*keys, "share", F.col(value).alias("value"))


def index_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], last: bool = False, least: int = 1, **how: int | str | None) -> DataFrame:
    """(keys, share, value): the sorted values' entry floor(n * share), or int(share * (n - 1)) if last; see
    ordered_entries()."""
    return ordered_entries(df, keys, value, {s: lambda n, s=s: F.floor(F.lit(float(s)) * (n - 1 if last else n)) for s in shares}, least, **how)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, **how: int) -> DataFrame:
    """(keys, median): the mean of the middle two values, or the middle one, of a number; see ordered_entries()."""
    middle = ordered_entries(df, keys, value, {0.0: lambda n: F.floor((n - 1) / 2), 1.0: lambda n: F.floor(n / 2)}, **how)
    return middle.groupBy(*keys).agg(F.avg("value").alias("median"))


def label_counts(df: DataFrame, label: Column, labels: Sequence[str]) -> DataFrame:
    """(ord, label, n) for the given labels in order, 0 for those that don't occur."""
    spark = df.sparkSession
    named = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "ord int, label string")
    counts = df.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    return F.broadcast(named).join(counts, "label", "left").select("ord", "label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def threshold_groups(df: DataFrame, value: str, limits: Sequence[float], out: str = "limit") -> DataFrame:
    """Each row once for every limit that its value does not exceed."""
    return df.withColumn(out, F.explode(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: F.col(value) <= x)))


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows of the newest version in each group."""
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_v"))
    return df.join(newest, list(keys)).where(F.struct(*order) == F.col("_v")).drop("_v")


def capped(n: Column, most: int) -> Column:
    """A count for a histogram whose last bin is open."""
    return F.least(n, F.lit(most))

"""Weekday-pattern forecasts with a backtest that never looks ahead. Models are functions DataFrame -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import local_date

#: Observations that a complete day has at least; days of a forecast; weight of the newest day when smoothing.
LEAST, AHEAD, ALPHA = 24, 7, 0.3
Model = Callable[[DataFrame], DataFrame]


def daily_means(points: DataFrame, zone: str = "UTC", least: int = LEAST, value: str = "population", at: str = "slot") -> DataFrame:
    """(source, day, n, mean, observations): complete local days strictly between the first and the last, n being the
    day's number. Sources with fewer than three such days have none."""
    day = points.select("source", local_date(F.col(at), zone).alias("day"), value)
    ends = F.broadcast(day.groupBy("source").agg(F.min("day").alias("a"), F.max("day").alias("z")))
    means = day.groupBy("source", "day").agg(F.avg(value).alias("mean"), F.count("*").alias("observations")).join(ends, "source")
    means = means.where((F.col("day") > F.col("a")) & (F.col("day") < F.col("z")) & (F.col("observations") >= least))
    means = means.withColumn("_k", F.count("*").over(Window.partitionBy("source"))).where("_k >= 3")
    return means.select("source", "day", F.unix_date("day").alias("n"), "mean", "observations")


def deviations(series: DataFrame) -> DataFrame:
    """(source, n, weekday, deviation): a day's mean less that of the full seven days around it."""
    w = Window.partitionBy("source").orderBy("n").rangeBetween(-3, 3)
    s = series.withColumns({"_c": F.count("*").over(w), "_m": F.avg("mean").over(w)}).where("_c = 7")
    return s.select("source", "n", F.pmod("n", F.lit(7)).alias("weekday"), (F.col("mean") - F.col("_m")).alias("deviation"))


def weekday_offsets(series: DataFrame) -> DataFrame:
    """Mean deviation per weekday; a source has none until all seven weekdays have one."""
    o = deviations(series).groupBy("source", "weekday").agg(F.avg("deviation").alias("offset"))
    return o.withColumn("_k", F.count("*").over(Window.partitionBy("source"))).where("_k = 7").drop("_k")


def offsets_known(series: DataFrame) -> DataFrame:
    """(source, n, weekday, offset): the offsets that are known on each day.

    A centred window is known three days later, so each origin uses deviations up to n - 3: running sums per weekday,
    carried to every day of the series."""
    dev = deviations(series).select("source", (F.col("n") + 3).alias("n"), "weekday", "deviation")
    grid = series.select("source", "n").withColumn("weekday", F.explode(F.sequence(F.lit(0), F.lit(6))))
    w = Window.partitionBy("source", "weekday").orderBy("n").rangeBetween(Window.unboundedPreceding, 0)
    g = grid.join(dev, ["source", "n", "weekday"], "full_outer").withColumns({"_s": F.sum("deviation").over(w), "_c": F.count("deviation").over(w)})
    g = g.join(series.select("source", "n"), ["source", "n"], "left_semi").where("_c > 0").select("source", "n", "weekday", (F.col("_s") / F.col("_c")).alias("offset"))
    return g.withColumn("_k", F.count("*").over(Window.partitionBy("source", "n"))).where("_k = 7").drop("_k")


def targets(levels: DataFrame, series: DataFrame, weekday: bool) -> DataFrame:
    """(source, n, ahead, forecast) from (source, n, level); with the target weekday's offset if `weekday`."""
    each = levels.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(AHEAD))))
    if not weekday:
        return each.select("source", "n", "ahead", F.col("level").alias("forecast"))
    o = offsets_known(series)
    each = each.withColumn("weekday", F.pmod(F.col("n") + F.col("ahead"), F.lit(7)))
    return each.join(o, ["source", "n", "weekday"]).select("source", "n", "ahead", (F.col("level") + F.col("offset")).alias("forecast"))


def adjusted(series: DataFrame) -> DataFrame:
    """Each day less its weekday's offset as known that day."""
    o = offsets_known(series)
    return series.withColumn("weekday", F.pmod("n", F.lit(7))).join(o, ["source", "n", "weekday"]).select("source", "n", (F.col("mean") - F.col("offset")).alias("level"))


def weekday_rule(series: DataFrame) -> DataFrame:
    """The origin's level without its weekday, with the target's; none where the origin is missing."""
    return targets(adjusted(series), series, True)


def latest_day(series: DataFrame) -> DataFrame:
    return targets(series.select("source", "n", F.col("mean").alias("level")), series, False)


def week_levels(series: DataFrame) -> DataFrame:
    w = Window.partitionBy("source").orderBy("n").rangeBetween(-6, 0)
    return series.select("source", "n", F.avg("mean").over(w).alias("level"))


def week_average(series: DataFrame) -> DataFrame:
    """Mean of those of the last seven days that are there."""
    return targets(week_levels(series), series, False)


def week_average_weekday(series: DataFrame) -> DataFrame:
    return targets(week_levels(series), series, True)


#: Days in which discounted sums are taken together, and blocks behind which a discount is 0 in double precision.
BLOCK, BLOCKS = 64, 34


def discounted(series: DataFrame, values: dict[str, Column], alpha: float = ALPHA) -> DataFrame:
    """(source, n, *values): at each day the smoothing sum of a value over all days up to it, the first one's weight
    being (1 - alpha)^k and that of those behind it alpha (1 - alpha)^k, k days back.

    Within a block it's a running sum of values over their discount, times the day's; a block takes the sum up to its
    start from the ends of those before it. Beyond BLOCKS blocks discounts are below the least double."""
    w = Window.partitionBy("source").orderBy("n")
    keep = 1 - alpha
    s = series.withColumn("_p", F.row_number().over(w) - 1).withColumns({"_b": F.floor(F.col("_p") / BLOCK), "_j": F.col("_p") % BLOCK})
    weight = F.when(F.col("_p") == 0, 1.0).otherwise(alpha) / F.pow(F.lit(keep), "_j")
    own = Window.partitionBy("source", "_b").orderBy("n")
    s = s.select("source", "n", "_b", "_j", *[(F.sum(c.cast("double") * weight).over(own) * F.pow(F.lit(keep), "_j")).alias(k) for k, c in values.items()])
    ends = s.groupBy("source", "_b").agg(*[F.max_by(k, "_j").alias(k) for k in values], F.max("_j").alias("_j"))
    back = Window.partitionBy("source").orderBy("_b").rangeBetween(-BLOCKS, -1)
    before = lambda k: F.aggregate(F.collect_list(F.struct("_b", k)).over(back), F.lit(0.0), lambda a, x: a + x[k] * F.pow(F.lit(keep**BLOCK), F.col("_b") - 1 - x["_b"]))
    carried = ends.select("source", "_b", *[before(k).alias(f"_{k}") for k in values])
    return s.join(carried, ["source", "_b"]).select("source", "n", *[(F.col(k) + F.col(f"_{k}") * F.pow(F.lit(keep), F.col("_j") + 1)).alias(k) for k in values])


def smoothed_weekday(series: DataFrame) -> DataFrame:
    """Exponential smoothing of the weekday-adjusted level, each origin with its own offsets.

    A level is the discounted sum of means less, for each weekday, its offset times the discounted weight of its days;
    neither sum depends on the origin's offsets, so days by seven rows a source are enough."""
    weekday = F.pmod("n", F.lit(7))
    sums = discounted(series, {"level": F.col("mean"), **{f"w{i}": (weekday == i).cast("int") for i in range(7)}})
    long = sums.select("source", "n", "level", F.posexplode(F.array(*[F.col(f"w{i}") for i in range(7)])).alias("weekday", "weight"))
    j = long.join(offsets_known(series), ["source", "n", "weekday"])
    return targets(j.groupBy("source", "n").agg((F.first("level") - F.sum(F.col("weight") * F.col("offset"))).alias("level")), series, True)


MODELS: dict[str, Model] = {"weekday_rule": weekday_rule, "latest_day": latest_day, "week_average": week_average, "week_average_weekday": week_average_weekday, "smoothed_weekday": smoothed_weekday}


def backtest(series: DataFrame, model: Model) -> DataFrame:
    """(source, n, ahead, forecast, actual, error): every origin's forecasts against the days that came."""
    f = model(series).withColumn("target", F.col("n") + F.col("ahead"))
    actual = series.select("source", F.col("n").alias("target"), F.col("mean").alias("actual"))
    return f.join(actual, ["source", "target"]).select("source", "n", "ahead", "forecast", "actual", (F.col("actual") - F.col("forecast")).alias("error"))


def hour_of_day(points: DataFrame, series: DataFrame, zone: str = "UTC", value: str = "population", at: str = "slot") -> DataFrame:
    """Mean deviation of each local hour from its day's mean."""
    p = points.select("source", local_date(F.col(at), zone).alias("day"), F.hour(F.from_utc_timestamp(at, zone)).alias("hour"), value)
    return p.join(series.select("source", "day", "mean"), ["source", "day"]).groupBy("source", "hour").agg(F.avg(F.col(value) - F.col("mean")).alias("deviation"))


def day_changes(series: DataFrame) -> DataFrame:
    """Mean and deviation of the change between days that follow each other."""
    w = Window.partitionBy("source").orderBy("n")
    c = series.withColumns({"_n": F.lag("n").over(w), "_m": F.lag("mean").over(w)}).where("_n = n - 1")
    return c.groupBy("source").agg(F.avg(F.col("mean") - F.col("_m")).alias("mean_change"), F.stddev_pop(F.col("mean") - F.col("_m")).alias("sd_change"))

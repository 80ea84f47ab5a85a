"""Forecasts and time series (F) over the points of five sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import forecast
from ..sources.shared import stored
from ..sources.views import duck, view
from .registry import query, text

SERIES = """, dy AS (SELECT source, CAST(slot AS DATE) AS day, population FROM points), en AS (SELECT source, min(day) AS a, max(day) AS z FROM dy GROUP BY 1),
s0 AS (SELECT source, day, avg(population) AS mean, count(*) AS observations FROM dy JOIN en USING (source) WHERE day > a AND day < z GROUP BY 1, 2 HAVING count(*) >= 24),
series AS (SELECT *, CAST(day - DATE '1970-01-01' AS BIGINT) AS n FROM s0 QUALIFY count(*) OVER (PARTITION BY source) >= 3)"""
DEV = SERIES + """, dev AS (SELECT source, n, n % 7 AS weekday, mean - m AS deviation FROM (SELECT *, count(*) OVER w AS c, avg(mean) OVER w AS m FROM series WINDOW w AS (PARTITION BY source ORDER BY n RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING)) WHERE c = 7)"""
KNOWN = DEV + """, kn0 AS (SELECT s.source, s.n, d.weekday, avg(d.deviation) AS off FROM series s JOIN dev d ON d.source = s.source AND d.n + 3 <= s.n GROUP BY 1, 2, 3),
known AS (SELECT * FROM kn0 QUALIFY count(*) OVER (PARTITION BY source, n) = 7), ah AS (SELECT unnest(range(1, 8)) AS ahead)"""
LEVELS = {
    "weekday_rule": "SELECT s.source, s.n, mean - off AS level FROM series s JOIN known k ON k.source = s.source AND k.n = s.n AND k.weekday = s.n % 7",
    "latest_day": "SELECT source, n, mean AS level FROM series",
    "week_average": "SELECT source, n, avg(mean) OVER (PARTITION BY source ORDER BY n RANGE BETWEEN 6 PRECEDING AND 0 FOLLOWING) AS level FROM series",
}
LEVELS["week_average_weekday"] = LEVELS["week_average"]
LEVELS["smoothed_weekday"] = "SELECT source, n, list_reduce(list(adj ORDER BY m), lambda a, x: a + 0.3 * (x - a)) AS level FROM (SELECT o.source, o.n, s.n AS m, s.mean - o.off AS adj FROM known o JOIN series s ON s.source = o.source AND s.n <= o.n AND s.n % 7 = o.weekday) GROUP BY 1, 2"
WEEKDAY = {"weekday_rule", "week_average_weekday", "smoothed_weekday"}


def forecasts(model: str) -> str:
    lv = f"({LEVELS[model]})"
    if model not in WEEKDAY:
        return f"SELECT source, n, ahead, level AS forecast FROM {lv}, ah"
    return f"SELECT l.source, l.n, ahead, level + off AS forecast FROM {lv} l, ah JOIN known k ON k.source = l.source AND k.n = l.n AND k.weekday = (l.n + ahead) % 7"


BACK = ", fc AS ({}), bt AS (SELECT f.source, f.n, ahead, forecast, mean AS actual, mean - forecast AS error FROM fc f JOIN series s ON s.source = f.source AND s.n = f.n + ahead)"


def pts(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "points")


def series(spark: SparkSession, d: str) -> DataFrame:
    return forecast.daily_means(pts(spark, d))


@query(duck("points", SERIES + " SELECT source, CAST(day AS VARCHAR) AS day, round(mean, 6) AS mean, observations FROM series"))
def f1_daily_means(spark: SparkSession, d: str) -> DataFrame:
    return series(spark, d).select("source", text("day"), F.round("mean", 6).alias("mean"), "observations")


@query(duck("points", DEV + " SELECT source, weekday, round(avg(deviation), 6) AS \"offset\" FROM dev GROUP BY 1, 2 QUALIFY count(*) OVER (PARTITION BY source) = 7"))
def f2_weekday_offsets(spark: SparkSession, d: str) -> DataFrame:
    return forecast.weekday_offsets(series(spark, d)).select("source", F.col("weekday").cast("long").alias("weekday"), F.round("offset", 6).alias("offset"))


def model_query(name: str, model: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        f = forecast.MODELS[model](series(spark, d))
        return f.select("source", F.col("n").cast("long").alias("n"), F.col("ahead").cast("long").alias("ahead"), F.round("forecast", 6).alias("forecast"))

    run.__name__ = name
    query(duck("points", KNOWN + f", fc AS ({forecasts(model)}) SELECT source, n, ahead, round(forecast, 6) AS forecast FROM fc"))(run)


for _name, _model in (("f3_weekday_rule", "weekday_rule"), ("f9_latest_day", "latest_day"), ("f10_week_average", "week_average"), ("f11_week_average_weekday", "week_average_weekday"), ("f12_smoothed_weekday", "smoothed_weekday")):
    model_query(_name, _model)


@query(duck("points", KNOWN + BACK.format(forecasts("weekday_rule")) + " SELECT source, n, ahead, round(forecast, 6) AS forecast, round(actual, 6) AS actual, round(error, 6) AS error FROM bt"))
def f4_j17_backtest(spark: SparkSession, d: str) -> DataFrame:
    b = forecast.backtest(series(spark, d), forecast.weekday_rule)
    return b.select("source", F.col("n").cast("long").alias("n"), F.col("ahead").cast("long").alias("ahead"), *[F.round(c, 6).alias(c) for c in ("forecast", "actual", "error")])


@query(duck("points", KNOWN + BACK.format(forecasts("weekday_rule")) + ", q AS (SELECT *, row_number() OVER (PARTITION BY source, ahead ORDER BY abs(error)) - 1 AS i, count(*) OVER (PARTITION BY source, ahead) AS k FROM bt) SELECT source, ahead, k AS errors, round(avg(abs(error)), 6) AS mean_absolute, round(max(CASE WHEN k >= 5 AND i = floor(0.8 * (k - 1)) THEN abs(error) END), 6) AS band FROM q GROUP BY 1, 2, 3"))
def f5_f6_errors_and_bands(spark: SparkSession, d: str) -> DataFrame:
    """Errors by horizon and the range that holds four of five."""
    b = stored(forecast.backtest(series(spark, d), forecast.weekday_rule).withColumn("miss", F.abs("error")), "backtest")
    q = stats.index_quantiles(b, ["source", "ahead"], "miss", (0.8,), last=True, least=5).select("source", "ahead", F.round("value", 6).alias("band"))
    m = b.groupBy("source", "ahead").agg(F.count("*").alias("errors"), F.round(F.avg("miss"), 6).alias("mean_absolute"))
    return m.join(q, ["source", "ahead"]).withColumn("ahead", F.col("ahead").cast("long"))


@query(duck("points", SERIES + " SELECT p.source, CAST(hour(slot) AS INT) AS hour, round(avg(population - mean), 6) AS deviation FROM points p JOIN series s ON s.source = p.source AND s.day = CAST(slot AS DATE) GROUP BY 1, 2"))
def f7_hour_of_day(spark: SparkSession, d: str) -> DataFrame:
    h = forecast.hour_of_day(pts(spark, d), series(spark, d))
    return h.select("source", "hour", F.round("deviation", 6).alias("deviation"))


F8 = KNOWN + BACK.format(forecasts("weekday_rule")) + """, lastn AS (SELECT source, max(n) AS z FROM series GROUP BY 1),
bands AS (SELECT source, ahead, max(CASE WHEN k >= 5 AND i = floor(0.8 * (k - 1)) THEN abs(error) END) AS band FROM (SELECT *, row_number() OVER (PARTITION BY source, ahead ORDER BY abs(error)) - 1 AS i, count(*) OVER (PARTITION BY source, ahead) AS k FROM bt) GROUP BY 1, 2)
SELECT s.source, s.n, 'shown' AS kind, round(mean, 2) AS value, round(forecast, 2) AS forecast, CAST(NULL AS DOUBLE) AS band FROM series s JOIN lastn z ON z.source = s.source LEFT JOIN bt ON bt.source = s.source AND bt.n + 1 = s.n AND ahead = 1 WHERE s.n > z.z - 28
UNION ALL SELECT f.source, f.n + f.ahead, 'ahead', NULL, round(forecast, 2), round(band, 2) FROM fc f JOIN lastn l ON l.source = f.source AND l.z = f.n LEFT JOIN bands b ON b.source = f.source AND b.ahead = f.ahead"""


@query(duck("points", F8))
def f8_forecast_summary(spark: SparkSession, d: str) -> DataFrame:
    """The last 28 days with the day-before forecast, and seven days ahead with their bands."""
    s = stored(series(spark, d), "series")  # a row per source and day
    last = s.groupBy("source").agg(F.max("n").alias("z"))
    rule = stored(forecast.weekday_rule(s), "forecasts")
    b = forecast.backtest(s, lambda _: rule).withColumn("miss", F.abs("error"))
    one = b.where("ahead = 1").select("source", (F.col("n") + 1).alias("n"), "forecast")
    none = F.lit(None).cast("double")
    shown = s.join(last, "source").where("n > z - 28").join(one, ["source", "n"], "left").select("source", "n", F.lit("shown").alias("kind"), F.round("mean", 2).alias("value"), F.round("forecast", 2).alias("forecast"), none.alias("band"))
    bands = stats.index_quantiles(b, ["source", "ahead"], "miss", (0.8,), last=True, least=5).select("source", "ahead", F.col("value").alias("band"))
    ahead = rule.join(last, "source").where("n = z").join(bands, ["source", "ahead"], "left")
    ahead = ahead.select("source", (F.col("n") + F.col("ahead")).alias("n"), F.lit("ahead").alias("kind"), none.alias("value"), F.round("forecast", 2).alias("forecast"), F.round("band", 2).alias("band"))
    return shown.union(ahead).withColumn("n", F.col("n").cast("long"))


F13 = KNOWN + ", " + ", ".join(f"f_{m} AS ({forecasts(m)})" for m in LEVELS) + ", al AS (" + " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM f_{m}" for m in LEVELS) + """),
e AS (SELECT model, ahead, abs(mean - forecast) AS miss FROM al a JOIN series s ON s.source = a.source AND s.n = a.n + a.ahead)
SELECT model, """ + ", ".join(f"round(avg(miss) FILTER (ahead = {h}), 6) AS d{h}" for h in range(1, 8)) + " FROM e GROUP BY 1"


@query(duck("points", F13))
def f13_model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Mean absolute error of five models by days ahead."""
    s = stored(series(spark, d), "series")
    out = None
    for name, model in forecast.MODELS.items():
        b = forecast.backtest(s, model).select(F.lit(name).alias("model"), "ahead", F.abs("error").alias("miss"))
        out = b if out is None else out.union(b)
    return out.groupBy("model").agg(*[F.round(F.avg(F.when(F.col("ahead") == h, F.col("miss"))), 6).alias(f"d{h}") for h in range(1, 8)])


@query(duck("points", SERIES + ", c AS (SELECT source, mean - lag(mean) OVER w AS x, n - lag(n) OVER w AS g FROM series WINDOW w AS (PARTITION BY source ORDER BY n)) SELECT source, round(avg(x), 6) AS mean_change, round(stddev_pop(x), 6) AS sd_change FROM c WHERE g = 1 GROUP BY 1"))
def f14_day_changes(spark: SparkSession, d: str) -> DataFrame:
    c = forecast.day_changes(series(spark, d))
    return c.select("source", F.round("mean_change", 6).alias("mean_change"), F.round("sd_change", 6).alias("sd_change"))

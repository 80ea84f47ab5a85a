"""Survival (K) over stays, versions and visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.scalars import MONEY_BANDS, band
from ..operators import survival
from ..sources.views import duck, table, view
from .registry import query

KM = """, c AS (SELECT grp, duration AS time, count_if(event) AS events, count_if(NOT event) AS censored FROM stays WHERE duration >= 0 GROUP BY 1, 2),
r AS (SELECT *, sum(events + censored) OVER (PARTITION BY grp ORDER BY time DESC) AS at_risk FROM c),
s AS (SELECT *, product(1 - events / at_risk) OVER w AS survival, sum(CASE WHEN events <> at_risk THEN events / (at_risk * (at_risk - events)) END) OVER w AS v, max(events = at_risk) OVER w AS void FROM r WINDOW w AS (PARTITION BY grp ORDER BY time)),
km AS (SELECT grp, time, CAST(at_risk AS BIGINT) AS at_risk, events, censored, survival,
CASE WHEN survival > 1e-15 AND survival < 1 AND NOT void THEN pow(survival, exp(-1.959963984540054 * sqrt(v) / ln(survival))) END AS lower,
CASE WHEN survival > 1e-15 AND survival < 1 AND NOT void THEN pow(survival, exp(1.959963984540054 * sqrt(v) / ln(survival))) END AS upper FROM s)"""
DAYS = (0, 7, 30, 90, 365, 2500)


def stays(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "stays")


def km(spark: SparkSession, d: str) -> DataFrame:
    return survival.kaplan_meier(stays(spark, d), ["grp"])


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query(duck("stays", KM + " SELECT grp, time, at_risk, events, censored, round(survival, 6) AS survival, round(lower, 6) AS lower, round(upper, 6) AS upper FROM km"))
def k1_k2_kaplan_meier(spark: SparkSession, d: str) -> DataFrame:
    return rounded(km(spark, d), "survival", "lower", "upper")


AT = KM + f""", days AS (SELECT unnest({list(DAYS)}) AS day), longest AS (SELECT grp, max(time) AS m FROM km GROUP BY 1),
at AS (SELECT l.grp, day, m, arg_max(survival, time) AS s, arg_max(CASE WHEN lower IS NULL THEN -1 ELSE lower END, time) AS lo, arg_max(CASE WHEN upper IS NULL THEN -1 ELSE upper END, time) AS hi FROM longest l CROSS JOIN days LEFT JOIN km k ON k.grp = l.grp AND time <= day GROUP BY 1, 2, 3),
atv AS (SELECT grp, day, CASE WHEN day <= m THEN coalesce(s, 1.0) END AS survival, CASE WHEN day <= m AND lo >= 0 THEN lo END AS lower, CASE WHEN day <= m AND hi >= 0 THEN hi END AS upper FROM "at")""".replace("at AS (SELECT l.grp", '"at" AS (SELECT l.grp')


@query(duck("stays", AT + " SELECT grp, day, round(survival, 6) AS survival, round(lower, 6) AS lower, round(upper, 6) AS upper FROM atv"))
def k3_survival_at_days(spark: SparkSession, d: str) -> DataFrame:
    return rounded(survival.survival_at(km(spark, d), ["grp"], DAYS), "survival", "lower", "upper")


@query(duck("stays", KM + f", days AS (SELECT unnest({list(DAYS)}) AS day) SELECT grp, day, CAST(sum(CASE WHEN time > day THEN events + censored ELSE 0 END) AS BIGINT) AS at_risk FROM km, days GROUP BY 1, 2"))
def k4_at_risk(spark: SparkSession, d: str) -> DataFrame:
    return survival.at_risk_at(km(spark, d), ["grp"], DAYS)


@query(duck("stays", KM + ", q AS (SELECT unnest([0.25, 0.5, 0.75, 0.99]::DOUBLE[]) AS share) SELECT grp, share, min(CASE WHEN survival <= 1 - share + 1e-12 THEN time END) AS time FROM km, q GROUP BY 1, 2"))
def k5_event_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return survival.event_quantiles(km(spark, d), ["grp"], (0.25, 0.5, 0.75, 0.99))


@query(duck("stays", KM + " SELECT grp, time, round(survival, 6) AS survival FROM km WHERE events > 0"))
def k6_step_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(survival.step_curve(km(spark, d)).select("grp", "time", "survival"), "survival")


K7_DAYS = (7, 30, 90)
K7_WIDE = ", ".join(f"round(max(survival) FILTER (day = {x}), 6) AS still_{x}, round(max(lower) FILTER (day = {x}), 6) AS lower_{x}, round(max(upper) FILTER (day = {x}), 6) AS upper_{x}" for x in K7_DAYS)
K7 = AT + ", wide AS (SELECT grp, " + K7_WIDE + """ FROM atv GROUP BY 1), counted AS (SELECT grp, CAST(sum(events + censored) AS BIGINT) AS n, CAST(sum(events) AS BIGINT) AS events, CAST(sum(censored) AS BIGINT) AS censored, max(time) AS longest,
min(CASE WHEN survival <= 0.75 + 1e-12 THEN time END) AS q1, min(CASE WHEN survival <= 0.5 + 1e-12 THEN time END) AS median, min(CASE WHEN survival <= 0.25 + 1e-12 THEN time END) AS q3, """ + ", ".join(f"CAST(sum(CASE WHEN time > {x} THEN events + censored ELSE 0 END) AS BIGINT) AS at_risk_{x}" for x in K7_DAYS) + """ FROM km GROUP BY 1)
SELECT * FROM counted JOIN wide USING (grp)"""


@query(duck("stays", K7))
def k7_group_summary(spark: SparkSession, d: str) -> DataFrame:
    got = survival.group_summary(stays(spark, d), ["grp"], days=K7_DAYS)
    return rounded(got, *[f"{c}_{x}" for x in K7_DAYS for c in ("still", "lower", "upper")])


@query(duck("details", " SELECT entity, CAST(epoch(min(seen_at) FILTER (n_rows >= 2)) AS BIGINT) AS first_complete, CAST(epoch(min(seen_at) FILTER (status = 'all')) AS BIGINT) AS first_decided, arg_min(amount, seen_at) FILTER (status = 'all') AS decided_amount FROM details GROUP BY 1"))
def k9_first_versions(spark: SparkSession, d: str) -> DataFrame:
    """First version with entries, first with a decision, and what it said."""
    decided = F.when(F.col("status") == "all", F.struct("seen_at", "amount"))
    g = view(spark, d, "details").groupBy("entity").agg(F.min(F.when(F.col("n_rows") >= 2, F.col("seen_at"))).alias("c"), F.min(decided).alias("f"))
    return g.select("entity", F.unix_seconds("c").alias("first_complete"), F.unix_seconds("f.seen_at").alias("first_decided"), F.col("f.amount").alias("decided_amount"))


BAND = "CASE WHEN amount <= 1000 THEN 'to 1000' WHEN amount <= 5000 THEN 'to 5000' WHEN amount <= 10000 THEN 'to 10000' WHEN amount <= 50000 THEN 'to 50000' ELSE 'over 50000' END"


@query(duck("details", f", l AS (SELECT {BAND} AS amount_band, CASE WHEN len(amount_types) > 1 THEN 'several' ELSE amount_types[1] END AS kind, status FROM details), s AS (SELECT 'amount' AS dimension, amount_band AS label FROM l UNION ALL SELECT 'kind', kind FROM l UNION ALL SELECT 'status', status FROM l) SELECT dimension, label, count(*) AS n FROM s GROUP BY 1, 2"))
def k10_group_labels(spark: SparkSession, d: str) -> DataFrame:
    x = view(spark, d, "details").select(band(F.col("amount"), MONEY_BANDS).alias("amount"), F.when(F.size("amount_types") > 1, "several").otherwise(F.try_element_at("amount_types", F.lit(1))).alias("kind"), "status")
    return x.select(F.expr("stack(3, 'amount', amount, 'kind', kind, 'status', status) AS (dimension, label)")).groupBy("dimension", "label").agg(F.count("*").alias("n"))


HOURS = """, h AS (SELECT (epoch(min(seen_at) FILTER (status = 'all')) - epoch(min(seen_at))) / 3600 AS hours FROM details GROUP BY entity), s AS (SELECT hours, row_number() OVER (ORDER BY hours) - 1 AS i, count(*) OVER () AS n FROM h WHERE hours IS NOT NULL)
SELECT CAST(share AS DOUBLE) AS share, max(hours) FILTER (i = floor(n * share)) AS value FROM s, (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS share) GROUP BY 1"""


@query(duck("details", HOURS))
def k13_a5_hours_to_stage(spark: SparkSession, d: str) -> DataFrame:
    """Index quantiles of the hours from first sight to a stage."""
    g = view(spark, d, "details").groupBy("entity").agg(((F.unix_seconds(F.min(F.when(F.col("status") == "all", F.col("seen_at")))) - F.unix_seconds(F.min("seen_at"))) / 3600).alias("hours"))
    return stats.index_quantiles(g, [], "hours", (0.1, 0.25, 0.5, 0.75, 0.9))


@query(duck("visits", ", f AS (SELECT date_diff('day', min(start_date), max(start_date)) AS days FROM visits) SELECT product, needed, days >= needed AS ready FROM f, (VALUES ('stays', 30), ('bonds', 28), ('linkage', 28), ('re-entry', 2500)) p(product, needed)"))
def k14_k15_readiness(spark: SparkSession, d: str) -> DataFrame:
    """Whether the follow-up is long enough, gathered over all products."""
    f = view(spark, d, "visits").agg(F.datediff(F.max("start_date"), F.min("start_date")).alias("days"))
    needs = F.array(*[F.struct(F.lit(p).alias("product"), F.lit(n).alias("needed")) for p, n in (("stays", 30), ("bonds", 28), ("linkage", 28), ("re-entry", 2500))])
    return f.select("days", F.explode(needs).alias("x")).select("x.product", "x.needed", survival.readiness(F.col("days"), F.col("x.needed")).alias("ready"))


@query(duck("stays", AT + " SELECT grp, day, round(1 - survival, 6) AS share, round(1 - upper, 6) AS share_lower, round(1 - lower, 6) AS share_upper FROM atv"))
def k16_event_shares(spark: SparkSession, d: str) -> DataFrame:
    return rounded(survival.event_shares(survival.survival_at(km(spark, d), ["grp"], DAYS)), "share", "share_lower", "share_upper")


ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]
K17 = f"SELECT ord, grp, CASE WHEN n BETWEEN 1 AND 9 THEN '<10' ELSE CAST(n AS VARCHAR) END AS n, CASE WHEN n >= 10 THEN m END AS longest FROM (SELECT CAST(i - 1 AS INT) AS ord, o.grp, count(s.entity) AS n, max(duration) AS m FROM (SELECT unnest({ORDER}) AS grp, generate_subscripts({ORDER}, 1) AS i) o LEFT JOIN stays s ON s.grp = o.grp GROUP BY 1, 2)"


@query(duck("stays", K17))
def k17_published_groups(spark: SparkSession, d: str) -> DataFrame:
    g = stays(spark, d).groupBy("grp").agg(F.count("*").alias("n"), F.max("duration").alias("longest"))
    return survival.published_rows(g, "grp", ORDER, "n", ["longest"])

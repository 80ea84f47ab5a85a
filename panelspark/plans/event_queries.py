"""Change events and intervals (C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.scalars import us_date
from ..operators import events, joins, survival
from ..operators.panel import owners_of
from ..sources.views import duck, table, view
from .registry import query, secs, text

V = view
ENDS = ", ends AS (SELECT o_orderkey AS entity, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INT) END AS end_date FROM orders)"
SNAP = "DATE '1998-12-01'"
KM = """, c AS (SELECT {k} AS g, duration AS time, count_if(event) AS events, count_if(NOT event) AS censored FROM {t} GROUP BY 1, 2), r AS (SELECT *, sum(events + censored) OVER (PARTITION BY g ORDER BY time DESC) AS at_risk FROM c),
km AS (SELECT *, product(1 - events / at_risk) OVER (PARTITION BY g ORDER BY time) AS survival FROM r)
SELECT g AS {k}, CAST(sum(events + censored) AS BIGINT) AS n, CAST(sum(events) AS BIGINT) AS events, min(CASE WHEN survival <= 0.5 + 1e-12 THEN time END) AS median FROM km GROUP BY 1"""


def ends(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("entity"), F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 900).cast("int"))).alias("end_date"))


def snap():
    return F.lit("1998-12-01").cast("date")


C5 = ENDS + f""", l AS (SELECT entity, arg_max(amount, seen_at) AS amount, min(seen_at) AS first_at FROM details WHERE status <> 'some' GROUP BY 1), h AS (SELECT l.*, date_diff('day', CAST(first_at AS DATE), {SNAP}) AS days FROM l JOIN ends USING (entity) WHERE end_date IS NULL OR end_date > {SNAP})
SELECT lim AS "limit", count(*) AS held, list_sort(list(days))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS high_median, count_if(days > 30) AS over_30, count_if(days > 90) AS over_90 FROM h, (SELECT unnest([10000, 30000, 60000]) AS lim) WHERE amount <= lim GROUP BY 1"""


@query(duck("details", C5))
def c5_c7_stock(spark: SparkSession, d: str) -> DataFrame:
    """Held at the snapshot by the last complete version's amount, in cumulative limits."""
    complete = V(spark, d, "details").where("status <> 'some'")
    l = complete.groupBy("entity").agg(F.max(F.struct("seen_at", "amount")).alias("x"), F.min("seen_at").alias("first_at"))  # noqa: E741
    h = l.join(ends(spark, d), "entity").where(F.col("end_date").isNull() | (F.col("end_date") > snap()))
    h = h.select(F.col("x.amount").alias("amount"), F.datediff(snap(), F.col("first_at").cast("date")).alias("days"))
    return stats.threshold_groups(h, "amount", (10000, 30000, 60000)).groupBy("limit").agg(F.count("*").alias("held"), stats.high_median("days").alias("high_median"), F.count_if(F.col("days") > 30).alias("over_30"), F.count_if(F.col("days") > 90).alias("over_90"))


C6 = ENDS + f""", f AS (SELECT entity, min(seen_at) AS seen_at, arg_min(amount, seen_at) AS amount FROM details WHERE status = 'all' GROUP BY 1),
x AS (SELECT lim, end_date IS NOT NULL AND end_date <= {SNAP} AS event, date_diff('day', CAST(seen_at AS DATE), CASE WHEN end_date <= {SNAP} THEN end_date ELSE {SNAP} END) AS duration, end_date, seen_at FROM f JOIN ends USING (entity), (SELECT unnest([10000, 30000, 60000]) AS lim) WHERE amount <= lim),
flow AS (SELECT lim AS "limit", event, duration FROM x WHERE (end_date IS NULL OR end_date >= CAST(seen_at AS DATE)) AND duration >= 0)""" + KM.format(k='"limit"', t="flow")


@query(duck("details", C6))
def c6_flow(spark: SparkSession, d: str) -> DataFrame:
    """Entities whose first decision is under a limit, followed to their end."""
    f = V(spark, d, "details").where("status = 'all'").groupBy("entity").agg(F.min(F.struct("seen_at", "amount")).alias("x")).select("entity", "x.seen_at", "x.amount")
    f = events.follow_up(f, ends(spark, d), snap()).where("duration is not null")
    return survival.group_summary(stats.threshold_groups(f, "amount", (10000, 30000, 60000)), ["limit"]).select("limit", "n", "events", "median")


MOVES = """, nd AS (SELECT entity, seen_at, CASE WHEN n_rows % 3 <> 0 THEN next_date END AS next_date FROM details), mv AS (SELECT *, lag(next_date) OVER w AS b, row_number() OVER w AS r FROM nd WINDOW w AS (PARTITION BY entity ORDER BY seen_at)),
moves AS (SELECT entity, seen_at, CASE WHEN b IS NULL THEN 'first' WHEN next_date IS NULL THEN 'removed' WHEN b <= CAST(seen_at AS DATE) THEN 'passed' WHEN next_date < b THEN 'earlier' ELSE 'reset' END AS kind, date_diff('day', b, next_date) AS days FROM mv WHERE next_date IS DISTINCT FROM b AND r > 1)"""


def moves(spark: SparkSession, d: str) -> DataFrame:
    """Rows of lineitem are dealt by entity before they are grouped, so that versions are put in order where they are."""
    li = table(spark, d, "lineitem")
    v = view(spark, d, "details", lineitem=li.repartition(joins.tasks_for(li), "l_orderkey"))
    return events.date_moves(v.withColumn("next_date", F.when(F.col("n_rows") % 3 != 0, F.col("next_date"))))


@query(duck("details", MOVES + " SELECT entity, CAST(epoch(seen_at) AS BIGINT) AS seen_at, kind, CAST(days AS INT) AS days FROM moves"))
def c8_date_moves(spark: SparkSession, d: str) -> DataFrame:
    return moves(spark, d).select("entity", secs("seen_at"), "kind", "days")


@query(duck("details", MOVES + " SELECT kind, count(*) AS n, count(DISTINCT entity) AS entities, CASE WHEN count(days) > 0 THEN list_sort(list(days) FILTER (days IS NOT NULL))[CAST(floor(count(days) / 2) AS BIGINT) + 1] END AS high_median FROM moves GROUP BY 1"))
def c8_date_move_summary(spark: SparkSession, d: str) -> DataFrame:
    return moves(spark, d).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("entity").alias("entities"), stats.high_median("days").alias("high_median"))


OWN = ", ow AS (SELECT entity, list(DISTINCT owner) FILTER (owner <> '') AS owners FROM roster GROUP BY 1), bad AS (SELECT DISTINCT unnest(owners) AS owner FROM ow WHERE len(owners) <> 1)"


@query(duck("roster", OWN + " SELECT owner FROM bad"))
def c10_conflicted_owners(spark: SparkSession, d: str) -> DataFrame:
    return events.conflicted_owners(owners_of(V(spark, d, "roster")))


@query(duck("roster", "SELECT entity, coalesce(string_agg(DISTINCT owner, ',' ORDER BY owner) FILTER (owner <> ''), '') AS owners, CAST(epoch(min(slot)) AS BIGINT) AS first_seen, CAST((list(end_date ORDER BY slot DESC))[1] AS VARCHAR) AS end_date FROM roster GROUP BY 1"))
def c14_visit_registry(spark: SparkSession, d: str) -> DataFrame:
    return events.visit_registry(V(spark, d, "roster")).select("entity", F.array_join("owners", ",").alias("owners"), secs("first_seen"), text("end_date"))


C15 = ", s AS (SELECT entity, seen_at, try_strptime(CASE WHEN n_rows = 2 THEN 'bad' ELSE strftime(next_date - 20, '%m/%d/%Y') END, '%m/%d/%Y')::DATE AS st FROM details), t AS (SELECT entity, seen_at, CASE WHEN st <= CAST(seen_at AS DATE) THEN st END AS st FROM s) SELECT entity, CAST((list(st ORDER BY seen_at DESC))[1] AS VARCHAR) AS start_date FROM t GROUP BY 1"


@query(duck("details", C15))
def c15_start_dates(spark: SparkSession, d: str) -> DataFrame:
    """The last written start date; none if it is malformed or after the day of the observation."""
    s = V(spark, d, "details").withColumn("s", us_date(F.when(F.col("n_rows") == 2, "bad").otherwise(F.date_format(F.date_sub("next_date", 20), "MM/dd/yyyy"))))
    s = s.withColumn("s", F.when(F.col("s") <= F.col("seen_at").cast("date"), F.col("s")))
    return s.groupBy("entity").agg(F.max(F.struct("seen_at", "s")).alias("x")).select("entity", F.col("x.s").cast("string").alias("start_date"))


@query(duck("details", ", h AS (SELECT entity, status || '/' || n_rows AS v, lag(status || '/' || n_rows) OVER (PARTITION BY entity ORDER BY seen_at) AS p FROM details) SELECT entity, count_if(p IS NOT NULL AND p <> v) AS changed, count(*) AS fetched FROM h GROUP BY 1"))
def c16_semantic_changes(spark: SparkSession, d: str) -> DataFrame:
    """Refetched records whose content hash differs from the fetch before."""
    h = F.sha2(F.to_json(F.struct("n_rows", "status")), 256)
    before = F.lag("h").over(Window.partitionBy("entity").orderBy("seen_at"))
    v = V(spark, d, "details").withColumn("h", h).withColumn("p", before)
    return v.groupBy("entity").agg(F.count_if(F.col("p") != F.col("h")).alias("changed"), F.count("*").alias("fetched"))

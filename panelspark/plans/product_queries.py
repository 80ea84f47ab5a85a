"""Products from usage to publication (R6-R16) and scalar functions (X) over the derived views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import products
from ..sources.views import duck, table, view
from .join_queries import PRICES
from .registry import query

V = view
MONEY = "CASE WHEN {0} <= 1000 THEN 'to 1000' WHEN {0} <= 5000 THEN 'to 5000' WHEN {0} <= 10000 THEN 'to 10000' WHEN {0} <= 50000 THEN 'to 50000' ELSE 'over 50000' END"


def priced(spark: SparkSession, d: str) -> DataFrame:
    p = spark.createDataFrame([(k, v, 500.0) for k, v in PRICES.items()], "item string, price double, free double")
    return products.cost(products.monthly(V(spark, d, "usage")), p)


COST = f", q AS (SELECT item, avg(amount) * 30.44 AS quantity FROM usage GROUP BY 1), c AS (SELECT item, quantity, round_even(quantity * price, 4) AS gross, round_even(greatest(0.0, quantity - 500) * price, 4) AS net, quantity / 500 AS allowance_used FROM q JOIN (VALUES {', '.join(f'({k!r}, {v}::DOUBLE)' for k, v in PRICES.items())}) p(item, price) USING (item))"


@query(duck("usage", COST + " SELECT item, round(quantity, 4) AS quantity, CASE WHEN item IN ('click', 'view') THEN 'read' ELSE 'write' END AS class FROM c"))
def r6_monthly_quantities(spark: SparkSession, d: str) -> DataFrame:
    q = products.monthly(V(spark, d, "usage"))
    return q.select("item", F.round("quantity", 4).alias("quantity"), S.looked_up(F.col("item"), {"click": "read", "view": "read"}, "write").alias("class"))


@query(duck("usage", COST + " SELECT item, round(gross, 2) AS gross, round(net, 2) AS net, round(allowance_used, 4) AS allowance_used FROM c"))
def r7_cost(spark: SparkSession, d: str) -> DataFrame:
    return priced(spark, d).select("item", F.round("gross", 2).alias("gross"), F.round("net", 2).alias("net"), F.round("allowance_used", 4).alias("allowance_used"))


@query(duck("usage", COST + " SELECT round(sum(gross), 2) AS gross, round(sum(net), 2) AS net, CASE WHEN sum(net) >= 0.8 * 1000000 THEN 'near target' WHEN sum(gross) > 1000000 THEN 'over without allowance' ELSE 'fine' END AS alert FROM c"))
def r8_cost_alert(spark: SparkSession, d: str) -> DataFrame:
    return products.cost_alert(priced(spark, d).agg(F.round(F.sum("gross"), 2).alias("gross"), F.round(F.sum("net"), 2).alias("net")), 1_000_000)


@query(duck("usage", ", g AS (SELECT item, sum(amount) AS used, (arg_max(amount, day) - arg_min(amount, day)) / (count(*) - 1) AS growth FROM usage GROUP BY 1) SELECT item, round(CASE WHEN growth > 0 THEN greatest(0.0, (1e6 - used) / (growth * 30.44)) END, 4) AS months_to_limit, round(greatest(0.0, used + growth * 30.44 * 12 - 1e6) * 0.02, 4) AS cost_in_a_year FROM g"))
def r9_storage_outlook(spark: SparkSession, d: str) -> DataFrame:
    g = V(spark, d, "usage").groupBy("item").agg(F.sum("amount").alias("used"), ((F.max_by("amount", "day") - F.min_by("amount", "day")) / (F.count("*") - 1)).alias("growth"))
    return g.select("item", *[F.round(c, 4).alias(k) for k, c in products.storage_outlook(F.col("used"), F.col("growth"), 1e6, 0.02).items()])


@query("SELECT p_brand AS label, CASE WHEN n BETWEEN 1 AND 9 THEN '<10' ELSE CAST(n AS VARCHAR) END AS n FROM (SELECT p_brand, count_if(p_size > 47) AS n FROM part GROUP BY 1)")
def r10_r11_published_counts(spark: SparkSession, d: str) -> DataFrame:
    """Aggregates under an allow-list, small counts suppressed."""
    g = table(spark, d, "part").groupBy(F.col("p_brand").alias("label")).agg(F.count_if(F.col("p_size") > 47).alias("n"), F.max("p_name").alias("name"))
    return products.published(g, ["n"], ["label", "n"])


QUEUE = """, z AS (SELECT max(seen_at) AS now FROM details), x AS (SELECT entity, max(seen_at) AS checked_at, arg_max(n_rows, seen_at) > 1 AS changed, arg_max(status, seen_at) <> 'all' AS live FROM details GROUP BY 1),
y AS (SELECT o_orderkey AS entity, CASE WHEN o_orderkey % 11 <> 0 THEN checked_at END AS checked_at, coalesce(changed, false) AS changed, coalesce(live, false) AS live, now, CASE WHEN o_orderkey % 3 = 0 THEN now - (o_orderkey % 5) * INTERVAL 20 MINUTE END AS failed_at FROM orders LEFT JOIN x ON entity = o_orderkey, z),
p AS (SELECT *, CASE WHEN changed AND checked_at IS NOT NULL THEN 0 WHEN checked_at IS NULL THEN 1 WHEN (epoch(now) - epoch(checked_at)) / 3600 >= 24 THEN 2 WHEN (epoch(now) - epoch(checked_at)) / 3600 >= 18 THEN 3 END AS priority FROM y)
SELECT entity, CAST(priority AS INT) AS priority, live FROM p WHERE priority IS NOT NULL AND (failed_at IS NULL OR epoch(now) - epoch(failed_at) >= 3600) ORDER BY priority, checked_at NULLS FIRST, live DESC, entity LIMIT 200"""


@query(duck("details", QUEUE))
def r12_refresh_queue(spark: SparkSession, d: str) -> DataFrame:
    """The first 200 entities to check again; every third one failed 0 to 80 minutes ago."""
    det = V(spark, d, "details")
    x = det.groupBy("entity").agg(F.max("seen_at").alias("checked_at"), (F.max_by("n_rows", "seen_at") > 1).alias("changed"), (F.max_by("status", "seen_at") != "all").alias("live"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("entity"))
    y = o.join(x, "entity", "left").crossJoin(F.broadcast(det.agg(F.max("seen_at").alias("now"))))
    y = y.select("entity", F.when(F.col("entity") % 11 != 0, F.col("checked_at")).alias("checked_at"), F.coalesce("changed", F.lit(False)).alias("changed"), F.coalesce("live", F.lit(False)).alias("live"), "now", F.when(F.col("entity") % 3 == 0, F.timestamp_seconds(F.unix_seconds("now") - F.col("entity") % 5 * 1200)).alias("failed_at"))
    return products.refresh_queue(y, F.col("now"), 200).select("entity", "priority", "live")


@query(duck("reports", ", f AS (SELECT DISTINCT family, version, case_no FROM reports) SELECT family, version, case_no, row_number() OVER (PARTITION BY family ORDER BY version DESC, case_no DESC) AS turn FROM f"))
def r13_fair_queue(spark: SparkSession, d: str) -> DataFrame:
    f = V(spark, d, "reports").select("family", "version", "case_no").distinct()
    return products.fair_queue(f, "family", "version", "case_no").select("family", "version", "case_no", F.col("turn").cast("long").alias("turn"))


R15 = "SELECT p_brand AS label, CASE WHEN part >= 10 THEN round(part / whole, 6) END AS share FROM (SELECT p_brand, count_if(p_size > 25) AS part, count(*) AS whole FROM part GROUP BY 1)"


@query(R15)
def r15_shown_shares(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "part").groupBy(F.col("p_brand").alias("label")).agg(F.count_if(F.col("p_size") > 25).alias("part"), F.count("*").alias("whole"))
    return g.select("label", F.round(S.shown_share(F.col("part"), F.col("whole")), 6).alias("share"))


@query("SELECT p_brand AS label, CASE WHEN NOT (a BETWEEN 1 AND 9 OR b BETWEEN 1 AND 9) THEN CASE WHEN b - a < 0 THEN '' ELSE '+' END || CAST(b - a AS VARCHAR) END AS change FROM (SELECT p_brand, count_if(p_size <= 25) AS a, count_if(p_size > 25) AS b FROM part GROUP BY 1)")
def r16_shown_changes(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "part").groupBy(F.col("p_brand").alias("label")).agg(F.count_if(F.col("p_size") <= 25).alias("a"), F.count_if(F.col("p_size") > 25).alias("b"))
    return g.select("label", products.shown_change(F.col("a"), F.col("b")).alias("change"))


X_SQL = """SELECT o_orderkey AS entity, CAST(try_strptime(us, '%m/%d/%Y') AS DATE)::VARCHAR AS us_date, CASE WHEN length(iso) >= 10 THEN CAST(try_cast(left(iso, 10) AS DATE) AS VARCHAR) END AS iso_date,
try_cast(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS money, CAST(year(DATE '1998-12-01') - year(od) - CASE WHEN (month(od), day(od)) > (12, 1) THEN 1 ELSE 0 END AS INT) AS age,
{money} AS money_band, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' WHEN o_orderpriority LIKE '2%' THEN 'high' ELSE 'other' END AS rank_label,
CAST(CAST((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS DATE) AS VARCHAR) AS local_date, strftime((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago', '%b %d, %I:%M %p') AS local_label,
lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(length(CAST(o_orderkey AS VARCHAR)), 4) AS INT), '0') AS padded, round_even(o_orderkey / 4, 1) AS half_even,
CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS looked_up
FROM (SELECT *, CAST(o_orderdate AS DATE) AS od, CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%m/%d/%Y') END AS us, CASE WHEN o_orderkey % 5 = 0 THEN '1998' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00' END AS iso,
'$' || format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) AS price FROM orders)""".format(money=MONEY.format("o_totalprice"))


@query(X_SQL)
def x1_to_x20_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Dates, money, ages, bands, ranks, local times, padding, rounding, look-ups on every order."""
    o = table(spark, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    day = F.col("o_orderdate").cast("date")
    us = F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.date_format("at", "MM/dd/yyyy"))
    iso = F.when(F.col("o_orderkey") % 5 == 0, "1998").otherwise(F.concat(day.cast("string"), F.lit("T00:00")))
    price = F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0))
    rank = S.most_serious(F.array(F.element_at(F.split("o_orderpriority", "-"), 1)), ["1", "2"], "other")
    return o.select(
        F.col("o_orderkey").alias("entity"),
        S.us_date(us).cast("string").alias("us_date"),
        S.iso_date(iso).cast("string").alias("iso_date"),
        S.money(price).alias("money"),
        S.age_on(day, F.lit("1998-12-01").cast("date")).alias("age"),
        S.band(F.col("o_totalprice"), S.MONEY_BANDS).alias("money_band"),
        S.looked_up(rank, {"1": "urgent", "2": "high"}, "other").alias("rank_label"),
        S.local_date(F.col("at"), "America/Chicago").cast("string").alias("local_date"),
        S.local_label(F.col("at"), "America/Chicago").alias("local_label"),
        S.padded_id(F.col("o_orderkey"), 4).alias("padded"),
        F.bround(F.col("o_orderkey") / 4, 1).alias("half_even"),
        S.looked_up(F.col("o_orderstatus"), {"F": "finished", "O": "open"}, "unknown").alias("looked_up"),
    )


X6 = """SELECT l_orderkey AS entity, CASE WHEN bool_and(l_returnflag = 'N') THEN 'all' WHEN bool_or(l_returnflag = 'N') THEN 'some' ELSE 'none' END AS status, CASE WHEN bool_or(l_returnflag = 'R') THEN 'R' WHEN bool_or(l_returnflag = 'A') THEN 'A' ELSE 'minor' END AS serious,
CASE WHEN bool_and(l_returnflag = 'N') THEN round(sum(l_extendedprice), 2) END AS only_reason FROM lineitem GROUP BY 1"""


@query(X6)
def x6_x8_array_rules(spark: SparkSession, d: str) -> DataFrame:
    """Most serious label, status of a set, amount where no other reason stands."""
    g = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("entity")).agg(F.collect_list("l_returnflag").alias("f"), F.round(F.sum("l_extendedprice"), 2).alias("a"))
    is_n = lambda x: x == "N"
    return g.select("entity", S.set_status(F.col("f"), is_n).alias("status"), S.most_serious(F.col("f"), ["R", "A"], "minor").alias("serious"), S.only_reason(F.col("f"), F.col("a"), is_n).alias("only_reason"))


X10 = r"""SELECT event_id, trim(regexp_replace('  ' || event_type || chr(9) || chr(10) || ' ' || CAST(user_id AS VARCHAR) || '  ', '\s+', ' ', 'g')) AS squeezed, try_cast(replace(regexp_extract('Showing 1 to ' || format('{:,}', event_id) || ' of n', 'to ([0-9,]+) of', 1), ',', '') AS BIGINT) AS number_found,
event_type || 'Error' AS error_class, CASE user_id % 3 WHEN 0 THEN user_id * 0.001 WHEN 1 THEN user_id * 1048576.0 ELSE CAST(user_id AS DOUBLE) END AS size_number, event_id % 50 = 0 AS heading FROM events"""


@query(X10)
def x10_x19_text_rules(spark: SparkSession, d: str) -> DataFrame:
    """White space, numbers in text, error classes, sizes with suffixes, heading rows."""
    e = table(spark, d, "events")
    messy = F.concat(F.lit("  "), "event_type", F.lit("\t\n "), F.col("user_id").cast("string"), F.lit("  "))
    shown = F.concat(F.lit("Showing 1 to "), F.format_number("event_id", 0), F.lit(" of n"))
    size = F.concat(F.col("user_id").cast("string"), F.element_at(F.array(F.lit("m"), F.lit("Mi"), F.lit("")), (F.col("user_id") % 3 + 1).cast("int")))
    head = F.col("event_id") % 50 == 0
    named = e.withColumns({"name": F.when(head, "name").otherwise(F.col("event_type")), "value": F.when(head, "value").otherwise("1")})
    return named.select("event_id", S.squeezed(messy).alias("squeezed"), S.number_in(shown, r"to ([0-9,]+) of").alias("number_found"), S.error_class(F.concat("event_type", F.lit("Error: secret"))).alias("error_class"), F.round(S.size_number(size), 6).alias("size_number"), S.is_heading(["name", "value"]).alias("heading"))


@query("SELECT o_orderkey AS entity, sha256('{\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}') AS row_hash FROM orders")
def x12_canonical_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("entity"), S.row_hash(["o_orderstatus", "o_custkey"]).alias("row_hash"))

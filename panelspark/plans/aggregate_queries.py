"""Aggregations (A), sorts and set operations (O)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.scalars import local_date
from ..sources import files
from ..sources.views import duck, table, view
from .registry import query, secs, text

V = view
LABELS = ["A", "N", "R", "X"]


@query("SELECT p_brand AS label, count(*) AS n FROM part GROUP BY 1")
def a1_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


@query(f"SELECT CAST(i - 1 AS INT) AS ord, o.label, count(l_returnflag) AS n FROM (SELECT unnest({LABELS}) AS label, generate_subscripts({LABELS}, 1) AS i) o LEFT JOIN lineitem ON l_returnflag = label GROUP BY 1, 2")
def a2_ordered_labels(spark: SparkSession, d: str) -> DataFrame:
    return stats.label_counts(table(spark, d, "lineitem"), F.col("l_returnflag"), LABELS)


@query(duck("stays", "SELECT grp, median(duration) AS median, quantile_disc(duration, 0.5 ORDER BY duration DESC) AS high_median FROM stays GROUP BY 1".replace("quantile_disc(duration, 0.5 ORDER BY duration DESC)", "list_sort(list(duration))[CAST(floor(count(*) / 2) AS BIGINT) + 1]")))
def a3_a4_medians(spark: SparkSession, d: str) -> DataFrame:
    """Mean of the middle two, and the upper of them."""
    return V(spark, d, "stays").groupBy("grp").agg(F.median("duration").alias("median"), stats.high_median("duration").alias("high_median"))


A6 = ", s AS (SELECT grp, duration, row_number() OVER (PARTITION BY grp ORDER BY duration) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM stays) SELECT grp, CAST(0.8 AS DOUBLE) AS share, max(CASE WHEN i = floor(0.8 * (n - 1)) AND n >= 5 THEN duration END) AS value FROM s GROUP BY 1"


@query(duck("stays", A6))
def a6_band_quantile(spark: SparkSession, d: str) -> DataFrame:
    return stats.index_quantiles(V(spark, d, "stays"), ["grp"], "duration", (0.8,), last=True, least=5)


@query(duck("points", "SELECT source, round(avg(population), 6) AS mean, round(stddev_pop(population), 6) AS sd, round(avg(abs(population - 2.0)), 6) AS mean_absolute FROM points GROUP BY 1"))
def a7_a8_mean_sd_mae(spark: SparkSession, d: str) -> DataFrame:
    return V(spark, d, "points").groupBy("source").agg(F.round(F.avg("population"), 6).alias("mean"), F.round(F.stddev_pop("population"), 6).alias("sd"), F.round(F.avg(F.abs(F.col("population") - 2.0)), 6).alias("mean_absolute"))


@query(duck("stays", "SELECT grp, count_if(duration > 365) AS over_365, count_if(duration > 730) AS over_730, round(count_if(duration > 365) / count(*), 6) AS share_365 FROM stays GROUP BY 1"))
def a9_conditional_shares(spark: SparkSession, d: str) -> DataFrame:
    n = F.count_if(F.col("duration") > 365)
    return V(spark, d, "stays").groupBy("grp").agg(n.alias("over_365"), F.count_if(F.col("duration") > 730).alias("over_730"), F.round(F.try_divide(n, F.count("*")), 6).alias("share_365"))


@query(duck("details", "SELECT lim AS \"limit\", count(*) AS n, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM details, (SELECT unnest([1000, 5000, 10000]) AS lim) WHERE amount <= lim GROUP BY 1"))
def a10_threshold_groups(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative groups: one row feeds every limit that holds it."""
    return stats.threshold_groups(V(spark, d, "details"), "amount", (1000, 5000, 10000)).groupBy("limit").agg(F.count("*").alias("n"), F.sum("n_rows").alias("n_rows"))


@query("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, round(median(o_totalprice), 4) AS median, count_if(o_totalprice > 200000) AS large FROM orders GROUP BY 1, 2")
def a11_two_level_groups(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), F.round(F.median("o_totalprice"), 4).alias("median"), F.count_if(F.col("o_totalprice") > 200000).alias("large"))


@query("SELECT l_partkey AS label, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, label LIMIT 15")
def a12_a25_top_labels(spark: SparkSession, d: str) -> DataFrame:
    """Each label once per entity, then the 15 commonest."""
    x = V(spark, d, "details").groupBy("entity").agg(F.array_distinct(F.flatten(F.collect_list("cases"))).alias("cases"))
    return x.select(F.explode("cases").alias("label")).groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(15)


@query(duck("reports", "SELECT family, version, case_no, entity, CAST(event_date AS VARCHAR) AS event_date FROM reports r WHERE version = (SELECT max(version) FROM reports x WHERE x.family = r.family)"))
def a13_latest_report(spark: SparkSession, d: str) -> DataFrame:
    return stats.latest_rows(V(spark, d, "reports"), ["family"], ["version"]).select("family", "version", "case_no", "entity", text("event_date"))


@query("SELECT o_custkey AS path, o_orderpriority AS digest, max(o_orderkey) AS parser_version FROM orders GROUP BY 1, 2")
def a14_newest_parse(spark: SparkSession, d: str) -> DataFrame:
    """Of several parses of one content the highest parser version wins."""
    w = Window.partitionBy("o_custkey", "o_orderpriority").orderBy(F.desc("o_orderkey"))
    o = table(spark, d, "orders").withColumn("r", F.row_number().over(w)).where("r = 1")
    return o.select(F.col("o_custkey").alias("path"), F.col("o_orderpriority").alias("digest"), F.col("o_orderkey").alias("parser_version"))


FLOW = """, cov AS (SELECT min(start_date) AS a, max(start_date) AS z FROM visits), i AS (SELECT start_date AS day, count(*) AS n FROM visits GROUP BY 1), o AS (SELECT end_date AS day, count(*) AS n FROM visits WHERE end_date IS NOT NULL GROUP BY 1),
flows AS (SELECT coalesce(i.day, o.day) AS day, coalesce(i.n, 0) AS first_seen, coalesce(o.n, 0) AS released FROM i FULL JOIN o ON i.day = o.day, cov WHERE coalesce(i.day, o.day) > a AND coalesce(i.day, o.day) < z)"""


def daily_flows(spark: SparkSession, d: str) -> DataFrame:
    v = V(spark, d, "visits")
    cov = F.broadcast(v.agg(F.min("start_date").alias("a"), F.max("start_date").alias("z")))
    i = v.groupBy(F.col("start_date").alias("day")).agg(F.count("*").alias("first_seen"))
    o = v.where("end_date is not null").groupBy(F.col("end_date").alias("day")).agg(F.count("*").alias("released"))
    f = i.join(o, "day", "full_outer").crossJoin(cov).where("day > a and day < z")
    return f.select("day", F.coalesce("first_seen", F.lit(0)).alias("first_seen"), F.coalesce("released", F.lit(0)).alias("released"))


@query(duck("visits", FLOW + " SELECT CAST(day AS VARCHAR) AS day, first_seen, released FROM flows"))
def a15_daily_flows(spark: SparkSession, d: str) -> DataFrame:
    return daily_flows(spark, d).select(text("day"), "first_seen", "released")


@query(duck("visits", FLOW + ", m AS (SELECT CAST(date_trunc('month', day) AS DATE) AS as_of FROM flows GROUP BY 1) SELECT CAST(as_of AS VARCHAR) AS as_of, round(avg(first_seen), 6) AS mean_in, round(avg(released), 6) AS mean_out, count(*) AS days FROM m JOIN flows ON day >= as_of - 7 AND day < as_of GROUP BY 1"))
def a16_prior_week_means(spark: SparkSession, d: str) -> DataFrame:
    """Means of the seven days before each date, over the days that are there."""
    f = daily_flows(spark, d)
    as_of = f.select(F.trunc("day", "month").alias("as_of")).distinct().withColumn("day", F.explode(F.expr("sequence(date_sub(as_of, 7), date_sub(as_of, 1))")))
    return as_of.join(f, "day").groupBy("as_of").agg(F.round(F.avg("first_seen"), 6).alias("mean_in"), F.round(F.avg("released"), 6).alias("mean_out"), F.count("*").alias("days")).select(text("as_of"), "mean_in", "mean_out", "days")


@query(duck("points", "SELECT CAST(CAST((slot AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS DATE) AS VARCHAR) AS day, median(population) AS median, count(*) AS versions FROM points GROUP BY 1"))
def a17_median_by_local_day(spark: SparkSession, d: str) -> DataFrame:
    return V(spark, d, "points").groupBy(local_date(F.col("slot"), "America/Chicago").cast("string").alias("day")).agg(F.median("population").alias("median"), F.count("*").alias("versions"))


@query(duck("visits", "SELECT owner, CASE WHEN count(end_date) = count(*) THEN CAST(min(end_date) AS VARCHAR) END AS first_end FROM visits GROUP BY 1"))
def a19_all_present_minimum(spark: SparkSession, d: str) -> DataFrame:
    return V(spark, d, "visits").groupBy("owner").agg(F.when(F.count("end_date") == F.count("*"), F.min("end_date")).cast("string").alias("first_end"))


@query(duck("reports", "SELECT family, count(DISTINCT (version, case_no)) AS versions FROM reports GROUP BY 1"))
def a20_distinct_versions(spark: SparkSession, d: str) -> DataFrame:
    return V(spark, d, "reports").groupBy("family").agg(F.count_distinct(F.struct("version", "case_no")).alias("versions"))


@query(duck("details", ", c AS (SELECT entity, count(*) AS n FROM details GROUP BY 1) SELECT least(n, 3) AS versions, count(*) AS entities FROM c GROUP BY 1"))
def a21_capped_histogram(spark: SparkSession, d: str) -> DataFrame:
    return V(spark, d, "details").groupBy("entity").count().groupBy(stats.capped(F.col("count"), 3).alias("versions")).agg(F.count("*").alias("entities"))


A22 = "SELECT o_orderstatus AS status, count(*) AS eligible, count(l) AS available, count_if(l > DATE '1998-06-01') AS fresh, count(*) - count(l) AS pending, CAST(min(l) AS VARCHAR) AS oldest FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS l FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1"


@query(A22)
def a22_coverage(spark: SparkSession, d: str) -> DataFrame:
    checked = V(spark, d, "details").groupBy(F.col("entity").alias("o_orderkey")).agg(F.max(F.col("seen_at").cast("date")).alias("l"))
    return table(spark, d, "orders").join(checked, "o_orderkey", "left").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("eligible"), F.count("l").alias("available"), F.count_if(F.col("l") > F.lit("1998-06-01").cast("date")).alias("fresh"), (F.count("*") - F.count("l")).alias("pending"), F.min("l").cast("string").alias("oldest"))


@query(duck("reports", """, f AS (SELECT family, version, count_if(entity = '') AS q FROM reports GROUP BY 1, 2)
SELECT family, count(*) AS listed, count_if(version < 1998) AS archived, count_if(version < 1998 AND version % 4 <> 0) AS parsed, count_if(version < 1998 AND version % 4 = 0) AS unsupported,
count_if(version >= 1997) AS pending, CAST(sum(CASE WHEN version < 1998 AND version % 4 <> 0 THEN q ELSE 0 END) AS BIGINT) AS quarantined FROM f GROUP BY 1"""))
def a23_catalogue_totals(spark: SparkSession, d: str) -> DataFrame:
    """Files of a family: those before 1998 are archived, each fourth year's cannot be read, later ones are due."""
    old = F.col("version") < 1998
    f = V(spark, d, "reports").groupBy("family", "version").agg(F.count_if(F.col("entity") == "").alias("q"))
    f = f.withColumns({"archived": old, "status": F.when(old & (F.col("version") % 4 == 0), "unsupported").when(old, "parsed").otherwise("listed")})
    return files.catalogue_totals(f.withColumn("quarantined", F.when(F.col("status") == "parsed", F.col("q")).otherwise(0)), "family", F.col("version") >= 1997)


@query(duck("usage", "SELECT item, round(median(amount), 6) AS daily_median, round(arg_max(amount, day), 6) AS latest, round((arg_max(amount, day) - arg_min(amount, day)) / (count(*) - 1), 6) AS growth FROM usage GROUP BY 1"))
def a24_usage_growth(spark: SparkSession, d: str) -> DataFrame:
    last, first = F.max_by("amount", "day"), F.min_by("amount", "day")
    return V(spark, d, "usage").groupBy("item").agg(F.round(F.median("amount"), 6).alias("daily_median"), F.round(last, 6).alias("latest"), F.round((last - first) / (F.count("*") - 1), 6).alias("growth"))


@query(duck("visits", FLOW + " SELECT round(avg(first_seen), 6) AS mean_in, round(avg(released), 6) AS mean_out, round(avg(first_seen - released), 6) AS net FROM flows"))
def a26_mean_flows(spark: SparkSession, d: str) -> DataFrame:
    return daily_flows(spark, d).agg(F.round(F.avg("first_seen"), 6).alias("mean_in"), F.round(F.avg("released"), 6).alias("mean_out"), F.round(F.avg(F.col("first_seen") - F.col("released")), 6).alias("net"))


@query("SELECT o_orderkey AS entity, o_orderpriority AS priority, round(o_totalprice, 2) AS amount FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50")
def o1_composite_sort(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(50).select(F.col("o_orderkey").alias("entity"), F.col("o_orderpriority").alias("priority"), F.round("o_totalprice", 2).alias("amount"))


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, population FROM points ORDER BY points.slot DESC, source LIMIT 40"))
def o3_last_rows(spark: SparkSession, d: str) -> DataFrame:
    return V(spark, d, "points").orderBy(F.desc("slot"), "source").limit(40).select("source", secs("slot"), "population")


@query(duck("reports", "SELECT 'union' AS op, count(*) AS n FROM (SELECT case_no FROM reports WHERE family = 'pending' UNION SELECT case_no FROM reports WHERE family = 'calendar_a') UNION ALL SELECT 'intersect', count(*) FROM (SELECT case_no FROM reports WHERE family = 'pending' INTERSECT SELECT case_no FROM reports WHERE family = 'calendar_a') UNION ALL SELECT 'except', count(*) FROM (SELECT case_no FROM reports WHERE family = 'pending' EXCEPT SELECT case_no FROM reports WHERE family = 'calendar_a')"))
def o4_set_operations(spark: SparkSession, d: str) -> DataFrame:
    r = V(spark, d, "reports")
    a, b = (r.where(F.col("family") == f).select("case_no") for f in ("pending", "calendar_a"))
    n = lambda op, df: df.agg(F.lit(op).alias("op"), F.count("*").alias("n"))
    return n("union", a.union(b).distinct()).union(n("intersect", a.intersect(b))).union(n("except", a.subtract(b)))


@query("SELECT l_partkey AS k, CAST(greatest(0, count_if(l_returnflag = 'N') - count_if(l_returnflag = 'R')) AS BIGINT) AS n FROM lineitem GROUP BY 1 HAVING count_if(l_returnflag = 'N') > count_if(l_returnflag = 'R')")
def o5_multiset_except(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    left, right = (li.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k")) for f in "NR")
    return left.exceptAll(right).groupBy("k").agg(F.count("*").alias("n"))


@query(duck("points", "SELECT CAST(epoch(slot) AS BIGINT) AS slot, max(source) AS source, CAST(arg_max(population, source) AS BIGINT) AS population FROM points GROUP BY 1"))
def o6_keep_last_after_union(spark: SparkSession, d: str) -> DataFrame:
    """A history merged by slot: of several rows the last one stays."""
    p = V(spark, d, "points")
    both = p.where("source < 'purchase'").union(p.where("source >= 'purchase'"))
    w = Window.partitionBy("slot").orderBy(F.desc("source"))
    return both.withColumn("r", F.row_number().over(w)).where("r = 1").select(secs("slot"), "source", "population")

"""Profile and trend products (R1-R3) over orders as listed entities and their lines as charges and bonds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import products
from ..operators import profile as P
from ..sources.views import table
from .registry import query

DATES = ["1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01"]
GRADES, VIOLATIONS = [f"G{k}" for k in range(9)], ["G9", "G10"]
FELONIES = GRADES[:6]


def listings(spark: SparkSession, d: str) -> DataFrame:
    """A row per date and order that is listed then without an end; orders without lines have no details."""
    line = table(spark, d, "lineitem").select("*", F.concat(F.lit("G"), F.col("l_suppkey") % 12).alias("grade"), F.col("l_shipdate").cast("date").alias("ship"))
    charge = F.struct("grade", F.concat(F.lit("P"), F.col("l_partkey") % 40).alias("description"))
    bond = F.struct(F.when(F.col("l_linestatus") == "F", "sentenced").otherwise("open").alias("status"), F.when(F.col("l_returnflag") == "R", "none set").otherwise("assessed").alias("kind"))
    details = line.groupBy(F.col("l_orderkey").alias("entity")).agg(
        F.collect_list(charge).alias("charges"), F.collect_list(F.when(F.col("l_linenumber") > 2, bond)).alias("bonds"),
        F.collect_list(F.when(F.col("l_linenumber") > 1, F.col("ship"))).alias("hearings"), F.bool_or(F.col("l_quantity") >= 49).alias("detainer"),
    )
    o = visits(spark, d).withColumn("as_of", F.explode(F.array(*[F.lit(x).cast("date") for x in DATES])))
    o = o.where((F.col("first_seen") <= F.col("as_of")) & (F.col("end_date").isNull() | (F.col("end_date") > F.col("as_of"))))
    birth = F.when(F.col("c_custkey") % 11 != 0, F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") * 37 % 26_000).cast("int")))
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_nationkey") % 3 == 0, "M").when(F.col("c_nationkey") % 3 == 1, "F").alias("sex"), F.expr("nullif(c_mktsegment, 'BUILDING')").alias("race"),
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("facility"), birth.alias("birth"),
    )
    rows = o.join(details, "entity", "left").join(c, "o_custkey", "left")
    start = F.when(F.col("entity") % 19 != 0, F.col("day"))
    return rows.select("as_of", "entity", F.col("charges").isNotNull().alias("known"), "sex", "race", F.col("o_orderpriority").alias("ethnicity"), "facility", "birth", start.alias("start"), "charges", "bonds", "hearings", "detainer", (F.col("o_totalprice") / 4).alias("bond_total"))


def visits(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    end = F.when(F.col("o_orderstatus") != "O", F.date_add(day, (F.col("o_orderkey") % 900).cast("int")))
    return table(spark, d, "orders").select("*", F.col("o_orderkey").alias("entity"), day.alias("day"), F.date_sub(day, 3).alias("first_seen"), end.alias("end_date"))


def profiles(spark: SparkSession, d: str) -> DataFrame:
    return P.profile(listings(spark, d), GRADES, VIOLATIONS)


def case(value: str, limits: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} <= {x} THEN '{label}'" for x, label in limits) + f" ELSE {otherwise} END"


AGE = [("17", "0-17"), ("24", "18-24"), ("34", "25-34"), ("44", "35-44"), ("54", "45-54"), ("64", "55-64"), ("200", "65-200")]
HELD = [("6", "0-6"), ("30", "7-30"), ("90", "31-90"), ("180", "91-180"), ("365", "181-365"), ("730", "366-730"), ("1095", "731-1095")]
BOND = [("1000", "to 1000"), ("5000", "to 5000"), ("10000", "to 10000"), ("25000", "to 25000"), ("50000", "to 50000"), ("100000", "to 100000"), ("250000", "to 250000")]
COURT = [("-1", "before"), ("0", "0"), ("7", "1-7"), ("30", "8-30"), ("90", "31-90")]
ZERO = {"age": [x for _, x in AGE] + ["not listed"], "held": [x for _, x in HELD] + ["1096+"], "grade": [*GRADES, "violation only", "other"], "bond": [x for _, x in BOND] + ["over 250000"], "court": [x for _, x in COURT] + ["91+", "no date"]}
PROFILE = f"""WITH dates AS (SELECT unnest([{", ".join(f"DATE '{x}'" for x in DATES)}]) AS as_of),
visits AS (SELECT *, CAST(o_orderdate AS DATE) AS od, CAST(o_orderdate AS DATE) - 3 AS first_seen, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INT) END AS end_date FROM orders),
lines AS (SELECT l_orderkey, count_if(l_linenumber > 2) AS bonds, count_if(l_linenumber > 2 AND l_linestatus = 'F') AS sentenced, count_if(l_linenumber > 2 AND l_linestatus <> 'F' AND l_returnflag <> 'R') AS open_money,
 count_if(l_linenumber > 2 AND l_returnflag = 'R') > 0 AS no_bond_set, min(l_suppkey % 12) FILTER (l_suppkey % 12 < 9) AS grade_no, bool_or(l_suppkey % 12 IN (9, 10)) AS violation_charge,
 bool_or(l_quantity >= 49) AS detainer, min(CAST(l_shipdate AS DATE)) FILTER (l_linenumber > 1) AS hearing FROM lineitem GROUP BY 1),
listed AS (SELECT *, CASE WHEN o_orderkey % 19 <> 0 AND od <= as_of THEN date_diff('day', od, as_of) END AS held_days, CASE WHEN c_custkey % 11 <> 0 THEN DATE '1930-01-01' + CAST(c_custkey * 37 % 26000 AS INT) END AS birth
 FROM visits CROSS JOIN dates LEFT JOIN lines ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey WHERE first_seen <= as_of AND (end_date IS NULL OR end_date > as_of)),
people AS (SELECT *, CASE WHEN bonds = 0 THEN 'empty' WHEN sentenced = bonds THEN 'all' WHEN sentenced > 0 THEN 'some' ELSE 'none' END AS status,
 CASE WHEN bonds > 0 AND open_money = bonds AND NOT detainer AND NOT violation_charge AND o_totalprice > 0 THEN o_totalprice / 4 END AS total,
 year(as_of) - year(birth) - CASE WHEN (month(as_of), day(as_of)) < (month(birth), day(birth)) THEN 1 ELSE 0 END AS age_years, date_diff('day', as_of, hearing) AS ahead FROM listed WHERE l_orderkey IS NOT NULL),
marks AS (SELECT as_of, unnest([{{'section': 'sex', 'label': CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'not listed' END}}, {{'section': 'race', 'label': CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE 'not listed' END}},
 {{'section': 'ethnicity', 'label': coalesce(o_orderpriority, 'not listed')}}, {{'section': 'facility', 'label': coalesce('N' || c_nationkey, 'not listed')}}, {{'section': 'age', 'label': CASE WHEN birth IS NULL THEN 'not listed' WHEN age_years >= 0 THEN {case("age_years", AGE, "NULL")} END}},
 {{'section': 'held', 'label': CASE WHEN held_days IS NOT NULL THEN {case("held_days", HELD, "'1096+'")} END}}, {{'section': 'status', 'label': status}},
 {{'section': 'grade', 'label': CASE WHEN grade_no IS NOT NULL THEN 'G' || grade_no WHEN violation_charge THEN 'violation only' ELSE 'other' END}},
 {{'section': 'bond', 'label': CASE WHEN total IS NOT NULL THEN {case("total", BOND, "'over 250000'")} END}}, {{'section': 'court', 'label': CASE WHEN ahead IS NULL THEN 'no date' ELSE {case("ahead", COURT, "'91+'")} END}}]) AS m FROM people),
zero AS (SELECT as_of, section, label FROM dates CROSS JOIN (VALUES {", ".join(f"('{k}', '{x}')" for k, xs in ZERO.items() for x in xs)}) z(section, label)),
counts AS (SELECT as_of, section, label, 'n' AS metric, sum(n) AS value FROM (SELECT as_of, m.section AS section, m.label AS label, 1 AS n FROM marks WHERE m.label IS NOT NULL UNION ALL SELECT as_of, section, label, 0 FROM zero) GROUP BY 1, 2, 3),
totals AS (SELECT as_of, median(held_days) AS median_days, round(count_if(held_days > 365) / count(*), 6) AS over_year_share, round(count_if(held_days > 730) / count(*), 6) AS over_two_years_share, count_if(held_days IS NULL) AS start_missing_or_future,
 count_if(detainer) AS detainer, count_if(violation_charge) AS violation_charge, count_if(no_bond_set) AS no_bond_set, count(total) AS people, count_if(total <= 5000) AS at_most_5000, count_if(total <= 10000) AS at_most_10000, round(median(total), 6) AS median FROM people GROUP BY 1),
roster AS (SELECT as_of, count(*) AS listed, count(l_orderkey) AS people, count(*) - count(l_orderkey) AS missing_details FROM listed GROUP BY 1),
by_status AS (SELECT as_of, status, count(*) AS people, median(held_days) AS median_days, count_if(held_days > 365) AS over_year FROM people WHERE held_days IS NOT NULL GROUP BY 1, 2),
offenses AS (SELECT as_of, 'P' || (l_partkey % 40) AS label, count(DISTINCT o_orderkey) AS n FROM people JOIN lineitem USING (l_orderkey) GROUP BY 1, 2),
profile AS (SELECT as_of, section, label, metric, CAST(value AS DOUBLE) AS value FROM counts
 {"".join(f" UNION ALL SELECT as_of, '{s}', {label}, '{m}', CAST({m} AS DOUBLE) FROM {t} WHERE {m} IS NOT NULL" for s, label, t, ms in [("people", "'all'", "roster", ["listed", "people", "missing_details"]), ("held_days", "'all'", "totals", ["median_days", "over_year_share", "over_two_years_share"]), ("held_by_status", "status", "by_status", ["people", "median_days", "over_year"]), ("flags", "'all'", "totals", P.FLAGS), ("bond_alone", "'all'", "totals", ["people", "at_most_5000", "at_most_10000", "median"])] for m in ms)}
 UNION ALL (SELECT as_of, 'offenses', label, 'n', CAST(n AS DOUBLE) FROM offenses QUALIFY row_number() OVER (PARTITION BY as_of ORDER BY n DESC, label) <= 15))"""


@query(PROFILE + " SELECT CAST(as_of AS VARCHAR) AS as_of, section, label, metric, value FROM profile")
def r1_profile(spark: SparkSession, d: str) -> DataFrame:
    """Ten distributions, four flags, days held, bonds and offenses of those listed at each date."""
    return profiles(spark, d).withColumn("as_of", F.col("as_of").cast("string"))


PICKS = {
    "people": ("people", "all", "people"), "held_median_days": ("held_days", "all", "median_days"), "held_over_year_share": ("held_days", "all", "over_year_share"), "held_over_two_years_share": ("held_days", "all", "over_two_years_share"),
    "unsentenced": ("status", "none", "n"), "unsentenced_median_days": ("held_by_status", "none", "median_days"), "partly_sentenced": ("status", "some", "n"), "all_sentenced": ("status", "all", "n"),
    "violation_only": ("grade", "violation only", "n"), "money_bond_only": ("bond_alone", "all", "people"), "money_bond_median": ("bond_alone", "all", "median"), "money_bond_at_most_5000": ("bond_alone", "all", "at_most_5000"),
    "money_bond_at_most_10000": ("bond_alone", "all", "at_most_10000"), "detainer": ("flags", "all", "detainer"), "violation_charge": ("flags", "all", "violation_charge"), "no_bond_set": ("flags", "all", "no_bond_set"),
    "court_date_passed": ("court", "before", "n"), "court_date_missing": ("court", "no date", "n"), "missing_details": ("people", "all", "missing_details"),
}
MAYBE = ("people", "held_median_days", "held_over_year_share", "held_over_two_years_share", "unsentenced_median_days", "money_bond_median")
PICKED = ", ".join(f"{'' if k in MAYBE else 'coalesce('}max(value) FILTER (section = '{s}' AND label = '{x}' AND metric = '{m}'){'' if k in MAYBE else ', 0)'} AS {k}" for k, (s, x, m) in PICKS.items())
METRICS = f"""{PROFILE}, picked AS (SELECT as_of, {PICKED}, coalesce(sum(value) FILTER (section = 'grade' AND label IN ('G0', 'G1', 'G2', 'G3', 'G4', 'G5')), 0) AS felonies FROM profile GROUP BY 1),
moves AS (SELECT day, sum(a) AS first_seen, sum(z) AS released FROM (SELECT first_seen AS day, 1 AS a, 0 AS z FROM visits UNION ALL SELECT end_date, 0, 1 FROM visits WHERE end_date IS NOT NULL) GROUP BY 1),
flows AS (SELECT * FROM moves WHERE day > (SELECT min(first_seen) FROM visits) AND day < (SELECT max(first_seen) FROM visits)),
recent AS (SELECT as_of, round(avg(first_seen), 6) AS new_per_day, round(avg(released), 6) AS released_per_day, CAST(count(day) AS DOUBLE) AS flow_days FROM dates LEFT JOIN flows ON day >= as_of - 7 AND day < as_of GROUP BY 1),
metrics AS (SELECT * EXCLUDE (felonies), CASE WHEN people > 0 THEN round(unsentenced / people, 6) END AS unsentenced_share, CASE WHEN people > 0 THEN round(felonies / people, 6) END AS felony_share FROM picked JOIN recent USING (as_of))"""


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return P.trend_metrics(profiles(spark, d), P.daily_flows(visits(spark, d)), FELONIES)


@query(METRICS + " SELECT * REPLACE (CAST(as_of AS VARCHAR) AS as_of) FROM metrics")
def r2_trend_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The 23 metrics of each date, and on how many days the flows rest."""
    return metrics(spark, d).withColumn("as_of", F.col("as_of").cast("string"))


NAMES = [*PICKS, "unsentenced_share", "felony_share", "new_per_day", "released_per_day"]


@query(METRICS + ", u AS (" + " UNION ALL ".join(f"SELECT as_of, '{n}' AS metric, {n} AS value FROM metrics" for n in NAMES) + "), r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY as_of DESC) AS k FROM u), c AS (SELECT metric, max(value) FILTER (k = 2) AS before, max(value) FILTER (k = 1) AS after FROM r GROUP BY 1) SELECT metric, before, after, round(after - before, 6) AS change FROM c WHERE before IS NOT NULL AND after IS NOT NULL")
def r3_trend_changes(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of the last two dates side by side, where both have them."""
    m = metrics(spark, d).select("as_of", *[F.col(n).cast("double").alias(n) for n in NAMES])
    changes = products.compared_dates(m.unpivot("as_of", NAMES, "metric", "value"))
    return changes.where("change IS NOT NULL").withColumn("change", F.round("change", 6))

"""Products that chain other operators (R): match rates, linkage, reconciliation of two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import joins, reconcile as two
from ..sources.views import duck, table, view
from .booking_queries import C9, START, D, S, bookings, event_timing, snap
from .event_queries import MOVES, moves
from .join_queries import REL
from .registry import query, secs

HELD = f"on_latest AND (end_date IS NULL OR end_date > {D})"

# --- match rates and linkage

MATCH = f""", bc AS (SELECT DISTINCT l_orderkey AS entity, CASE WHEN l_partkey % 5 = 0 THEN 'x' ELSE 'X' END || l_partkey AS case_no FROM lineitem), held AS (SELECT entity FROM bookings WHERE {HELD}),
rp AS (SELECT family, version, 'X' || case_no AS case_no, CASE WHEN entity <> '' THEN CAST(entity AS BIGINT) END AS entity FROM reports), pend AS (SELECT * FROM rp WHERE family = 'pending' AND version = (SELECT max(version) FROM rp WHERE family = 'pending')),
other AS (SELECT DISTINCT family, case_no FROM rp WHERE family <> 'pending'), court AS (SELECT case_no FROM other UNION SELECT case_no FROM pend),
matches AS (SELECT 'pending' AS section, 'version' AS metric, max(version) AS value FROM pend UNION ALL SELECT 'pending', 'rows', count(*) FROM pend UNION ALL SELECT 'pending', 'with entity', count(entity) FROM pend
UNION ALL SELECT 'pending', 'matching', count(*) FROM pend WHERE entity IN (SELECT entity FROM bookings) UNION ALL SELECT 'pending', 'matching with the case', count(*) FROM pend JOIN bc USING (entity, case_no) WHERE entity IN (SELECT entity FROM bookings)
UNION ALL SELECT 'held', 'entities', count(*) FROM held UNION ALL SELECT 'held', 'pending', count(*) FROM held WHERE entity IN (SELECT entity FROM pend)
UNION ALL SELECT family, 'versions', count(DISTINCT version) FROM rp WHERE family <> 'pending' GROUP BY 1 UNION ALL SELECT family, 'rows', count(*) FROM rp WHERE family <> 'pending' GROUP BY 1 UNION ALL SELECT family, 'cases', count(*) FROM other GROUP BY 1
UNION ALL SELECT family, 'cases matching', count(*) FROM other WHERE case_no IN (SELECT case_no FROM bc) GROUP BY 1 UNION ALL SELECT family, 'held with a listed case', count(DISTINCT h.entity) FROM other o LEFT JOIN bc USING (case_no) LEFT JOIN held h USING (entity) GROUP BY 1
UNION ALL SELECT 'lower case', 'cases', count(DISTINCT case_no) FROM bc WHERE case_no LIKE 'x%' UNION ALL SELECT 'lower case', 'match in upper case', count(DISTINCT case_no) FROM bc WHERE case_no LIKE 'x%' AND case_no NOT IN (SELECT case_no FROM court) AND upper(case_no) IN (SELECT case_no FROM court))"""


def held_now(b: DataFrame) -> DataFrame:
    return b.where(F.col("on_latest") & (F.col("end_date").isNull() | (F.col("end_date") > snap())))


def long(section: Column | str, **metrics: Column) -> list[Column]:
    """One struct for each metric."""
    s = F.lit(section) if isinstance(section, str) else section
    return [F.struct(s.alias("section"), F.lit(k.replace("_", " ")).alias("metric"), v.cast("long").alias("value")) for k, v in metrics.items()]


def unfolded(df: DataFrame, structs: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*structs)).alias("x")).select("x.*")


def match_rates(b: DataFrame, cases: DataFrame, reports: DataFrame) -> DataFrame:
    """(section, metric, value): how far court reports match entities by number and by case.

    b: entities; cases: (entity, case_no), which may repeat; reports: (family, version, case_no, entity or null). Of the
    pending report the newest version counts, of the others all. A case in lower case that would only match in upper case
    is counted. Each number is counted after a step that leaves what it counts once, so no row is copied per number."""
    tasks = joins.tasks_for(cases)
    held = held_now(b).select("entity").withColumn("held", F.lit(True))
    known = b.select("entity").withColumn("known", F.lit(True))
    pending = reports.where("family = 'pending'")
    pend = pending.join(F.broadcast(pending.agg(F.max("version").alias("version"))), "version", "left_semi")
    p = pend.agg(F.max("version").alias("v"), F.count("*").alias("n"), F.count("entity").alias("e"))
    named = pend.where("entity is not null").select("entity", "case_no").repartition(tasks, "entity").join(known, "entity")
    k = named.agg(F.count("*").alias("k"))
    p = p.crossJoin(k).crossJoin(named.join(cases.repartition(tasks, "entity"), ["entity", "case_no"], "left_semi").agg(F.count("*").alias("o")))
    out = unfolded(p, long("pending", version=F.col("v"), rows=F.col("n"), with_entity=F.col("e"), matching=F.col("k"), matching_with_the_case=F.col("o")))
    h = held.join(pend.select("entity").distinct().withColumn("listed", F.lit(True)), "entity", "left").agg(F.count("*").alias("n"), F.count("listed").alias("l"))
    out = out.union(unfolded(h, long("held", entities=F.col("n"), pending=F.col("l"))))
    rest = reports.where("family <> 'pending'")
    distinct = rest.select("family", "case_no").distinct()
    known_case = cases.select("case_no").distinct().withColumn("own", F.lit(True))
    with_case = distinct.join(known_case, "case_no", "left").groupBy("family").agg(F.count("case_no").alias("c"), F.count("own").alias("m"))
    with_held = joins.listed_entities(cases, distinct, tasks).join(held, "entity", "left_semi").groupBy("family").agg(F.count("*").alias("h"))
    per = rest.groupBy("family").agg(F.count_distinct("version").alias("v"), F.count("*").alias("n")).join(with_case, "family").join(with_held, "family", "left").fillna(0, "h")
    out = out.union(unfolded(per, long(F.col("family"), versions=F.col("v"), rows=F.col("n"), cases=F.col("c"), cases_matching=F.col("m"), held_with_a_listed_case=F.col("h"))))
    court = distinct.select("case_no").union(pend.select("case_no")).distinct()
    lower = cases.where(F.col("case_no").rlike("^[a-z]")).select("case_no").distinct()
    up = lower.join(court, "case_no", "left_anti").select(F.upper("case_no").alias("case_no")).join(court, "case_no", "left_semi").agg(F.count("*").alias("u"))
    return out.union(unfolded(lower.agg(F.count("*").alias("n")).crossJoin(up), long("lower case", cases=F.col("n"), match_in_upper_case=F.col("u"))))


def rates(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    cases = li.select(F.col("l_orderkey").alias("entity"), F.concat(F.when(F.col("l_partkey") % 5 == 0, "x").otherwise("X"), F.col("l_partkey").cast("string")).alias("case_no"))
    r = view(spark, d, "reports").select("family", "version", F.concat(F.lit("X"), "case_no").alias("case_no"), F.when(F.col("entity") != "", F.col("entity").cast("long")).alias("entity"))
    return match_rates(bookings(spark, d), cases, r)


@query(duck("bookings reports", MATCH + " SELECT section, metric, CAST(value AS BIGINT) AS value FROM matches"))
def r5_match_rates(spark: SparkSession, d: str) -> DataFrame:
    return rates(spark, d)


R14 = C9 + MATCH + MOVES + f""", ready AS (SELECT date_diff('day', {S}, {D}) AS days)
SELECT 'match rates' AS part, section, metric, CAST(value AS BIGINT) AS value FROM matches UNION ALL SELECT 'date changes', kind, 'changes', count(*) FROM moves GROUP BY 2 UNION ALL SELECT 'date changes', kind, 'entities', count(DISTINCT entity) FROM moves GROUP BY 2
UNION ALL SELECT 'event timing', section || ': ' || label, 'n', n FROM timing UNION ALL SELECT 'event timing', section || ': ' || label, 'median days', median FROM timing WHERE median IS NOT NULL
UNION ALL SELECT 'readiness', 'follow-up', 'days', days FROM ready UNION ALL SELECT 'readiness', 'follow-up', 'ready', CAST(days >= 28 AS BIGINT) FROM ready"""


@query(duck("bookings details reports", R14))
def r14_linkage(spark: SparkSession, d: str) -> DataFrame:
    """Match rates, changes of planned dates, timing of linked events and readiness in one long table."""
    part = lambda name, df: df.select(F.lit(name).alias("part"), "section", "metric", "value")
    m = moves(spark, d).groupBy(F.col("kind")).agg(F.count("*").alias("n"), F.count_distinct("entity").alias("e"))
    t = event_timing(spark, d).withColumn("s", F.concat_ws(": ", "section", "label"))
    timing = unfolded(t, long(F.col("s"), n=F.col("n"), median_days=F.col("median"))).where("value is not null")
    days = F.datediff(snap(), F.lit(START).cast("date"))
    ready = unfolded(spark.range(1), long("follow-up", days=days, ready=days >= 28))
    out = part("match rates", rates(spark, d)).union(part("date changes", unfolded(m, long(F.col("kind"), changes=F.col("n"), entities=F.col("e")))))
    return out.union(part("event timing", timing)).union(part("readiness", ready))


# --- reconciliation of two sources

R4 = """, a AS (SELECT slot, entity, max(CASE WHEN owner <> '' AND (end_date IS NULL OR end_date > CAST(slot AS DATE)) THEN 1 ELSE 0 END) = 1 AS held FROM roster GROUP BY 1, 2),
b AS (SELECT DISTINCT date_trunc('day', ts) + (hour(ts) // 6) * INTERVAL 6 HOUR + CASE WHEN day(ts) % 5 = 0 THEN INTERVAL 125 MINUTE ELSE INTERVAL 20 MINUTE END AS version, user_id AS entity FROM events WHERE event_type <> 'view' AND user_id % 10 <> 0),
al AS (SELECT version, arg_min(slot, abs(epoch(slot) - epoch(version))) AS slot FROM (SELECT DISTINCT version FROM b) v LEFT JOIN (SELECT DISTINCT slot FROM roster) s ON abs(epoch(slot) - epoch(version)) <= 1800 GROUP BY 1),
x AS (SELECT version, entity, held FROM al JOIN a USING (slot)), y AS (SELECT version, entity FROM b JOIN al USING (version) WHERE slot IS NOT NULL), fs AS (SELECT entity, min(slot) AS first_seen FROM roster GROUP BY 1),
j2 AS (SELECT j.version, j.entity, coalesce(x.held, false) AS held, x.held IS NOT NULL AS listed, y.entity IS NOT NULL AS in_second, first_seen FROM (SELECT version, entity FROM x UNION SELECT version, entity FROM y) j LEFT JOIN x USING (version, entity) LEFT JOIN y USING (version, entity) LEFT JOIN fs ON fs.entity = j.entity)
SELECT CAST(epoch(al.version) AS BIGINT) AS version, CAST(epoch(al.slot) AS BIGINT) AS slot, count(*) FILTER (listed) AS listed, count(*) FILTER (held) AS held, count(*) FILTER (in_second) AS second, count(*) FILTER (held AND in_second) AS shared, count(*) FILTER (in_second AND NOT listed) AS only_second,
count(*) FILTER (in_second AND NOT listed AND first_seen > al.slot) AS seen_later, count(*) FILTER (in_second AND listed AND NOT held) AS listed_not_held, count(*) FILTER (held AND NOT in_second) AS only_first FROM al LEFT JOIN j2 USING (version) GROUP BY ALL"""


def two_sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(slot, entity, held) of the roster and (version, entity) of a second source whose versions come later.

    A fixture: the second source is made of the same events, without views and every tenth user."""
    r = view(spark, d, "roster")
    held = (F.col("owner") != "") & (F.col("end_date").isNull() | (F.col("end_date") > F.col("slot").cast("date")))
    a = r.groupBy("slot", "entity").agg(F.bool_or(F.coalesce(held, F.lit(False))).alias("held"))
    ts = F.col("ts").cast("timestamp")
    at = F.timestamp_micros((F.floor(F.unix_seconds(ts) / 21600) * 21600 + F.when(F.day(ts) % 5 == 0, 7500).otherwise(1200)) * 1_000_000)
    return a, table(spark, d, "events").where("event_type <> 'view' and user_id % 10 <> 0").select(at.alias("version"), F.col("user_id").alias("entity")).distinct()


def version_sets(first: DataFrame, second: DataFrame, seconds: int = 1800) -> DataFrame:
    """Each version of the second source with the snapshot of the first that is nearest within a bound: how many
    entities are listed, held, in the second source, in both, and in one only; versions without a snapshot stay."""
    slots = first.select("slot").distinct()
    al = joins.nearest(second.select("version").distinct(), slots, "version", "slot", seconds).select("version", "slot")
    x = al.where("slot is not null").join(first, "slot").select("version", "entity", "held", F.lit(True).alias("listed"))
    y = second.join(al.where("slot is not null").select("version"), "version").withColumn("in_second", F.lit(True))
    seen = first.groupBy("entity").agg(F.min("slot").alias("first_seen"))
    j = x.join(y, ["version", "entity"], "full_outer").join(seen, "entity", "left").join(al, "version", "right")
    is_ = lambda c: F.coalesce(F.col(c), F.lit(False))
    listed, held, second_ = is_("listed"), is_("held"), is_("in_second")
    counts = {"listed": listed, "held": held, "second": second_, "shared": held & second_, "only_second": second_ & ~listed, "seen_later": second_ & ~listed & (F.col("first_seen") > F.col("slot")), "listed_not_held": second_ & listed & ~held, "only_first": held & ~second_}
    return j.groupBy("version", "slot").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


@query(duck("roster", R4))
def r4_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    return version_sets(*two_sources(spark, d)).select(secs("version"), secs("slot"), "listed", "held", "second", "shared", "only_second", "seen_later", "listed_not_held", "only_first")


# charge rows of a second source and records of the first, made of events: shifted and unknown entities, dates that
# agree, differ or lack, cases of all relations
CHARGES = """SELECT {at} AS version, CASE WHEN event_id % 29 = 0 THEN 100000 + user_id WHEN event_id % 13 = 0 THEN user_id + 1 ELSE user_id END AS entity, concat('K', CAST(user_id * 7 + event_id % 4 AS {text})) AS case_no,
CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) - CAST(user_id % 40 + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INT) END AS book_date, value > 60 AS hold, CASE WHEN event_id % 3 <> 0 THEN CAST(ts AS DATE) + CAST(user_id % 11 AS INT) END AS court_date,
CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END AS authority FROM {events} WHERE event_type <> 'view' AND user_id % 10 <> 0"""
RECORDS = """SELECT user_id AS entity, CASE WHEN user_id % 9 <> 0 THEN d - 1 - CAST(user_id % 40 AS INT) + CAST(CASE user_id % 4 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS INT) END AS start_date,
{cases} AS cases, user_id % 3 = 0 AS hold, CASE WHEN user_id % 7 <> 0 THEN {array}(d - 1 + CAST(user_id % 11 AS INT), d + 10 + CAST(user_id % 2 AS INT)) ELSE {none} END AS hearings,
CASE WHEN user_id % 4 = 0 THEN '' ELSE concat('L', CAST(user_id % 3 AS {text})) END AS location FROM (SELECT user_id, max(max(CAST(ts AS DATE))) OVER () AS d FROM {events} GROUP BY user_id) WHERE user_id % 8 <> 0"""
CASES = "CASE user_id % 5 WHEN 0 THEN {none} WHEN 1 THEN {a}(concat('K', u * 7), concat('K', u * 7 + 1), concat('K', u * 7 + 2), concat('K', u * 7 + 3)) WHEN 2 THEN {a}(concat('K', u * 7)) WHEN 3 THEN {a}(concat('K', u * 7), concat('K', u * 7 + 1), 'X') ELSE {a}('Y') END".replace("u *", "user_id *")
DUCK_AT = "date_trunc('day', ts) + (hour(ts) // 6) * INTERVAL 6 HOUR + CASE WHEN day(ts) % 5 = 0 THEN INTERVAL 125 MINUTE ELSE INTERVAL 20 MINUTE END"
SPARK_AT = "timestamp_seconds(floor(unix_seconds(ts) / 21600) * 21600 + CASE WHEN day(ts) % 5 = 0 THEN 7500 ELSE 1200 END)"
#: Zone of the product's local days.
ZONE = "America/Chicago"
R4_FULL = f""", a AS (SELECT slot, entity, max(CASE WHEN owner <> '' AND (end_date IS NULL OR end_date > CAST(slot AS DATE)) THEN 1 ELSE 0 END) = 1 AS held FROM roster GROUP BY 1, 2),
b AS ({CHARGES.format(at=DUCK_AT, text="VARCHAR", events="events")}), rec AS ({RECORDS.format(cases=CASES.format(a="list_value", none="CAST([] AS VARCHAR[])"), array="list_value", none="CAST([] AS DATE[])", text="VARCHAR", events="events")}),
al AS (SELECT version, arg_min(slot, abs(epoch(slot) - epoch(version))) AS slot FROM (SELECT DISTINCT version FROM b) v LEFT JOIN (SELECT DISTINCT slot FROM roster) s ON abs(epoch(slot) - epoch(version)) <= 1800 GROUP BY 1),
fs AS (SELECT entity, min(slot) AS first_seen FROM roster GROUP BY 1), x AS (SELECT version, entity, held FROM al JOIN a USING (slot)), y AS (SELECT DISTINCT version, entity FROM b JOIN al USING (version) WHERE slot IS NOT NULL),
sets AS (SELECT j.version, al.slot, j.entity, x.held IS NOT NULL AS listed, coalesce(x.held, false) AS held, y.entity IS NOT NULL AS in_second, first_seen FROM (SELECT version, entity FROM x UNION SELECT version, entity FROM y) j LEFT JOIN x USING (version, entity) LEFT JOIN y USING (version, entity) JOIN al ON al.version = j.version LEFT JOIN fs ON fs.entity = j.entity),
counts AS (SELECT version, count_if(in_second) AS second, count_if(held) AS held, count_if(listed) AS listed, count_if(in_second AND held) AS shared, count_if(in_second AND NOT listed) AS only_second, count_if(in_second AND NOT listed AND first_seen <= slot) AS only_second_seen_before,
count_if(in_second AND listed AND NOT held) AS second_listed_ended, count_if(held AND NOT in_second) AS only_first, count_if(held AND NOT in_second AND epoch(first_seen) >= epoch(version) - 25000) AS only_first_recent FROM sets GROUP BY 1),
top AS (SELECT max(version) AS version FROM al WHERE slot IS NOT NULL), now AS (SELECT sets.* FROM sets JOIN top USING (version)), r AS (SELECT b.* FROM b JOIN top USING (version)),
days AS (SELECT CAST(CAST((version AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS DATE) AS VARCHAR) AS day, count(*) AS versions, {", ".join(f"median({c}) AS {c}" for c in two.BY_DAY)} FROM counts GROUP BY 1),
s AS (SELECT entity, list(DISTINCT book_date) FILTER (book_date IS NOT NULL) AS bd, list(DISTINCT case_no) FILTER (case_no <> '') AS a, bool_or(coalesce(hold, false)) AS hold, min(court_date) AS court FROM r WHERE entity IN (SELECT entity FROM now WHERE held AND in_second) GROUP BY 1),
g AS (SELECT s.*, rec.start_date, rec.cases AS b, coalesce(rec.hold, false) AS own, list_min(rec.hearings) AS heard, rec.entity IS NOT NULL AS known FROM s LEFT JOIN rec USING (entity)),
f AS (SELECT CASE WHEN NOT known THEN 'no record' WHEN bd IS NULL OR start_date IS NULL THEN 'date missing on one side' WHEN len(bd) > 1 THEN 'several dates' WHEN bd[1] = start_date THEN 'same date' WHEN bd[1] > start_date THEN 'second later' ELSE 'second earlier' END AS book_date,
CASE WHEN NOT known THEN 'no record' ELSE {REL} END AS cases, CASE WHEN NOT known THEN 'no record' WHEN hold AND own THEN 'both' WHEN hold THEN 'only second' WHEN own THEN 'only first' ELSE 'neither' END AS hold,
CASE WHEN NOT known THEN 'no record' WHEN court IS NULL AND heard IS NULL THEN 'neither lists a date' WHEN court IS NULL OR heard IS NULL THEN 'only one lists a date' WHEN court = heard THEN 'same earliest date' ELSE 'other earliest date' END AS court FROM g),
lone AS (SELECT * FROM r WHERE entity IN (SELECT entity FROM now WHERE in_second AND NOT listed)), mode AS (SELECT entity, authority FROM (SELECT entity, CASE WHEN trim(authority) = '' THEN 'not listed' ELSE trim(authority) END AS authority, count(*) AS n FROM lone GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY n DESC, authority) = 1),
traits AS (SELECT entity, date_diff('day', min(book_date), CAST((max(version) AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS DATE)) AS days, bool_or(coalesce(hold, false)) AS hold FROM lone GROUP BY 1),
t AS (SELECT authority, CASE WHEN days IS NULL THEN 'date missing' WHEN days <= 1 THEN '1 day or less' WHEN days <= 7 THEN '2-7 days' WHEN days <= 30 THEN '8-30 days' WHEN days <= 365 THEN '31-365 days' ELSE 'more than a year' END AS age, CASE WHEN hold THEN 'hold' ELSE 'no hold' END AS hold FROM traits JOIN mode USING (entity)),
loc AS (SELECT CASE WHEN rec.entity IS NULL THEN 'no record' ELSE coalesce(nullif(location, ''), 'not listed') END AS location FROM now LEFT JOIN rec ON rec.entity = now.entity WHERE held AND NOT in_second),
v AS (SELECT count(*) AS versions, count(slot) AS aligned, count(*) - count(slot) AS unaligned FROM al), last AS (SELECT counts.* FROM counts JOIN top USING (version))
SELECT part, section, label, CAST(value AS DOUBLE) AS value FROM (
{" UNION ALL ".join(f"SELECT 'versions' AS part, 'all' AS section, '{c}' AS label, {c} AS value FROM v" for c in ("versions", "aligned", "unaligned"))}
UNION ALL {" UNION ALL ".join(f"SELECT 'latest', 'all', '{c.replace('_', ' ')}', {c} FROM last" for c in (*two.BY_DAY, "listed", "only_second_seen_before", "only_first_recent"))}
UNION ALL {" UNION ALL ".join(f"SELECT 'by day', day, '{c.replace('_', ' ')}', {c} FROM days" for c in ("versions", *two.BY_DAY))}
UNION ALL {" UNION ALL ".join(f"SELECT 'field agreement', '{c.replace('_', ' ')}', {c}, count(*) FROM f GROUP BY {c}" for c in ("book_date", "cases", "hold", "court"))}
UNION ALL {" UNION ALL ".join(f"SELECT 'second only', '{c}', {c}, count(*) FROM t GROUP BY {c}" for c in ("authority", "age", "hold"))}
UNION ALL SELECT 'first only', 'location', location, count(*) FROM loc GROUP BY location)"""


@query(duck("roster", R4_FULL))
def r4_reconciliation_product(spark: SparkSession, d: str) -> DataFrame:
    """Counts, medians by day, agreement of fields and traits of what one source lists only, in one long table."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    second = spark.sql(CHARGES.format(at=SPARK_AT, text="STRING", events="{e}"), e=e)
    cases = CASES.format(a="array", none="CAST(array() AS ARRAY<STRING>)")
    records = spark.sql(RECORDS.format(cases=cases, array="array", none="CAST(array() AS ARRAY<DATE>)", text="STRING", events="{e}"), e=e)
    return two.reconciliation(two_sources(spark, d)[0], second, records, ZONE, 1800, 25_000)

"""Entities with owners, start and end dates and outcomes: changes of amounts (C), re-entry and visits (C, J, A), stays (K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.scalars import band
from ..operators import events, joins, survival
from ..sources.shared import stored
from ..sources.views import duck, table, view
from .registry import query, secs, text

SNAP, START = "1998-08-15", "1992-06-01"
D, S = f"DATE '{SNAP}'", f"DATE '{START}'"


def bookings(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "bookings")


def snap():
    return F.lit(SNAP).cast("date")


# --- changes of amounts

AMOUNT = "CASE WHEN (entity + day(seen_at)) % 7 = 0 THEN 0 ELSE amount END"
CHANGES = f""", pv AS (SELECT entity, seen_at, {AMOUNT} AS am, amount_types AS k, lag({AMOUNT}) OVER w AS pa, lag(amount_types) OVER w AS pk FROM details WHERE status <> 'some' WINDOW w AS (PARTITION BY entity ORDER BY seen_at)),
changes AS (SELECT * FROM (SELECT entity, seen_at, CASE WHEN list_contains(k, 'A') AND NOT list_contains(pk, 'A') THEN 'newly assessed' WHEN list_contains(k, 'R') AND NOT list_contains(pk, 'R') THEN 'recognizance entered'
WHEN pa > 0 AND am > 0 AND am < pa THEN 'reduced' WHEN pa > 0 AND am > 0 AND am > pa THEN 'increased' WHEN pa > 0 AND am = 0 THEN 'cleared' END AS kind, pa AS before, am AS after FROM pv WHERE pk IS NOT NULL) WHERE kind IS NOT NULL),
firsts AS (SELECT entity, kind, min(seen_at) AS seen_at, arg_min(before, seen_at) AS before, arg_min(after, seen_at) AS after FROM changes GROUP BY 1, 2)"""
FOLLOW = CHANGES + f""", fu AS (SELECT f.*, coalesce(end_date <= {D}, false) AS event, date_diff('day', CAST(seen_at AS DATE), CASE WHEN end_date <= {D} THEN end_date WHEN outcome = 'disappeared' THEN CAST(last_seen AS DATE) ELSE {D} END) AS days FROM firsts f JOIN bookings USING (entity)),
follow AS (SELECT *, CASE WHEN days >= 0 THEN days END AS duration FROM fu)"""
KM = """, {t}_c AS (SELECT {k}, duration AS time, count_if(event) AS events, count_if(NOT event) AS censored FROM {t} WHERE duration >= 0 GROUP BY ALL), {t}_r AS (SELECT *, sum(events + censored) OVER (PARTITION BY {k} ORDER BY time DESC) AS at_risk FROM {t}_c),
{t}_km AS (SELECT *, product(1 - events / at_risk) OVER (PARTITION BY {k} ORDER BY time) AS survival FROM {t}_r)"""
SUMMED = "CAST(sum(events + censored) AS BIGINT) AS n, CAST(sum(events) AS BIGINT) AS events, CAST(min(CASE WHEN survival <= 0.5 + 1e-12 THEN time END) AS INT) AS median"


def changes(spark: SparkSession, d: str) -> DataFrame:
    cleared = (F.col("entity") + F.day("seen_at")) % 7 == 0
    v = view(spark, d, "details").withColumn("amount", F.when(cleared, 0).otherwise(F.col("amount")))
    return events.classified_changes(v, F.col("status") != "some", "amount", "amount_types", "A", "R")


def followed(spark: SparkSession, d: str) -> DataFrame:
    """First changes of each kind, followed to the entity's end; a disappeared entity is censored when last seen."""
    b = bookings(spark, d).select("entity", "end_date", "outcome", F.col("last_seen").cast("date").alias("last_day"))
    return events.follow_up(events.first_of_kind(changes(spark, d)), b, snap(), gone=F.col("outcome") == "disappeared", last_day=F.col("last_day"))


@query(duck("details", CHANGES + " SELECT entity, CAST(epoch(seen_at) AS BIGINT) AS seen_at, kind, before, after FROM changes"))
def c1_classified_changes(spark: SparkSession, d: str) -> DataFrame:
    return changes(spark, d).select("entity", secs("seen_at"), "kind", "before", "after")


@query(duck("details", CHANGES + " SELECT entity, CAST(epoch(seen_at) AS BIGINT) AS seen_at, kind, before, after FROM firsts"))
def c2_first_of_kind(spark: SparkSession, d: str) -> DataFrame:
    return events.first_of_kind(changes(spark, d)).select("entity", secs("seen_at"), "kind", "before", "after")


@query(duck("details bookings", FOLLOW + " SELECT entity, kind, event, CAST(duration AS INT) AS duration FROM follow"))
def c3_follow_up(spark: SparkSession, d: str) -> DataFrame:
    return followed(spark, d).select("entity", "kind", "event", "duration")


C4 = FOLLOW + KM.format(t="follow", k="kind") + f""", s AS (SELECT kind, {SUMMED} FROM follow_km GROUP BY 1), g AS (SELECT kind, count(*) AS entities, count_if(duration IS NULL) AS seen_after_end, list_sort(list(1 - after / before) FILTER (kind = 'reduced')) AS cut FROM follow GROUP BY 1)
SELECT g.kind, entities, seen_after_end, n, events, median, round(cut[len(cut) // 2 + 1], 6) AS median_cut FROM g LEFT JOIN s USING (kind)"""


@query(duck("details bookings", C4))
def c4_event_study(spark: SparkSession, d: str) -> DataFrame:
    """After the first change of each kind: entities, changes seen after the end, survival, and by how much the amount is
    reduced (the upper median)."""
    f = followed(spark, d)
    share = F.when(F.col("kind") == "reduced", 1 - F.col("after") / F.col("before"))
    g = f.withColumn("cut", share).groupBy("kind").agg(F.count("*").alias("entities"), F.count_if(F.col("duration").isNull()).alias("seen_after_end"), F.round(stats.high_median("cut"), 6).alias("median_cut"))
    s = survival.group_summary(f, ["kind"]).select("kind", "n", "events", "median")
    return g.join(s, "kind", "left").select("kind", "entities", "seen_after_end", "n", "events", "median", "median_cut")


# --- owners and visits

OWNED = ", bad AS (SELECT DISTINCT unnest(owners) AS owner FROM bookings WHERE len(owners) <> 1), v AS (SELECT *, owners[1] AS owner FROM bookings WHERE len(owners) = 1 AND owners[1] NOT IN (SELECT owner FROM bad))"
NEXT = OWNED + ", nx AS (SELECT a.entity, min(b.first_seen) AS nxt FROM v a JOIN v b ON a.owner = b.owner AND a.entity <> b.entity AND CAST(b.first_seen AS DATE) >= a.end_date AND b.first_seen > a.first_seen GROUP BY 1)"


def owned(spark: SparkSession, d: str) -> DataFrame:
    return events.unconflicted(bookings(spark, d))


def next_visits(spark: SparkSession, d: str) -> DataFrame:
    tasks = joins.tasks_for(table(spark, d, "orders"))  # all visits, of which the table's footers tell the number
    return joins.next_event(owned(spark, d), "owner", "entity", "first_seen", "end_date", tasks=tasks)


@query(duck("bookings", NEXT + " SELECT v.entity, owner, CAST(end_date AS VARCHAR) AS end_date, CAST(epoch(nxt) AS BIGINT) AS next_seen FROM v JOIN nx USING (entity)"))
def j16_next_event(spark: SparkSession, d: str) -> DataFrame:
    n = next_visits(spark, d).where("next_seen is not null")
    return n.select("entity", "owner", text("end_date"), secs("next_seen"))


C11 = NEXT + f""", e AS (SELECT * FROM bookings WHERE end_date BETWEEN {S} AND {D}), x AS (SELECT nxt IS NOT NULL AS event, date_diff('day', end_date, coalesce(CAST(nxt AS DATE), {D})) AS duration, 1 AS g FROM e JOIN v USING (entity, end_date) LEFT JOIN nx USING (entity))
""" + KM.format(t="x", k="g") + """, days AS (SELECT unnest([7, 30, 60, 90]) AS day), longest AS (SELECT max(time) AS m FROM x_km)
SELECT day, CASE WHEN day <= max(m) THEN round(coalesce(arg_max(survival, time) FILTER (time <= day), 1.0), 6) END AS survival, (SELECT count(*) FROM e) AS released, (SELECT count(*) FROM e) - (SELECT count(*) FROM x) AS excluded, (SELECT count_if(event AND duration = 0) FROM x) AS same_day FROM x_km, days, longest GROUP BY day"""


@query(duck("bookings", C11))
def c11_re_entry(spark: SparkSession, d: str) -> DataFrame:
    """From an end within coverage to the owner's next first sight, censored at the snapshot. Visits without an owner or
    of a conflicted one are counted as excluded."""
    e = bookings(spark, d).where(F.col("end_date").between(F.lit(START).cast("date"), snap()))
    nxt = next_visits(spark, d)
    x = nxt.where(F.col("end_date").between(F.lit(START).cast("date"), snap()))
    x = x.select(F.lit(1).alias("g"), F.col("next_seen").isNotNull().alias("event"), F.datediff(F.coalesce(F.col("next_seen").cast("date"), snap()), "end_date").alias("duration"))
    at = survival.survival_at(survival.kaplan_meier(x, ["g"]), ["g"], (7, 30, 60, 90)).select("day", F.round("survival", 6).alias("survival"))
    counts = x.agg(F.count("*").alias("n"), F.count_if(F.col("event") & (F.col("duration") == 0)).alias("same_day")).crossJoin(e.agg(F.count("*").alias("released")))
    return at.crossJoin(counts).select("day", "survival", "released", (F.col("released") - F.col("n")).alias("excluded"), "same_day")


GAPS = OWNED + """, gg AS (SELECT *, bool_or(start_date IS NULL) OVER (PARTITION BY owner) AS void, lag(end_date) OVER w AS pe, lag(start_date) OVER w AS ps, row_number() OVER w AS r FROM v WINDOW w AS (PARTITION BY owner ORDER BY start_date NULLS FIRST, entity)),
gaps AS (SELECT owner, entity, CASE WHEN void OR pe IS NULL THEN 'missing' WHEN ps >= start_date OR pe < ps OR pe > start_date THEN 'invalid' ELSE 'measured' END AS kind, date_diff('day', pe, start_date) AS apart FROM gg WHERE r > 1)"""
GAP_BINS = [(7, "0-7"), (30, "8-30"), (90, "31-90"), (180, "91-180"), (365, "181-365"), (None, "over 365")]


@query(duck("bookings", GAPS + " SELECT owner, entity, kind, CAST(CASE WHEN kind = 'measured' THEN apart END AS INT) AS days FROM gaps"))
def c12_visit_gaps(spark: SparkSession, d: str) -> DataFrame:
    return events.visit_gaps(owned(spark, d))


CASE = "CASE " + " ".join(f"WHEN apart <= {h} THEN '{x}'" if h else f"ELSE '{x}' END" for h, x in GAP_BINS)


@query(duck("bookings", GAPS + f", b AS (SELECT {CASE} AS label FROM gaps WHERE kind = 'measured') SELECT CAST(i - 1 AS INT) AS ord, o.label, count(b.label) AS n FROM (SELECT unnest({[x for _, x in GAP_BINS]}) AS label, generate_subscripts({[x for _, x in GAP_BINS]}, 1) AS i) o LEFT JOIN b ON b.label = o.label GROUP BY 1, 2"))
def c13_gap_histogram(spark: SparkSession, d: str) -> DataFrame:
    g = events.visit_gaps(owned(spark, d)).where("days is not null")
    return stats.label_counts(g, band(F.col("days"), GAP_BINS), [x for _, x in GAP_BINS])


A18 = OWNED + """, c AS (SELECT owner, count(*) AS n FROM v GROUP BY 1) SELECT count(*) AS people, count_if(n = 1) AS once, count_if(n = 2) AS twice, count_if(n = 3) AS three, count_if(n = 4) AS four, count_if(n >= 5) AS five_plus, max(n) AS most,
count_if(n > 1) AS repeat_people, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS repeat_visits, CAST(sum(n - 1) AS BIGINT) AS additional, (SELECT count(*) FROM bookings WHERE len(owners) > 0) - (SELECT count(*) FROM v) AS excluded FROM c"""


@query(duck("bookings", A18))
def a18_visit_frequency(spark: SparkSession, d: str) -> DataFrame:
    """How often owners come back; visits of conflicted owners are counted as excluded."""
    n = F.col("n")
    c = owned(spark, d).groupBy("owner").agg(F.count("*").alias("n"))
    is_n = [F.count_if(n == k).alias(name) for k, name in ((1, "once"), (2, "twice"), (3, "three"), (4, "four"))]
    out = c.agg(F.count("*").alias("people"), *is_n, F.count_if(n >= 5).alias("five_plus"), F.max("n").alias("most"), F.count_if(n > 1).alias("repeat_people"), F.sum(F.when(n > 1, n).otherwise(0)).alias("repeat_visits"), F.sum(n - 1).alias("additional"), F.sum("n").alias("_all"))
    named = bookings(spark, d).agg(F.count_if(F.size("owners") > 0).alias("_named"))
    return out.crossJoin(named).withColumn("excluded", F.col("_named") - F.col("_all")).drop("_all", "_named")


# --- stays

BUILT = f""", o AS (SELECT *, coalesce(start_date, CAST(first_seen AS DATE)) AS origin, CASE WHEN end_date <= {D} THEN end_date WHEN outcome = 'disappeared' THEN CAST(last_seen AS DATE) ELSE {D} END AS until, coalesce(end_date <= {D}, false) AS event FROM bookings),
b AS (SELECT *, CASE WHEN origin < CAST(first_seen AS DATE) - 7 THEN 'start too early' WHEN origin > CAST(first_seen AS DATE) THEN 'start after first seen' WHEN until < origin THEN 'end before origin' END AS reason FROM o),
built AS (SELECT *, CASE WHEN reason IS NULL THEN date_diff('day', origin, until) END AS duration FROM b), cohort AS (SELECT * FROM built WHERE NOT left_truncated)"""


def built(spark: SparkSession, d: str) -> DataFrame:
    seen = F.col("first_seen").cast("date")
    return survival.build_stays(bookings(spark, d), F.col("start_date"), seen, F.col("end_date"), snap(), gone=F.col("outcome") == "disappeared", last_seen=F.col("last_seen").cast("date"))


def cohort(spark: SparkSession, d: str) -> DataFrame:
    """Entities first seen after coverage began."""
    return built(spark, d).where("not left_truncated")


@query(duck("bookings", BUILT + " SELECT entity, CAST(origin AS VARCHAR) AS origin, start_date IS NOT NULL AS from_start, reason, CAST(duration AS INT) AS duration, event FROM built"))
def k8_stays(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d).select("entity", text("origin"), "from_start", "reason", "duration", "event")


K11 = BUILT + """, j AS (SELECT b.*, o_orderpriority AS priority, o_orderstatus AS status FROM cohort b JOIN orders ON o_orderkey = entity WHERE duration IS NOT NULL),
st AS (SELECT 'all' AS dimension, 'all' AS label, duration, event FROM j UNION ALL SELECT 'priority', priority, duration, event FROM j UNION ALL SELECT 'status', status, duration, event FROM j)""" + KM.format(t="st", k="dimension, label") + f" SELECT dimension, label, {SUMMED}, CAST(max(time) AS INT) AS longest FROM st_km GROUP BY 1, 2"


@query(duck("bookings", K11))
def k11_cohort(spark: SparkSession, d: str) -> DataFrame:
    """Stays that aren't left out, overall and by two groupings, in one pass."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("entity"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    s = cohort(spark, d).where("duration is not null").join(o, "entity")
    out = survival.group_summary(survival.stacked_groups(s, ["priority", "status"]), ["dimension", "label"])
    return out.select("dimension", "label", "n", "events", "longest", "median")


@query(duck("bookings", BUILT + " SELECT 'excluded' AS section, reason AS label, count(*) AS n FROM cohort WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT 'origin', CASE WHEN start_date IS NULL THEN 'first_seen' ELSE 'start' END, count(*) FROM cohort WHERE reason IS NULL GROUP BY ALL"))
def k11_cohort_counts(spark: SparkSession, d: str) -> DataFrame:
    """Why entities are left out of the cohort, and where the others' stays begin."""
    out = F.col("reason").isNotNull()
    label = F.when(out, F.col("reason")).when(F.col("from_start"), "start").otherwise("first_seen")
    return cohort(spark, d).groupBy(F.when(out, "excluded").otherwise("origin").alias("section"), label.alias("label")).agg(F.count("*").alias("n"))


K12 = BUILT + """, h AS (SELECT list_sort(list((epoch(last_seen) - epoch(end_listed_at)) / 3600)) AS hours FROM bookings WHERE outcome = 'released' AND end_listed_at IS NOT NULL AND NOT on_latest)
SELECT count_if(end_listed_at = first_seen) AS ended_when_seen, count_if(event AND duration = 0) AS same_day, any_value(len(hours)) AS listed_after, any_value(hours[len(hours) // 2 + 1]) AS median_hours, any_value(hours[1]) AS shortest_hours, any_value(hours[len(hours) // 10 + 1]) AS tenth_hours FROM cohort, h WHERE reason IS NULL"""


@query(duck("bookings", K12))
def k12_short_stays(spark: SparkSession, d: str) -> DataFrame:
    """Stays that fell between two snapshots, and how long ended entities stay listed."""
    c = cohort(spark, d).where("reason is null").agg(F.count_if(F.col("end_listed_at") == F.col("first_seen")).alias("ended_when_seen"), F.count_if(F.col("event") & (F.col("duration") == 0)).alias("same_day"))
    h = bookings(spark, d).where("outcome = 'released' and end_listed_at is not null and not on_latest").select(((F.unix_seconds("last_seen") - F.unix_seconds("end_listed_at")) / 3600).alias("hours"))
    q = stats.index_quantiles(h, [], "hours", (0.0, 0.1, 0.5))
    named = [F.max(F.when(F.col("share") == s, F.col("value"))).alias(name) for s, name in ((0.5, "median_hours"), (0.0, "shortest_hours"), (0.1, "tenth_hours"))]
    return c.crossJoin(h.agg(F.count("*").alias("listed_after"))).crossJoin(q.agg(*named))


K13 = BUILT + """, st AS (SELECT entity, min(seen_at) FILTER (status <> 'some') AS entered, min(seen_at) FILTER (status = 'all') AS decided FROM details GROUP BY 1), c AS (SELECT c.entity, first_seen, entered, decided FROM cohort c LEFT JOIN st USING (entity) WHERE reason IS NULL),
u AS (SELECT 'entered' AS stage, (epoch(entered) - epoch(first_seen)) / 3600 AS hours FROM c UNION ALL SELECT 'decided', (epoch(decided) - epoch(first_seen)) / 3600 FROM c),
l AS (SELECT stage, count(*) AS n, list_sort(list(hours) FILTER (hours IS NOT NULL)) AS hs FROM u GROUP BY 1) SELECT stage, CAST(len(hs) AS BIGINT) AS reached, CAST(n - len(hs) AS BIGINT) AS not_reached, hs[len(hs) // 2 + 1] AS median_hours, hs[CAST(floor(len(hs) * 0.9) AS BIGINT) + 1] AS ninetieth_hours FROM l"""


@query(duck("details bookings", K13))
def k13_record_completion(spark: SparkSession, d: str) -> DataFrame:
    """Hours from first sight to a first complete and a first decided version; entities that never get there are counted."""
    done = lambda status: F.min(F.when(status, F.col("seen_at")))
    st = view(spark, d, "details").groupBy("entity").agg(done(F.col("status") != "some").alias("entered"), done(F.col("status") == "all").alias("decided"))
    c = cohort(spark, d).where("reason is null").select("entity", "first_seen").join(st, "entity", "left")
    hours = lambda name: (F.unix_seconds(name) - F.unix_seconds("first_seen")) / 3600
    u = c.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), hours(s).alias("hours")) for s in ("entered", "decided")])).alias("x")).select("x.*")
    n = u.groupBy("stage").agg(F.count("hours").alias("reached"), F.count_if(F.col("hours").isNull()).alias("not_reached"))
    q = stats.index_quantiles(u, ["stage"], "hours", (0.5, 0.9)).groupBy("stage").agg(F.max(F.when(F.col("share") == 0.5, F.col("value"))).alias("median_hours"), F.max(F.when(F.col("share") == 0.9, F.col("value"))).alias("ninetieth_hours"))
    return n.join(q, "stage", "left")


# --- timing of linked events

C9 = f""", ind AS (SELECT case_no, min(event_date) AS day FROM reports WHERE family = 'indictments' GROUP BY 1), cs AS (SELECT l_orderkey AS entity, CAST(l_partkey AS VARCHAR) AS case_no, bool_or(l_linestatus = 'O') AS open, bool_and(l_linestatus = 'F' AND l_returnflag = 'R') AS sentenced FROM lineitem GROUP BY 1, 2),
lc AS (SELECT entity, arg_max(status, seen_at) AS last_status FROM details WHERE status <> 'some' GROUP BY 1),
e AS (SELECT entity, min(day) AS day, bool_or(open) AS open, bool_and(sentenced) AS sentenced FROM cs JOIN ind USING (case_no) GROUP BY 1),
t AS (SELECT date_diff('day', start_date, day) AS days, CASE WHEN left_truncated THEN 'present at start' ELSE 'new' END AS grp, CASE WHEN open THEN 'open' WHEN sentenced THEN 'sentenced' ELSE 'other' END AS st, last_status FROM bookings JOIN e USING (entity) LEFT JOIN lc USING (entity) WHERE start_date IS NOT NULL),
tl AS (SELECT 'during stay' AS section, grp AS label, days FROM t WHERE days >= 0 UNION ALL SELECT 'during stay, case open', grp, days FROM t WHERE days >= 0 AND st = 'open' UNION ALL SELECT 'before start', grp, NULL FROM t WHERE days < 0
UNION ALL SELECT 'case status', st, NULL FROM t UNION ALL SELECT 'none decided', grp, NULL FROM t WHERE last_status = 'none'), ll AS (SELECT section, label, count(*) AS n, list_sort(list(days) FILTER (days IS NOT NULL)) AS ds FROM tl GROUP BY 1, 2),
timing AS (SELECT section, label, n, ds[len(ds) // 4 + 1] AS q1, ds[len(ds) // 2 + 1] AS median, ds[3 * len(ds) // 4 + 1] AS q3 FROM ll)"""


def details_by_entity(spark: SparkSession, d: str, tasks: int) -> DataFrame:
    """The details, dealt by entity before rows are grouped, so that what is grouped or put in order by entity later on
    stays where it is."""
    return view(spark, d, "details", lineitem=table(spark, d, "lineitem").repartition(tasks, "l_orderkey"))


def event_timing(spark: SparkSession, d: str) -> DataFrame:
    """(section, label, n, q1, median, q3): from the start to the earliest linked event, for entities that are new and
    those present at the start, and for those with the linked case open; what comes before the start, the linked
    cases' status classes and entities with nothing decided are counted.

    Rows of lineitem are dealt once by case and once by entity; what is counted of them, one row per label and number of
    days, is stored, as counts and quantiles both read it."""
    li = table(spark, d, "lineitem")
    tasks = joins.tasks_for(li)
    first = view(spark, d, "reports").where("family = 'indictments'").groupBy("case_no").agg(F.min("event_date").alias("day"))
    case = li.select(F.col("l_orderkey").alias("entity"), F.col("l_partkey").cast("string").alias("case_no"), (F.col("l_linestatus") == "O").alias("open"), ((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")).alias("sentenced"))
    e = case.repartition(tasks, "case_no").join(first.hint("shuffle_hash"), "case_no").select("entity", "day", "open", "sentenced").repartition(tasks, "entity")
    e = e.groupBy("entity").agg(F.min("day").alias("day"), F.bool_or("open").alias("open"), F.bool_and("sentenced").alias("sentenced"))
    last = details_by_entity(spark, d, tasks).where("status <> 'some'").groupBy("entity").agg(F.max_by("status", "seen_at").alias("last_status"))
    t = bookings(spark, d).where("start_date is not null").join(e, "entity").join(last, "entity", "left").withColumn("days", F.datediff("day", "start_date"))
    grp = F.when(F.col("left_truncated"), "present at start").otherwise("new")
    status = F.when(F.col("open"), "open").when(F.col("sentenced"), "sentenced").otherwise("other")
    row = lambda where, section, label, days: F.when(where, F.struct(F.lit(section).alias("section"), label.alias("label"), days.alias("days")))
    none, days = F.lit(None).cast("int"), F.col("days")
    rows = F.array(row(days >= 0, "during stay", grp, days), row((days >= 0) & F.col("open"), "during stay, case open", grp, days), row(days < 0, "before start", grp, none), row(F.lit(True), "case status", status, none), row(F.col("last_status") == "none", "none decided", grp, none))
    u = t.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select("x.*")
    u = stored(u.groupBy("section", "label", "days").agg(F.count("*").alias("n")), "timing")
    q = stats.index_quantiles(u, ["section", "label"], "days", (0.25, 0.5, 0.75), times="n").groupBy("section", "label").agg(*[F.max(F.when(F.col("share") == s, F.col("value"))).alias(name) for s, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    return u.groupBy("section", "label").agg(F.sum("n").alias("n")).join(q, ["section", "label"], "left")


@query(duck("bookings details reports", C9 + " SELECT section, label, n, CAST(q1 AS INT) AS q1, CAST(median AS INT) AS median, CAST(q3 AS INT) AS q3 FROM timing"))
def c9_event_timing(spark: SparkSession, d: str) -> DataFrame:
    return event_timing(spark, d)

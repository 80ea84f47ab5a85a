"""Point metrics (P) and panel (L) over the derived views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import money
from ..operators import panel, points
from ..sources.views import ROSTER_SLOT, duck, table, view
from .registry import query, secs, text

E = "CAST(epoch({}) AS BIGINT)".format
SEQ = ", seq AS (SELECT slot, row_number() OVER (ORDER BY slot) AS seq, lag(slot) OVER (ORDER BY slot) AS before FROM (SELECT DISTINCT slot FROM roster))"
FLOWS = SEQ + """, here AS (SELECT DISTINCT seq, entity FROM roster JOIN seq USING (slot)),
moved AS (SELECT coalesce(a.seq, b.seq + 1) AS seq, count_if(b.entity IS NULL) AS came, count_if(a.entity IS NULL) AS gone FROM here a FULL JOIN here b ON b.seq + 1 = a.seq AND a.entity = b.entity GROUP BY 1),
flows AS (SELECT s.slot, CASE WHEN epoch(s.slot) - epoch(before) = 21600 THEN coalesce(came, 0) END AS arrivals, CASE WHEN epoch(s.slot) - epoch(before) = 21600 THEN coalesce(gone, 0) END AS departures,
CASE WHEN epoch(s.slot) - epoch(before) = 21600 THEN 360.0::DOUBLE END AS comparison_minutes FROM seq s LEFT JOIN moved m ON m.seq = s.seq)"""


def roster(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "roster")


def pts(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "points")


def roster_flows(spark: SparkSession, d: str) -> DataFrame:
    return points.flows(roster(spark, d), ROSTER_SLOT, ROSTER_SLOT)


@query(f"SELECT {E('time_bucket(INTERVAL 15 MINUTE, ts)')} AS slot, count(*) AS n FROM events GROUP BY 1")
def p1_slots(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(points.slot_of(F.col("ts").cast("timestamp")).alias("slot"))
    return e.groupBy("slot").agg(F.count("*").alias("n")).select(secs("slot"), "n")


P2 = """, local AS (SELECT *, CAST((slot AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS DATE) AS day FROM roster),
per AS (SELECT slot, owner, max(CASE WHEN end_date IS NULL OR end_date > day THEN 1 ELSE 0 END) AS active FROM local GROUP BY 1, 2)
SELECT CAST(epoch(slot) AS BIGINT) AS slot, (SELECT count(*) FROM per p WHERE p.slot = r.slot AND owner <> '' AND active = 1) AS population,
(SELECT count(*) FROM per p WHERE p.slot = r.slot AND owner <> '') AS listed_owners, count(*) AS n_rows,
(SELECT count(*) FROM per p WHERE p.slot = r.slot AND owner <> '' AND active = 0) AS seen_not_active, count(DISTINCT entity) AS entities FROM roster r GROUP BY r.slot"""


@query(duck("roster", P2))
def p2_snapshot_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = points.snapshot_metrics(roster(spark, d), "America/Chicago")
    return m.select(secs("slot"), "population", "listed_owners", "n_rows", "seen_not_active", "entities")


@query(duck("second", "SELECT CAST(book_date AS VARCHAR) AS book_date, count(DISTINCT entity) AS entities, count(*) AS n_rows FROM second GROUP BY book_date"))
def p3_second_source_metrics(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "second").groupBy("book_date").agg(F.count_distinct("entity").alias("entities"), F.count("*").alias("n_rows")).select(text("book_date"), "entities", "n_rows")


@query(duck("roster", FLOWS + f" SELECT {E('slot')} AS slot, arrivals, departures, comparison_minutes FROM flows"))
def p4_arrivals_departures(spark: SparkSession, d: str) -> DataFrame:
    return roster_flows(spark, d).select(secs("slot"), "arrivals", "departures", "comparison_minutes")


OBSERVED = f""", o AS (SELECT event_type AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, user_id AS entity, ts FROM events), q AS (SELECT source, slot, min(ts) AS obs, row_number() OVER w AS seq, lag(slot) OVER w AS before, lag(min(ts)) OVER w AS obs_before FROM o GROUP BY 1, 2 WINDOW w AS (PARTITION BY source ORDER BY slot)),
h AS (SELECT DISTINCT source, seq, entity FROM o JOIN q USING (source, slot)), mv AS (SELECT coalesce(a.source, b.source) AS source, coalesce(a.seq, b.seq + 1) AS seq, count_if(b.entity IS NULL) AS came, count_if(a.entity IS NULL) AS gone FROM h a FULL JOIN h b ON a.source = b.source AND b.seq + 1 = a.seq AND a.entity = b.entity GROUP BY 1, 2),
gap AS (SELECT *, epoch(slot) - epoch(before) = 900 AND floor(epoch(obs)) > floor(epoch(obs_before)) AND floor(epoch(obs)) - floor(epoch(obs_before)) <= 1200 AS near FROM q),
moved_on AS (SELECT g.source, g.slot, g.obs, CASE WHEN near THEN coalesce(came, 0) END AS arrivals, CASE WHEN near THEN coalesce(gone, 0) END AS departures, CASE WHEN near THEN round_even((floor(epoch(obs)) - floor(epoch(obs_before))) / 60, 1) END AS comparison_minutes FROM gap g LEFT JOIN mv ON mv.source = g.source AND mv.seq = g.seq)"""


def observed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events as listings of sources at 15-minute slots, with the time of each."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select(F.col("event_type").alias("source"), points.slot_of(ts).alias("slot"), F.col("user_id").alias("entity"), ts.alias("ts"), "value")


@query("WITH e AS (SELECT 1)" + OBSERVED + f" SELECT source, {E('slot')} AS slot, arrivals, departures, comparison_minutes FROM moved_on")
def p4_observed_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Flows by source at 15-minute slots; neighbours whose observations lie over 20 minutes apart aren't compared."""
    return points.flows(observed_rows(spark, d), keys=("source",), observed="ts").select("source", secs("slot"), "arrivals", "departures", "comparison_minutes")


@query(duck("roster", f", f AS (SELECT entity, min(slot) AS slot FROM roster GROUP BY 1) SELECT {E('s.slot')} AS slot, CAST(sum(count(f.entity)) OVER (ORDER BY s.slot) AS BIGINT) AS seen FROM (SELECT DISTINCT slot FROM roster) s LEFT JOIN f ON f.slot = s.slot GROUP BY s.slot"))
def p5_cumulative_seen(spark: SparkSession, d: str) -> DataFrame:
    return points.cumulative_seen(roster(spark, d)).select(secs("slot"), "seen")


MISSING = ", span AS (SELECT source, min(slot) AS a, max(slot) AS z FROM points GROUP BY 1), every AS (SELECT source, unnest(generate_series(a, z, INTERVAL 15 MINUTE)) AS slot FROM span), missing AS (SELECT * FROM every ANTI JOIN points USING (source, slot))"


@query(duck("points", MISSING + f" SELECT source, {E('slot')} AS slot FROM missing"))
def p6_missing_slots(spark: SparkSession, d: str) -> DataFrame:
    return points.missing_slots(pts(spark, d), ["source"]).select("source", secs("slot"))


@query(duck("points", MISSING + " SELECT strftime(slot, '%H:%M') AS time_of_day, count(*) AS n FROM missing GROUP BY 1"))
def p7_missing_by_time(spark: SparkSession, d: str) -> DataFrame:
    return points.missing_slots(pts(spark, d), ["source"]).groupBy(F.date_format("slot", "HH:mm").alias("time_of_day")).agg(F.count("*").alias("n"))


BINS = " UNION ALL ".join(f"SELECT {n} AS width, CAST(floor(epoch(slot) / {n}) * {n} AS BIGINT) AS bin, CAST(sum(arrivals) AS BIGINT) AS arrivals, CAST(sum(departures) AS BIGINT) AS departures FROM flows WHERE arrivals IS NOT NULL GROUP BY 2" for n in (900, 3600, 86400))


@query(duck("roster", FLOWS + " " + BINS))
def p8_change_bins(spark: SparkSession, d: str) -> DataFrame:
    """Three widths of bins from one pass over the slots."""
    f = roster_flows(spark, d)
    out = [points.change_bins(f, n).select(F.lit(n).alias("width"), secs("bin"), "arrivals", "departures") for n in (900, 3600, 86400)]
    return out[0].union(out[1]).union(out[2])


@query(duck("points", f", g AS (SELECT *, epoch(slot) - epoch(lag(slot) OVER (PARTITION BY source ORDER BY slot)) > 900 AS gap FROM points) SELECT source, {E('slot')} AS slot, population FROM g UNION ALL SELECT source, {E('slot')} - 900, NULL FROM g WHERE gap"))
def p9_gap_broken_series(spark: SparkSession, d: str) -> DataFrame:
    return points.gap_broken(pts(spark, d), ["source"], "population").select("source", secs("slot"), "population")


@query(duck("points", f"SELECT {E('date_trunc($$hour$$, slot)')} AS hour, max_by(population, slot) FILTER (source = 'click') AS click, max_by(population, slot) FILTER (source = 'view') AS \"view\", max_by(population, slot) FILTER (source = 'purchase') AS purchase FROM points WHERE source IN ('click', 'view', 'purchase') GROUP BY 1"))
def p10_hourly_alignment(spark: SparkSession, d: str) -> DataFrame:
    p = pts(spark, d).where(F.col("source").isin("click", "view", "purchase"))
    return points.hourly_alignment(p, ["click", "view", "purchase"]).select(secs("hour"), "click", "view", "purchase")


@query(duck("points", f"SELECT source, {E('slot')} AS slot, population FROM points WHERE observed_at >= (SELECT max(observed_at) FROM points) - INTERVAL 7 DAY"))
def p11_view_range(spark: SparkSession, d: str) -> DataFrame:
    p = pts(spark, d)
    latest = F.broadcast(p.agg(F.max("observed_at").alias("now")))
    return points.view_range(p.crossJoin(latest), 5, F.col("now")).select("source", secs("slot"), "population")


@query(duck("points", f"SELECT source, {E('slot')} AS slot, population FROM points QUALIFY row_number() OVER (PARTITION BY source ORDER BY slot DESC) <= 192"))
def p12_last_attempts(spark: SparkSession, d: str) -> DataFrame:
    return points.last_n(pts(spark, d), 192, ["source"]).select("source", secs("slot"), "population")


HEALTH = """, latest AS (SELECT max(observed_at) AS now FROM points), h AS (SELECT source, max(observed_at) AS last, sum(population) % 7 = 0 AS failed, count(*) % 2 = 0 AS complete FROM points GROUP BY 1),
health AS (SELECT source, last, CASE WHEN failed THEN 'failed' WHEN CAST(floor(epoch(now)) AS BIGINT) - CAST(floor(epoch(last)) AS BIGINT) > 1800 THEN 'overdue' WHEN NOT complete THEN 'incomplete' ELSE 'ok' END AS health FROM h, latest)"""


def health(spark: SparkSession, d: str) -> DataFrame:
    p = pts(spark, d)
    h = p.groupBy("source").agg(F.max("observed_at").alias("last"), (F.sum("population") % 7 == 0).alias("failed"), (F.count("*") % 2 == 0).alias("complete"))
    h = h.crossJoin(F.broadcast(p.agg(F.max("observed_at").alias("now"))))
    return h.select("source", "last", points.source_health(F.col("last"), F.col("failed"), F.col("complete"), F.col("now")).alias("health"))


@query(duck("points", HEALTH + " SELECT source, health FROM health"))
def p13_source_health(spark: SparkSession, d: str) -> DataFrame:
    return health(spark, d).select("source", "health")


@query(duck("points", HEALTH + """ SELECT CASE max(CASE health WHEN 'ok' THEN 0 WHEN 'incomplete' THEN 1 WHEN 'overdue' THEN 2 WHEN 'failed' THEN 3 ELSE 4 END) WHEN 0 THEN 'ok' WHEN 1 THEN 'incomplete' WHEN 2 THEN 'overdue' WHEN 3 THEN 'failed' ELSE 'no data' END AS worst,
CAST(floor(epoch(min(last))) AS BIGINT) AS last_success, string_agg(source || ': ' || health, '; ' ORDER BY source) AS detail FROM health"""))
def p14_health_rollup(spark: SparkSession, d: str) -> DataFrame:
    return points.health_rollup(health(spark, d)).select("worst", secs("last_success"), "detail")


@query("SELECT event_type AS product, max(epoch(ts)) >= (SELECT max(epoch(ts)) FROM events) - 3600 AS fresh FROM events GROUP BY 1")
def p15_freshness(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    now = F.broadcast(e.agg(F.max("ts").alias("now")))
    through = e.groupBy(F.col("event_type").alias("product")).agg(F.max("ts").alias("through")).crossJoin(now)
    return through.select("product", (F.unix_micros("through") >= F.unix_micros("now") - 3_600_000_000).alias("fresh"))


P16 = """SELECT l_orderkey AS scan, bool_and(follows) AS contiguous, bool_and(z_line - a_line + 1 = n) AS ranges_fit, sum(n) = max(z_line) AS total_met, sum(n) = count(*) AS no_duplicates
FROM (SELECT l_orderkey, l_linenumber AS a_line, l_linenumber AS z_line, coalesce(lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber), 0) + 1 = l_linenumber AS follows, n FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)) GROUP BY 1"""


@query(P16)
def p16_scan_completeness(spark: SparkSession, d: str) -> DataFrame:
    """An order is a scan and each of its lines a page of one row."""
    pages = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("scan"), F.col("l_linenumber").alias("first")).agg(F.count("*").alias("rows"))
    pages = pages.withColumns({"last": F.col("first"), "distinct": F.lit(1), "total": F.max("first").over(Window.partitionBy("scan"))})
    return points.scan_completeness(pages, "scan", "first", "last", "rows", "total", "distinct")


SPANS = SEQ + """, isl AS (SELECT entity, seq, slot, seq - row_number() OVER (PARTITION BY entity ORDER BY seq) AS g FROM roster JOIN seq USING (slot)),
spans AS (SELECT entity, min(seq) AS start_seq, max(seq) AS end_seq, min(slot) AS span_start, max(slot) AS span_end FROM isl GROUP BY entity, g)"""
ENDS = """, ends AS (SELECT entity, slot AS seen_at, end_date FROM (SELECT *, row_number() OVER w AS rn, lag(end_date) OVER w AS prior FROM roster WINDOW w AS (PARTITION BY entity ORDER BY slot)) WHERE end_date IS DISTINCT FROM prior AND NOT (rn = 1 AND end_date IS NULL))
, last_end AS (SELECT entity, arg_max(coalesce(CAST(end_date AS VARCHAR), ''), seen_at) AS end_text, max(seen_at) AS listed_at FROM ends GROUP BY 1)"""
OWNERS = ", owner_changes AS (SELECT entity, slot AS seen_at, owner FROM (SELECT *, row_number() OVER w AS rn, lag(owner) OVER w AS prior FROM roster WINDOW w AS (PARTITION BY entity ORDER BY slot)) WHERE rn = 1 OR owner IS DISTINCT FROM prior)"
PANEL = SPANS + ENDS + """, cov AS (SELECT min(slot) AS a, max(slot) AS z FROM roster), base AS (SELECT entity, min(slot) AS first_seen, max(slot) AS last_seen FROM roster GROUP BY 1),
cnt AS (SELECT entity, count(*) AS spans FROM spans GROUP BY 1),
panel AS (SELECT b.entity, first_seen, last_seen, spans, spans - 1 AS reappearances, nullif(end_text, '') AS end_date, listed_at, first_seen = a AS left_truncated, last_seen = z AS on_latest,
CASE WHEN try_cast(nullif(end_text, '') AS DATE) <= CAST(z AS DATE) THEN 'released' WHEN last_seen = z THEN 'held' ELSE 'disappeared' END AS outcome
FROM base b JOIN cnt USING (entity) LEFT JOIN last_end USING (entity), cov)"""


@query(duck("roster", f"SELECT entity, {E('min(slot)')} AS first_seen, {E('max(slot)')} AS last_seen, count(*) AS n FROM roster GROUP BY 1"))
def l1_first_last_seen(spark: SparkSession, d: str) -> DataFrame:
    return panel.first_last(roster(spark, d)).select("entity", secs("first_seen"), secs("last_seen"), "n")


@query(duck("roster", SPANS + f" SELECT entity, start_seq, end_seq, {E('span_start')} AS span_start, {E('span_end')} AS span_end FROM spans"))
def l2_presence_spans(spark: SparkSession, d: str) -> DataFrame:
    return panel.presence_spans(roster(spark, d)).select("entity", F.col("start_seq").cast("long").alias("start_seq"), F.col("end_seq").cast("long").alias("end_seq"), secs("span_start"), secs("span_end"))


@query(duck("roster", ENDS + f" SELECT entity, {E('seen_at')} AS seen_at, CAST(end_date AS VARCHAR) AS end_date FROM ends"))
def l4_end_date_history(spark: SparkSession, d: str) -> DataFrame:
    return panel.changes(roster(spark, d), "end_date").select("entity", secs("at", "seen_at"), text("end_date"))


@query(duck("roster", ENDS + f" SELECT entity, nullif(end_text, '') AS end_date, {E('listed_at')} AS listed_at FROM last_end"))
def l5_current_end_date(spark: SparkSession, d: str) -> DataFrame:
    return panel.current_value(panel.changes(roster(spark, d), "end_date"), "end_date").select("entity", text("end_date"), secs("listed_at"))


@query(duck("roster", OWNERS + f" SELECT entity, {E('seen_at')} AS seen_at, owner FROM owner_changes"))
def l6_owner_history(spark: SparkSession, d: str) -> DataFrame:
    return panel.changes(roster(spark, d), "owner", True).select("entity", secs("at", "seen_at"), "owner")


@query(duck("roster", "SELECT entity, coalesce(string_agg(DISTINCT owner, ',' ORDER BY owner) FILTER (owner <> ''), '') AS owners FROM roster GROUP BY 1"))
def l6_owner_sets(spark: SparkSession, d: str) -> DataFrame:
    return panel.owners_of(roster(spark, d)).select("entity", F.array_join("owners", ",").alias("owners"))


@query(duck("roster", PANEL + f" SELECT entity, {E('first_seen')} AS first_seen, {E('last_seen')} AS last_seen, spans, reappearances, end_date, {E('listed_at')} AS listed_at, left_truncated, on_latest, outcome FROM panel"))
def l7_l8_panel(spark: SparkSession, d: str) -> DataFrame:
    """L1 to L8 in one row per entity: spans, reappearances, end date, flags, outcome."""
    return panel.build_panel(roster(spark, d)).select("entity", secs("first_seen"), secs("last_seen"), "spans", "reappearances", text("end_date"), secs("listed_at"), "left_truncated", "on_latest", "outcome")


FACTS = ["amount", "status", "next_date", "n_rows"]
L9 = """SELECT l_orderkey AS entity, CAST(min(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT)) AS VARCHAR) AS next_date, round(sum(l_extendedprice), 2) AS amount,
bool_or(l_returnflag = 'R') AS any_hold, string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) AS cases, count(*) FILTER (l_linestatus = 'O') AS open_items FROM lineitem GROUP BY 1"""


@query(L9)
def l9_nested_facts(spark: SparkSession, d: str) -> DataFrame:
    """Typed facts from a nested record: each order's lines as an array of structs, read by higher-order functions."""
    items = F.collect_list(F.struct("l_partkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus", F.format_string("$%.2f", "l_extendedprice").alias("price")))
    nested = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("entity")).agg(items.alias("items"))
    dates = F.transform("items", lambda x: F.date_add(x["l_shipdate"].cast("date"), x["l_quantity"].cast("int")))
    return nested.select(
        "entity",
        F.array_min(dates).cast("string").alias("next_date"),
        F.round(F.aggregate("items", F.lit(0.0), lambda a, x: a + money(x["price"])), 2).alias("amount"),
        F.exists("items", lambda x: x["l_returnflag"] == "R").alias("any_hold"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("items", lambda x: x["l_partkey"].cast("string")))), ",").alias("cases"),
        F.size(F.filter("items", lambda x: x["l_linestatus"] == "O")).cast("long").alias("open_items"),
    )


NEW = "amount IS DISTINCT FROM lag(amount) OVER w OR status IS DISTINCT FROM lag(status) OVER w OR next_date IS DISTINCT FROM lag(next_date) OVER w OR n_rows IS DISTINCT FROM lag(n_rows) OVER w"


@query(duck("details", f"SELECT entity, {E('seen_at')} AS seen_at, amount, status, CAST(next_date AS VARCHAR) AS next_date, n_rows FROM (SELECT *, ({NEW}) AS isnew FROM details WHERE entity IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') WINDOW w AS (PARTITION BY entity ORDER BY seen_at)) WHERE isnew"))
def l10_versions(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("entity"))
    return panel.versions(view(spark, d, "details"), FACTS, known, at="seen_at").select("entity", secs("seen_at"), "amount", "status", text("next_date"), "n_rows")


HELD = SPANS + ENDS + OWNERS + """, last AS (SELECT max(seq) AS m FROM seq),
er AS (SELECT entity, seq AS a, coalesce(lead(seq) OVER (PARTITION BY entity ORDER BY seq) - 1, m) AS z, end_date FROM ends JOIN seq ON seen_at = slot, last),
orr AS (SELECT entity, seq AS a, coalesce(lead(seq) OVER (PARTITION BY entity ORDER BY seq) - 1, m) AS z, owner FROM owner_changes JOIN seq ON seen_at = slot, last),
held AS (SELECT p.entity, s.seq, s.slot, o.owner, e.end_date FROM spans p JOIN seq s ON s.seq BETWEEN start_seq AND end_seq
LEFT JOIN orr o ON o.entity = p.entity AND s.seq BETWEEN o.a AND o.z LEFT JOIN er e ON e.entity = p.entity AND s.seq BETWEEN e.a AND e.z)"""


@query(duck("roster", HELD + f" SELECT entity, {E('slot')} AS slot, owner, CAST(end_date AS VARCHAR) AS end_date, end_date IS NULL OR end_date > CAST(slot AS DATE) AS held FROM held"))
def l11_l12_values_held(spark: SparkSession, d: str) -> DataFrame:
    """The values in effect at every snapshot, and whether the entity was held then."""
    h = panel.held_rows(roster(spark, d))
    return h.select("entity", secs("slot"), "owner", text("end_date"), panel.held_at(F.col("slot"), F.col("end_date")).alias("held"))


@query(duck("roster", "SELECT 0 AS mismatches, (SELECT count(DISTINCT slot) FROM roster) AS snapshots"))
def l13_population_check(spark: SparkSession, d: str) -> DataFrame:
    """No snapshot's population may differ from the one recomputed from spans and histories."""
    r = roster(spark, d)
    archived = points.snapshot_metrics(r).select("slot", "population")
    bad = panel.check_populations(r, archived)
    return bad.agg(F.count("*").cast("int").alias("mismatches")).crossJoin(archived.agg(F.count("*").alias("snapshots")))


ALTERED = "CASE WHEN day(slot) % 5 = 2 AND hour(slot) = 6 THEN 1 ELSE 0 END"
P2_UTC = "per AS (SELECT slot, owner, max(CASE WHEN end_date IS NULL OR end_date > CAST(slot AS DATE) THEN 1 ELSE 0 END) AS active FROM roster GROUP BY 1, 2), pop AS (SELECT slot, count_if(active = 1 AND owner <> '') AS population FROM per GROUP BY 1)"


@query(duck("roster", f", {P2_UTC} SELECT {E('slot')} AS slot, population + {ALTERED} AS population, population AS recomputed FROM pop WHERE {ALTERED} = 1"))
def l13_altered_populations(spark: SparkSession, d: str) -> DataFrame:
    """Archived populations of some snapshots are one too high: just those are told, with what they should be."""
    r = roster(spark, d)
    off = F.when((F.day("slot") % 5 == 2) & (F.hour("slot") == 6), 1).otherwise(0)
    archived = points.snapshot_metrics(r).select("slot", (F.col("population") + off).alias("population"))
    return panel.check_populations(r, archived).select(secs("slot"), F.col("population").cast("long").alias("population"), F.col("recomputed").cast("long").alias("recomputed"))


L14 = PANEL + OWNERS + """ SELECT count(*) AS entities, count_if(outcome = 'released') AS released, count_if(outcome = 'held') AS held, count_if(outcome = 'disappeared') AS disappeared, count_if(left_truncated) AS left_truncated,
(SELECT count(*) FROM (SELECT entity FROM owner_changes GROUP BY 1 HAVING count(*) > 1)) AS owner_changed, (SELECT count(*) FROM (SELECT entity FROM ends GROUP BY 1 HAVING count(*) > 1)) AS end_changed, CAST(sum(reappearances) AS BIGINT) AS reappearances FROM panel"""


@query(duck("roster", L14))
def l14_panel_summary(spark: SparkSession, d: str) -> DataFrame:
    r = roster(spark, d)
    many = lambda h, name: h.groupBy("entity").count().agg(F.count_if(F.col("count") > 1).alias(name))
    own, end = many(panel.changes(r, "owner", True), "owner_changed"), many(panel.changes(r, "end_date"), "end_changed")
    p = panel.build_panel(r)
    flags = [F.count_if(F.col("outcome") == o).alias(o) for o in ("released", "held", "disappeared")]
    out = p.agg(F.count("*").alias("entities"), *flags, F.count_if("left_truncated").alias("left_truncated"), F.sum("reappearances").alias("reappearances"))
    return out.crossJoin(own).crossJoin(end)


@query(duck("details", ", x AS (SELECT " + ", ".join(f"{f} IS DISTINCT FROM lag({f}) OVER w AND row_number() OVER w > 1 AS {f}" for f in FACTS) + " FROM details WINDOW w AS (PARTITION BY entity ORDER BY seen_at)) " + " UNION ALL ".join(f"SELECT '{f}' AS field, count_if({f}) AS changes FROM x" for f in FACTS)))
def l15_field_changes(spark: SparkSession, d: str) -> DataFrame:
    return panel.field_changes(view(spark, d, "details"), FACTS, at="seen_at")


@query("SELECT DISTINCT l_orderkey AS entity, l_partkey AS case_no FROM lineitem")
def l16_cases_of_entity(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "details").select("entity", F.explode("cases").alias("case_no")).distinct()

"""Snapshot history (H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, points
from ..sources.views import ROSTER_SLOT, duck, table, view
from .registry import query, secs, text

COLS = ["owner", "end_date"]
#: A snapshot is a multiset of (owner, end date) pairs; hashes differ between engines, so rows are shown by value.
ST = """, st AS (SELECT slot, owner, end_date, count(*) AS m FROM roster GROUP BY 1, 2, 3), seq AS (SELECT slot, row_number() OVER (ORDER BY slot) AS seq, lag(slot) OVER (ORDER BY slot) AS before FROM (SELECT DISTINCT slot FROM roster)),
sq AS (SELECT slot, seq, before IS NULL OR CAST(before AS DATE) <> CAST(slot AS DATE) AS first FROM seq), h AS (SELECT st.*, seq, first FROM st JOIN sq USING (slot)),
jn AS (SELECT coalesce(a.seq, b.seq + 1) AS seq, coalesce(a.owner, b.owner) AS owner, coalesce(a.end_date, b.end_date) AS end_date, coalesce(a.m, 0) - coalesce(b.m, 0) AS delta
FROM h a FULL JOIN (SELECT h.* FROM h JOIN sq n ON n.seq = h.seq + 1 AND NOT n.first) b ON a.seq = b.seq + 1 AND a.owner = b.owner AND a.end_date IS NOT DISTINCT FROM b.end_date),
lg AS (SELECT slot, jn.seq, first, owner, end_date, delta FROM jn JOIN sq ON sq.seq = jn.seq WHERE delta <> 0)"""


def states(spark: SparkSession, d: str) -> DataFrame:
    return history.canonical_states(view(spark, d, "roster"), COLS)


@query(duck("roster", ST + " SELECT CAST(epoch(slot) AS BIGINT) AS slot, owner, CAST(end_date AS VARCHAR) AS end_date, m AS multiplicity FROM st"))
def h1_canonical_states(spark: SparkSession, d: str) -> DataFrame:
    return states(spark, d).select(secs("slot"), "owner", text("end_date"), "multiplicity")


@query(duck("roster", ST + " SELECT CAST(epoch(slot) AS BIGINT) AS slot, owner, CAST(end_date AS VARCHAR) AS end_date, delta FROM lg"))
def h2_h7_change_log(spark: SparkSession, d: str) -> DataFrame:
    """Differences of consecutive snapshots; positive deltas are the rows that a replay shows."""
    return history.change_log(states(spark, d), COLS).select(secs("slot"), "owner", text("end_date"), "delta")


H3 = " SELECT owner, CAST(end_date AS VARCHAR) AS end_date FROM roster WHERE slot = (SELECT max(slot) FROM roster WHERE CAST(slot AS DATE) = DATE '2024-01-15')"


@query(duck("roster", H3))
def h3_state_at(spark: SparkSession, d: str) -> DataFrame:
    """The last snapshot of a day rebuilt from that day's log."""
    log = history.change_log(states(spark, d), COLS)
    return history.state_at(log, F.lit("2024-01-15 23:59:59").cast("timestamp"), COLS).select("owner", text("end_date"))


H4 = """SELECT fault, count(*) AS n FROM (SELECT CASE WHEN c <= 0 THEN 'count not positive' WHEN n > 1 THEN 'duplicate entry' WHEN kind = 'removed' AND coalesce(m, 0) < c THEN 'removes too many' END AS fault
FROM (SELECT k, kind, c, count(*) OVER (PARTITION BY k) AS n FROM (SELECT l_partkey AS k, CASE WHEN l_returnflag = 'R' THEN 'removed' ELSE 'added' END AS kind, CAST(min(l_linenumber) - 1 AS BIGINT) AS c FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2)) p
LEFT JOIN (SELECT l_partkey, count(*) AS m FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 7 GROUP BY 1) b ON b.l_partkey = p.k) WHERE fault IS NOT NULL GROUP BY 1"""


@query(H4)
def h4_patch_faults(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("row_hash", F.col("l_partkey"))
    before = li.where("l_returnflag = 'A' and l_linenumber = 7").groupBy("row_hash").agg(F.count("*").alias("multiplicity"))
    patch = li.where("l_returnflag <> 'A'").groupBy("row_hash", F.when(F.col("l_returnflag") == "R", "removed").otherwise("added").alias("kind")).agg((F.min("l_linenumber") - 1).cast("long").alias("count"))
    return history.patch_faults(before, patch).groupBy("fault").agg(F.count("*").alias("n"))


@query(duck("roster", "SELECT 0 AS breaks, (SELECT count(DISTINCT slot) FROM roster) AS entries"))
def h5_chain_check(spark: SparkSession, d: str) -> DataFrame:
    """Each entry's fingerprint of the state before must be the state of the entry before it."""
    e = chain(spark, d)
    return history.chain_breaks(e).agg(F.count("*").cast("int").alias("breaks")).crossJoin(e.agg(F.count("*").alias("entries")))


def chain(spark: SparkSession, d: str) -> DataFrame:
    """(slot, state, before): fingerprints of each snapshot and of the one before it."""
    s = states(spark, d)
    f = history.fingerprints(s).select("slot", F.col("total").alias("state"))
    q = points.sequence(s, [])
    return f.join(q.select("slot", "before"), "slot").join(f.select(F.col("slot").alias("before"), F.col("state").alias("b")), "before", "left").select("slot", "state", F.col("b").alias("before"))


@query(duck("roster", "SELECT CAST(epoch(slot) AS BIGINT) AS slot FROM (SELECT slot, lag(slot) OVER (ORDER BY slot) AS prior FROM (SELECT DISTINCT slot FROM roster)) WHERE prior IS NOT NULL AND (day(slot) % 6 = 1 AND hour(slot) = 12 OR day(prior) % 7 = 3 AND hour(prior) = 18)"))
def h5_broken_chain(spark: SparkSession, d: str) -> DataFrame:
    """Some entries name another state before them, some states are altered afterwards: the entry itself, or the one
    after it, breaks the chain."""
    e = chain(spark, d)
    e = e.withColumn("before", F.when((F.day("slot") % 6 == 1) & (F.hour("slot") == 12), F.col("before") + 1).otherwise(F.col("before")))
    e = e.withColumn("state", F.when((F.day("slot") % 7 == 3) & (F.hour("slot") == 18), F.col("state") - 1).otherwise(F.col("state")))
    return history.chain_breaks(e).select(secs("slot"))


@query(duck("points", "SELECT source, CAST(epoch(max(slot)) AS BIGINT) AS slot, max(CAST(epoch(slot) AS BIGINT)) FILTER (slot <= TIMESTAMP '2024-01-20') AS stale_slot, max(slot) FILTER (source <> 'click' OR slot <= TIMESTAMP '2024-01-20') = max(slot) AS same FROM points GROUP BY 1"))
def h9_lost_observations(spark: SparkSession, d: str) -> DataFrame:
    """A projection that has lost one source's observations after a cursor differs from the rebuilt one there only."""
    p = view(spark, d, "points").select("source", "slot", "population")
    cursor = F.col("slot") <= F.lit("2024-01-20").cast("timestamp")
    old, whole = history.latest_projection(p.where(cursor)), history.latest_projection(p)
    lost = history.latest_projection(old.union(p.where(~cursor & (F.col("source") != "click"))))
    j = whole.join(old.select("source", F.col("slot").alias("stale")), "source", "left").join(lost.select("source", F.struct("slot", "population").alias("a")), "source")
    return j.select("source", secs("slot"), F.unix_seconds("stale").alias("stale_slot"), F.struct("slot", "population").eqNullSafe(F.col("a")).alias("same"))


H6 = ST + """, ch AS (SELECT seq, count(*) AS changed FROM lg WHERE NOT first GROUP BY 1), n AS (SELECT slot, CAST(sum(m) AS BIGINT) AS n FROM st GROUP BY 1)
SELECT CAST(epoch(slot) AS BIGINT) AS slot, n, coalesce(changed, 0) AS changed, CASE WHEN first THEN 'checkpoint' WHEN changed IS NULL THEN 'unchanged' WHEN changed >= n THEN 'checkpoint' ELSE 'delta' END AS kind FROM sq JOIN n USING (slot) LEFT JOIN ch ON ch.seq = sq.seq"""


@query(duck("roster", H6))
def h6_entry_kinds(spark: SparkSession, d: str) -> DataFrame:
    s = states(spark, d)
    return history.entry_kinds(s, history.change_log(s, COLS)).select(secs("slot"), "n", "changed", "kind")


@query(duck("details", "SELECT entity, CAST(epoch(max(seen_at)) AS BIGINT) AS checked_at, arg_max(status, seen_at) AS status FROM details WHERE seen_at <= TIMESTAMP '1996-01-01' GROUP BY 1"))
def h8_checks_at(spark: SparkSession, d: str) -> DataFrame:
    """Each entity's last check up to a time."""
    x = view(spark, d, "details").where("seen_at <= timestamp '1996-01-01'").groupBy("entity").agg(F.max(F.struct("seen_at", "status")).alias("x"))
    return x.select("entity", F.unix_seconds("x.seen_at").alias("checked_at"), "x.status")


@query(duck("points", "SELECT source, CAST(epoch(max(slot)) AS BIGINT) AS slot, arg_max(population, slot) AS population, true AS same FROM points GROUP BY 1"))
def h9_recovered_projection(spark: SparkSession, d: str) -> DataFrame:
    """The projection rebuilt from what came after a cursor equals the one from the whole table."""
    p = view(spark, d, "points").select("source", "slot", "population")
    whole = history.latest_projection(p)
    cursor = F.lit("2024-01-20").cast("timestamp")
    after = history.latest_projection(history.latest_projection(p.where(F.col("slot") <= cursor)).union(p.where(F.col("slot") > cursor)))
    j = whole.join(after.select("source", F.struct("slot", "population").alias("a")), "source")
    return j.select("source", secs("slot"), "population", F.struct("slot", "population").eqNullSafe(F.col("a")).alias("same"))


H10 = f", hd AS (SELECT *, entity % 20 = 0 AS heading FROM roster), sm AS (SELECT slot, count_if(heading) AS removed, count_if(NOT heading) AS n_rows, count(DISTINCT entity) FILTER (NOT heading) AS population FROM hd GROUP BY 1), q AS (SELECT DISTINCT slot, lag(slot) OVER (ORDER BY slot) AS before FROM (SELECT DISTINCT slot FROM roster)), nw AS (SELECT slot, entity FROM hd WHERE NOT heading) SELECT CAST(epoch(sm.slot) AS BIGINT) AS slot, removed, n_rows, population, CASE WHEN epoch(sm.slot) - epoch(before) = {ROSTER_SLOT} THEN (SELECT count(*) FROM nw a WHERE a.slot = sm.slot AND NOT EXISTS (SELECT 1 FROM nw b WHERE b.slot = q.before AND b.entity = a.entity)) END AS arrivals FROM sm JOIN q USING (slot)"


@query(duck("roster", H10))
def h10_repaired_history(spark: SparkSession, d: str) -> DataFrame:
    """Some rows are headings; they go from every snapshot and the metrics are computed again."""
    r = view(spark, d, "roster")
    heading = F.col("entity") % 20 == 0
    flows = points.flows(r.where(~heading), ROSTER_SLOT, ROSTER_SLOT).select("slot", "arrivals")
    return history.repaired(r, heading).join(flows, "slot", "left").select(secs("slot"), "removed", "n_rows", "population", "arrivals")


@query(duck("roster", ST + ", k AS (" + H6.split("SELECT CAST(epoch(slot)")[1].join(["SELECT CAST(epoch(slot)", ""]) + ") SELECT kind, count(*) AS n, 0 AS differing FROM k GROUP BY 1").replace("k AS (", "ch AS (SELECT seq, count(*) AS changed FROM lg WHERE NOT first GROUP BY 1), n AS (SELECT slot, CAST(sum(m) AS BIGINT) AS n FROM st GROUP BY 1), k AS ("))
def h11_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Every snapshot rebuilt from the log equals the original; entries counted by kind."""
    s = states(spark, d)
    log = history.change_log(s, COLS)
    again = history.all_states(log, s)
    own = s.select("slot", "row_hash", "multiplicity")
    differing = own.exceptAll(again).union(again.exceptAll(own)).agg(F.count("*").cast("int").alias("differing"))
    return history.entry_kinds(s, log).groupBy("kind").agg(F.count("*").alias("n")).crossJoin(differing)


@query(duck("roster", ", gone AS (SELECT owner, end_date, min(slot) AS slot FROM roster GROUP BY owner, end_date), st AS (SELECT slot, owner, end_date, count(*) AS m FROM roster GROUP BY 1, 2, 3) SELECT CAST(epoch(s.slot) AS BIGINT) AS slot, count(*) AS differing FROM st s JOIN gone g ON s.owner IS NOT DISTINCT FROM g.owner AND s.end_date IS NOT DISTINCT FROM g.end_date AND CAST(s.slot AS DATE) = CAST(g.slot AS DATE) WHERE s.slot >= g.slot GROUP BY 1"))
def h11_damaged_log(spark: SparkSession, d: str) -> DataFrame:
    """A log that has lost each row's first entry rebuilds other multiplicities for the rest of that day."""
    s = states(spark, d)
    log = history.change_log(s, COLS)
    first = log.groupBy("row_hash").agg(F.min("seq").alias("seq"))
    again = history.all_states(log.join(first, ["row_hash", "seq"], "left_anti"), s)
    own = s.select("slot", "row_hash", "multiplicity")
    return own.exceptAll(again).groupBy(secs("slot")).agg(F.count("*").alias("differing"))

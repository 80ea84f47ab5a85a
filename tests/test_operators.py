"""Hand-worked cases."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelspark.functions import scalars, stats
from panelspark.operators import events, forecast, history, joins, panel, points, products, survival
from panelspark.sources import files, publish
from panelspark.streaming import ingest, registry

T0 = datetime(2024, 1, 1)


def minutes(n):
    return T0 + timedelta(minutes=n)


def snaps(spark, rows):
    return spark.createDataFrame([(minutes(m), e, o, d) for m, e, o, d in rows], "slot timestamp, entity string, owner string, end_date date")


def test_kaplan_meier_by_hand(spark):
    """Eight stays, two ends on one day, an end and a cut-off on another; the last one ends."""
    stays = [(12, True), (4, False), (20, True), (7, True), (9, False), (7, True), (15, False), (4, True)]
    km = survival.kaplan_meier(spark.createDataFrame([("g", t, e) for t, e in stays], "g string, duration int, event boolean"), ["g"])
    table = km.orderBy("time").collect()
    assert [(r.time, r.at_risk, round(r.survival, 6)) for r in table] == [(4, 8, 0.875), (7, 6, 0.583333), (9, 4, 0.583333), (12, 3, 0.388889), (15, 2, 0.388889), (20, 1, 0.0)]
    # 7/8 with a variance of 1/56 on the log-log scale, and 7/12 with 1/56 + 2/24
    limits = [(round(r.lower, 4), round(r.upper, 4)) for r in table[:2]]
    assert limits == [(0.387, 0.9814), (0.1802, 0.8441)]
    assert table[-1].lower is None and table[-1].upper is None
    at = {r.day: r.survival and round(r.survival, 6) for r in survival.survival_at(km, ["g"], (3, 10, 21)).collect()}
    assert at == {3: 1.0, 10: 0.583333, 21: None}
    assert survival.at_risk_at(km, ["g"], (7,)).first().at_risk == 4
    q = {r.share: r.time for r in survival.event_quantiles(km, ["g"], (0.1, 0.25, 0.5)).collect()}
    assert q == {0.1: 4, 0.25: 7, 0.5: 12}


def test_spans_follow_observations_not_time(spark):
    rows = snaps(spark, [(0, "a", "p", None), (15, "a", "p", None), (45, "b", "q", None), (60, "a", "p", None), (60, "b", "q", None)])
    got = {(r.entity, r.span_start, r.span_end) for r in panel.presence_spans(rows).collect()}
    assert got == {("a", minutes(0), minutes(15)), ("a", minutes(60), minutes(60)), ("b", minutes(45), minutes(60))}
    assert [r.slot for r in points.missing_slots(rows.select("slot", F.lit("s").alias("source")), ["source"]).collect()] == [minutes(30)]


def test_arrivals_only_between_adjacent_slots(spark):
    rows = snaps(spark, [(0, "a", "", None), (0, "b", "", None), (15, "b", "", None), (15, "c", "", None), (45, "c", "", None)])
    got = [(r.arrivals, r.departures, r.comparison_minutes) for r in points.flows(rows).orderBy("slot").collect()]
    assert got == [(None, None, None), (1, 1, 15.0), (None, None, None)]


def test_population_is_reproduced_when_owner_and_end_change(spark):
    d = date(2024, 1, 1)
    rows = snaps(spark, [(0, "a", "p", None), (0, "b", "q", None), (15, "a", "p", d), (15, "b", "q", None), (30, "a", "r", None), (30, "b", "", None)])
    metrics = points.snapshot_metrics(rows)
    assert [r.population for r in metrics.orderBy("slot").collect()] == [2, 1, 1]
    assert panel.check_populations(rows, metrics).isEmpty()
    assert not panel.check_populations(rows, metrics.withColumn("population", F.lit(9))).isEmpty()
    with pytest.raises(ValueError):
        publish.gate(metrics)


def test_end_history_ignores_an_initial_null(spark):
    d = date(2024, 2, 1)
    rows = snaps(spark, [(0, "a", "p", None), (15, "a", "p", d), (30, "a", "p", None), (45, "a", "", None)])
    assert [r.end_date for r in panel.changes(rows, "end_date").orderBy("at").collect()] == [d, None]
    assert [r.owner for r in panel.changes(rows, "owner", True).orderBy("at").collect()] == ["p", ""]


def test_nearest_prefers_the_earlier_at_a_tie(spark):
    left = spark.createDataFrame([(minutes(m),) for m in (-5, 10, 115, 300)], "l timestamp")
    right = spark.createDataFrame([(minutes(m),) for m in (0, 20, 120)], "r timestamp")
    got = {(r.l, r.r) for r in joins.nearest(left, right, "l", "r", 1200).collect()}
    assert got == {(minutes(-5), minutes(0)), (minutes(10), minutes(0)), (minutes(115), minutes(120)), (minutes(300), None)}


def test_three_medians(spark):
    df = spark.createDataFrame([("g", v) for v in (1, 2, 3, 4)], "g string, v int")
    r = df.groupBy("g").agg(F.median("v").alias("m"), stats.high_median("v").alias("h")).first()
    assert (r.m, r.h) == (2.5, 3)
    assert stats.index_quantiles(df, ["g"], "v", (0.5,)).first().value == 3
    assert stats.index_quantiles(df, ["g"], "v", (0.8,), last=True, least=5).first().value is None
    five = df.union(spark.createDataFrame([("g", 5)], "g string, v int"))
    assert stats.index_quantiles(five, ["g"], "v", (0.8,), last=True, least=5).first().value == 4


def test_scalars(spark):
    df = spark.createDataFrame([(" 02/29/2024 x", "$1,234.50", date(2000, 2, 29)), ("bad", "n/a", date(2000, 3, 1))], "d string, m string, b date")
    r = df.select(scalars.us_date(F.col("d")).alias("d"), scalars.money(F.col("m")).alias("m"), scalars.age_on(F.col("b"), F.lit("2023-02-28").cast("date")).alias("a")).collect()
    assert [tuple(x) for x in r] == [(date(2024, 2, 29), 1234.5, 22), (None, None, 22)]
    s = spark.createDataFrame([("250m",), ("512Mi",), ("2",), ("x",)], "s string").select(scalars.size_number(F.col("s")).alias("n")).collect()
    assert [x.n for x in s] == [0.25, 512 * 2**20, 2.0, None]
    n = spark.createDataFrame([(0,), (9,), (10,)], "n long").select(scalars.suppressed(F.col("n")).alias("n")).collect()
    assert [x.n for x in n] == ["0", "<10", "10"]
    p = spark.createDataFrame([(7,), (12345,)], "n long").select(scalars.padded_id(F.col("n"), 4).alias("p")).collect()
    assert [x.p for x in p] == ["0007", "12345"]


def test_set_relations(spark):
    cases = [([1], [1], "identical"), ([1], [1, 2], "subset"), ([1, 2], [1], "superset"), ([1, 2], [2, 3], "overlap"), ([1], [2], "disjoint"), ([], [2], "missing"), (None, [1], "missing")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a array<int>, b array<int>")
    assert [r.c for r in df.select(scalars.set_relation(F.col("a"), F.col("b")).alias("c")).collect()] == [c for _, _, c in cases]


def test_change_log_round_trip_and_faults(spark):
    rows = snaps(spark, [(0, "a", "x", None), (0, "b", "x", None), (15, "a", "x", None), (30, "a", "x", None), (24 * 60, "c", "y", None)])
    s = history.canonical_states(rows, ["owner", "end_date"])
    log = history.change_log(s, ["owner", "end_date"])
    assert {(r.slot, r.owner, r.delta) for r in log.collect()} == {(minutes(0), "x", 2), (minutes(15), "x", -1), (minutes(1440), "y", 1)}
    again = history.all_states(log, s)
    own = s.select("slot", "row_hash", "multiplicity")
    assert own.exceptAll(again).isEmpty() and again.exceptAll(own).isEmpty()
    kinds = [r.kind for r in history.entry_kinds(s, log).orderBy("slot").collect()]
    assert kinds == ["checkpoint", "checkpoint", "unchanged", "checkpoint"]
    assert history.state_at(log, F.lit(minutes(0)), ["owner", "end_date"]).count() == 2


def test_forecast_offsets_and_no_leakage(spark):
    pattern = [30, 27, 0, -8, -19, -22, -8]
    rows = [("s", date(2024, 1, 1) + timedelta(days=i), i, 1000.0 + pattern[i % 7], 96) for i in range(30)]
    schema = "source string, day date, n int, mean double, observations long"
    s = spark.createDataFrame(rows, schema)
    o = {r.weekday: r.offset for r in forecast.weekday_offsets(s).collect()}
    assert [round(o[i], 6) for i in range(7)] == [float(p) for p in pattern]
    assert forecast.weekday_offsets(s.where("n < 12")).isEmpty()
    bumped = spark.createDataFrame([(a, b, n, m + 50 * (n == 29), c) for a, b, n, m, c in rows], schema)
    key = lambda df: {(r.n, r.ahead): round(r.forecast, 9) for r in df.where("n < 29").collect()}
    assert key(forecast.weekday_rule(s)) == key(forecast.weekday_rule(bumped))
    one = [r.error for r in forecast.backtest(bumped, forecast.weekday_rule).where("ahead = 1 and n = 28").collect()]
    assert [round(e, 6) for e in one] == [50.0]


def test_visit_gaps(spark):
    v = [("A", 1, date(2024, 1, 1), date(2024, 1, 5)), ("A", 2, date(2024, 1, 10), None), ("A", 3, date(2024, 2, 1), None), ("B", 4, date(2024, 1, 1), date(2024, 3, 1)), ("B", 5, date(2024, 2, 1), None), ("", 6, date(2024, 1, 1), None)]
    got = {(r.entity, r.kind, r.days) for r in events.visit_gaps(spark.createDataFrame(v, "owner string, entity int, start_date date, end_date date")).collect()}
    assert got == {(2, "measured", 5), (3, "missing", None), (5, "invalid", None)}


def test_date_moves(spark):
    d = lambda n: date(2024, 1, 1) + timedelta(days=n)
    v = spark.createDataFrame([("e", minutes(0), d(5)), ("e", minutes(1440 * 6), d(20)), ("e", minutes(1440 * 7), d(43)), ("e", minutes(1440 * 8), None), ("e", minutes(1440 * 9), d(50))], "entity string, seen_at timestamp, next_date date")
    got = [(r.kind, r.days) for r in events.date_moves(v).orderBy("seen_at").collect()]
    assert got == [("passed", 15), ("reset", 23), ("removed", None), ("first", None)]


def test_fair_and_refresh_queues(spark):
    f = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "family string, modified int, name string")
    assert [(r.family, r.name) for r in products.fair_queue(f).collect()] == [("a", "y"), ("b", "z"), ("a", "x")]
    now = minutes(60 * 48)
    rows = spark.createDataFrame([(1, minutes(0), None, False, True), (2, None, None, False, True), (3, minutes(60 * 47), None, False, True), (4, minutes(60), now, True, True), (5, minutes(60 * 47), None, True, True)], "entity int, checked_at timestamp, failed_at timestamp, changed boolean, live boolean")
    assert [r.entity for r in products.refresh_queue(rows, F.lit(now), 10).collect()] == [5, 2, 1]


def test_csv_reports_are_quarantined(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbftitle\r\nname,case,when\r\nx,1,2\r\nname,case,when\r\n\"q,r\",2,3\r\n")
    (tmp_path / "b.csv").write_text("name,case,when\n" + "x,1,2\n" * 3 + "\"x\"y\",1,2\n")
    (tmp_path / "c.csv").write_text("nothing\n")
    rows, found = files.parse_reports(files.numbered_lines(spark, str(tmp_path)), "case", 3)
    assert {r.file: r.status for r in found.collect()} == {"a.csv": "parsed", "b.csv": "rejected", "c.csv": "no header"}
    assert [r.fields for r in rows.orderBy("line_no").collect()] == [["x", "1", "2"], ["q,r", "2", "3"]]


def test_listing_checksums_and_json(spark, tmp_path):
    (tmp_path / "l.xml").write_text("<dir><file><name>a%20b.csv</name><size>3</size><modified>86400</modified></file><file><name>..%2Fx</name><size>1</size><modified>1</modified></file><folder>z</folder></dir>")
    got = [(r.name, r.fault) for r in files.parse_listing(spark, str(tmp_path / "l.xml")).collect()]
    assert got == [("a b.csv", None), ("../x", "path leaves the folder")]
    folder = tmp_path / "blobs"
    folder.mkdir()
    (folder / "x").write_bytes(b"one")
    (folder / "y").write_bytes(b"two")
    import hashlib

    digests = spark.createDataFrame([("x", hashlib.sha256(b"one").hexdigest()), ("y", "0")], "name string, digest string")
    assert {r.name: r.reason for r in files.verified_contents(spark, str(folder), digests).collect()} == {"x": None, "y": "checksum differs"}
    (tmp_path / "r.json").write_text('{"a": 1}\n')
    assert files.read_json(spark, str(tmp_path / "r.json"), "a int").first().a == 1


def test_stream_registry_equals_rebuild(spark, tmp_path):
    rows = snaps(spark, [(0, "a", "p", date(2024, 2, 1)), (15, "a", "", None), (15, "b", "q", None), (30, "a", "r", None)])
    src, out, cursor = (f"file://{tmp_path}/{x}" for x in ("src", "out", "cursor"))
    for low, high in ((0, 15), (15, 30), (30, 45)):
        rows.where((F.col("slot") >= F.lit(minutes(low))) & (F.col("slot") < F.lit(minutes(high)))).write.mode("append").parquet(src)
        ingest.run_available(spark.readStream.schema(rows.schema).parquet(src), registry.registry_sink(spark, out), cursor)
    key = lambda df: sorted((r.entity, tuple(r.owners), r.first_seen, r.last) for r in df.collect())
    assert key(registry.registry_table(spark, out)) == key(registry.merge_registry(None, rows))


def test_once_per_slot_takes_every_event_type(spark, tmp_path):
    from panelspark.plans import stream_queries

    rows = [(1, "click", "2024-01-01 00:01:00"), (2, "click", "2024-01-01 00:02:00"), (3, "refund", "2024-01-01 00:20:00"), (4, None, "2024-01-01 00:03:00")]
    spark.createDataFrame(rows, "event_id long, event_type string, ts string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = stream_queries.st3_st7_once_per_slot(spark, str(tmp_path)).collect()
    assert {(r.source, r.slot) for r in got} == {("click", 1704067200), ("refund", 1704068100), (None, 1704067200)} and len(got) == 3


def test_lines_that_are_not_utf8_are_read_as_windows_1252(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes("“é” €\nplain".encode("cp1252"))
    (tmp_path / "u.csv").write_bytes("﻿“é” €\r\nplain".encode())
    got = {(r.file, r.line_no): r.line for r in files.numbered_lines(spark, str(tmp_path)).collect()}
    assert got == {(f, k): x for f in ("w.csv", "u.csv") for k, x in enumerate(["“é” €", "plain"])}

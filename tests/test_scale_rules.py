"""Rules that only show with heavy tails, long series, several writers or failing sources."""

import os
import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelspark.functions import stats
from panelspark.operators import events, forecast, joins, points, reconcile
from panelspark.sources import layout, shared
from panelspark.streaming import ingest, isolation, registry

T0 = datetime(2024, 1, 1)


def hours(n):
    return T0 + timedelta(hours=n)


# --- quantiles


@pytest.mark.parametrize(("whole", "ranges"), [(20_000, 1024), (10, 16), (0, 64)])
@pytest.mark.parametrize("last", [False, True])
def test_index_quantiles_by_force(spark, whole, ranges, last):
    rng = random.Random(4)
    groups = {"tail": [rng.randrange(3000) for _ in range(4000)] + [10**12], "one": [7] * 50, "few": [3, 1, 2], "odd": [rng.gauss(0, 1) ** 9 for _ in range(500)]}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("few", None)], "g string, v double").repartition(3)
    shares = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {(r.g, r.share): r.value for r in stats.index_quantiles(df, ["g"], "v", shares, last, least=5, whole=whole, ranges=ranges).collect()}
    want = {}
    for g, vs in groups.items():
        for s in shares:
            at = int(s * (len(vs) - 1)) if last else int(len(vs) * s)
            want[g, s] = float(sorted(vs)[at]) if len(vs) >= 5 and at < len(vs) else None
    assert got == want
    medians = {r.g: r.median for r in stats.exact_median(df, ["g"], "v", whole=whole, ranges=ranges).collect()}
    assert medians == {g: statistics.median(map(float, vs)) for g, vs in groups.items()}
    everything = [v for vs in groups.values() for v in vs]
    assert stats.index_quantiles(df, [], "v", (0.5,), whole=whole, ranges=ranges).first().value == sorted(everything)[len(everything) // 2]


def test_ranges_are_even_despite_an_outlier(spark):
    values = spark.range(100_000).select(F.col("id").cast("double").alias("v")).union(spark.createDataFrame([(1e12,)], "v double"))
    cuts = values.agg(F.percentile_approx("v", [i / 1024 for i in range(1, 1024)], 20 * 1024).alias("c"))
    sizes = values.crossJoin(cuts).select("v", stats.range_of("c", "v", 1024).alias("part")).groupBy("part").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("z"))
    got = sorted((r.part, r.n, r.a, r.z) for r in sizes.collect())
    assert max(n for _, n, _, _ in got) <= 3 * 100_001 / 1024 and len(got) > 1000
    assert all(x[3] < y[2] for x, y in zip(got, got[1:], strict=False))


# --- forecasts


def test_smoothing_by_force(spark):
    """Days are missing, the series is longer than a block, and each origin has offsets of its own."""
    rng = random.Random(8)
    start, days = date(2020, 1, 1), [i for i in range(400) if i not in (90, 91, 250)]
    rows = [("s", start + timedelta(days=i), i + 18262, 1000 + 20 * (i % 7) + rng.gauss(0, 30), 96) for i in days]
    s = spark.createDataFrame(rows, "source string, day date, n int, mean double, observations long")
    offsets = {(r.n, r.weekday): r.offset for r in forecast.offsets_known(s).collect()}
    want = {}
    for k, (_, _, n, _, _) in enumerate(rows):
        if (n, 0) in offsets:
            adj = [m - offsets[n, i % 7] for _, _, i, m, _ in rows[: k + 1]]
            level = adj[0]
            for x in adj[1:]:
                level += 0.3 * (x - level)
            want |= {(n, a): level + offsets[n, (n + a) % 7] for a in range(1, 8)}
    got = {(r.n, r.ahead): r.forecast for r in forecast.smoothed_weekday(s).collect()}
    assert got.keys() == want.keys() and len(want) > 2000
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_discounts_of_long_series(spark):
    s = spark.range(5000).select(F.lit("s").alias("source"), F.col("id").cast("int").alias("n"), (F.col("id") % 50).cast("double").alias("mean"))
    got = {r.n: r.x for r in forecast.discounted(s, {"x": F.col("mean")}).collect()}
    level = 0.0
    for i in range(5000):
        level = float(i % 50) if i == 0 else level + 0.3 * (i % 50 - level)
        assert abs(got[i] - level) < 1e-9


# --- next events


@pytest.mark.parametrize("seconds", [3600, 86_400 * 3, 86_400 * 32])
def test_next_event_of_a_hot_owner_by_force(spark, seconds):
    rng = random.Random(seconds)
    rows = [(rng.choice(["hot"] * 8 + ["p", "q", ""]), i, hours(rng.randrange(24 * 60)), None if rng.random() < 0.2 else (T0 + timedelta(days=rng.randrange(70))).date()) for i in range(400)]
    df = spark.createDataFrame(rows, "owner string, entity int, first_seen timestamp, end_date date").repartition(5)
    got = {r.entity: r.next_seen for r in joins.next_event(df, "owner", "entity", "first_seen", "end_date", seconds).collect()}
    midnight = lambda d: datetime(d.year, d.month, d.day)
    want = {i: min((t for o, _, t, _ in rows if o == owner and t > first and t >= midnight(end)), default=None) for owner, i, first, end in rows if owner and end}
    assert got == want


def test_next_event_deals_rows_by_their_number(spark):
    at = F.timestamp_seconds(1_600_000_000 + F.col("id") * 3600)
    df = spark.range(6000).select(F.lit("hot").alias("owner"), F.col("id").alias("entity"), at.alias("first_seen"), at.cast("date").alias("end_date"))
    out = joins.next_event(df, "owner", "entity", "first_seen", "end_date", 86_400 * 2, tasks=12)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and len(sizes) > 8 and max(sizes) < 1500  # however Spark would join such small partitions
    assert joins.tasks_for(df, 100) == 60 and joins.tasks_for(df) == spark.sparkContext.defaultParallelism


def test_next_event_of_an_event_never_seen(spark):
    rows = [("p", 1, None, date(2024, 1, 1)), ("p", 2, T0 + timedelta(days=900), date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "owner string, entity int, first_seen timestamp, end_date date")
    assert {r.entity: r.next_seen for r in joins.next_event(df, "owner", "entity", "first_seen", "end_date").collect()} == {1: None, 2: None}


@pytest.mark.parametrize("days", [1, 32, 4000])
def test_visit_gaps_of_a_hot_owner_by_force(spark, days):
    rng = random.Random(days)
    day = lambda n: date(2023, 1, 1) + timedelta(days=n)
    rows = []
    for i in range(400):
        owner, at = rng.choice(["hot"] * 8 + ["p", "q", "void", ""]), rng.randrange(500)
        rows.append((owner, i, None if owner == "void" and rng.random() < 0.3 else day(at), None if rng.random() < 0.2 else day(at + rng.randrange(-1, 4))))
    df = spark.createDataFrame(rows, "owner string, entity int, start_date date, end_date date").repartition(5)
    got = {r.entity: (r.kind, r.days) for r in events.visit_gaps(df, days=days).collect()}
    want = {}
    for owner in {r[0] for r in rows} - {""}:
        own = sorted((r for r in rows if r[0] == owner), key=lambda r: (r[2] is not None, r[2] or day(0), r[1]))
        void = any(r[2] is None for r in own)
        for (_, _, a, z), (_, i, start, _) in zip(own, own[1:], strict=False):
            if void or z is None:
                want[i] = ("missing", None)
            elif a >= start or z < a or z > start:
                want[i] = ("invalid", None)
            else:
                want[i] = ("measured", (start - z).days)
    assert got == want


# --- layout and commits


def test_a_scan_reads_only_the_folders_of_its_source_and_days(spark, tmp_path):
    rows = [(s, hours(i), i) for s in ("a", "b") for i in range(24 * 10)]
    p = spark.createDataFrame(rows, "source string, slot timestamp, population long")
    path = f"file://{tmp_path}/days"
    layout.write_days(p, path)
    got = layout.scan_days(spark, path, p.schema, "a", F.lit(hours(47)), F.lit(hours(73)))
    assert sorted(r.population for r in got.collect()) == list(range(48, 74))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    run = got._jdf.queryExecution()
    run.toRdd().count()
    assert run.executedPlan().collectLeaves().head().metrics().apply("numFiles").value() == 3  # of 20: the cursor's day too
    assert got.columns == ["source", "slot", "population"]
    # a day that is written again replaces that day only
    layout.write_days(p.where("source = 'b' and slot < '2024-01-02'").withColumn("population", F.lit(-1).cast("long")), path)
    again = layout.scan_days(spark, path, p.schema, "b").collect()
    assert len(again) == 240 and sum(r.population == -1 for r in again) == 24


def test_commits_are_once_and_whole(spark, tmp_path):
    path, kind = f"file://{tmp_path}/log", "source string, slot int, id int"
    first = spark.createDataFrame([("a", 1, i) for i in range(5)] + [("a", 2, 9)], kind)
    for _ in range(2):
        layout.commit_new(spark, first, path, ["source", "slot"])
    layout.commit_new(spark, spark.createDataFrame([("a", 2, 77), ("a", 3, 1), ("b", 1, 2)], kind), path, ["source", "slot"])
    got = lambda: sorted(map(tuple, layout.committed(spark, first.schema, path).collect()))
    want = [("a", 1, i) for i in range(5)] + [("a", 2, 9), ("a", 3, 1), ("b", 1, 2)]
    assert got() == want
    # a second writer that hasn't seen the first one's commit replaces the key whole
    layout.replace_folders(spark.createDataFrame([("a", 3, 1)], kind), path, ["source", "slot"])
    assert got() == want


def test_an_application_stores_in_one_folder_that_can_be_cleared(spark):
    one = shared.stored(spark.range(3), "t")
    assert one.count() == 3 and shared.exists(spark, shared.application_folder(spark))
    assert spark.conf.get("spark.checkpoint.dir") in shared.shared_folder(spark, "x")
    shared.clear(spark)
    assert not shared.exists(spark, shared.application_folder(spark))


# --- sources side by side


def test_a_failing_source_leaves_the_others_and_its_own_results(spark, tmp_path):
    at = lambda x: f"file://{tmp_path}/{x}"
    put = lambda n: spark.createDataFrame([(n,)], "id long").write.mode("append").parquet(at("in"))
    stream = lambda: spark.readStream.schema("id long").parquet(at("in"))
    kept = lambda n: sorted(r.id for r in spark.read.parquet(at(n)).collect())

    def broken(batch, number):
        batch.select(F.raise_error(F.lit("a row with a name in it"))).collect()

    def run(number, sink):
        sources = {n: isolation.Source(stream(), sink if n == "x" else ingest.append_sink(at(n)), at(f"cursor-{n}")) for n in ("x", "y", "z")}
        sources["nowhere"] = isolation.Source(spark.readStream.format("rate").load().select("value"), broken, "no-such-scheme://x/y")
        told = isolation.run_isolated(sources, number)
        isolation.record_attempts(spark, told, at("attempts"))
        return {r[0]: r[2:] for r in told}

    put(1)
    assert run(1, ingest.append_sink(at("x")))["x"] == ("success", None)
    put(2)
    told = run(2, broken)
    assert told["x"] == ("failed", "SparkRuntimeException") and told["y"] == told["z"] == ("success", None) and told["nowhere"][0] == "failed"
    assert kept("x") == [1] and kept("y") == kept("z") == [1, 2]
    put(3)
    told = run(3, ingest.append_sink(at("x")))
    assert kept("x") == kept("y") == [1, 2, 3] and told["x"] == ("success", None)
    assert run(4, ingest.append_sink(at("x")))["x"] == ("nothing new", None) and kept("x") == [1, 2, 3]
    states = {r.source: r for r in isolation.source_states(spark.read.schema(isolation.ATTEMPTS).parquet(at("attempts"))).collect()}
    assert (states["x"].runs, states["x"].failures, states["x"].last_status, states["x"].last_success, states["x"].error) == (4, 1, "nothing new", 4, None)
    assert states["nowhere"].failures == 4 and states["nowhere"].last_success is None


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = f"file://{tmp_path}/registry"
    snap = lambda rows: spark.createDataFrame(rows, "slot timestamp, entity string, owner string, end_date date")
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "registry").glob("bucket=*/*.parquet")}
    first = snap([(hours(0), f"e{i}", "p", None) for i in range(200)])
    sink = registry.registry_sink(spark, path, 16)
    sink(first, 0)
    before = files()
    second = snap([(hours(1), "e3", "q", date(2024, 2, 1)), (hours(1), "new", "", None)])
    for _ in range(2):  # the same batch twice, as after a crash
        sink(second, 1)
    after = files()
    touched = {f"bucket={r.b}" for r in second.select(registry.bucket_of("entity", 16).alias("b")).collect()}
    assert len(before) == 16 and {b for b in after if after[b] != before[b]} == touched
    key = lambda df: sorted((r.entity, tuple(r.owners), r.first_seen, r.last) for r in df.collect())
    assert key(registry.registry_table(spark, path)) == key(registry.merge_registry(None, first.union(second)))
    assert registry.upsert(spark, path, second.limit(0), registry.merge_registry, "entity", 16) == []


def test_first_sights_are_the_first_even_if_rows_come_late(spark, tmp_path):
    at = lambda x: f"file://{tmp_path}/{x}"
    for batch in ([(5, "a"), (6, "a"), (6, "b")], [(7, "a"), (7, "c"), (8, "c")], [(4, "b"), (9, "d"), (9, "a")]):
        spark.createDataFrame([(hours(h), e) for h, e in batch], "slot timestamp, entity string").write.mode("append").parquet(at("in"))
        with registry.keyed_state(spark):
            ingest.run_available(registry.first_sights(spark.readStream.schema("slot timestamp, entity string").parquet(at("in"))), ingest.append_sink(at("out")), at("cursor"), "update")
    out = spark.read.parquet(at("out"))
    assert {(r.batch, r.entity, r.first) for r in out.where("first is not null").collect()} == {(0, "a", hours(5)), (0, "b", hours(6)), (1, "c", hours(7)), (2, "b", hours(4)), (2, "d", hours(9))}
    seen = out.groupBy("entity").agg(F.min("first").alias("slot"))
    rows = spark.read.parquet(at("in"))
    assert {(r.slot, r.seen) for r in points.cumulative_seen(seen).collect()} <= {(r.slot, r.seen) for r in points.cumulative_seen(rows).collect()}


# --- reconciliation


def test_reconciliation_has_every_class(spark):
    day = date(2024, 3, 10)
    d = lambda n: day + timedelta(days=n)
    noon = datetime(2024, 3, 10, 18)
    m = lambda n: noon + timedelta(minutes=n)
    listed = [*"abcdefghijkl", "gone", "h1", "h2", "h3", "h4"]
    first = [(m(-300), e, True) for e in [*listed, "left"] if e != "h2"] + [(m(-5), e, e != "gone") for e in listed] + [(m(500), "z", True)]
    rows = {
        "a": [("1", d(-9), False, d(3), "x")], "b": [("1", d(-8), True, None, "x"), ("2", d(-8), False, d(5), "x")], "c": [("1", d(-10), False, None, "x")],
        "d": [("1", d(-9), False, None, "x"), ("2", d(-7), False, None, "x")], "e": [("", None, True, d(3), "x")], "f": [("7", d(-9), False, d(3), "x")],
        "g": [("3", d(-9), None, d(3), "x")], "gone": [("1", d(-1), False, None, "x")],
        "left": [("1", d(-1), True, None, " one "), ("1", d(-400), False, None, "two"), ("2", None, False, None, "one")],
        "new": [("1", d(2), False, None, ""), ("1", d(3), False, None, "b"), ("1", d(3), False, None, None)], "undated": [("1", None, False, None, "q")],
    }
    second = [(v, e, *r) for v in (noon,) for e, rs in rows.items() for r in rs] + [(m(200), "a", "1", d(0), False, None, "x"), (m(-300), "a", "1", d(0), False, None, "x"), (m(-298), "a", "1", d(0), False, None, "x")]
    details = [
        ("a", d(-9), ["1"], False, [d(9), d(3)], "cell"), ("b", d(-9), ["1"], True, [d(4)], "cell"), ("c", d(-9), ["1", "2"], False, [], ""), ("d", d(-9), ["2", "3"], True, [d(1)], "x"),
        ("e", d(-9), ["1"], False, [], "x"), ("f", None, ["8"], False, [d(3)], "x"), ("h1", None, [], False, [], "cell"), ("h2", None, [], False, [], None), ("h3", None, [], False, [], ""),
    ]
    got = reconcile.reconciliation(
        spark.createDataFrame(first, "slot timestamp, entity string, held boolean"),
        spark.createDataFrame(second, "version timestamp, entity string, case_no string, book_date date, hold boolean, court_date date, authority string"),
        spark.createDataFrame(details, "entity string, start_date date, cases array<string>, hold boolean, hearings array<date>, location string"), "America/Chicago",
    ).collect()
    of = lambda part, section: {r.label: r.value for r in got if (r.part, r.section) == (part, section)}
    assert len(got) == len({(r.part, r.section, r.label) for r in got})
    assert of("versions", "all") == {"versions": 4, "aligned": 3, "unaligned": 1}
    assert of("latest", "all") == {"second": 11, "held": 16, "listed": 17, "shared": 7, "only second": 3, "only second seen before": 1, "second listed ended": 1, "only first": 9, "only first recent": 1}
    assert of("field agreement", "book date") == {"same date": 1, "second later": 1, "second earlier": 1, "several dates": 1, "date missing on one side": 2, "no record": 1}
    assert of("field agreement", "cases") == {"identical": 1, "superset": 1, "subset": 1, "overlap": 1, "missing": 1, "disjoint": 1, "no record": 1}
    assert of("field agreement", "hold") == {"neither": 3, "both": 1, "only first": 1, "only second": 1, "no record": 1}
    assert of("field agreement", "court") == {"same earliest date": 2, "other earliest date": 1, "neither lists a date": 1, "only one lists a date": 2, "no record": 1}
    assert of("second only", "authority") == {"one": 1, "not listed": 1, "q": 1}
    assert of("second only", "age") == {"more than a year": 1, "1 day or less": 1, "date missing": 1}
    assert of("second only", "hold") == {"hold": 1, "no hold": 2}
    assert of("first only", "location") == {"cell": 1, "not listed": 2, "no record": 6}
    assert of("by day", "2024-03-10") == {"versions": 3, "second": 1, "held": 17, "shared": 1, "only second": 0, "second listed ended": 0, "only first": 16}


# --- what is counted once


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_listed_entities_by_force(spark):
    rng = random.Random(5)
    cases = [(rng.randrange(40), str(rng.randrange(30))) for _ in range(300)] + [(99, None)]
    listed = [(rng.choice("abc"), str(rng.randrange(60))) for _ in range(60)] * 2 + [("a", None)]
    got = joins.listed_entities(spark.createDataFrame(cases, "entity int, case_no string"), spark.createDataFrame(listed, "family string, case_no string"), 7)
    assert got.rdd.getNumPartitions() == 7
    want = {(f, e) for f, c in listed for e, own in cases if c == own and c}
    assert sorted((r.family, r.entity) for r in got.collect()) == sorted(want)


def test_entries_of_rows_that_stand_for_several(spark):
    rows = [("g", v, n) for v, n in ((5, 3), (1, 2), (9, 1), (None, 4), (1, 1))]
    df = spark.createDataFrame(rows, "k string, v int, n int")
    got = {r.share: r.value for r in stats.index_quantiles(df, ["k"], "v", (0.25, 0.5, 0.9), times="n").collect()}
    values = [1, 1, 1, 5, 5, 5, 9]
    assert got == {s: values[int(7 * s)] for s in got} and len(got) == 3


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no driver tables")
def test_no_row_is_copied_per_count_and_timing_is_worked_out_once(spark):
    from panelspark.plans import booking_queries, join_queries, linkage_queries

    d = "/root/testdata/sf0.001"
    assert "Expand" not in plan_of(join_queries.j12_case_matches(spark, d))
    assert "Expand" not in plan_of(linkage_queries.r5_match_rates(spark, d))
    assert "l_orderkey" not in plan_of(booking_queries.c9_event_timing(spark, d))  # reads what is stored

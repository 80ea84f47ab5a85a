"""Profile of a listed population at one or more dates, and its trend metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.stats import exact_median
from ..sources.shared import stored

# fixed values: upper bounds of the bands: full years, days held, money, days until a date (a band before 0 comes first)
AGES, HELD, MONEY, AHEAD = (17, 24, 34, 44, 54, 64, 200), (6, 30, 90, 180, 365, 730, 1095, None), (1000, 5000, 10_000, 25_000, 50_000, 100_000, 250_000, None), (0, 7, 30, 90, None)
NOT_LISTED, BEFORE, NO_DATE, VIOLATION, OTHER = "not listed", "before", "no date", "violation only", "other"
FLAGS = ("start_missing_or_future", "detainer", "violation_charge", "no_bond_set")


def bands(limits: Sequence[int | None]) -> list[tuple[int | None, str]]:
    """Whole-number bands from 0 by their upper bounds, with labels such as 7-30 and 1096+."""
    lows = [0, *[x + 1 for x in limits[:-1]]]
    return [(high, f"{low}+" if high is None else str(low) if low == high else f"{low}-{high}") for low, high in zip(lows, limits, strict=True)]


def money_bands(limits: Sequence[int | None]) -> list[tuple[int | None, str]]:
    return [(x, f"over {limits[-2]}" if x is None else f"to {x}") for x in limits]


def described(rows: DataFrame, grades: Sequence[str], violations: Sequence[str]) -> DataFrame:
    """One row per listed entity with its labels, days held, flags and sum of bonds; null lists count as empty."""
    lists = {c: F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType)) for c in ("charges", "bonds", "hearings")}
    rows = rows.withColumns({**lists, "detainer": F.coalesce("detainer", F.lit(False)), "_start": F.when(F.col("start") <= F.col("as_of"), F.col("start"))})
    violation = F.coalesce(F.exists("charges", lambda c: c["grade"].isin(*violations)), F.lit(False))
    serious = S.most_serious(F.transform("charges", lambda c: c["grade"]), grades, OTHER)
    open_money = lambda b: F.coalesce((b["status"] == "open") & (b["kind"] == "assessed"), F.lit(False))
    alone = ~F.col("detainer") & ~violation & (F.col("bond_total") > 0)
    ahead = F.datediff(F.array_min("hearings"), "as_of")
    rows = rows.select(
        "as_of", "known", "sex", "race", "ethnicity", "facility", "detainer",
        F.when(F.col("birth").isNull(), NOT_LISTED).otherwise(S.band(S.age_on(F.col("birth"), F.col("as_of")), bands(AGES))).alias("age"),
        F.datediff("as_of", "_start").alias("held_days"),
        S.set_status(F.col("bonds"), lambda b: F.coalesce(b["status"] == "sentenced", F.lit(False))).alias("status"),
        F.when((serious == OTHER) & violation, VIOLATION).otherwise(serious).alias("grade"),
        F.when(alone, S.only_reason(F.col("bonds"), F.col("bond_total"), open_money)).alias("bond_total"),
        F.when(ahead.isNull(), NO_DATE).when(ahead < 0, BEFORE).otherwise(S.band(ahead, bands(AHEAD))).alias("court"),
        violation.alias("violation_charge"),
        F.coalesce(F.exists("bonds", lambda b: b["kind"] == "none set"), F.lit(False)).alias("no_bond_set"),
        F.array_distinct(F.filter(F.transform("charges", lambda c: c["description"]), lambda x: x != "")).alias("offenses"),
    )
    named = {c: F.coalesce(c, F.lit(NOT_LISTED)) for c in ("sex", "race", "ethnicity", "facility")}
    held, bond = S.band(F.col("held_days"), bands(HELD)), S.band(F.col("bond_total"), money_bands(MONEY))
    return rows.withColumns({**named, "held": held, "bond": bond, "start_missing_or_future": F.col("held_days").isNull()})


def unfolded(df: DataFrame, keys: Sequence[str], section: str, label: Column, metrics: Sequence[str]) -> DataFrame:
    """(keys, section, label, metric, value): a row for each metric column."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keys, F.lit(section).alias("section"), label.alias("label"), F.explode(cells).alias("_m")).select(*keys, "section", "label", "_m.metric", "_m.value")


def profile(listed: DataFrame, grades: Sequence[str], violations: Sequence[str], top: int = 15) -> DataFrame:
    """(as_of, section, label, metric, value) for each date: ten distributions, flags, days held, bonds, offenses.

    listed: a row per date and listed entity: as_of, known (whether it has details), sex, race, ethnicity, facility,
    birth, start, charges (grade, description), bonds (status, kind), detainer, bond_total, hearings. Bands and grades
    that nobody is in come with 0. The described rows are stored once in the shared folder and read, by the columns it
    needs, for each part; counts combine before the shuffle; the median of sums is found by ranges."""
    listed = stored(described(listed, grades, violations), "profile")
    roster = listed.groupBy("as_of").agg(F.count("*").alias("listed"), F.count_if("known").alias("people")).withColumn("missing_details", F.col("listed") - F.col("people"))
    rows = listed.where("known")
    dims = ["sex", "race", "ethnicity", "facility", "age", "held", "status", "grade", "bond", "court"]
    whole = {"age": [x for _, x in bands(AGES)] + [NOT_LISTED], "held": [x for _, x in bands(HELD)], "grade": [*grades, VIOLATION, OTHER], "bond": [x for _, x in money_bands(MONEY)], "court": [BEFORE, *[x for _, x in bands(AHEAD)], NO_DATE]}
    pair = lambda k, c, n: F.struct(F.lit(k).alias("section"), c.alias("label"), F.lit(n).alias("n"))
    each = rows.select("as_of", F.explode(F.array(*[pair(k, F.col(k), 1) for k in dims])).alias("p"))
    none = roster.select("as_of", F.explode(F.array(*[pair(k, F.lit(x), 0) for k, xs in whole.items() for x in xs])).alias("p"))
    counts = each.union(none).where("p.label IS NOT NULL").groupBy("as_of", "p.section", "p.label").agg(F.sum("p.n").cast("double").alias("value"))
    counts = counts.select("as_of", "section", "label", F.lit("n").alias("metric"), "value")

    days, total = F.col("held_days"), F.col("bond_total")
    totals = rows.groupBy("as_of").agg(
        F.median(days).alias("median_days"), F.count_if(days > 365).alias("_year"), F.count_if(days > 730).alias("_two"), F.count("*").alias("_n"), *[F.count_if(F.col(c)).alias(c) for c in FLAGS],
        F.count(total).alias("people"), F.count_if(total <= 5000).alias("at_most_5000"), F.count_if(total <= 10_000).alias("at_most_10000"),
    )
    totals = totals.withColumns({"over_year_share": F.round(F.col("_year") / F.col("_n"), 6), "over_two_years_share": F.round(F.col("_two") / F.col("_n"), 6)})
    by_status = rows.where(days.isNotNull()).groupBy("as_of", "status").agg(F.count("*").alias("people"), F.median(days).alias("median_days"), F.count_if(days > 365).alias("over_year"))
    middle = exact_median(rows, ["as_of"], "bond_total").select("as_of", F.round("median", 6).alias("median"))
    offenses = rows.select("as_of", F.explode("offenses").alias("label")).groupBy("as_of", "label").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("as_of").orderBy(F.desc("n"), "label"))
    offenses = offenses.withColumn("_r", rank).where(F.col("_r") <= top)

    key, every = ["as_of"], F.lit("all")
    parts = [
        unfolded(roster, key, "people", every, ["listed", "people", "missing_details"]),
        unfolded(totals, key, "held_days", every, ["median_days", "over_year_share", "over_two_years_share"]),
        unfolded(by_status, key, "held_by_status", F.col("status"), ["people", "median_days", "over_year"]),
        unfolded(totals, key, "flags", every, FLAGS),
        unfolded(totals, key, "bond_alone", every, ["people", "at_most_5000", "at_most_10000"]),
        unfolded(middle, key, "bond_alone", every, ["median"]),
        unfolded(offenses, key, "offenses", F.col("label"), ["n"]),
    ]
    for p in parts:
        counts = counts.union(p)
    return counts.where("value IS NOT NULL")


def daily_flows(visits: DataFrame, seen: str = "first_seen", end: str = "end_date") -> DataFrame:
    """(day, first_seen, released) of the complete days: those between the first and the last day of sightings.

    Entities of the first sighting were there before and don't count as new."""
    span = visits.agg(F.min(seen).alias("_first"), F.max(seen).alias("_last"))  # one row
    moves = F.array(F.struct(F.col(seen).alias("day"), F.lit(1).alias("a"), F.lit(0).alias("z")), F.struct(F.col(end).alias("day"), F.lit(0).alias("a"), F.lit(1).alias("z")))
    rows = visits.select(F.explode(moves).alias("m")).where("m.day IS NOT NULL").groupBy("m.day").agg(F.sum("m.a").alias("first_seen"), F.sum("m.z").alias("released"))
    return rows.crossJoin(span).where((F.col("day") > F.col("_first")) & (F.col("day") < F.col("_last"))).select("day", "first_seen", "released")


def trend_metrics(profiles: DataFrame, flows: DataFrame, felonies: Sequence[str], days: int = 7) -> DataFrame:
    """One row of 23 metrics and flow_days for each date of profile() and the daily flows of the days before it."""

    def at(section: str, metric: str = "n", *labels: str) -> Column:
        is_it = (F.col("section") == section) & (F.col("metric") == metric) & F.col("label").isin(*(labels or ("all",)))
        return F.sum(F.when(is_it, F.col("value")))

    count = lambda *a: F.coalesce(at(*a), F.lit(0.0))
    m = profiles.groupBy("as_of").agg(
        at("people", "people").alias("people"), at("held_days", "median_days").alias("held_median_days"),
        at("held_days", "over_year_share").alias("held_over_year_share"), at("held_days", "over_two_years_share").alias("held_over_two_years_share"),
        count("status", "n", "none").alias("unsentenced"), at("held_by_status", "median_days", "none").alias("unsentenced_median_days"),
        count("status", "n", "some").alias("partly_sentenced"), count("status", "n", "all").alias("all_sentenced"),
        count("grade", "n", *felonies).alias("felonies"), count("grade", "n", VIOLATION).alias("violation_only"),
        count("bond_alone", "people").alias("money_bond_only"), at("bond_alone", "median").alias("money_bond_median"),
        count("bond_alone", "at_most_5000").alias("money_bond_at_most_5000"), count("bond_alone", "at_most_10000").alias("money_bond_at_most_10000"),
        count("flags", "detainer").alias("detainer"), count("flags", "violation_charge").alias("violation_charge"), count("flags", "no_bond_set").alias("no_bond_set"),
        count("court", "n", BEFORE).alias("court_date_passed"), count("court", "n", NO_DATE).alias("court_date_missing"), count("people", "missing_details").alias("missing_details"),
    )
    share = lambda c: F.round(F.try_divide(c, "people"), 6)
    m = m.withColumns({"unsentenced_share": share("unsentenced"), "felony_share": share("felonies")}).drop("felonies")
    before = m.select("as_of", F.explode(F.sequence(F.date_sub("as_of", days), F.date_sub("as_of", 1))).alias("day"))
    recent = before.join(flows, "day").groupBy("as_of").agg(F.round(F.avg("first_seen"), 6).alias("new_per_day"), F.round(F.avg("released"), 6).alias("released_per_day"), F.count("*").cast("double").alias("flow_days"))
    return m.join(recent, "as_of", "left").withColumn("flow_days", F.coalesce("flow_days", F.lit(0.0)))

"""Profile and trend metrics on a few listed entities, worked by hand."""

import datetime as dt

from panelspark.operators import profile as P

DAY = dt.date(2020, 1, 10)
SCHEMA = "as_of date, known boolean, sex string, race string, ethnicity string, facility string, birth date, start date, charges array<struct<grade:string,description:string>>, bonds array<struct<status:string,kind:string>>, hearings array<date>, detainer boolean, bond_total double"


def cells(df):
    return {(r["section"], r["label"], r["metric"]): r["value"] for r in df.collect()}


def test_profile(spark):
    opened, done = ("open", "assessed"), ("sentenced", "assessed")
    rows = [
        (DAY, True, "M", None, "e", "n", dt.date(2000, 1, 11), DAY - dt.timedelta(400), [("A", "x"), ("B", "x")], [opened, opened], [DAY - dt.timedelta(1)], False, 5000.0),
        (DAY, True, "M", "r", "e", "n", None, DAY - dt.timedelta(7), [("V", "y")], [done, opened], [DAY, DAY + dt.timedelta(9)], False, 5000.0),
        (DAY, True, None, "r", "e", None, dt.date(2021, 1, 1), DAY + dt.timedelta(1), [], [], [], True, 10.0),
        (DAY, True, "F", "r", "e", "n", dt.date(1950, 1, 1), None, None, None, None, None, None),
        (DAY, True, "F", "r", "e", "n", dt.date(1950, 1, 1), DAY, [("B", "x")], [opened], None, None, 7001.0),
        (DAY, False, *[None] * 11),
    ]
    got = cells(P.profile(spark.createDataFrame(rows, SCHEMA), ["A", "B"], ["V"]))
    wanted = {
        ("people", "all", "listed"): 6, ("people", "all", "people"): 5, ("people", "all", "missing_details"): 1,
        ("sex", "M", "n"): 2, ("sex", "not listed", "n"): 1, ("race", "not listed", "n"): 1, ("facility", "not listed", "n"): 1,
        ("age", "18-24", "n"): 1, ("age", "not listed", "n"): 1, ("age", "65-200", "n"): 2, ("age", "0-17", "n"): 0,  # not yet born: in no band
        ("held", "366-730", "n"): 1, ("held", "7-30", "n"): 1, ("held", "0-6", "n"): 1, ("held_days", "all", "median_days"): 7, ("held_days", "all", "over_year_share"): 0.2,
        ("flags", "all", "start_missing_or_future"): 2, ("flags", "all", "detainer"): 1, ("flags", "all", "violation_charge"): 1, ("flags", "all", "no_bond_set"): 0,
        ("status", "empty", "n"): 2, ("status", "some", "n"): 1, ("status", "none", "n"): 2, ("held_by_status", "none", "people"): 2, ("held_by_status", "none", "over_year"): 1,
        ("grade", "A", "n"): 1, ("grade", "B", "n"): 1, ("grade", "violation only", "n"): 1, ("grade", "other", "n"): 2,
        ("bond_alone", "all", "people"): 2, ("bond_alone", "all", "median"): 6000.5, ("bond_alone", "all", "at_most_5000"): 1, ("bond", "to 5000", "n"): 1, ("bond", "to 10000", "n"): 1,
        ("court", "before", "n"): 1, ("court", "0", "n"): 1, ("court", "no date", "n"): 3, ("offenses", "x", "n"): 2, ("offenses", "y", "n"): 1,
    }
    assert {k: got.get(k) for k in wanted} == wanted
    assert ("held_by_status", "empty", "people") not in got


def test_profile_of_nobody(spark):
    assert P.profile(spark.createDataFrame([], SCHEMA), ["A"], ["V"]).count() == 0


def test_flows_and_metrics(spark):
    d = lambda k: dt.date(2020, 1, 1) + dt.timedelta(k)
    visits = spark.createDataFrame([(d(0), d(5)), (d(4), None), (d(4), d(9)), (d(5), d(20)), (d(9), None)], "first_seen date, end_date date")
    flows = P.daily_flows(visits)
    assert sorted(map(tuple, flows.collect())) == [(d(4), 2, 0), (d(5), 1, 1)]  # the first and last day are not complete
    row = (DAY, True, *[None] * 11)
    m = P.trend_metrics(P.profile(spark.createDataFrame([row], SCHEMA), ["A"], ["V"]), flows, ["A"]).first()
    assert (m["people"], m["new_per_day"], m["released_per_day"], m["flow_days"]) == (1, 1.5, 0.5, 2)
    assert m["unsentenced_median_days"] is None and m["court_date_missing"] == 1 and m["felony_share"] == 0
    assert len(m) == 25  # as_of, 23 metrics, flow_days

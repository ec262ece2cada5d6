import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from flowcube.functions.timecalc import rounded_ratio
from flowcube.operators import calendar as cal
from flowcube.operators import events as ev
from flowcube.operators import intervals as iv
from flowcube.operators import planning as pl


def series(spark, counts, start=dt.date(2026, 6, 1), team="G"):
    rows = [(team, start + dt.timedelta(days=i), n) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "team string, day date, total_commits long")


def test_silences_and_marker_sides(spark):
    # runs of 2, 3 and 8 zero days; the 8-day run crosses the marker
    counts = [1, 0, 0, 1, 0, 0, 0, 2, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0]
    cad = series(spark, counts)
    marker = "2026-06-12"
    runs = sorted((r["from_day"].day, r["days"], r["side"]) for r in cal.silences(cad, 3, marker).collect())
    assert runs == [(5, 3, "before"), (9, 8, "neither"), (18, 4, "after")]
    s = cal.silence_summary(cad, 3, marker).collect()[0]
    assert s["silences"] == 1 and s["longest_days"] == 3
    assert s["longest_after_days"] == 4
    assert s["days"] == 12 and s["commits"] == 4 and s["days_with_commits"] == 3


def test_daily_cadence_keeps_zero_days(spark):
    commits = spark.createDataFrame(
        [("A", 1, 1, dt.datetime(2026, 6, 1, 10), dt.datetime(2026, 6, 1, 10), False),
         ("A", 2, 1, dt.datetime(2026, 6, 4, 10), dt.datetime(2026, 6, 4, 10), False),
         ("A", 3, 1, dt.datetime(2026, 6, 2, 10), dt.datetime(2026, 6, 2, 10), True),
         ("B", 4, 2, dt.datetime(2026, 5, 1, 10), dt.datetime(2026, 5, 1, 10), False)],
        "team string, commit_id long, author_id long, authored_at timestamp_ntz, committed_at timestamp_ntz, "
        "is_merge boolean")
    teams = spark.createDataFrame([("A", dt.datetime(2026, 5, 30)), ("B", dt.datetime(2026, 5, 30))],
                                  "team string, created_at timestamp_ntz")
    out = sorted((r["team"], r["day"].day, r["total_commits"]) for r in cal.daily_cadence(commits, teams).collect())
    assert out == [("A", 1, 1), ("A", 2, 0), ("A", 3, 0), ("A", 4, 1),
                   ("B", 1, 0), ("B", 2, 0), ("B", 3, 0), ("B", 4, 0)]


def test_exact_median_even_and_odd(spark):
    data = {"odd": [5.0, 1.0, 3.0, 3.0, 10.0], "even": [4.0, 1.0, 2.0, 8.0], "one": [7.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "g string, x double")
    got = {r["g"]: r["median"] for r in pl.exact_median(df, ["g"], "x").collect()}
    assert got == {k: statistics.median(v) for k, v in data.items()}


def test_rounded_ratio_is_exact_half_away(spark):
    df = spark.createDataFrame([(285, 1000), (-285, 1000), (1005, 1000), (1, 3), (5, 10)], "n long, d long")
    got = [r[0] for r in df.select(rounded_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [0.29, -0.29, 1.01, 0.33, 0.5]


def raw_events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, team string, card long, action string, column string, "
                                       "person string, occurred_at timestamp_ntz")


BOARD = [("G", "Scrum Board", 0, "Backlog"), ("G", "Scrum Board", 1, "Doing"), ("G", "Other", 0, "Doing")]


def test_dedupe_and_classify(spark):
    t = dt.datetime(2026, 6, 1, 9)
    rows = [(1, "G", 1, "add", None, "p", t), (2, "G", 1, "add", None, "p", t), (3, "G", 1, "add", None, "p", t),
            (4, "G", 1, "add", "Doing", "ci-runner", t), (5, "G", 1, "add", "ART. 5", "p", t),
            (6, "G", 1, "add", "  ", "p", t)]
    d = ev.dedupe_events(raw_events(spark, rows))
    assert sorted(r["event_id"] for r in d.collect()) == [1, 4, 5, 6]
    board = spark.createDataFrame(BOARD, "team string, board string, position int, column string")
    c = {r["event_id"]: r for r in ev.classify_events(d, board).collect()}
    assert c[1]["kind"] == ev.KIND_UNKNOWN and c[6]["kind"] == ev.KIND_UNKNOWN
    assert c[4]["kind"] == ev.KIND_MOVE and c[4]["is_bot"] == 1  # one row despite two boards with 'Doing'
    assert c[5]["kind"] == ev.KIND_LABEL and c[5]["canonical_label"] == "ART-05"


def test_interval_end_kinds(spark):
    h = lambda x: dt.datetime(2026, 6, 1) + dt.timedelta(hours=x)
    rows = [(1, "G", 1, "add", "Backlog", "p", h(0)), (2, "G", 1, "remove", "Backlog", "p", h(10)),
            (3, "G", 1, "add", "Backlog", "p", h(20)),                 # no exit, card closed later
            (4, "G", 2, "add", "Doing", "p", h(5)),                    # no exit, card still open
            (5, "G", 3, "remove", "Doing", "p", h(1)),                 # exit without entry: dropped
            (6, "G", 4, "add", "Doing", "p", h(30))]                   # closed before the entry: cut-off
    board = spark.createDataFrame(BOARD[:2], "team string, board string, position int, column string")
    cards = spark.createDataFrame([("G", 1, h(50), "S1"), ("G", 2, None, None), ("G", 3, None, "S1"),
                                   ("G", 4, h(29), "S1")],
                                  "team string, card long, closed_at timestamp_ntz, sprint string")
    cut = spark.createDataFrame([(h(100),)], "cutoff timestamp_ntz")
    it = iv.pair_intervals(iv.stage_moves(raw_events(spark, rows), board), cards, cut)
    got = sorted((r["card"], r["n"], r["end_kind"], r["left_at"]) for r in it.collect())
    assert got == [(1, 1, iv.END_EXIT, h(10)), (1, 2, iv.END_CLOSED, h(50)),
                   (2, 1, iv.END_CUTOFF, h(100)), (4, 1, iv.END_CUTOFF, h(100))]
    s = {(r["sprint"], r["stage"]): r for r in iv.dwell_summary(it, 48.0).collect()}
    assert s[("S1", "Backlog")]["hours_total"] == 40.0
    assert s[("(sem sprint)", "Doing")]["cards_over_limit"] == 1
    sc = iv.stage_cards(it, 48.0, team="G", stage="Backlog").collect()
    assert len(sc) == 1 and sc[0]["passes"] == 2 and sc[0]["end_kinds"] == f"{iv.END_EXIT},{iv.END_CLOSED}"


def test_sprint_assignment_by_date(spark):
    t = dt.datetime
    rows = [(1, "G", 1, "add", "Doing", "p", t(2024, 1, 5, 23)), (2, "G", 1, "add", "Doing", "p", t(2024, 1, 6, 1))]
    cal_df = spark.createDataFrame([("S1", dt.date(2024, 1, 1), dt.date(2024, 1, 5))],
                                   "sprint string, start_date date, end_date date")
    got = {r["event_id"]: (r["sprint"], r["calendar_origin"])
           for r in ev.assign_period(raw_events(spark, rows), cal_df, "occurred_at", "G3").collect()}
    assert got == {1: ("S1", "G3"), 2: (None, None)}
    assert ev.calendar_overlaps(cal_df).count() == 0

"""Calendars, daily cadence and runs of silence.

Canonical inputs:

* ``commits``  team, commit_id, author_id, authored_at, committed_at, is_merge,
  lines_added, lines_removed, lines_total, title
* ``teams``    team, created_at

Scale notes: commits are aggregated to (team, day) before anything touches
the calendar, so the dense grid is |teams| × |days| rows regardless of the
commit volume.  The gaps-and-islands step (``day - row_number``) runs per
team over that aggregated grid, which is bounded by the number of calendar
days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def authored(commits: DataFrame, teams: DataFrame) -> DataFrame:
    """Authored commits (P5): not a merge and committed on/after the team's creation."""
    return (commits.join(teams.select("team", "created_at"), "team")
                   .filter(~F.col("is_merge") & (F.col("committed_at") >= F.col("created_at")))
                   .drop("created_at"))


def dense_days(df: DataFrame, day_col: str = "day") -> DataFrame:
    """One row per day between the min and max of ``day_col``."""
    bounds = df.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


def daily_cadence(commits: DataFrame, teams: DataFrame) -> DataFrame:
    """Authored commits per team per day on a gap-free calendar (M1); zeros kept.

    The calendar spans the first to the last authored day over all teams and
    is crossed with every team, so each team gets the same days.
    """
    a = authored(commits, teams).withColumn("day", F.to_date("authored_at"))
    counts = a.groupBy("team", "day").agg(F.count(F.lit(1)).alias("total_commits"))
    # Bounds per team, then the span over all teams by a window over the team
    # rows (bounded by the number of teams); each team row is expanded to that
    # span, so the grid is |teams| × |days| by construction.  The per-day
    # counts feed both branches through one shared exchange.
    spans = counts.groupBy("team").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    every = Window.partitionBy()
    grid = (teams.select("team").join(spans, "team", "left")
                 .select("team", F.min("lo").over(every).alias("lo"), F.max("hi").over(every).alias("hi"))
                 .select("team", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day")))
    return (grid.join(counts, ["team", "day"], "left")
                .select("team", "day", F.coalesce("total_commits", F.lit(0)).cast("bigint").alias("total_commits")))


def daily_peak(cadence: DataFrame) -> DataFrame:
    """Busiest day per team (O8); ties go to the earliest day."""
    w = Window.partitionBy("team").orderBy(F.col("total_commits").desc(), F.col("day").asc())
    return (cadence.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                   .select("team", F.col("day").alias("peak_day"), F.col("total_commits").alias("peak_commits")))


def weekday_profile(cadence: DataFrame) -> DataFrame:
    """Commits and calendar days per ISO weekday (1 = Monday) per team."""
    return (cadence.withColumn("weekday", F.weekday("day") + 1)
                   .groupBy("team", "weekday")
                   .agg(F.sum("total_commits").cast("bigint").alias("commits"),
                        F.count(F.lit(1)).alias("days"),
                        F.count_if(F.col("total_commits") > 0).alias("active_days")))


def zero_runs(cadence: DataFrame, marker=None) -> DataFrame:
    """Every run of consecutive zero days per team (W10), with its side of ``marker``.

    Island key = day − row_number over the zero days; a run is ``before`` the
    marker only if it ends on/before it, ``after`` only if it starts after it,
    otherwise ``neither`` (a run crossing the marker).
    """
    zeros = cadence.filter(F.col("total_commits") == 0)
    w = Window.partitionBy("team").orderBy("day")
    runs = (zeros.withColumn("island", F.date_sub("day", F.row_number().over(w).cast("int")))
                 .groupBy("team", "island")
                 .agg(F.min("day").alias("from_day"), F.max("day").alias("to_day"),
                      F.count(F.lit(1)).alias("days"))
                 .drop("island"))
    if marker is None:
        return runs.withColumn("side", F.lit("before"))
    m = F.lit(marker).cast("date")
    side = (F.when(F.col("to_day") <= m, "before").when(F.col("from_day") > m, "after").otherwise("neither"))
    return runs.withColumn("side", side)


def silences(cadence: DataFrame, min_days: int = 3, marker=None) -> DataFrame:
    """Runs of at least ``min_days`` days without commits (M3)."""
    return zero_runs(cadence, marker).filter(F.col("days") >= min_days) \
        .select("team", "from_day", "to_day", "days", "side")


def silence_summary(cadence: DataFrame, min_days: int = 3, marker=None) -> DataFrame:
    """Per team up to the marker: silences, longest run (ties -> the later one), longest
    run after the marker, commits, days and days with a record (W11)."""
    runs = zero_runs(cadence, marker)
    before = runs.filter(F.col("side") == "before")
    after = runs.filter(F.col("side") == "after")
    b = before.groupBy("team").agg(
        F.count_if(F.col("days") >= min_days).alias("silences"),
        F.max(F.struct("days", "from_day", "to_day")).alias("longest"))
    a = after.groupBy("team").agg(F.max("days").alias("longest_after_days"))
    upto = cadence if marker is None else cadence.filter(F.col("day") <= F.lit(marker).cast("date"))
    c = upto.groupBy("team").agg(F.sum("total_commits").cast("bigint").alias("commits"),
                                 F.count(F.lit(1)).alias("days"),
                                 F.count_if(F.col("total_commits") > 0).alias("days_with_commits"))
    teams = cadence.select("team").distinct()
    return (teams.join(c, "team", "left").join(b, "team", "left").join(a, "team", "left")
                 .select("team", F.coalesce("silences", F.lit(0)).cast("bigint").alias("silences"),
                         F.col("longest.days").alias("longest_days"),
                         F.col("longest.from_day").alias("longest_from"),
                         F.col("longest.to_day").alias("longest_to"),
                         "longest_after_days", "commits", "days", "days_with_commits"))


def day_detail(commits: DataFrame, team: str, day: str) -> DataFrame:
    """Non-merge commits of one team on one local day (M2).

    ``to_date(ts) = d`` is rewritten by Spark into a timestamp range, which
    reaches the Parquet scan as a pushed filter.
    """
    return (commits.filter((F.col("team") == team) & (F.to_date("authored_at") == F.lit(day).cast("date"))
                           & ~F.col("is_merge"))
                   .select("commit_id", "author_id", "authored_at", "title",
                           "lines_added", "lines_removed", "lines_total"))


def excluded_history(commits: DataFrame, teams: DataFrame) -> DataFrame:
    """Records left out of the cadence per team (A30): merges after creation, and the
    inherited history (committed before creation) with its first and last day."""
    j = commits.join(teams.select("team", "created_at"), "team")
    inherited = F.col("committed_at") < F.col("created_at")
    return j.groupBy("team").agg(
        F.count_if(F.col("is_merge") & ~inherited).alias("merges"),
        F.count_if(inherited).alias("inherited"),
        F.min(F.when(inherited, F.to_date("authored_at"))).alias("inherited_from"),
        F.max(F.when(inherited, F.to_date("authored_at"))).alias("inherited_to"))


def batch_closings(cards: DataFrame, min_size: int = 5) -> DataFrame:
    """Closings recorded in batches (A27): ≥ ``min_size`` cards closed in the same minute."""
    per_min = (cards.filter(F.col("closed_at").isNotNull())
                    .groupBy("team", F.date_trunc("minute", "closed_at").alias("minute"))
                    .agg(F.count(F.lit(1)).alias("n"))
                    .filter(F.col("n") >= min_size))
    return per_min.groupBy("team").agg(F.count(F.lit(1)).alias("batches"),
                                       F.sum("n").cast("bigint").alias("closings_in_batches"))


def cutoff(*stamps: DataFrame) -> DataFrame:
    """Data cut-off (A12): the latest instant over several sources, each given as a
    one-column DataFrame of timestamps.  Each source is reduced to its max first."""
    maxes = [s.agg(F.max(s.columns[0]).cast("timestamp_ntz").alias("ts")) for s in stamps]
    u = maxes[0]
    for m in maxes[1:]:
        u = u.unionByName(m)
    return u.agg(F.max("ts").alias("cutoff"))


def recent_window(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days counted back from the latest record, not from today."""
    latest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) > latest - F.make_dt_interval(F.lit(days)))

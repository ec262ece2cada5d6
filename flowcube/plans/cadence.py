"""Calendar, cadence and silence keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowcube.operators import calendar as cal
from flowcube.plans import standins as si
from flowcube.operators.materialize import materialize
from flowcube.sources.tables import Tables

DETAIL_TEAM = "AMERICA"
DETAIL_DAY = "1996-03-15"
RECENT_DAYS = 30


def _cadence(t):
    """Team × day grid (bounded by teams × calendar days), written once for its readers."""
    return materialize(cal.daily_cadence(si.commits(t), si.teams(t)))


def q_authored_filter(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cal.authored(si.commits(t), si.teams(t)).select("team", "commit_id", "author_id", "authored_at")


def q_excluded_history(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cal.excluded_history(si.commits(t), si.teams(t))


def q_daily_cadence(spark, sf_dir):
    return _cadence(Tables(spark, sf_dir))


def q_daily_peak(spark, sf_dir):
    return cal.daily_peak(_cadence(Tables(spark, sf_dir)))


def q_weekday_profile(spark, sf_dir):
    return cal.weekday_profile(_cadence(Tables(spark, sf_dir)))


def q_silences(spark, sf_dir):
    return cal.silences(_cadence(Tables(spark, sf_dir)), 3, si.SILENCE_MARKER)


def q_silence_summary(spark, sf_dir):
    return cal.silence_summary(_cadence(Tables(spark, sf_dir)), 3, si.SILENCE_MARKER)


def q_day_detail(spark, sf_dir):
    return cal.day_detail(si.commits(Tables(spark, sf_dir)), DETAIL_TEAM, DETAIL_DAY)


def q_batch_closings(spark, sf_dir):
    return cal.batch_closings(si.cards(Tables(spark, sf_dir)), 5)


def q_cutoff(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cal.cutoff(t.events.select("ts"), t.orders.select("o_orderdate"), t.lineitem.select("l_shipdate"))


def q_recent_window(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cal.recent_window(si.commits(t), "authored_at", RECENT_DAYS).select("team", "commit_id", "authored_at")


QUERIES = {
    "authored_filter": q_authored_filter,
    "excluded_history": q_excluded_history,
    "daily_cadence": q_daily_cadence,
    "daily_peak": q_daily_peak,
    "weekday_profile": q_weekday_profile,
    "silences": q_silences,
    "silence_summary": q_silence_summary,
    "day_detail": q_day_detail,
    "batch_closings": q_batch_closings,
    "cutoff": q_cutoff,
    "recent_window": q_recent_window,
}

_W = "WITH " + si.COMMITS_SQL
CADENCE = _W + """,
authored_ AS (SELECT c.* FROM commits_ c JOIN teams_ g ON g.team = c.team
              WHERE c.committed_at >= g.created_at AND NOT c.is_merge),
counts_ AS (SELECT team, CAST(authored_at AS DATE) AS day, count(*) AS n FROM authored_ GROUP BY 1, 2),
days_ AS (SELECT CAST(range AS DATE) AS day FROM range((SELECT min(day) FROM counts_),
          (SELECT max(day) FROM counts_) + INTERVAL 1 DAY, INTERVAL 1 DAY)),
cadence AS (SELECT g.team, d.day, CAST(coalesce(c.n, 0) AS BIGINT) AS total_commits
            FROM teams_ g CROSS JOIN days_ d LEFT JOIN counts_ c ON c.team = g.team AND c.day = d.day),
runs AS (SELECT team, min(day) AS from_day, max(day) AS to_day, count(*) AS days
         FROM (SELECT team, day, day - CAST(row_number() OVER (PARTITION BY team ORDER BY day) AS INTEGER) AS island
               FROM cadence WHERE total_commits = 0) GROUP BY team, island),
sruns AS (SELECT *, CASE WHEN to_day <= DATE '2001-03-31' THEN 'before'
                         WHEN from_day > DATE '2001-03-31' THEN 'after' ELSE 'neither' END AS side FROM runs)
"""

ORACLE = {
    "authored_filter": CADENCE + "SELECT team, commit_id, author_id, authored_at FROM authored_",
    "excluded_history": _W + """
        SELECT c.team, count(*) FILTER (WHERE is_merge AND NOT committed_at < created_at) AS merges,
               count(*) FILTER (WHERE committed_at < created_at) AS inherited,
               min(CASE WHEN committed_at < created_at THEN CAST(authored_at AS DATE) END) AS inherited_from,
               max(CASE WHEN committed_at < created_at THEN CAST(authored_at AS DATE) END) AS inherited_to
        FROM commits_ c JOIN teams_ g ON g.team = c.team GROUP BY c.team""",
    "daily_cadence": CADENCE + "SELECT * FROM cadence",
    "daily_peak": CADENCE + """
        SELECT team, day AS peak_day, total_commits AS peak_commits FROM (
          SELECT *, row_number() OVER (PARTITION BY team ORDER BY total_commits DESC, day ASC) AS rn FROM cadence)
        WHERE rn = 1""",
    "weekday_profile": CADENCE + """
        SELECT team, isodow(day) AS weekday, CAST(sum(total_commits) AS BIGINT) AS commits, count(*) AS days,
               count(*) FILTER (WHERE total_commits > 0) AS active_days
        FROM cadence GROUP BY 1, 2""",
    "silences": CADENCE + "SELECT team, from_day, to_day, days, side FROM sruns WHERE days >= 3",
    "silence_summary": CADENCE + """,
        b AS (SELECT team, count(*) FILTER (WHERE days >= 3) AS silences,
                     max({'days': days, 'from_day': from_day, 'to_day': to_day}) AS longest
              FROM sruns WHERE side = 'before' GROUP BY team),
        a AS (SELECT team, max(days) AS longest_after_days FROM sruns WHERE side = 'after' GROUP BY team),
        c AS (SELECT team, CAST(sum(total_commits) AS BIGINT) AS commits, count(*) AS days,
                     count(*) FILTER (WHERE total_commits > 0) AS days_with_commits
              FROM cadence WHERE day <= DATE '2001-03-31' GROUP BY team),
        t AS (SELECT DISTINCT team FROM cadence)
        SELECT t.team, CAST(coalesce(b.silences, 0) AS BIGINT) AS silences, b.longest.days AS longest_days,
               b.longest.from_day AS longest_from, b.longest.to_day AS longest_to, a.longest_after_days,
               c.commits, c.days, c.days_with_commits
        FROM t LEFT JOIN c USING (team) LEFT JOIN b USING (team) LEFT JOIN a USING (team)""",
    "day_detail": _W + """
        SELECT commit_id, author_id, authored_at, title, lines_added, lines_removed, lines_total
        FROM commits_ WHERE team = 'AMERICA' AND CAST(authored_at AS DATE) = DATE '1996-03-15' AND NOT is_merge""",
    "batch_closings": _W + """
        SELECT team, count(*) AS batches, CAST(sum(n) AS BIGINT) AS closings_in_batches FROM (
          SELECT team, date_trunc('minute', closed_at) AS m, count(*) AS n FROM cards_
          WHERE closed_at IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5) GROUP BY team""",
    "cutoff": """
        SELECT max(ts) AS cutoff FROM (SELECT max(ts) AS ts FROM events UNION ALL
          SELECT max(o_orderdate) FROM orders UNION ALL SELECT max(l_shipdate) FROM lineitem)""",
    "recent_window": _W + """
        SELECT team, commit_id, authored_at FROM commits_
        WHERE authored_at > (SELECT max(authored_at) FROM commits_) - INTERVAL 30 DAY""",
}

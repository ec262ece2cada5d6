"""Conformed dimensions and card facts of the dimensional model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcube.functions.timecalc import MICROS_PER_HOUR, elapsed_micros

# Portuguese month and weekday names and day-part bands of the model.
MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro",
          "outubro", "novembro", "dezembro"]
WEEKDAYS = ["segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado", "domingo"]
DAY_PARTS = [(0, 5, "Madrugada"), (6, 11, "Manha"), (12, 17, "Tarde"), (18, 23, "Noite")]
BUSINESS_HOURS = (9, 17)
# Sentinel people of the person dimension (key order 0, 1, 2) and their type;
# roster people are of type MEMBRO.
SENTINELS = [("[externo]", "EXTERNO"), ("[bot]", "BOT"), ("[desconhecido]", "DESCONHECIDO")]
MEMBER_TYPE = "MEMBRO"


def dim_date(days: DataFrame) -> DataFrame:
    """Daily calendar (D1) over the span of ``days`` (one date column named ``day``).

    Weekday 1 = Monday (``weekday()+1``, not ``dayofweek``, whose 1 is Sunday).
    """
    bounds = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    wd = F.weekday("date") + 1
    months = F.array(*[F.lit(m) for m in MONTHS])
    wdays = F.array(*[F.lit(w) for w in WEEKDAYS])
    iso_year = F.year(F.date_add("date", 3 - F.weekday("date")))
    return d.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.element_at(months, F.month("date")).alias("month_name"), F.date_format("date", "yyyy-MM").alias("year_month"),
        F.weekofyear("date").alias("iso_week"),
        F.concat(iso_year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear("date").cast("string"), 2, "0"))
         .alias("iso_year_week"),
        F.dayofmonth("date").alias("day"), wd.alias("weekday"), F.element_at(wdays, wd).alias("weekday_name"),
        (wd >= 6).alias("is_weekend"))


def dim_hour(hours: DataFrame) -> DataFrame:
    """Hour dimension (D2) from the distinct hours observed in ``hours`` (column ``hour``)."""
    h = hours.select("hour").distinct()
    part = None
    for lo, hi, name in DAY_PARTS:
        cond = F.col("hour").between(lo, hi)
        part = F.when(cond, name) if part is None else part.when(cond, name)
    lo, hi = BUSINESS_HOURS
    return h.select(F.col("hour").alias("hour_key"), "hour",
                    F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"),
                    part.alias("day_part"), F.col("hour").between(lo, hi).alias("is_business_hour"),
                    F.col("hour").between(0, 5).alias("is_small_hours"))


def card_lead_time(cards: DataFrame, events: DataFrame) -> DataFrame:
    """Card fact (D5): lead time from creation to close in exact hours, events and moves."""
    ev = events.groupBy("team", "card").agg(F.count(F.lit(1)).alias("events"),
                                            F.count_if(F.col("kind") == "MUDANCA_COLUNA").alias("moves"))
    micros = elapsed_micros("created_at", "closed_at")
    return (cards.join(ev, ["team", "card"], "left")
                 .select("team", "card", "sprint", "created_at", "closed_at",
                         F.col("closed_at").isNotNull().alias("is_closed"),
                         (micros.cast("double") / F.lit(float(MICROS_PER_HOUR))).alias("lead_time_hours"),
                         F.coalesce("events", F.lit(0)).cast("bigint").alias("events"),
                         F.coalesce("moves", F.lit(0)).cast("bigint").alias("moves")))


def dim_person(roster: DataFrame, active: DataFrame, keys: DataFrame) -> DataFrame:
    """Conformed person dimension (D3) with a stable surrogate key.

    ``roster``: person_id, origin_team, role, status.  ``active``: one ``person_id`` per fact row; it is reduced to
    distinct ids (map-side) before the flag join.  The three sentinel rows are added so facts that point at them keep
    referential integrity.  ``keys``: person_id and person_sk of the key map, which holds the sentinels and the roster.
    """
    spark = roster.sparkSession
    sent = spark.createDataFrame(
        [(p, None, None, None, True, kind) for p, kind in SENTINELS],
        "person_id string, origin_team string, role string, status string, is_sentinel boolean, person_type string")
    people = roster.select("person_id", "origin_team", "role", "status", F.lit(False).alias("is_sentinel"),
                           F.lit(MEMBER_TYPE).alias("person_type"))
    people = people.unionByName(sent)
    act = active.select("person_id").distinct().withColumn("__act", F.lit(True))
    p = people.join(keys, "person_id").join(act, "person_id", "left")
    return p.select("person_sk", "person_id", "origin_team", "role", "status",
                    "is_sentinel", "person_type", F.col("__act").isNotNull().alias("had_activity"))


def dim_team(teams: DataFrame, activity: DataFrame, roster: DataFrame) -> DataFrame:
    """Team dimension (D3): surrogate key, creation, last activity, days of life and roster size.

    ``teams``: team_sk, team, created_at.  ``activity``: team, ts (one row per fact row).
    ``roster``: team (one row per member).  Both are reduced per team
    (map-side partial aggregation) before they meet the team rows.
    """
    last = activity.groupBy("team").agg(F.max("ts").alias("last_activity_at"))
    size = roster.groupBy("team").agg(F.count(F.lit(1)).alias("members"))
    return (teams.join(last, "team", "left").join(size, "team", "left")
                 .select("team_sk", "team", "created_at", "last_activity_at",
                         F.datediff(F.to_date("last_activity_at"), F.to_date("created_at")).alias("days_of_life"),
                         F.coalesce("members", F.lit(0)).cast("bigint").alias("members")))

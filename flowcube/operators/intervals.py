"""Stage intervals, dwell and backlog (M4-M6).

Entries (``add``) and exits (``remove``) of a card in a board stage are paired
by order: the n-th entry closes on the n-th exit (T9).  Instead of a self join
on the ordinal, both actions are numbered and then pivoted in one aggregate
keyed by (team, card, stage, n).  The numbering is the skew-tolerant ordinal
of :mod:`flowcube.operators.windows`, so a card with a very long history is
numbered by several tasks.  An entry without exit
ends at the card's close if that is not before the entry, else at the data
cut-off; an exit without entry disappears.

Dwell is summed in integer microseconds and rounded once, exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.functions.timecalc import MICROS_PER_HOUR, elapsed_micros, hours, rounded_ratio
from flowcube.operators import windows
from flowcube.operators.materialize import materialize

# How an interval ended, and the no-sprint bucket.
END_EXIT = "saida registrada"
END_CLOSED = "sem saida: fechado com o cartao"
END_CUTOFF = "sem saida: aberto no corte"
NO_SPRINT = "(sem sprint)"


def stage_moves(events: DataFrame, board: DataFrame) -> DataFrame:
    """Distinct column moves (T10: distinct without the person); the board's few columns are broadcast, no event is dealt out by its stage."""
    b = board.select("team", F.col("column").alias("stage"), "position")
    return (events.withColumnRenamed("column", "stage").join(F.broadcast(b), ["team", "stage"])
                  .select("team", "card", "action", "stage", "position", "occurred_at").distinct())


def pair_intervals(moves: DataFrame, cards: DataFrame, cutoff: DataFrame) -> DataFrame:
    """One row per pass of a card through a stage, with its end and end kind (M4).

    ``cutoff`` is a one-row DataFrame with column ``cutoff`` (stays lazy: no driver round trip).
    """
    moves = materialize(moves)
    numbered = windows.ordinal(moves, ["team", "card", "stage", "action"], ["occurred_at"], "n")
    pivot = (numbered.groupBy("team", "card", "stage", "position", "n")
                     .agg(F.max(F.when(F.col("action") == "add", F.col("occurred_at"))).alias("entered_at"),
                          F.max(F.when(F.col("action") == "remove", F.col("occurred_at"))).alias("exit_at"))
                     .filter(F.col("entered_at").isNotNull()))
    c = cards.select("team", "card", "closed_at", F.coalesce("sprint", F.lit(NO_SPRINT)).alias("sprint"),
                     *[x for x in cards.columns if x in ("title", "state", "assignees")])
    j = pivot.join(c, ["team", "card"]).withColumn("cutoff", cutoff.select("cutoff").scalar())
    closed_ok = F.col("closed_at") >= F.col("entered_at")
    return j.select(
        "team", "sprint", "stage", "position", "card", "n", "entered_at",
        F.when(F.col("exit_at").isNotNull(), F.col("exit_at"))
         .when(closed_ok, F.col("closed_at")).otherwise(F.col("cutoff")).alias("left_at"),
        F.when(F.col("exit_at").isNotNull(), END_EXIT).when(closed_ok, END_CLOSED).otherwise(END_CUTOFF)
         .alias("end_kind"),
        *[x for x in c.columns if x in ("title", "state", "assignees")])


def per_card(intervals: DataFrame) -> DataFrame:
    """Dwell per card and stage, summing re-entries."""
    return (intervals.withColumn("micros", elapsed_micros("entered_at", "left_at"))
                     .groupBy("team", "sprint", "stage", "position", "card")
                     .agg(F.count(F.lit(1)).alias("passes"),
                          F.sum(F.col("micros").cast("decimal(38,0)")).alias("micros"),
                          F.count_if(F.col("end_kind") != END_EXIT).alias("without_exit"),
                          F.count_if(F.col("end_kind") == END_CUTOFF).alias("open_at_cutoff")))


def dwell_summary(intervals: DataFrame, limit_hours: float = 48.0) -> DataFrame:
    """Per team × sprint × stage: cards, passes, hours total/avg/max, cards over the
    limit, intervals without exit / open at cut-off; flag the worst stage (M4, W2)."""
    limit_micros = int(round(limit_hours * MICROS_PER_HOUR))
    p = per_card(intervals)
    r = (p.groupBy("team", "sprint", "stage", "position")
          .agg(F.count(F.lit(1)).alias("cards"), F.sum("passes").cast("bigint").alias("passes"),
               F.sum("micros").cast("decimal(38,0)").alias("micros_total"), F.max("micros").alias("micros_max"),
               F.count_if(F.col("micros") > limit_micros).alias("cards_over_limit"),
               F.sum("without_exit").cast("bigint").alias("intervals_without_exit"),
               F.sum("open_at_cutoff").cast("bigint").alias("intervals_open_at_cutoff")))
    w = Window.partitionBy("team", "sprint").orderBy(F.col("cards_over_limit").desc(), F.col("micros_total").desc())
    return r.select(
        "team", "sprint", "stage", "position", "cards", "passes",
        rounded_ratio(F.col("micros_total"), MICROS_PER_HOUR, 1).alias("hours_total"),
        rounded_ratio(F.col("micros_total"), F.col("cards") * MICROS_PER_HOUR, 1).alias("hours_avg_per_card"),
        rounded_ratio(F.col("micros_max"), MICROS_PER_HOUR, 1).alias("hours_max"),
        "cards_over_limit", "intervals_without_exit", "intervals_open_at_cutoff",
        F.lit(float(limit_hours)).alias("limit_hours"),
        (F.rank().over(w) == 1).cast("int").alias("is_worst"))


def stage_cards(intervals: DataFrame, limit_hours: float = 48.0, team: str | None = None,
                sprint: str | None = None, stage: str | None = None, with_micros: bool = False) -> DataFrame:
    """Cards of one stage (M5); a filter is applied only when its argument is set (P7).  ``with_micros`` adds
    the exact dwell in microseconds for readers that sum or compare it."""
    limit_micros = int(round(limit_hours * MICROS_PER_HOUR))
    i = intervals
    for col, val in (("team", team), ("sprint", sprint), ("stage", stage)):
        if val is not None:
            i = i.filter(F.col(col) == val)
    extra = [x for x in ("title", "state", "assignees") if x in i.columns]
    g = (i.withColumn("micros", elapsed_micros("entered_at", "left_at"))
          .groupBy("team", "sprint", "stage", "card", *extra)
          .agg(F.count(F.lit(1)).alias("passes"), F.min("entered_at").alias("first_entry"),
               F.max("left_at").alias("last_exit"), F.sum(F.col("micros").cast("decimal(38,0)")).alias("micros"),
               F.concat_ws(",", F.array_sort(F.collect_set("end_kind"))).alias("end_kinds"),
               F.count_if(F.col("end_kind") != END_EXIT).alias("intervals_without_exit"),
               F.count_if(F.col("end_kind") == END_CUTOFF).alias("intervals_open_at_cutoff")))
    exact = [F.col("micros")] if with_micros else []
    return g.select("team", "sprint", "stage", "card", *extra, *exact, "passes", "first_entry", "last_exit",
                    rounded_ratio(F.col("micros"), MICROS_PER_HOUR, 1).alias("hours_in_stage"),
                    hours(F.col("micros")).alias("hours_exact"),
                    (F.col("micros") > limit_micros).cast("int").alias("over_limit"),
                    "end_kinds", "intervals_without_exit", "intervals_open_at_cutoff")


def backlog_summary(cards_of_stages: DataFrame) -> DataFrame:
    """Per team over all sprints (M6): distinct cards, % of them over the limit in some
    stage, the worst stage (most cards over limit, then most time, then name).  Reads ``stage_cards`` with micros.

    The cards of stages are written once: intervals are not paired again for each of the two countings.
    """
    cards_of_stages = materialize(cards_of_stages.select("team", "stage", "card", "over_limit", "micros"))
    per_stage = (cards_of_stages.groupBy("team", "stage")
                 .agg(F.count_if(F.col("over_limit") == 1).alias("over"), F.sum(F.col("micros").cast("decimal(38,0)")).alias("h")))
    worst = (per_stage.groupBy("team")
             .agg(F.max(F.struct("over", "h", F.col("stage"))).alias("w")))
    # one row per card first: distinct cards, and those over the limit in any stage, are then plain counts
    t = (cards_of_stages.groupBy("team", "card").agg(F.max("over_limit").alias("over")).groupBy("team")
         .agg(F.count(F.lit(1)).alias("cards"), F.count_if(F.col("over") == 1).alias("cards_over_limit")))
    return (t.join(worst, "team")
             .select("team", "cards", "cards_over_limit",
                     F.try_divide(F.col("cards_over_limit").cast("double") * 100, F.col("cards").cast("double"))
                      .alias("pct_over_limit"),
                     F.col("w.stage").alias("worst_stage"), F.col("w.over").alias("worst_stage_cards_over")))

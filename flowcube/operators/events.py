"""Board event treatment (M21): dedupe, classify, label, sprint, sequence.

Canonical input ``card_events``: event_id, team, card, action, column, person,
occurred_at.  ``board``: team, board, position, column.  ``calendar``: sprint,
start_date, end_date.

Scale notes: the board and the sprint calendar are small, bounded
dimensions and are broadcast.  The sprint range join is turned into an
equi-join by expanding the calendar to one row per day (bounded by the
calendar's length), so it plans as a broadcast hash join instead of a nested
loop.  Sequencing does not use a per-card window (a card with a huge history
would land in one task): positions come from a range-partitioned ordinal and
the next event from an equi-join on the position.  The dedupe is a hash
aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.functions import text
from flowcube.functions.timecalc import MICROS_PER_HOUR, elapsed_micros, rounded_ratio
from flowcube.operators import windows
from flowcube.operators.materialize import materialize

# Event kinds and the calendar-origin label of the reference.
KIND_MOVE = "MUDANCA_COLUNA"
KIND_LABEL = "MARCACAO_ROTULO"
KIND_UNKNOWN = "DESCONHECIDO"

EVENT_COLS = ["team", "card", "action", "column", "person", "occurred_at"]


def dedupe_events(raw: DataFrame, cols: list[str] | None = None, id_col: str = "event_id") -> DataFrame:
    """Exact duplicates collapse to the smallest surrogate id (A7).  NULLs group together."""
    cols = cols or EVENT_COLS
    return raw.groupBy(*cols).agg(F.min(id_col).alias(id_col)).select(id_col, *cols)


def classify_events(events: DataFrame, board: DataFrame, board_name: str = "Scrum Board") -> DataFrame:
    """Column move vs label vs unknown (J12, P12, F7) and the bot flag.

    The board is filtered to one board first (T11) so a column name shared by
    several boards cannot multiply rows.
    """
    b = (board.filter(F.col("board") == board_name)
              .select("team", F.col("column").alias("__bcol"), F.col("board").alias("board_natural"),
                      F.col("position")))
    j = events.join(b, (events["team"] == b["team"]) & (events["column"] == b["__bcol"]), "left") \
              .drop(b["team"])
    empty = F.col("column").isNull() | (F.trim("column") == "")
    kind = (F.when(empty, KIND_UNKNOWN).when(F.col("__bcol").isNotNull(), KIND_MOVE).otherwise(KIND_LABEL))
    canon = text.canonical_label(F.col("column"))
    return (j.withColumn("kind", kind)
             .withColumn("is_bot", text.is_bot(F.col("person")))
             .withColumn("canonical_label", F.when(F.col("kind") == KIND_LABEL, canon))
             .withColumn("label_category",
                         F.when(F.col("kind") == KIND_LABEL, text.label_category(F.col("canonical_label"))))
             .drop("__bcol"))


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per (day, sprint) of a sprint calendar."""
    return calendar.select("sprint", F.explode(F.sequence("start_date", "end_date")).alias("__day"))


def assign_period(events: DataFrame, calendar: DataFrame, ts: str, origin: str) -> DataFrame:
    """Sprint of each event by the date of ``ts`` (J7); ``origin`` names whose calendar it is."""
    days = calendar_days(calendar)
    j = events.withColumn("__day", F.to_date(ts)).join(days, "__day", "left").drop("__day")
    has = F.col("sprint").isNotNull()
    return (j.withColumn("sprint_team", F.when(has, F.col("team")))
             .withColumn("calendar_origin", F.when(has, F.lit(origin))))


def calendar_overlaps(calendar: DataFrame) -> DataFrame:
    """Days claimed by more than one sprint (would duplicate events in J7): gate input."""
    return (calendar_days(calendar).groupBy("__day").agg(F.count(F.lit(1)).alias("sprints"))
                                   .filter(F.col("sprints") > 1).withColumnRenamed("__day", "day"))


def sequence_events(events: DataFrame, part: list[str], ts: str, tie: str) -> DataFrame:
    """Position of each event in its card and the next event's instant.

    Uses the skew-tolerant ordinal (a card with a huge history is split over
    several tasks); the lead is taken inside the same buckets.
    """
    return windows.ordinal_and_next(events, part, [ts, tie], "seq_in_card", ts, "__next")


def event_order(events: DataFrame) -> DataFrame:
    """event_id, team, card, occurred_at with the place in the card and the hours to the next event."""
    e = sequence_events(events, ["team", "card"], "occurred_at", "event_id")
    nxt = F.when(F.col("__next").isNotNull(), rounded_ratio(elapsed_micros("occurred_at", "__next"), MICROS_PER_HOUR, 2))
    return e.select("event_id", "team", "card", "occurred_at", "seq_in_card", nxt.alias("hours_to_next"))


def event_treatment(raw: DataFrame, board: DataFrame, calendar: DataFrame, calendar_team: str) -> DataFrame:
    """The treated event view (M21), one row per distinct event."""
    e = classify_events(dedupe_events(raw), board)
    # The classified log feeds the key counts, the bucket split points and the
    # ordered pass: it is written once instead of re-derived per branch.
    e = materialize(assign_period(e, calendar, "occurred_at", calendar_team))
    e = sequence_events(e, ["team", "card"], "occurred_at", "event_id")
    nxt = F.when(F.col("__next").isNotNull(),
                 rounded_ratio(elapsed_micros("occurred_at", "__next"), MICROS_PER_HOUR, 2))
    return e.select(
        "event_id", "team", "card", "person",
        F.to_date("occurred_at").alias("event_date"), F.hour("occurred_at").alias("event_hour"),
        "occurred_at", "action", "kind", "is_bot", F.col("column").alias("source_column"),
        F.when(F.col("kind") == KIND_MOVE, F.col("column")).alias("board_column"),
        "label_category", "canonical_label", "sprint_team", "sprint", "calendar_origin", "seq_in_card",
        nxt.alias("hours_to_next"), F.lit(1).alias("event_counter"))

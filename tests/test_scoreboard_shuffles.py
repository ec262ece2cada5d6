"""What the scoreboard does not shuffle: closings are read from the published cards, no card is dealt out by its size, no event by its stage."""

from pyspark.sql import functions as F

from flowcube.functions.timecalc import cents
from flowcube.operators import intervals, planning as pl
from flowcube.plans import concentration, planning, standins
from flowcube.plans import text as text_plan
from flowcube.sources.tables import Tables
from tests.test_scoreboard_inputs import data, sorted_rows  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_closings_come_from_the_published_cards(spark, data):  # noqa: F811
    t, plain = Tables(spark, data), Tables(spark, data)
    standins.write_orders_with_team(t)
    cards = standins.cards(t)
    assert sorted_rows(cards) == sorted_rows(standins.cards(plain)) and cards.filter("closed_at is not null").count() > 1
    read = str(cards.inputFiles())
    assert not any(f"{name}.parquet" in read for name in ("lineitem", "orders", "customer"))
    given = planning.coverage_flags(t, planning.card_flags(spark, t), planning.links(t))
    assert sorted_rows(given) == sorted_rows(planning.coverage_flags(plain))
    assert text_plan.citation_links(t).filter("is_dangling = 0").count() > 0


def test_sums_of_narrow_lines_equal_those_of_the_records(spark, data):  # noqa: F811
    t = Tables(spark, data)
    whole = concentration.line_records(t).groupBy("team", "sprint", "person").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("revenue_cents"), F.count_if(F.col("l_returnflag") == "R").alias("returns"))
    got = concentration.person_totals(t)
    assert sorted_rows(got.select(*whole.columns)) == sorted_rows(whole) and got.filter("sprint is null").count() > 0


def test_small_tables_are_broadcast(spark, data):  # noqa: F811
    t = Tables(spark, data)
    base = pl.card_base(planning.sized_cards(spark, t), planning.size_table(spark), planning.links(t))
    assert "hashpartitioning(size#" not in plan(base)
    moves = intervals.stage_moves(spark.createDataFrame([], "team string, card long, action string, column string, occurred_at timestamp_ntz"),
                                  standins.board_columns(spark))
    assert plan(moves).count("hashpartitioning(") == 1 and "BroadcastHashJoin" in plan(moves)

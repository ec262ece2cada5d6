"""Inputs that the scoreboard shares between its parts: same rows as the plans of their own, orders joined to customers once."""

import datetime as dt
import decimal

import pytest

from flowcube.plans import concentration, planning, standins
from flowcube.plans import text as text_plan
from flowcube.sources.tables import Tables


@pytest.fixture
def data(spark, tmp_path):
    """Cards with and without axis words and listed suppliers, repeated and null keys, lines without a part or an order."""
    day, money = dt.datetime(1996, 1, 1), decimal.Decimal("12.00")
    rows = {
        "region": ([(0, "AFRICA"), (1, "ASIA")], "r_regionkey long, r_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(1, 0), (2, 1), (None, 0)], "c_custkey long, c_nationkey long"),
        "supplier": ([(1, 0), (2, 1), (10, 0)], "s_suppkey long, s_nationkey long"),
        "part": ([(1, "red ring"), (2, "plain ring"), (3, None), (1, "cold ring")], "p_partkey long, p_name string"),
        "orders": ([(k, c, s, day, float(k or 1), p) for k, c, s, p in [
            (1, 1, "F", "1-URGENT"), (2, 2, "O", "5-LOW"), (3, 1, "P", None), (4, 9, "F", "2-HIGH"), (None, 1, "F", "1-URGENT"), (2, 1, "F", "2-HIGH")]],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_totalprice double, o_orderpriority string"),
        "lineitem": ([(k, n, p, s, 1.0, float(money), "R", day) for k, n, p, s in [
            (1, 1, 1, 1), (1, 3, 2, 2), (2, 1, 2, 10), (2, 2, 2, 2), (3, 5, 2, 1), (3, 1, 8, 1), (4, 1, 1, 1), (None, 1, 1, 1), (7, 1, 1, 1), (3, 2, 3, None)]],
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


def test_flags_of_cards_equal_flags_of_lines(spark, data):
    plain = sorted_rows(planning.coverage_flags(Tables(spark, data)))
    t = Tables(spark, data)
    standins.write_orders_with_team(t)
    assert sorted_rows(planning.coverage_flags(t, planning.card_flags(spark, t))) == plain and len(plain) > 5


def test_written_orders_give_the_same_commits_cards_and_links(spark, data):
    t, plain = Tables(spark, data), Tables(spark, data)
    standins.write_orders_with_team(t)
    for build in (standins.commits, standins.cards, text_plan.card_keys):
        assert sorted_rows(build(t)) == sorted_rows(build(plain))
        assert "customer.parquet" not in str(build(t).inputFiles()) and "customer.parquet" in str(build(plain).inputFiles())
    narrow = text_plan._citation_links(t, without=("cited_in", "authored_at", "title"))
    whole = text_plan.citation_links(plain)
    assert whole.columns == ["team", "card", "cited_number", "is_dangling", "cited_in", "commit_id", "author_id", "authored_at", "title", "lines_added", "lines_removed"]
    assert sorted_rows(narrow) == sorted_rows(whole.drop("cited_in", "authored_at", "title"))

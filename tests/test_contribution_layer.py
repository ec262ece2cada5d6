import re
import shutil
import statistics

import pytest
from pyspark.sql import functions as F

from flowcube.operators import planning as pl
from flowcube.plans import concentration as conc
from flowcube.sources import published
from flowcube.sources.tables import Tables
from tests.conftest import SF_SMALL


@pytest.fixture
def data(tmp_path):
    for name in conc.INPUTS:
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def versions(spark, data):
    return published.versions(spark, published.root_of(spark, "contribution", data))


def test_layer_is_published_once_and_not_with_a_false_gate(spark, data, monkeypatch):
    totals = conc.sl.slice_totals
    with monkeypatch.context() as m:
        m.setattr(conc.sl, "slice_totals", lambda *a, **k: totals(*a, **k).filter(F.col("value") % 2 == 0))
        with pytest.raises(published.GateError, match="total_items_eq_items"):
            conc.q_gini_concentration(spark, data)
    assert versions(spark, data) == []
    first = conc.q_gini_concentration(spark, data).count()
    conc.q_axis_share(spark, data)
    conc._READ.clear()  # as another application would
    assert conc.q_gini_concentration(spark, data).count() == first > 100
    assert len(versions(spark, data)) == 1


def test_cards_of_two_assignees_count_for_both_and_once_for_the_group(spark):
    t = Tables(spark, SF_SMALL)
    cards = conc.axis_cards(spark, t).filter("is_member = 1 and n_axes > 0")
    bridge = conc.assigned(cards).join(conc.members(t), ["team", "person"], "left_semi")
    assert bridge.filter("n_people = 2").count() > 0
    whole, units = conc.axis_sums(spark, t)
    whole, units = whole.filter("slice = '(todas)'"), units.filter("slice = '(todas)'")
    group = "who = '(grupo)'"
    assert whole.filter(group).agg(F.sum("cards_total")).first()[0] == cards.count()
    assert whole.filter(f"not {group}").agg(F.sum("cards_total")).first()[0] == bridge.count() > cards.count() - 1
    # units: a whole card for the group, the members' shares of it otherwise
    assert units.filter(group).agg(F.sum("units")).first()[0] == cards.count() * conc.UNITS
    want = bridge.agg(F.sum(F.expr(f"{conc.UNITS} div n_people"))).first()[0]
    assert units.filter(f"not {group}").agg(F.sum("units")).first()[0] == want


def test_medians_of_several_columns(spark):
    rows = [("a", 1.0, 5), ("a", 2.0, None), ("a", 10.0, 8), ("b", None, 3), ("b", 4.0, 4)]
    out = pl.exact_medians(spark.createDataFrame(rows, "g string, x double, y bigint"), ["g"], {"mx": "x", "my": "y"})
    got = {r.g: (r.mx, r.my) for r in out.collect()}
    assert got == {g: tuple(statistics.median([r[i] for r in rows if r[0] == g and r[i] is not None]) for i in (1, 2)) for g in "ab"}


def joins(df):
    """Left keys of the shuffled joins, the last one first."""
    return re.findall(r"SortMergeJoin \[(\w+)#", df._jdf.queryExecution().executedPlan().toString())


def test_lines_are_shuffled_by_order_and_never_by_customer(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joins(conc.line_records(Tables(spark, SF_SMALL))) == ["l_orderkey", "o_custkey"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_card_is_closed_by_a_line_shipped_on_the_first_date_of_its_number(spark, tmp_path):
    for name in conc.INPUTS:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0 if name in ("orders", "lineitem") else 10 ** 6).write.parquet(
            f"{tmp_path}/{name}.parquet")
    day = "timestamp_ntz'1996-01-0{}'".format
    orders = [(1, day(5)), (1, day(2)), (2, day(5)), (3, day(1)), (4, day(5))]
    spark.sql(" union all ".join(f"select bigint({k}) o_orderkey, bigint(1) o_custkey, 'F' o_orderstatus, 1d o_totalprice, {d} o_orderdate, "
                                 "'1-URGENT' o_orderpriority" for k, d in orders)).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 7, day(3)), (2, 8, day(3)), (4, 999999, day(6)), (None, 7, day(9))]  # card 4: a part that is not listed
    spark.sql(" union all ".join(f"select bigint({k or 'null'}) l_orderkey, bigint({p}) l_partkey, bigint(1) l_suppkey, 1 l_linenumber, 1d l_quantity, "
                                 f"1d l_extendedprice, 0d l_discount, 0d l_tax, 'R' l_returnflag, 'F' l_linestatus, {d} l_shipdate"
                                 for k, p, d in lines)).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted((r.card, r.state, r.assignee, r.labels is None) for r in conc.axis_cards(spark, Tables(spark, str(tmp_path))).collect())
    assert got == [(1, "fechado", "1", False)] * 2 + [(2, "aberto", "1", False), (3, "aberto", "(vazio)", True), (4, "fechado", "(vazio)", True)]

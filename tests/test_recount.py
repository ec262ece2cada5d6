import random
import statistics

import pytest
from pyspark.sql import functions as F

from flowcube.operators import recount
from flowcube.plans import facts
from flowcube.sources.tables import Tables

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(2)
    return {"one": [7], "two": [-5, 10**15], "ties": [3] * 50 + [4] * 50, "wide": [rng.randint(-10**17, 10**17) for _ in range(301)],
            "near": [10**12 + rng.randint(0, 5000) for _ in range(400)], "zero": [0, 0, 0]}


@pytest.fixture(scope="module")
def df(spark, groups):
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None)]
    return spark.createDataFrame(rows, "g string, v bigint").repartition(7)


def test_middle_values_equal_a_sorted_list(df, groups):
    got = {r.g: (r.low_middle, r.high_middle) for r in recount.middle(df, ["g"], "v").collect()}
    assert got == {g: (statistics.median_low(vs), statistics.median_high(vs)) for g, vs in groups.items()}


def test_largest_merges_states_of_tasks(df, groups):
    got = {r.g: r.largest for r in recount.largest(df, ["g"], "v", 3).collect()}
    assert got == {g: sorted(vs, reverse=True)[:3] for g, vs in groups.items()}


def test_pair_differences_equal_all_pairs(spark, groups):
    rows = [(g, abs(v)) for g, vs in groups.items() for v in vs]
    sizes = spark.createDataFrame([(g, len(vs) + 4) for g, vs in groups.items()], "g string, members bigint")
    out = recount.pair_differences(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v", sizes).collect()
    assert len(out) == len(groups)
    for r in out:
        vs = [abs(v) for v in groups[r.g]] + [0] * 4
        pairs = sum(abs(a - b) for i, a in enumerate(vs) for b in vs[:i])
        assert (r.members, int(r.total), int(r.differences)) == (len(vs), sum(vs), pairs)


def test_empty_input(spark):
    none = spark.createDataFrame([], "g string, v bigint")
    assert recount.middle(none, ["g"], "v").count() == 0
    assert recount.largest(none, ["g"], "v", 2).count() == 0
    assert recount.pair_differences(none, ["g"], "v").count() == 0


def test_every_gate_can_fail(spark):
    """Either side broken by one figure, a missing or a changed one, turns exactly its gates false."""
    tables = facts.recount_tables(spark, Tables(spark, SF_SMALL))
    gates = {r.gate: r.ok for r in facts.recount_gates(tables).collect()}
    assert len(gates) == 8 and all(gates.values())
    broken = {}
    for name, (first, second, keys, value) in tables.items():
        key = second.orderBy(*keys).first()[keys[0]]
        wrong = second.withColumn(value, F.when(F.col(keys[0]) == key, F.lit(None)).otherwise(F.col(value)))
        broken[name] = (first, wrong, keys, value)
    gates = {r.gate: r.ok for r in facts.recount_gates(broken).collect()}
    assert [g for g, ok in gates.items() if not ok] == [f"{name}_that_differ" for name in tables]
    lost = {name: (first.limit(1), second, keys, value) for name, (first, second, keys, value) in tables.items()}
    assert not any(r.ok for r in facts.recount_gates(lost).collect())

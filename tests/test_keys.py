import pytest
from pyspark.sql import functions as F

from flowcube.operators import keymap
from flowcube.plans import facts, keys
from flowcube.sources import published
from flowcube.sources.tables import Tables
from tests.conftest import SF_SMALL


def load(spark, root, mark, people):
    df = spark.createDataFrame(people, "person string, place bigint")
    return {r.person: r.sk for r in keymap.extend(df, ["person"], ["place"], root, mark).collect()}


def test_new_members_shift_no_key(spark, tmp_path):
    root = str(tmp_path / "keys")
    first = load(spark, root, "a", [("ann", 5), ("bob", 7), ("bob", 7), ("cid", 9)])
    assert first == {"ann": 1, "bob": 2, "cid": 3}
    # a smaller place than all others, and one member gone
    second = load(spark, root, "b", [("abe", 1), ("bob", 7), ("cid", 9), ("dan", 8)])
    assert second == {**first, "abe": 4, "dan": 5}
    assert load(spark, root, "b", [("eve", 0)]) == second  # a state that was loaded
    assert load(spark, root, "c", [("ann", 5)]) == second  # nothing new


def test_loaders_at_once_share_or_follow(spark, tmp_path, monkeypatch):
    """A second loader that publishes between the first one's reading and writing."""
    root = str(tmp_path / "keys")
    publish, state = published.publish, {"others": [("x", [("zoe", 1)])]}

    def slow(spark_, root_, mark, write):
        def late(folder):
            gates = write(folder)
            while state["others"]:
                other, people = state["others"].pop()
                load(spark, root, other, people)
            return gates
        return publish(spark_, root_, mark, late)

    monkeypatch.setattr(published, "publish", slow)
    assert load(spark, root, "a", [("ann", 5)]) == {"zoe": 1, "ann": 2}  # numbered after the other's
    state["others"] = [("b", [("bob", 1)])]
    assert load(spark, root, "b", [("bob", 1)]) == {"zoe": 1, "ann": 2, "bob": 3}  # the same load: one version
    assert len(published.versions(spark, root)) == 3


def test_an_entry_that_was_never_written_is_taken_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(published, "ABANDONED_S", 1)
    root = tmp_path / "keys"
    (root / "_log" / "000001").mkdir(parents=True)
    assert load(spark, str(root), "a", [("ann", 5)]) == {"ann": 1}


def test_composite_keys_and_empty_load(spark, tmp_path):
    root = str(tmp_path / "keys")
    none = spark.createDataFrame([], "team string, sprint string")
    assert keymap.extend(none, ["team", "sprint"], ["team", "sprint"], root, "a").collect() == []
    some = spark.createDataFrame([("B", "1"), ("A", "2"), ("A", "1")], "team string, sprint string")
    out = keymap.extend(some, ["team", "sprint"], ["team", "sprint"], root, "b").collect()
    assert {(r.team, r.sprint): r.sk for r in out} == {("A", "1"): 1, ("A", "2"): 2, ("B", "1"): 3}


def test_people_of_several_roles_are_folded_back(spark):
    people = spark.createDataFrame([("[externo]", 1), ("[desconhecido]", 3), ("7", 9)], "person_id string, person_sk bigint")
    rows = spark.createDataFrame([(1, "7", None), (2, "99", "7"), (3, None, None)], "row int, a string, b string")
    out = keys.with_people(rows, ["row"], {"a_sk": F.col("a"), "b_sk": F.col("b")}, people)
    assert {r.row: (r.a_sk, r.b_sk) for r in out.collect()} == {1: (9, None), 2: (1, 9), 3: (None, None)}
    one = keys.with_people(rows, ["row"], {"a_sk": F.col("a")}, people)
    assert {r.row: r.a_sk for r in one.collect()} == {1: 9, 2: 1, 3: None}


@pytest.mark.parametrize("fact", ["fact_commit", "fact_merge_request", "fact_card", "fact_event"])
def test_facts_refer_to_the_dimensions(spark, fact):
    """Required keys are there, and every key is one of its dimension."""
    t = Tables(spark, SF_SMALL)
    df = facts.QUERIES[fact](spark, SF_SMALL).cache()
    dimension = {"team_sk": "team", "sprint_sk": "sprint", "status_sk": "status", "label_sk": "label", "size_sk": "label"}
    sks = [c for c in df.columns if c.endswith("_sk")]
    assert df.filter("team_sk is null").count() == 0
    for c in sks:
        name = dimension.get(c, "person")
        known = keys.key_map(spark, t, name).select(F.col(f"{name}_sk").alias(c)).distinct()
        assert df.filter(F.col(c).isNotNull()).join(known, c, "left_anti").count() == 0
        assert df.filter(F.col(c).isNotNull()).count() > 0
    df.unpersist()

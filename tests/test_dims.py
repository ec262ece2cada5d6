from flowcube.operators import dims


def test_dim_person_sentinels_first_dense_keys_and_activity(spark):
    roster = spark.createDataFrame(
        [("7", "ASIA", "owner", "active"), ("3", "EUROPE", "guest", "active"), ("5", None, None, None)],
        "person_id string, origin_team string, role string, status string")
    keys = spark.createDataFrame([(p, i + 1) for i, p in enumerate(["[externo]", "[bot]", "[desconhecido]", "3", "5", "7", "gone"])],
                                 "person_id string, person_sk bigint")
    active = spark.createDataFrame([("3",), ("3",), ("[externo]",), ("99",)], "person_id string")
    rows = [r.asDict() for r in dims.dim_person(roster, active, keys).orderBy("person_sk").collect()]
    assert [r["person_sk"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["person_id"] for r in rows] == ["[externo]", "[bot]", "[desconhecido]", "3", "5", "7"]
    assert [r["person_type"] for r in rows] == ["EXTERNO", "BOT", "DESCONHECIDO", "MEMBRO", "MEMBRO", "MEMBRO"]
    assert [r["is_sentinel"] for r in rows] == [True, True, True, False, False, False]
    # an id seen only in the facts ("99") is not added; repeated fact rows do not duplicate people
    assert [r["had_activity"] for r in rows] == [True, False, False, True, False, False]


def test_dim_team_counts_roster_and_keeps_teams_without_activity(spark):
    teams = spark.createDataFrame([("A", "2024-01-01 00:00:00"), ("B", "2024-01-01 00:00:00")],
                                  "team string, created_at string").selectExpr(
        "1L as team_sk", "team", "cast(created_at as timestamp_ntz) as created_at")
    activity = spark.createDataFrame([("A", "2024-01-03 10:00:00"), ("A", "2024-01-11 09:00:00")],
                                     "team string, ts string").selectExpr("team", "cast(ts as timestamp_ntz) as ts")
    roster = spark.createDataFrame([("A",), ("A",), ("A",)], "team string")
    rows = {r["team"]: r.asDict() for r in dims.dim_team(teams, activity, roster).collect()}
    assert rows["A"]["days_of_life"] == 10 and rows["A"]["members"] == 3
    assert rows["B"]["last_activity_at"] is None and rows["B"]["days_of_life"] is None and rows["B"]["members"] == 0

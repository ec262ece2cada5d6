from flowcube.plans import facts
from tests.conftest import SF_SMALL


def test_views_answer_sql(spark):
    names = facts.register_views(spark, SF_SMALL, "v_")
    assert {"v_fact_commit", "v_board_moves", "v_dim_sprint"} <= set(names)
    moves, marks, log = (spark.sql(f"SELECT count(*) FROM {v}").first()[0] for v in ("v_board_moves", "v_label_marks", "v_fact_event"))
    unknown = spark.sql("SELECT count(*) FROM v_fact_event WHERE kind = 'DESCONHECIDO'").first()[0]
    assert moves + marks + unknown == log and moves and marks


def test_gate_sees_a_wrong_target(spark):
    rows = [("MUDANCA_COLUNA", "c", None, True), ("MUDANCA_COLUNA", None, None, False), ("MARCACAO_ROTULO", None, "l", True),
            ("MARCACAO_ROTULO", "c", "l", False), ("DESCONHECIDO", None, None, True), ("DESCONHECIDO", None, "l", False), ("x", None, None, False)]
    df = spark.createDataFrame(rows, "kind string, column_key string, label_key string, ok boolean")
    assert all(r["got"] == r["ok"] for r in df.withColumn("got", facts.target_ok()).collect())

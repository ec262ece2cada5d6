from pyspark.sql import functions as F

from flowcube.functions import text


def test_citation_rule(spark):
    rows = [(1, "fix #12) done", None), (2, "#12abc and #9ab445", "see #3"), (3, "#007 only", "#4 #5"),
            (4, "#0 zero", None), (5, "two #1 #2", None), (6, "no refs", "msg #8."), (7, "#1#2", None)]
    df = spark.createDataFrame(rows, "id int, title string, message string")
    nums, src = text.citations_with_fallback(F.col("title"), F.col("message"))
    got = {r["id"]: (sorted(r["n"]), r["s"]) for r in df.select("id", nums.alias("n"), src.alias("s")).collect()}
    assert got[1] == ([12], "title")
    assert got[2] == ([3], "message")        # '#12abc' and a colour are not citations
    assert got[3] == ([4, 5], "message")     # leading zero is not valid, so the message is used
    assert got[4] == ([0], "title")
    assert got[5] == ([1, 2], "title")
    assert got[6] == ([8], "message")
    assert got[7] == ([1, 2], "title")


def test_label_canonicalisation(spark):
    raw = ["ART. 5", "art.05", "ART 18", "ART. 19", "ART.", "SIZE_PP", "size pp", "pp", "P1", "Fix", "bug",
           "negócios", " Design ", "ano:2026", "Art 0"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    c = text.canonical_label(F.col("raw"))
    got = {r["raw"]: (r["c"], r["k"]) for r in df.select("raw", c.alias("c"),
                                                       text.label_category(c).alias("k")).collect()}
    assert got["ART. 5"] == ("ART-05", "ARTEFATO")
    assert got["art.05"] == ("ART-05", "ARTEFATO")
    assert got["ART 18"] == ("ART-18", "ARTEFATO")
    assert got["ART. 19"] == ("ART. 19", "TIPO_TRABALHO")
    assert got["ART."][0] == "ART."
    assert got["Art 0"][0] == "ART 0"
    assert got["SIZE_PP"] == got["size pp"] == got["pp"] == ("SIZE_PP", "TAMANHO")
    assert got["P1"] == ("P1", "PRIORIDADE")
    assert got["Fix"] == got["bug"] == ("BUG", "BUG")
    assert got["negócios"][0] == "NEGÓCIOS"  # Unicode upper, not ASCII-only
    assert got[" Design "] == ("DESIGN", "TIPO_TRABALHO")
    assert got["ano:2026"] == ("ANO:2026", "METADADO_TURMA")


def test_explode_weighted_and_roundtrip(spark):
    df = spark.createDataFrame([(1, "a;;b"), (2, "x"), (3, None), (4, "a;")], "k int, v string")
    ex = text.explode_weighted(df, ["k"], "v")
    rows = sorted((r["k"], r["position"], r["value"], r["n_values"]) for r in ex.collect())
    assert rows[:3] == [(1, 1, "a", 3), (1, 2, "", 3), (1, 3, "b", 3)]
    assert not [r for r in rows if r[0] == 3]
    w = {r["k"]: r["w"] for r in ex.groupBy("k").agg(F.sum("weight").alias("w")).collect()}
    assert all(abs(x - 1.0) < 1e-12 for x in w.values())
    back = {r["k"]: r["rejoined"] for r in text.rejoin_parts(ex, ["k"]).collect()}
    assert back == {1: "a;;b", 2: "x", 4: "a;"}


def test_bot_flag(spark):
    df = spark.createDataFrame([("ci-runner",), ("Release-Bot",), ("ana",), (None,)], "p string")
    assert [r[0] for r in df.select(text.is_bot(F.col("p"))).collect()] == [1, 1, 0, 0]

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcube.operators import windows


def skewed(spark):
    # key 0 holds half of all rows
    return spark.range(0, 6000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("k"),
                                       (F.col("id") * 7919 % 6007).alias("v"), (F.col("id") % 3).alias("x"))


def test_ordinal_matches_row_number_when_hot_key_is_split(spark):
    df = skewed(spark)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    for budget in (200, 10**9):
        got = windows.ordinal(df, ["k"], ["v"], "rn", bucket_rows=budget)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_running_sum_matches_window_when_hot_key_is_split(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("cs", F.sum("x").over(w))
    got = windows.running_sum(df, ["k"], ["v"], "x", "cs", bucket_rows=200)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_next_value(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, rn int, v string")
    got = sorted((r["k"], r["rn"], r["nx"]) for r in windows.next_value(df, ["k"], "rn", "v", "nx").collect())
    assert got == [(1, 1, "b"), (1, 2, None), (2, 1, None)]


def test_ordinal_and_next_match_row_number_and_lead(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("v")
    ref = df.withColumn("rn", F.row_number().over(w)).withColumn("nx", F.lead("x").over(w))
    for budget in (200, 10**9):
        got = windows.ordinal_and_next(df, ["k"], ["v"], "rn", "x", "nx", bucket_rows=budget)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_hot_key_comes_down_to_the_budget(spark):
    df = spark.range(0, 64_000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 64_007).alias("v"))
    d = windows._bucketed(df, ["k"], "v", 1000)
    sizes = [r["count"] for r in d.groupBy("__bk").count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 1200  # as many pieces as the key needs, no fixed number


def test_ordinal_without_keys_and_by_text(spark):
    df = spark.range(0, 3000).select(F.format_string("p%05d", F.col("id") * 7919 % 3001).alias("v"))
    want = [r["v"] for r in df.orderBy("v").collect()]
    got = windows.ordinal(df, [], ["v"], "rn", bucket_rows=100).orderBy("rn").collect()
    assert [r["v"] for r in got] == want and [r["rn"] for r in got] == list(range(1, 3001))

from pyspark.sql import functions as F

from flowcube.functions.scalars import side_by_side, values_of
from flowcube.functions.timecalc import cents, year_month


def test_side_by_side_keeps_every_column_of_one_row_aggregates(spark):
    df = spark.range(1, 11).withColumn("v", F.col("id") * 3)
    a = df.agg(F.count(F.lit(1)).alias("n"))
    b = df.agg(F.sum("v").alias("s"), F.max("id").alias("hi"))
    c = df.filter("id > 100").agg(F.sum("v").alias("empty_sum"))
    row = side_by_side(a, b, c).collect()
    assert len(row) == 1
    assert row[0].asDict() == {"n": 10, "s": 165, "hi": 10, "empty_sum": None}


def test_side_by_side_plans_no_join(spark):
    df = spark.range(5)
    plan = side_by_side(df.agg(F.count(F.lit(1)).alias("n")), df.agg(F.sum("id").alias("s"))) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "NestedLoop" not in plan


def test_values_of_attaches_totals_to_rows(spark):
    df = spark.range(1, 5)
    (total,) = values_of(df.agg(F.sum("id").alias("total")))
    got = sorted(tuple(r) for r in df.select("id", (F.col("id") / total).alias("share")).collect())
    assert got == [(1, 0.1), (2, 0.2), (3, 0.3), (4, 0.4)]


def test_cents_round_half_away_from_zero(spark):
    rows = spark.createDataFrame([(0.125,), (-0.125,), (19.99,), (0.285,), (1.005,), (-2.5,), (None,)], "x double")
    got = [r[0] for r in rows.select(cents("x")).collect()]
    # 0.125 and -2.5 are exact binary halves; 0.285 * 100 is 28.499999999999996 as a double.
    assert got == [13, -13, 1999, 28, 100, -250, None]


def test_cents_equals_round_of_the_product(spark):
    df = spark.range(-200000, 200000, 7).select((F.col("id") / F.lit(1000.0)).alias("x"))
    diff = df.filter(cents("x") != F.round(F.col("x") * 100).cast("bigint")).count()
    assert diff == 0


def test_year_month_text(spark):
    df = spark.createDataFrame([("1995-03-07 10:00:00",), ("2024-12-31 23:59:59",)], "t string") \
        .select(F.to_timestamp_ntz("t").alias("t"))
    assert [r[0] for r in df.select(year_month("t")).collect()] == ["1995-03", "2024-12"]

import pytest
from pyspark.sql import functions as F

from flowcube.operators import quality
from flowcube.sources import io


def test_local_wall_time_changes_day(spark):
    df = spark.createDataFrame([("2026-06-02T02:30:00Z",), ("2026-06-01T23:30:00-03:00",),
                                ("2026-06-02T02:30:00+00:00",)], "s string")
    got = [r[0] for r in df.select(io.to_local_wall_time("s")).collect()]
    assert [str(x) for x in got] == ["2026-06-01 23:30:00"] * 3


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "2026-01-01", "2026-01-01T10:00:00Z", "x", None),
                                ("-2", "3", "2026-01-02", "2026-01-01T10:00:00.123-03:00", "", None)],
                               "a string, b string, c string, d string, e string, f string")
    got = {r["column_name"]: r["inferred_type"] for r in io.infer_types(df).collect()}
    assert got == {"a": "INTEGER", "b": "REAL", "c": "DATE", "d": "DATETIME", "e": "TEXT", "f": "TEXT"}


def test_infer_types_stops_on_timestamp_without_offset(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00",)], "a string")
    with pytest.raises(Exception, match="without offset"):
        io.infer_types(df).collect()


def test_strict_cast(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", None)], "i string, r string")
    audit = {r["column_name"]: (r["non_null"], r["failed"]) for r in
             io.strict_cast_audit(df, {"i": "I", "r": "R"}).collect()}
    assert audit == {"i": (2, 1), "r": (1, 0)}
    with pytest.raises(Exception, match="cannot convert"):
        io.strict_cast(df, {"i": "I"}).collect()


def test_gates_on_broken_tables(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 99), (3, None)], "id long, fk long")
    parent = spark.createDataFrame([(10,)], "pk long")
    u = quality.key_uniqueness(child, "child", ["id"]).collect()[0]
    assert (u["rows"], u["distinct_keys"], u["is_unique"]) == (4, 3, False)
    o = quality.orphan_count(child, parent, "fk", ["fk"], ["pk"]).collect()[0]
    assert o["orphan_rows"] == 1
    f = quality.fanout(child.withColumn("m", F.lit(1.5)), child.select("fk"), "fk", "m").collect()[0]
    assert f["join_rows"] == 5  # 2x2 for fk=10, 1x1 for fk=99
    one = spark.createDataFrame([(3, 3, 1, 2)], "a long, b long, c long, d long")
    g = {r["gate"]: r["ok"] for r in quality.gate_rows(one, [("ab", "a", "b"), ("cd", "c", "d")]).collect()}
    assert g == {"ab": True, "cd": False}
    with pytest.raises(Exception, match="gate failed: cd"):
        quality.assert_gates(quality.gate_rows(one, [("cd", "c", "d")])).collect()
    d = quality.symmetric_difference(child.select("id"), spark.createDataFrame([(1,), (4,)], "id long"))
    assert sorted((r["id"], r["only_in"]) for r in d.collect()) == [(1, "a"), (2, "a"), (3, "a"), (4, "b")]


def test_round_trip_sees_every_kind_of_difference(spark):
    rows = [(1, "a", [1.0]), (2, None, None), (2, None, None), (3, "c", [2.0, 0.5])]
    schema = "id long, t string, v array<float>"
    source = spark.createDataFrame(rows, schema)
    copies = {"same": list(reversed(rows)), "value": [(1, "A", [1.0]), *rows[1:]], "lost": rows[:3], "null": [(1, None, [1.0]), *rows[1:]],
              "twice": [rows[0], rows[0], rows[1], rows[3]], "array": [*rows[:3], (3, "c", [0.5, 2.0])],
              "swapped": [(1, "c", [1.0]), *rows[1:3], (3, "a", [2.0, 0.5])]}  # equal columns, other rows
    gates = quality.round_trip({n: (source, spark.createDataFrame(c, schema)) for n, c in copies.items()}).collect()
    assert len(gates) == len(copies) * 6
    bad = {}
    for g in gates:
        if not g["ok"]:
            kind, table = g["gate"].split(":")
            bad.setdefault(table.split(".")[0], set()).add(kind)
    cols, row = "columns_that_differ", "rows_that_differ"
    assert bad == {"value": {cols, row}, "lost": {"rows_eq_source", cols, row}, "null": {"nulls_eq_source", cols, row},
                   "twice": {"nulls_eq_source", cols, row}, "array": {cols, row}, "swapped": {row}}
    n = {g["gate"]: g["observed"] for g in gates}
    assert n["rows_that_differ:value"] == "2" and n["rows_that_differ:lost"] == "1" and n["rows_that_differ:swapped"] == "4"


def test_profile_of_observed_types_and_first_values(spark, tmp_path):
    rows = [(i, str(i % 7) if i != 5 else None, "2024-01-%02d" % (i % 9 + 1), ("x" * 100 if i else "1.5"), [1.0, float(i)], float(i), i + 0.5, None)
            for i in range(50)]
    spark.createDataFrame(rows, "a long, i string, d string, t string, v array<float>, whole double, half double, none string").coalesce(1) \
         .selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(a as int)) as day").write.parquet(f"{tmp_path}/t")
    out = {r["column_name"]: r for r in quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()}
    assert {c: r["observed_type"] for c, r in out.items()} == {
        "a": "INTEGER", "i": "INTEGER", "d": "DATE", "t": "TEXT", "v": "ARRAY", "whole": "INTEGER", "half": "REAL", "none": "TEXT", "day": "DATE"}
    assert out["i"]["samples"] == "0 | 1 | 2" and out["d"]["samples"] == "2024-01-01 | 2024-01-02 | 2024-01-03"
    assert out["t"]["samples"] == "1.5 | " + "x" * 60 and out["t"]["max_value"] == "x" * 60 and out["t"]["distinct_values"] == 2
    assert (out["i"]["rows"], out["i"]["nulls"], out["i"]["distinct_values"]) == (50, 1, 7)
    assert (out["none"]["nulls"], out["none"]["distinct_values"], out["none"]["samples"]) == (50, 0, None)
    assert out["v"]["distinct_values"] == 50 and out["v"]["samples"] is None


def test_profile_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "a long, t string").write.parquet(f"{tmp_path}/t")
    out = quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()
    assert [(r["column_name"], r["observed_type"], r["rows"], r["min_value"], r["samples"]) for r in out] == [
        ("a", "TEXT", 0, None, None), ("t", "TEXT", 0, None, None)]


def test_profile_counts_times_by_the_microsecond(spark, tmp_path):
    spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1000000) as at from range(10)").write.parquet(f"{tmp_path}/t")
    (out,) = quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()
    assert (out["distinct_values"], out["observed_type"], out["max_value"]) == (10, "DATETIME", "2024-01-01 00:00:00.000009")


def test_profile_writes_a_row_a_column_and_not_its_values(spark, tmp_path, monkeypatch):
    from flowcube.operators import materialize
    written, write = [], materialize.materialize
    monkeypatch.setattr(materialize, "materialize", lambda df: written.append(write(df)) or written[-1])
    spark.range(1000).selectExpr("id as a", "cast(id % 10 as string) as b").write.parquet(f"{tmp_path}/t")
    quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()
    assert sum(df.count() for df in written) <= 2


def test_profile_tells_long_texts_apart_and_knows_their_class(spark, tmp_path):
    n = quality.SHOWN
    rows = [("1" * n, "x" * n, "é" * n, ""), ("1" * (n + 40), "x" * n + "a", "é" * n + "a", ":"), ("-" + "1" * n, "x" * n + "b", None, "-"), ("1" * n, "x" * n, "é" * 40, "5")]
    spark.createDataFrame(rows, "i string, t string, e string, s string").coalesce(1).write.parquet(f"{tmp_path}/t")
    out = {r["column_name"]: r for r in quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()}
    assert {c: (r["distinct_values"], r["observed_type"], r["min_value"], r["max_value"]) for c, r in out.items()} == {
        "i": (3, "INTEGER", "-" + "1" * (n - 1), "1" * n), "t": (3, "TEXT", "x" * n, "x" * n), "e": (3, "TEXT", "é" * 40, "é" * n),
        "s": (4, "TEXT", "", ":")}
    assert out["i"]["samples"] == " | ".join(["1" * n, "1" * n, "-" + "1" * (n - 1)]) and out["s"]["samples"] == " | : | -"


def test_profile_samples_of_columns_that_repeat_themselves_at_first(spark, tmp_path, monkeypatch):
    import datetime
    from decimal import Decimal
    t = datetime.datetime(2024, 1, 1, 0, 0, 0, 5)
    monkeypatch.setattr(quality, "HEAD", 4)
    cols = "n long, d double, s string, at timestamp, day date, dec decimal(10,2), yes boolean, one string"
    def rows(start):
        return [(i // 8, -0.0 if i < 8 else 0.0 if i < 10 else i / 8, "x" * 70 + str(i // 8), t + datetime.timedelta(microseconds=i // 8),
                 datetime.date(2024, 1, 1 + i // 8), None if i < 8 else Decimal(i // 8), i >= 16, "o") for i in range(start, start + 16)]
    empty = spark.createDataFrame([], cols)
    for name, df in (("a", empty), ("b", spark.createDataFrame(rows(0), cols)), ("c", spark.createDataFrame(rows(16), cols))):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    for name in "cab":  # files of one table, by path: none of the rows, the first, the last
        (part,) = (tmp_path / name).glob("*.parquet")
        (tmp_path / "t").mkdir(exist_ok=True)
        (tmp_path / "t" / f"{name}.parquet").write_bytes(part.read_bytes())
    out = {r["column_name"]: r["samples"] for r in quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()}
    day = "2024-01-01 00:00:00.00000"
    assert out == {"n": "0 | 1 | 2", "d": "-0.0 | 1.25 | 1.375", "s": " | ".join(["x" * 60] * 3), "at": f"{day}5 | {day}6 | {day}7",
                   "day": "2024-01-01 | 2024-01-02 | 2024-01-03", "dec": "1.00 | 2.00 | 3.00", "yes": "false | true", "one": "o"}
    monkeypatch.setattr(quality, "FIRST_FILES", 0)  # all by the scan of whole columns
    again = {r["column_name"]: r["samples"] for r in quality.column_profile(spark.read.parquet(f"{tmp_path}/t"), "t").collect()}
    assert again == out

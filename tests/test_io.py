import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcube.sources import io

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("day", T.StringType())])


def write(tmp_path, name, data):
    path = tmp_path / name
    path.write_bytes(data)
    return f"file://{path}"


def test_quoted_line_breaks_crlf_and_bom(spark, tmp_path):
    data = "\ufeffid,title,day\r\n1,\"two\r\nlines, \"\"quoted\"\"\",2024-01-02\r\n2,,\r\n".encode()
    rows = io.read_csv(spark, write(tmp_path, "a.csv", data), SCHEMA).collect()
    assert [r["id"] for r in rows] == [1, 2]
    assert rows[0]["title"].replace("\r\n", "\n") == 'two\nlines, "quoted"'
    assert rows[1]["title"] is None and rows[1]["day"] is None


def test_wrong_header_stops(spark, tmp_path):
    path = write(tmp_path, "b.csv", b"id,name,day\n1,x,y\n")
    with pytest.raises(Exception):
        io.read_csv(spark, path, SCHEMA).collect()


def test_short_rows_are_padded_and_long_rows_counted(spark, tmp_path):
    path = write(tmp_path, "c.csv", b"id,title,day\n1,x\n2,y,z\n3,a,b,c\n")
    ragged = io.read_ragged_csv(spark, path, SCHEMA)
    rows = {r["id"]: r for r in ragged.collect()}
    assert rows[1]["day"] is None and rows[2]["day"] == "z" and rows[3]["__overflow"] == "c"
    assert tuple(io.overflow_audit(ragged).first()) == (3, 1)


def test_changed_file_is_seen(spark, tmp_path):
    a, b = tmp_path / "x.bin", tmp_path / "y.bin"
    a.write_bytes(b"one")
    b.write_bytes(b"two")
    before = spark.createDataFrame(io.file_hashes(spark, f"file://{tmp_path}/*.bin").collect())
    assert io.unchanged(before, io.file_hashes(spark, f"file://{tmp_path}/*.bin")).count() == 0
    b.write_bytes(b"TWO")
    assert [r["path"].endswith("y.bin") for r in io.unchanged(before, io.file_hashes(spark, f"file://{tmp_path}/*.bin")).collect()] == [True]


def test_semicolon_csv_has_a_byte_order_mark(spark, tmp_path):
    out = tmp_path / "out"
    io.write_semicolon_csv(spark.createDataFrame([(1, "a;b")], "id int, t string").coalesce(1), f"file://{out}")
    text = next(out.glob("part-*.csv")).read_bytes().decode("utf-8")
    assert text.startswith("\ufeffid;t") and '"a;b"' in text


def test_record_numbers_follow_the_file(spark, tmp_path):
    path = write(tmp_path, "d.csv", b"id,title,day\n" + b"".join(b"%d,t,d\n" % i for i in (5, 3, 9, 1)))
    rows = io.number_records(io.read_csv(spark, path, SCHEMA)).orderBy("record_no").collect()
    assert [(r["record_no"], r["id"]) for r in rows] == [(1, 5), (2, 3), (3, 9), (4, 1)]


def test_record_numbers_follow_paths_whatever_the_sizes(spark, tmp_path):
    """Spark reads large files first; numbers go by path, and by the place within a file."""
    want = []
    for name, n in (("a.csv", 3), ("b.csv", 500), ("c.csv", 4000), ("d.csv", 0), ("e.csv", 1)):
        ids = [len(want) + i for i in range(n)]
        want += ids
        write(tmp_path, name, b"id,title,day\n" + b"".join(b"%d,title of the row,d\n" % i for i in ids))
    df = io.read_csv(spark, f"file://{tmp_path}/*.csv", SCHEMA)
    assert [r["id"] for r in df.collect()] != want
    rows = io.number_records(df)
    assert rows.columns == ["id", "title", "day", "record_no"]
    assert {r["id"]: r["record_no"] for r in rows.collect()} == {i: i + 1 for i in want}


def test_hashes_are_streamed_in_pieces(spark, tmp_path):
    import hashlib
    data = {"a b.bin": b"x" * 1000, "big.bin": bytes(range(256)) * 5000, "empty.bin": b""}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    out = {r["path"].rsplit("/", 1)[1]: (r["length"], r["sha256"]) for r in io.file_hashes(spark, f"file://{tmp_path}/*.bin", piece=97).collect()}
    want = {name: (len(c), hashlib.sha256(c).hexdigest()) for name, c in data.items() if c}  # Spark's listing leaves empty files out
    assert {k.replace("%20", " "): v for k, v in out.items()} == want


def test_manifest_before_and_after(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.bin").write_bytes(b"%d" % i)
    manifest = spark.createDataFrame(io.file_hashes(spark, f"file://{tmp_path}/*.bin").collect())
    assert io.manifest_check(io.file_hashes(spark, f"file://{tmp_path}/*.bin"), manifest).filter("not ok").count() == 0
    (tmp_path / "1.bin").write_bytes(b"changed")
    (tmp_path / "2.bin").rename(tmp_path / "3.bin")
    bad = io.manifest_check(io.file_hashes(spark, f"file://{tmp_path}/*.bin"), manifest).filter("not ok").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in bad) == ["1.bin", "2.bin", "3.bin"]


def test_first_records_are_records_not_lines(spark, tmp_path):
    path = write(tmp_path, "f.csv", b'id,title,day\n1,"two\nlines",a\n2,"and\nthree\nmore",b\n3,x,c\n')
    rows = io.first_records(io.read_csv(spark, path, SCHEMA), 2).collect()
    assert [(r["id"], r["title"]) for r in rows] == [(1, "two\nlines"), (2, "and\nthree\nmore")]


def test_table_counts_have_an_expected_side(spark, tmp_path):
    spark.range(1000).repartition(4).write.parquet(f"{tmp_path}/t")
    spark.range(0).write.parquet(f"{tmp_path}/none")
    read = lambda n: spark.read.parquet(f"{tmp_path}/{n}")
    out = {r["table_name"]: tuple(r)[1:] for r in io.table_counts({"t": read("t"), "none": read("none"), "lost": read("t").filter("id < 900")}).collect()}
    assert out["t"] == (1000, 1000, True) and out["none"] == (0, 0, True)
    assert out["lost"][0] == 900 and out["lost"][2] is False


def test_copy_casts_texts_and_keeps_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-02 03:04:05"), (2, None)], "id int, at string")
    back = io.copy_table(df, f"file://{tmp_path}/copy", ["at"])
    assert dict(back.dtypes)["at"] == "timestamp_ntz"
    assert io.load_parity(df, back, "t").first()["ok"]
    assert back.filter(F.col("at").isNull()).count() == 1


def test_local_sessions_only_get_a_scratch_folder(spark, monkeypatch):
    from flowcube import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Fake:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Fake())

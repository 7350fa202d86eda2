"""S1-S8 round trips."""

from pyspark.sql import functions as F

from hourglass.session import scratch_path
from hourglass.sources import io


def test_lines_with_offsets(spark, tmp_path):
    p = tmp_path / "in.txt"
    p.write_text("abc\n0123456789\nxy\n")
    plain = io.read_lines(spark, str(p))
    assert [r.value for r in plain.collect()] == ["abc", "0123456789", "xy"]
    keyed = io.read_lines(spark, str(p), with_offsets=True).orderBy("offset").collect()
    assert [(r.offset, r.value) for r in keyed] == [(0, "abc"), (4, "0123456789"), (15, "xy")]


def test_csv_round_trip_keeps_empty_strings(spark):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "x,y")], "k string, v string")
    path = scratch_path(spark, "csv")
    io.write_csv(df, path, null_value="\\N")
    back = io.read_csv_strings(spark, path, ["k", "v"], null_value="\\N")
    assert sorted(tuple(r) for r in back.collect()) == [("a", ""), ("b", None), ("c", "x,y")]


def test_stage_lines_kv_round_trip(spark):
    df = spark.range(5).select(F.col("id"), (F.col("id") * 2).alias("v"))
    path = io.save_stage(df, scratch_path(spark, "stage"))
    assert io.load_stage(spark, path).dtypes == df.dtypes
    lines = spark.createDataFrame([("b",), ("a",)], "value string")
    lp = io.write_lines(lines, scratch_path(spark, "lines"))
    assert sorted(r.value for r in io.read_lines(spark, lp).collect()) == ["a", "b"]
    kv = spark.createDataFrame([("Number of records:", 5)], "label string, n int")
    kp = io.write_kv(kv, scratch_path(spark, "kv"))
    assert [tuple(r) for r in io.read_kv(spark, kp, ["label", "n"]).collect()] == [("Number of records:", "5")]


def test_rows_to_table(spark):
    t = io.rows_to_table(spark, [("temperature", 3.0, 96.0)], "variable string, min double, max double")
    assert t.dtypes == [("variable", "string"), ("min", "double"), ("max", "double")]


def test_csv_corrupt_rows_are_kept_and_flagged(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("a,b\n1,2\n3\n4,5,6\n")
    df = io.read_csv_strings(spark, str(p), ["a", "b"], corrupt_column="_bad")
    rows = {r.a: (r.b, r._bad) for r in df.collect()}
    assert rows["1"] == ("2", None)
    assert rows["3"] == (None, "3")          # too few cells: kept, raw line in the corrupt column
    assert rows["4"] == ("5", "4,5,6")       # too many cells: kept, raw line in the corrupt column


def test_offsets_across_blocks_and_files(spark, tmp_path):
    want = set()
    for name in ("a.txt", "b.txt"):
        at, raw = 0, b""
        for i in range(3000):
            line = f"{name} line {i} é".encode() + b"x" * (i % 37)
            want.add((at, line.decode()))
            raw += line + (b"\r\n" if i % 5 == 0 else b"\n")
            at = len(raw)
        (tmp_path / name).write_bytes(raw)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = io.read_lines(spark, str(tmp_path), with_offsets=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.offset, r.value) for r in rows} == want and len(rows) == len(want)

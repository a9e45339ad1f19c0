"""Header lines as rows, and the types of columns in files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.compare import explained
from tidemark.operators import quality

FILES = {
    "a/x.csv": 'id,"Full ""N"" ame","a,b"\n1,"say ""x"", y",2024-01-05\n,b,\n',
    "a/y.csv": "\ufeffID,day\n5000000000,2024-01-05 10:00:00\n",
    "b/z.csv": "id,id,extra\n1,2,true\n",
    "b/empty.csv": "",
    "b/only_header.csv": "id,v\n",
}


@pytest.fixture
def path(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        Path(tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_headers_of_all_files_in_one_scan(spark, path):
    headers = quality.header_rows(spark, path)
    got = sorted((r["source"], r["position"], r["column_name"]) for r in headers.collect())
    assert got == [
        ("only_header.csv", 0, "id"), ("only_header.csv", 1, "v"), ("x.csv", 0, "id"), ("x.csv", 1, 'full"n"ame'), ("x.csv", 2, "a,b"),
        ("y.csv", 0, "id"), ("y.csv", 1, "day"), ("z.csv", 0, "id"), ("z.csv", 1, "id"), ("z.csv", 2, "extra"),
    ]
    assert explained(headers).count("Scan text") >= 1


def test_files_are_judged_and_stopped(spark, path):
    control = spark.createDataFrame([("x.csv", "ID"), ("x.csv", 'Full "N" ame'), ("x.csv", "a,b"), ("y.csv ", "id"), ("y.csv", "day"), ("y.csv", "more"), ("z.csv", "id")], "file_name string, file_column string")
    compared = quality.compare_headers(quality.header_rows(spark, path), control)
    rows = {(r["source"], r["column_name"]): r["status"] for r in compared.collect()}
    assert rows["y.csv", "more"] == "missing" and rows["z.csv", "id"] == "repeated" and rows["z.csv", "extra"] == rows["only_header.csv", "v"] == "extra"
    assert {r["source"]: r["loads"] for r in quality.files_to_load(compared).collect()} == {"x.csv": True, "y.csv": False, "z.csv": False, "only_header.csv": False}


def test_types_of_columns(spark, path):
    headers = quality.header_rows(spark, path)
    types = quality.column_types(spark, headers, path, escape='"')
    got = sorted((r["source"], r["column_name"], r["data_type"]) for r in types.collect())
    assert got == [
        ("only_header.csv", "id", "void"), ("only_header.csv", "v", "void"), ("x.csv", "a,b", "date"), ("x.csv", 'full"n"ame', "string"), ("x.csv", "id", "int"),
        ("y.csv", "day", "date"), ("y.csv", "id", "bigint"), ("z.csv", "extra", "boolean"), ("z.csv", "id", "int"), ("z.csv", "id", "int"),
    ]
    control = spark.createDataFrame([("x.csv", "id", "double"), ("y.csv", "id", "int"), ("z.csv", "extra", "date"), ("x.csv", "a,b", "timestamp")], "file_name string, file_column string, target_type string")
    wrong = sorted((r["source"], r["actual"], r["expected"]) for r in quality.compare_file_types(types, control).collect())
    assert wrong == [("y.csv", "bigint", "int"), ("z.csv", "boolean", "date")]


def test_shapes_admit_every_text_that_casts(spark):
    bare = ["0", "7", "-7", "+7", "007", "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807", "9223372036854775808", "1.5", "1.", ".5",
            ".", "1e5", "1E-5", "1e+5d", "-1.5F", "2D", "0x1p3", "0x1.8p-3", "inf", "-Infinity", "NaN", "nand", "true", "T", "YES", "n", "no", "off", "", "+", "e5",
            "1996-01-02", "1996-1-2", "1996", "1996-01-02T03:04:05.678", "12:30:00", "a", "1a", "Customer#1", "\u0661", "1 2"]
    rows = spark.createDataFrame([(before + text + after,) for text in bare for before in ("", " ", "\t\x01") for after in ("", "\n", "\x7f ")], "v string")
    for kind in quality.GUESSED:
        wrong = rows.select("v", F.col("v").try_cast(kind).isNotNull().alias("cast"), quality._casts(F.col("v"), kind).alias("got")).filter("NOT got <=> cast")
        assert wrong.collect() == [], kind


def test_a_cast_that_cannot_succeed_is_not_tried(spark):
    """Of texts that fit no number, no truth value and no date, every type but the last two is refused by its shape."""
    rows = spark.createDataFrame([("1996-01-02T03:04:05",), ("Customer#000000001",), ("173665.47 EUR",)], "v string")
    for kind in quality.SHAPES:
        assert rows.filter(F.col("v").rlike(quality.SHAPES[kind])).count() == 0, kind
        assert "WHEN RLIKE" in str(quality._casts(F.col("v"), kind)).upper().replace("CASE ", "")

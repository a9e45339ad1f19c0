"""Text, date and number expressions against plain Python on random texts, in one job each."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.functions import dates, text, values


def random_texts(n=400):
    rng = random.Random(11)
    pieces = ["a", "B", ".", "..", "Update", "Service", " ", "\n", "\t", "é", "<b>", "</li>", "&nbsp;", "[", "]", ",", "/", "_20240131", "x1"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(n)] + [None]


def python_between(s, a, b):
    if a not in s:
        return None
    rest = s.split(a, 1)[1]
    return rest.split(b, 1)[0]


def test_text_functions_match_python(spark):
    texts = random_texts()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    rows = df.select(
        "s",
        text.text_before("s", "Update").alias("before"),
        text.text_after("s", "Update").alias("after"),
        text.text_between("s", "Service", "Update").alias("between"),
        text.one_line("s").alias("line"),
        text.dotted_part("s", 2).alias("part"),
        text.initial_capital("s").alias("capital"),
        text.plain_text("s").alias("plain"),
        text.blank_to("s").alias("filled"),
        text.text_length("s").alias("length"),
        text.path_segment("s", -1).alias("segment"),
    ).collect()
    assert len(rows) == len(texts)
    for r in rows:
        s = r["s"]
        if s is None:
            assert [v for v in r if v is not None] == ["unknown"]
            continue
        assert r["before"] == (s.split("Update", 1)[0] if "Update" in s else None)
        assert r["after"] == (s.split("Update", 1)[1] if "Update" in s else None)
        assert r["between"] == python_between(s, "Service", "Update")
        assert r["line"] == s.replace("\r", "").replace("\n", "").replace("\t", "")
        parts = s.split(".")
        assert r["part"] == (parts[-2] if 2 <= len(parts) <= 4 else None)
        assert r["capital"] == s[:1].upper() + s[1:].lower()
        plain = s
        for token, value in text.RICH_TEXT_TOKENS:
            plain = plain.replace(token, value)
        assert r["plain"] == plain.strip(" ")
        assert r["filled"] == (s if s.strip(" ") else "unknown")
        assert r["length"] == len(s.rstrip(" "))
        assert r["segment"] == s.split("/")[-1]


def test_list_items(spark):
    texts = ["[a, b]", "a,b , c", "[]", "", "['x', \"y\"]", "[ one ]"]
    df = spark.createDataFrame([(s,) for s in texts], "s string").select(text.list_items("s").alias("x"))
    assert [r["x"] for r in df.collect()] == [["a", "b"], ["a", "b", "c"], [], [], ["x", "y"], ["one"]]


def test_file_dates(spark):
    names = ["sales_01022024.csv", "a_b_20240201.csv", "none.csv", "sales_2024.csv", "x_99999999.csv", "x_20240301_old.csv"]
    df = spark.createDataFrame([(s,) for s in names], "s string")
    rows = df.select(text.file_date("s", "ddMMyyyy").alias("d"), text.file_date("s", "yyyyMMdd").alias("y")).collect()
    assert [r["d"] for r in rows][0] == "20240131"
    assert [r["y"] for r in rows][1:5] == ["20240131", "N/A", "N/A", "N/A"]
    assert rows[5]["y"] == "N/A"


def test_calendar_parts_match_python(spark):
    days = [dt.date(1999, 12, 31) + dt.timedelta(days=37 * i) for i in range(120)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    parts = dates.date_parts("d")
    for r in df.select("d", dates.month_key("d").alias("m"), *[c.alias(n) for n, c in parts.items()]).collect():
        d = r["d"]
        assert r["m"] == d.strftime("%Y%m") and r["date_key"] == int(d.strftime("%Y%m%d"))
        assert (r["day_name"], r["month_name"]) == (d.strftime("%A"), d.strftime("%B"))
        assert (r["week_of_year"], r["day_of_year"]) == (d.isocalendar().week, d.timetuple().tm_yday)
        assert r["quarter"] == f"Q{(d.month + 2) // 3}"


def test_numbers(spark):
    df = spark.createDataFrame([(1, 3, "2024-05"), (2, 0, "abcd"), (None, 5, None)], "a int, b int, s string")
    rows = df.select(values.whole_percent("a", "b").alias("p"), values.number_prefix("s", 4).alias("n")).collect()
    assert [(r["p"], r["n"]) for r in rows] == [(33, 2024), (None, None), (None, None)]


def test_fills_follow_the_schema(spark):
    df = spark.createDataFrame([(None, None, None, None)], "t string, i int, d double, b boolean")
    assert df.fillna(values.fill_values(df)).first() == ("unknown", 0, 0.0, None)
    nan = spark.createDataFrame([(float("nan"), "abc", 1)], "d double, t string, i int")
    assert nan.select(values.any_missing(nan).alias("x")).first()["x"] is True
    assert nan.select(F.lit(1)).count() == 1

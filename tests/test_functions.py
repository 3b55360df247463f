from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farelens import functions as fn


def value(spark, column, **columns):
    names = ", ".join(f"{name} string" for name in columns)
    df = spark.createDataFrame([tuple(columns.values())], names)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("index", "item"), [(0, "a"), (1, "b"), (2, None), (9, None)])
def test_split_item(spark, index, item):
    assert value(spark, fn.split_item("s", ", ?", index), s="a, b") == item


def test_cutting_text(spark):
    assert value(spark, fn.tail_from("s", 3), s="abcde") == "cde"
    assert value(spark, fn.tail_from("s", 9), s="abc") == ""
    assert value(spark, fn.between_ends("s"), s="[120.50]") == "120.50"
    assert value(spark, fn.replace_all("s", "[{}]", ""), s="{a}{b}") == "ab"
    assert value(spark, fn.between_ends("s"), s=None) is None


@pytest.mark.parametrize(
    ("text", "repeats"),
    [
        ("departure x departure", True),
        ("departure", False),
        ("departures departure", False),
        (None, None),
    ],
)
def test_word_repeats(spark, text, repeats):
    assert value(spark, fn.word_repeats(F.col("s"), "departure"), s=text) is repeats


def test_map_entries(spark):
    price = F.create_map(F.lit("currency"), F.lit("EUR"), F.lit("grandTotal"), "s")
    assert value(spark, fn.entry_text(price, "grandTotal"), s="100.10") == "[100.10]"
    assert value(spark, fn.entry_text(price, "tax"), s="1") == "[]"
    assert value(spark, fn.entry_values(price, "currency"), s="1") == ["EUR"]


@pytest.mark.parametrize(("text", "number"), [("1.5", 1.5), ("x", None), ("", None), (None, None)])
def test_as_number(spark, text, number):
    assert value(spark, fn.as_number("s"), s=text) == number


def test_dates(spark):
    df = spark.createDataFrame(
        [("2023-01-14T10:25:00",), ("2023-01-14",), ("2023-13-45",), ("garbage",)], "s string"
    )
    rows = df.select(fn.as_date("s").alias("d"), fn.as_event_time(df, "s").alias("t")).collect()
    assert [r.d for r in rows] == [date(2023, 1, 14), date(2023, 1, 14), None, None]
    assert [r.t for r in rows] == [datetime(2023, 1, 14, 10, 25), datetime(2023, 1, 14), None, None]
    stamped = df.select(F.to_timestamp(F.lit("2023-01-14 10:00:00")).alias("t"))
    assert stamped.select(fn.as_event_time(stamped, "t")).dtypes == [("t", "timestamp")]

from datetime import datetime

import pytest

from farelens.operators import metrics

SCHEMA = "id string, date_de_depart string, price double, Company string"


def tickets(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def values(df):
    return [tuple(row) for row in df.collect()]


def test_windows_are_30_days_from_the_epoch(spark):
    rows = tickets(
        spark,
        ("1", "2023-01-22T23:59:59", 10.0, "A"),
        ("2", "2022-12-24T00:00:00", 20.0, "A"),
        ("3", "2023-01-23T00:00:00", 40.0, "A"),
        ("4", "no date", 99.0, "A"),
        ("5", None, 99.0, "A"),
    )
    assert values(metrics.avg_price_by_window(rows)) == [
        (datetime(2022, 12, 24), datetime(2023, 1, 23), 15.0),
        (datetime(2023, 1, 23), datetime(2023, 2, 22), 40.0),
    ]
    assert len(values(metrics.avg_price_by_window(rows, width="1 day"))) == 3


def test_company_average_counts_every_row(spark):
    rows = tickets(
        spark,
        ("1", "2023-01-14", 10.0, "B"),
        ("1", "2023-01-14", 10.0, "B"),
        ("2", "2023-01-14", 40.0, "B"),
        ("3", "2023-01-14", 5.0, None),
        ("4", "2023-01-14", None, "A"),
    )
    assert values(metrics.avg_price_by_company(rows)) == [(None, 5.0), ("A", None), ("B", 20.0)]


def test_ticket_count_is_distinct_and_orders_ties_by_company(spark):
    rows = tickets(
        spark,
        ("1", "2023-01-14", 1.0, "B"),
        ("1", "2023-01-15", 2.0, "B"),
        (None, "2023-01-15", 2.0, "B"),
        (None, "2023-01-15", 2.0, "B"),
        ("1", "2023-01-14", 1.0, "A"),
        ("2", "2023-01-14", 1.0, "A"),
        ("9", "2023-01-14", 1.0, None),
    )
    assert values(metrics.tickets_by_company(rows)) == [("A", 2), ("B", 2), (None, 1)]
    per_day = metrics.tickets_by_company(rows, key_cols=("id", "date_de_depart"))
    assert values(per_day) == [("B", 3), ("A", 2), (None, 1)]


def test_counts_per_key(spark):
    rows = tickets(spark, *[("1", "2023-01-14", 1.0, "A")] * 3, ("2", "2023-01-14", 1.0, "A"))
    assert sorted(values(metrics.ticket_counts(rows, ["id", "Company"]))) == [
        ("1", "A", 3),
        ("2", "A", 1),
    ]


def test_weekday_average_is_over_distinct_prices(spark):
    saturday, sunday = "2023-01-14T10:00:00", "2023-01-15"
    rows = tickets(
        spark,
        ("1", saturday, 10.0, "A"),
        ("1", saturday, 10.0, "B"),
        ("2", saturday, 40.0, "A"),
        ("3", sunday, 7.0, "A"),
        ("4", "garbage", 3.0, "A"),
    )
    assert values(metrics.avg_price_by_weekday(rows)) == [(None, 3.0), (1, 7.0), (7, 25.0)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_results_do_not_depend_on_the_session_time_zone(spark, zone):
    rows = tickets(spark, ("1", "2023-01-14T23:30:00", 10.0, "A"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(metrics.avg_price_by_weekday(rows)) == [(7, 10.0)]
        assert values(metrics.avg_price_by_window(rows, "1 day"))[0][0] == datetime(2023, 1, 14)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_exact_averages_do_not_depend_on_partitioning(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    tickets = lines.selectExpr("l_suppkey as Company", "l_extendedprice as price")

    def found(parts):
        spread = tickets.repartition(parts, "price")
        return metrics.avg_price_by_company(spread, exact=2).collect()

    assert found(1) == found(3) == found(8)


def test_exact_average_of_nothing_is_null(spark):
    rows = spark.createDataFrame([("A", None), ("B", 1.25), ("B", 1.5)], "Company string, price double")
    found = metrics.avg_price_by_company(rows, exact=2).collect()
    assert [tuple(r) for r in found] == [("A", None), ("B", 1.375)]

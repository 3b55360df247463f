"""Every registered query against its SQL, on the smallest given tables."""

import math
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from farelens.operators.tickets import plane_tickets, ticket_table
from farelens.plans import tables
from farelens.plans.export import tickets_for_requests
from farelens.plans.queries import QUERIES
from farelens.schemas import REQUEST_KEY

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sql, name):
    result = contract.queries()[name](spark, str(SF))
    expected = sql.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = canonical(result.columns, [tuple(r) for r in result.collect()])
    assert found == canonical(columns, expected.fetchall())
    assert found


def test_times_survive_a_zone_with_daylight_saving(spark, sql):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("ticket_table_connecting", "safe_casts", "avg_price_30d_stream"):
            test_query_equals_sql(spark, sql, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_query_runs_python_per_row(spark):
    for name in ("connecting_tickets", "direct_tickets", "avg_price_by_weekday", "safe_casts"):
        plan = contract.queries()[name](spark, str(SF))._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_entry(spark):
    assert contract.entry(spark).columns == ["weekday", "avg_price"]


@pytest.mark.parametrize("name", ["bookable_offers", "explode_itineraries", "ticket_table_connecting"])
def test_generated_methods_stay_small_enough_to_be_compiled(spark, name):
    """The JVM interprets methods of more than 8,000 bytes."""
    plan = QUERIES[name](spark, str(SF))._jdf.queryExecution()
    code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert all(n < 8000 for n in sizes)
    if "Adaptive" not in plan.executedPlan().toString():
        assert sizes


def test_segments_are_not_put_together_by_interpreted_code(spark):
    plan = tables.offers(spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "departure" in plan and "lambdafunction(struct(" not in plan


def test_the_export_leaves_out_what_was_not_asked_for(spark):
    offers = tables.offers(spark, str(SF))
    asked = (F.col("adults") == 2) & (F.col("destination") == "BBA")
    requests = offers.filter(asked).select(*REQUEST_KEY).distinct()
    names = tables.airports(spark, str(SF)), tables.airlines(spark, str(SF))
    found = tickets_for_requests(requests, offers, *names).drop("dep_date")
    expected = ticket_table(plane_tickets(offers.filter(asked), *names, "connecting"))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert 0 < expected.count() < ticket_table(plane_tickets(offers, *names, "connecting")).count()

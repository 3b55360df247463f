from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from samples import AIRLINES, AIRPORTS, DIRECT, VIA_MADRID, airlines, airports, offer, segment

from farelens.operators import tickets as tix
from farelens.schemas import TICKET
from farelens.sources.offers import offers_from_rows
from farelens.workspace import stored


def build(spark, documents, stops, airport_rows=AIRPORTS, airline_rows=AIRLINES):
    return tix.plane_tickets(
        offers_from_rows(spark, documents),
        airports(spark, airport_rows),
        airlines(spark, airline_rows),
        stops,
    )


def test_direct_ticket(spark):
    tickets = build(spark, [offer("1", DIRECT), offer("2", VIA_MADRID)], "direct")
    assert tuple(tickets.columns) == tix.DIRECT_COLUMNS
    (row,) = tickets.collect()
    assert row.asDict() == {
        "id": "1",
        "Aeroport_de_depart": "CDG",
        "ville_de_depart": "Paris",
        "date_de_depart": "2023-01-14T02:00:00",
        "Aeroport_darrive": "LIS",
        "Ville_darrivee": "Lisbon",
        "date_darrivee": "2023-01-14T03:00:00",
        "escale": False,
        "currency": "EUR",
        "prices": "120.50",
        "Cabin": "ECONOMY",
        "Company": "Air One",
        "lastTicketingDate": "2023-01-10",
    }


def test_connecting_ticket(spark):
    tickets = build(spark, [offer("1", DIRECT), offer("2", VIA_MADRID)], "connecting")
    assert tuple(tickets.columns) == tix.CONNECTING_COLUMNS
    (row,) = tickets.collect()
    assert (row.ville_de_depart, row.ville_descale, row.ville_darrivee) == (
        "Paris",
        "Madrid",
        "Lisbon",
    )
    assert (row.date_darrivee_escale, row.date_depart_escale) == (
        "2023-01-14T03:00:00",
        "2023-01-14T04:00:00",
    )


def test_unknown_or_missing_codes_drop_the_ticket(spark):
    documents = [
        offer("unknown-airport", [segment(1, "CDG", "XXX")]),
        offer("null-airport", [segment(1, None, "LIS")]),
        offer("unknown-airline", [segment(1, "CDG", "LIS", carrier="ZZ")]),
        offer("null-airline", [segment(1, "CDG", "LIS", carrier=None)]),
    ]
    assert build(spark, documents, "direct").count() == 0


def test_a_code_listed_twice_multiplies_the_ticket(spark):
    cities = [*AIRPORTS, ("Lutetia", "CDG")]
    tickets = build(spark, [offer("1", DIRECT)], "direct", airport_rows=cities)
    assert sorted(r.ville_de_depart for r in tickets.collect()) == ["Lutetia", "Paris"]


def test_large_dimension_joins_without_broadcast(spark):
    """Same tickets when no side is small enough to broadcast."""
    documents = [offer(str(n), VIA_MADRID) for n in range(50)]
    expected = sorted(map(tuple, build(spark, documents, "connecting").collect()))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        tickets = build(spark, documents, "connecting")
        assert "SortMergeJoin" in tickets._jdf.queryExecution().toString()
        assert sorted(map(tuple, tickets.collect())) == expected
    finally:
        spark.conf.set(key, before)


def test_ticket_table_of_both_variants(spark):
    documents = [offer("1", DIRECT), offer("2", VIA_MADRID)]
    direct = tix.ticket_table(build(spark, documents, "direct"))
    connecting = tix.ticket_table(build(spark, documents, "connecting"))
    assert direct.columns == connecting.columns == TICKET.names
    assert direct.dtypes == connecting.dtypes
    rows = {r.id: r for r in direct.union(connecting).collect()}
    assert rows["1"].ville_descale is None and rows["1"].date_depart_escale is None
    assert rows["2"].date_depart_escale == datetime(2023, 1, 14, 4)
    assert rows["2"].lastTicketingDate == date(2023, 1, 10)
    assert [rows["1"].price, rows["1"].escale, rows["2"].escale] == [120.5, False, True]


@pytest.mark.parametrize(
    ("text", "price"),
    [("99.123456789", 99.123456789), ("free", None), (None, None), ("100", 100.0)],
)
def test_price_text(spark, text, price):
    documents = [offer("1", DIRECT, price={"currency": "EUR", "grandTotal": text})]
    assert tix.ticket_table(build(spark, documents, "direct")).first().price == price


def test_malformed_times_become_null(spark):
    leg = segment(1, "CDG", "LIS")
    leg["departure"]["at"] = "soon"
    documents = [offer("1", [leg], lastTicketingDate="never")]
    row = tix.ticket_table(build(spark, documents, "direct")).first()
    assert (row.date_de_depart, row.lastTicketingDate) == (None, None)
    assert row.date_darrivee == datetime(2023, 1, 14, 3)


ROLES = {
    "departure_airport": "ville_de_depart",
    "layover_airport": "ville_descale",
    "arrival_airport": "ville_darrivee",
}


def legs(spark, *rows):
    keys = "id string, origin string, destination string, request_date date, adults int"
    codes = ", ".join(f"{code} string" for code in ROLES)
    values = [(f"id-{n}", "CDG", None if n % 2 else "LIS", None, 2, *r) for n, r in enumerate(rows)]
    return spark.createDataFrame(values, f"{keys}, {codes}")


def test_cities_of_all_roles_by_one_join(spark):
    """Unknown and null codes drop a row, codes listed twice multiply it, keys may hold nulls."""
    fares = legs(
        spark,
        ("CDG", "MAD", "LIS"),
        ("CDG", "XXX", "LIS"),
        ("MAD", "MAD", "MAD"),
        (None, "MAD", "LIS"),
        ("CDG", "MAD", None),
        *[("CDG", "MAD", "CDG")] * 20,
    )
    known = airports(spark, [*AIRPORTS, ("Madrid again", "MAD"), (None, "LIS")])
    expected = fares
    for code, city in ROLES.items():
        expected = tix.with_city(expected, known, code, city)
    found = tix.with_cities(fares, known, ROLES)
    assert found.columns == [*fares.columns, *ROLES.values()]
    assert sorted(map(str, found.collect())) == sorted(
        map(str, expected.select(*found.columns).collect())
    )
    assert found.count() > 40
    assert tix.with_cities(fares.limit(0), known, ROLES).count() == 0


def test_one_join_and_no_shuffle_of_fares_per_role(spark):
    fares, known = stored(legs(spark, ("CDG", "MAD", "LIS"))), stored(airports(spark))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plans = []
        role_by_role = fares
        for code, city in ROLES.items():
            role_by_role = tix.with_city(role_by_role, known, code, city)
        for df in (tix.with_cities(fares, known, ROLES), role_by_role):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [p.count("SortMergeJoin") for p in plans] == [1, 3]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [3, 6]


def test_names_as_of_a_day(spark):
    """Overlapping, open, single-day and empty ranges; days outside, days and keys unknown."""
    days = [date(2023, 1, 1), date(2023, 6, 30), date(2023, 7, 1), date(2024, 2, 29), None]
    rows = spark.createDataFrame(
        [(n, key, day) for n, day in enumerate(days) for key in ("AF", "IB", "ZZ", None)],
        "n int, carrier string, day date",
    )
    versions = [
        ("AF", None, date(2023, 6, 30), "old"),
        ("AF", date(2023, 6, 30), None, "new"),
        ("AF", date(2023, 7, 1), date(2023, 7, 1), "one day"),
        ("AF", date(2024, 1, 1), date(2023, 1, 1), "never"),
        ("IB", None, None, "always"),
        ("ZZ", date(2025, 1, 1), None, "later"),
        (None, None, None, "nobody"),
    ]
    table = spark.createDataFrame(
        versions, "carrier string, valid_from date, valid_to date, Company string"
    )
    expected = [
        (r.n, r.carrier, r.day, name)
        for r in rows.collect()
        for key, low, high, name in versions
        if None not in (r.day, r.carrier) and key == r.carrier
        if (low is None or low <= r.day) and (high is None or r.day <= high)
    ]
    for bucket_days in (1, 90, 10000):
        found = tix.as_of(rows, table, "carrier", "day", bucket_days=bucket_days)
        assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert tix.as_of(rows.limit(0), table, "carrier", "day").count() == 0
    assert tix.as_of(rows, table.limit(0), "carrier", "day").count() == 0


def test_names_as_of_a_day_within_a_known_span_compute_the_rows_once(spark):
    """Rows that fail when computed: planning with a span must not touch them."""
    rows = spark.createDataFrame([(1, "AF", date(2023, 1, 1))], "n int, carrier string, day date")
    versions = spark.createDataFrame(
        [("AF", None, None, "Air")], "carrier string, valid_from date, valid_to date, Company string"
    )
    span = (date(2022, 1, 1), date(2024, 1, 1))
    assert [r.Company for r in tix.as_of(rows, versions, "carrier", "day", span=span).collect()] == ["Air"]
    failing = rows.withColumn("day", F.when(F.col("n") > 0, F.raise_error(F.lit("computed")).cast("date")))
    assert tix.as_of(failing, versions, "carrier", "day", span=span).columns[-1] == "Company"

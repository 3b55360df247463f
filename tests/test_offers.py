import random
from datetime import date

import pytest
from samples import DIRECT, VIA_MADRID, offer, segment, traveler

from farelens.operators import offers as ops
from farelens.schemas import OFFER
from farelens.sources.offers import offers_from_rows


def load(spark, *documents):
    return offers_from_rows(spark, documents)


def ids(df):
    return sorted(row.id for row in df.select("id").collect())


def test_seats_must_cover_the_passengers(spark):
    offers = load(
        spark,
        offer("below", DIRECT, numberOfBookableSeats=1),
        offer("equal", DIRECT, numberOfBookableSeats=2),
        offer("above", DIRECT, numberOfBookableSeats=3),
        offer("unknown", DIRECT, numberOfBookableSeats=None),
    )
    assert ids(ops.bookable_offers(offers)) == ["above", "equal"]
    assert ids(ops.bookable_offers(offers, adults=3)) == ["above"]


def test_itineraries_by_segment_count(spark):
    three = [*VIA_MADRID, segment(3, "LIS", "OPO")]
    offers = load(
        spark,
        offer("empty-list"),
        offer("null-list", itineraries=None),
        offer("null-segments", None),
        offer("zero", []),
        offer("two-itineraries", DIRECT, three),
    )
    rows = {
        (r.id, r.itinerary_pos): (r.n_segments, r.escale) for r in ops.itineraries(offers).collect()
    }
    assert rows == {
        ("null-segments", 0): (0, False),
        ("zero", 0): (0, False),
        ("two-itineraries", 0): (1, False),
        ("two-itineraries", 1): (3, True),
    }


def test_direct_legs(spark):
    offers = load(
        spark,
        offer("direct", [segment(1, "CDG", "LIS", carrier="AF", operating="TP")]),
        offer("connecting", VIA_MADRID),
        offer("no-leg", []),
    )
    its = ops.itineraries(offers)
    (row,) = ops.direct_legs(its).collect()
    assert (row.id, row.departure_airport, row.arrival_airport) == ("direct", "CDG", "LIS")
    assert (row.departure_time, row.arrival_time) == ("2023-01-14T02:00:00", "2023-01-14T03:00:00")
    assert row.carrier == "AF"
    assert ops.direct_legs(its, carrier="operating").first().carrier == "TP"
    with pytest.raises(ValueError):
        ops.direct_legs(its, carrier="any")


def test_connecting_legs_are_the_first_two(spark):
    three = [*VIA_MADRID, segment(3, "LIS", "OPO")]
    (row,) = ops.connecting_legs(ops.itineraries(load(spark, offer("x", three)))).collect()
    assert row.n_segments == 3
    assert (row.departure_airport, row.layover_airport, row.arrival_airport) == (
        "CDG",
        "MAD",
        "LIS",
    )
    assert row.layover_arrival_time == "2023-01-14T03:00:00"
    assert row.layover_departure_time == "2023-01-14T04:00:00"
    assert row.arrival_time == "2023-01-14T05:00:00"


@pytest.mark.parametrize(
    ("operating", "expected"),
    [(("AF", "IB"), "AF"), ((None, "IB"), "IB"), ((None, None), None)],
)
def test_connecting_carrier_is_the_first_operating_one(spark, operating, expected):
    legs = [
        segment(1, "CDG", "MAD", operating=operating[0]),
        segment(2, "MAD", "LIS", operating=operating[1]),
    ]
    rows = ops.connecting_legs(ops.itineraries(load(spark, offer("x", legs))))
    assert rows.first().carrier == expected
    marketing = ops.connecting_legs(
        ops.itineraries(load(spark, offer("x", legs))), carrier="marketing"
    )
    assert marketing.first().carrier == "AF"


def test_one_row_per_offer_with_the_lowest_travellers_cabin(spark):
    people = [traveler(10, "FIRST"), traveler(2, "ECONOMY"), traveler(3, "BUSINESS")]
    offers = load(
        spark,
        offer("many", VIA_MADRID, travelerPricings=people),
        offer("none", VIA_MADRID, travelerPricings=[]),
        offer("null", VIA_MADRID, travelerPricings=None),
    )
    (row,) = ops.offer_fares(offers, "connecting").collect()
    assert (row.id, row.Cabin, row.prices, row.currency) == ("many", "ECONOMY", "120.50", "EUR")
    assert ops.travelers(offers).count() == 3


def test_first_fitting_itinerary_wins(spark):
    late = [segment(4, "CDG", "MAD"), segment(5, "MAD", "LIS")]
    offers = load(spark, offer("x", DIRECT, VIA_MADRID, late))
    (row,) = ops.offer_fares(offers, "connecting").collect()
    assert (row.itinerary_pos, row.departure_time) == (1, "2023-01-14T02:00:00")
    assert ops.offer_fares(offers, "direct").first().itinerary_pos == 0


def test_same_id_of_two_dates_stays_two_offers(spark):
    offers = load(
        spark,
        offer("1", DIRECT),
        offer("1", DIRECT),
        offer("1", DIRECT, request_date=date(2023, 1, 15)),
        offer("1", DIRECT, destination="OPO"),
    )
    assert ops.offer_fares(offers, "direct").count() == 3


@pytest.mark.parametrize("seed", range(3))
def test_survivor_does_not_depend_on_order(spark, seed):
    """Copies that differ in every payload column, in random order and partitioning."""
    documents = [
        offer(
            "1",
            [segment(n % 3, "CDG", "MAD", operating=None if n % 2 else "AF"), VIA_MADRID[1]],
            price={"currency": "EUR", "grandTotal": f"{100 + n % 5}.00"},
            travelerPricings=[traveler(n % 4 + 1, "ECONOMY"), traveler(n % 4 + 2, "FIRST")],
        )
        for n in range(40)
    ]
    expected = ops.offer_fares(load(spark, *documents), "connecting").collect()
    random.Random(seed).shuffle(documents)
    for document in documents:
        document["travelerPricings"].reverse()
    shuffled = load(spark, *documents).repartition(3 + seed)
    assert ops.offer_fares(shuffled, "connecting").collect() == expected
    assert len(expected) == 1


def test_hot_offer_is_cut_before_the_shuffle(spark):
    offers = load(spark, offer("1", DIRECT))
    plan = ops.offer_fares(offers, "direct")._jdf.queryExecution().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_unknown_stops_are_refused(spark):
    with pytest.raises(ValueError):
        ops.offer_fares(load(spark, offer("1", DIRECT)), "maybe")


def test_no_documents_give_no_rows(spark):
    assert ops.offer_fares(load(spark), "direct").count() == 0


def test_null_items_of_lists_stay(spark):
    document = offer("1", DIRECT)
    document["itineraries"] = [None, *document["itineraries"]]
    document["travelerPricings"] = [None, traveler(1, "ECONOMY")]
    offers = spark.createDataFrame([document], OFFER)
    its = ops.itineraries(offers).orderBy("itinerary_pos").collect()
    assert [(r.itinerary_pos, r.n_segments) for r in its] == [(0, 0), (1, 1)]
    assert [r.travelerId for r in ops.travelers(offers).collect()] == [None, "1"]
    empty = spark.createDataFrame([offer("2", itineraries=[], travelerPricings=[])], OFFER)
    assert ops.itineraries(empty).count() == ops.travelers(empty).count() == 0


def test_lowest_traveler_does_not_change_the_fare(spark):
    lists = [
        [traveler(10, "A"), traveler(9, "B"), traveler(2, "C")],
        [traveler(1, "A")],
        [{"travelerId": "x", "fareDetailsBySegment": None}, traveler(3, "B")],
        [],
        None,
    ]
    documents = [offer(str(n), DIRECT, travelerPricings=t) for n, t in enumerate(lists)]
    offers = spark.createDataFrame(documents, OFFER)

    def cabins(df):
        rows = ops.add_fare(ops.direct_legs(ops.itineraries(df))).collect()
        return sorted((r.id, r.travelerId, str(r.Cabin)) for r in rows)

    cut = ops.lowest_traveler(offers)
    assert cabins(cut) == cabins(offers)
    assert cut.filter("size(travelerPricings) > 1").isEmpty()


def test_passenger_counts_are_part_of_the_key(spark):
    documents = [offer("1", DIRECT, adults=n) for n in (1, 2, 4, 5)]
    fares = ops.offer_fares(spark.createDataFrame(documents, OFFER), "direct").collect()
    assert sorted(r.adults for r in fares) == [1, 2, 4]


def test_no_filter_ranks_travelers(spark):
    """Spark moves a filter on the cut list below the explode, and ranks the travellers there once more."""
    people = [None, [], [traveler(2, "B"), traveler(1, "A")]]
    documents = [
        offer(f"id-{n}", DIRECT, travelerPricings=listed) for n, listed in enumerate(people)
    ]
    bookable = ops.lowest_traveler(ops.bookable_offers(offers_from_rows(spark, documents)))
    fares = ops.add_fare(ops.legs(ops.itineraries(bookable), "direct"))
    plan = fares._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [step for step in plan if "Filter" in step and "array_min" in step]
    assert [(r.id, r.Cabin) for r in fares.collect()] == [("id-2", "A")]

"""Offer documents to one flat row per offer: itinerary, legs, fare.

A document is one row, and everything up to :func:`dedup_offers` works inside that row,
so only the final de-duplication moves data.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.schemas import OFFER_KEY, REQUEST_KEY

STOPS = ("direct", "connecting")
CARRIERS = ("marketing", "operating")

_HEAD = (*OFFER_KEY, "lastTicketingDate")
_FARE = ("price", "travelerPricings")


def check_stops(stops: str) -> str:
    if stops not in STOPS:
        raise ValueError(f"stops must be one of {STOPS}, not {stops!r}")
    return stops


def bookable_offers(offers: DataFrame, adults: int | None = None) -> DataFrame:
    """Offers with a seat for every passenger.

    ``adults`` defaults to the passenger count of the request an offer answers. Offers
    with an unknown seat count are dropped.
    """
    wanted = F.col("adults") if adults is None else F.lit(adults)
    return offers.filter(F.col("numberOfBookableSeats") >= wanted).select(
        *_HEAD, "itineraries", *_FARE
    )


def itineraries(offers: DataFrame) -> DataFrame:
    """One row per itinerary, with its segment count and the stop-over flag ``escale``.

    Offers with an empty or null itinerary list disappear, as with any ``explode``; a null
    itinerary in a list is one without segments.
    """
    itinerary = F.posexplode_outer("itineraries").alias("itinerary_pos", "itinerary")
    n_segments = F.coalesce(F.size("segments"), F.lit(0))
    return (
        _dropping_empty(offers.select(*_HEAD, *_FARE, itinerary), "itinerary_pos")
        .select(*_HEAD, "itinerary_pos", F.col("itinerary.segments").alias("segments"), *_FARE)
        .withColumns({"n_segments": n_segments, "escale": n_segments >= 2})
    )


def travelers(offers: DataFrame) -> DataFrame:
    """One row per traveller, null ones included: id and the cabin of the first fare segment."""
    traveler = F.posexplode_outer("travelerPricings").alias("traveler_pos", "traveler")
    return _dropping_empty(offers.select(*_HEAD, traveler), "traveler_pos").select(
        *_HEAD,
        F.col("traveler.travelerId").alias("travelerId"),
        F.get("traveler.fareDetailsBySegment", 0)["cabin"].alias("Cabin"),
    )


def direct_legs(its: DataFrame, carrier: str = "marketing") -> DataFrame:
    """Both ends and the carrier of itineraries with a single segment.

    An itinerary without any segment has no leg and is left out.
    """
    first = F.get("segments", 0)
    return its.filter(~F.col("escale") & (F.col("n_segments") == 1)).select(
        *_leg_head(),
        first["departure"]["iataCode"].alias("departure_airport"),
        first["departure"]["at"].alias("departure_time"),
        first["arrival"]["iataCode"].alias("arrival_airport"),
        first["arrival"]["at"].alias("arrival_time"),
        _carrier(carrier).alias("carrier"),
        *_FARE,
    )


def connecting_legs(its: DataFrame, carrier: str = "operating") -> DataFrame:
    """The first two legs and the carrier of itineraries with two or more segments.

    With three or more, the arrival is that of leg 2; ``n_segments`` tells them apart.
    """
    first, second = F.get("segments", 0), F.get("segments", 1)
    return its.filter("escale").select(
        *_leg_head(),
        first["departure"]["iataCode"].alias("departure_airport"),
        first["departure"]["at"].alias("departure_time"),
        first["arrival"]["iataCode"].alias("layover_airport"),
        first["arrival"]["at"].alias("layover_arrival_time"),
        second["departure"]["at"].alias("layover_departure_time"),
        second["arrival"]["iataCode"].alias("arrival_airport"),
        second["arrival"]["at"].alias("arrival_time"),
        _carrier(carrier).alias("carrier"),
        *_FARE,
    )


def legs(its: DataFrame, stops: str) -> DataFrame:
    return direct_legs(its) if check_stops(stops) == "direct" else connecting_legs(its)


def add_fare(leg_rows: DataFrame) -> DataFrame:
    """Price, currency and cabin next to the legs; the cabin is the lowest traveller's.

    Offers without travellers are dropped. Ids that are numbers rank by value.
    """
    ranked = F.transform("travelerPricings", lambda t: F.struct(*_rank(t)))
    return (
        leg_rows.filter(_some_travelers(leg_rows))
        .withColumn("traveler", F.array_min(ranked))
        .withColumns(
            {
                "prices": F.col("price.grandTotal"),
                "currency": F.col("price.currency"),
                "traveler_number": F.col("traveler.number"),
                "travelerId": F.col("traveler.travelerId"),
                "Cabin": F.col("traveler.cabin"),
            }
        )
        .drop("price", "travelerPricings", "traveler")
    )


def dedup_offers(fares: DataFrame, key: tuple[str, ...] = OFFER_KEY) -> DataFrame:
    """One row per key: first itinerary, then lowest traveller, then the smallest row.

    The order covers every column, so the survivor does not depend on how rows are
    spread. ``row_number() = 1`` lets Spark cut each key to one row per map task before
    the shuffle, so a key shared by very many rows does not pile up in one task.
    """
    order = [F.asc_nulls_first(c) for c in survivor_order(fares, key)]
    return (
        fares.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
        .filter("_rank = 1")
        .drop("_rank")
    )


def survivor_order(fares: DataFrame, key: tuple[str, ...] = OFFER_KEY) -> list[str]:
    """The columns besides the key, in the order that decides which row of a key survives."""
    ranks = [c for c in ("itinerary_pos", "traveler_number", "travelerId") if c in fares.columns]
    return [*ranks, *(c for c in fares.columns if c not in key and c not in ranks)]


def smallest_rows(fares: DataFrame, key: tuple[str, ...] = OFFER_KEY) -> DataFrame:
    """The rows of :func:`dedup_offers` as an aggregate, which a stream can keep as state: the
    smallest struct of a key in that order, nulls first. Equal keys combine before the shuffle."""
    smallest = F.min(F.struct(*survivor_order(fares, key))).alias("smallest")
    return fares.groupBy(*key).agg(smallest).select(*key, "smallest.*")


def with_fare(leg_rows: DataFrame) -> DataFrame:
    """Legs with their fare, one row per offer."""
    return dedup_offers(add_fare(leg_rows)).drop("traveler_number", "travelerId")


def offer_fares(offers: DataFrame, stops: str, adults: int | None = None) -> DataFrame:
    """Documents to flat fares in one chain: seats, itinerary, legs, fare, de-duplication."""
    bookable = lowest_traveler(bookable_offers(offers, adults))
    return with_fare(legs(itineraries(bookable), stops))


def lowest_traveler(offers: DataFrame) -> DataFrame:
    """Cut the travellers to the one whose cabin the fare shows, so that rows made from an
    offer carry one. Offers without travellers stay as they are."""
    ranked = F.transform("travelerPricings", lambda t: F.struct(*_rank(t), t.alias("traveler")))
    one = F.array(F.array_min(ranked)["traveler"])
    cut = F.when(F.size("travelerPricings") > 1, one).otherwise(F.col("travelerPricings"))
    return offers.withColumn("travelerPricings", cut)


def _rank(t: Column) -> tuple[Column, ...]:
    return (
        t["travelerId"].try_cast("int").alias("number"),
        t["travelerId"].alias("travelerId"),
        F.get(t["fareDetailsBySegment"], 0)["cabin"].alias("cabin"),
    )


def _some_travelers(leg_rows: DataFrame) -> Column:
    """Whether travellers are listed. Compared by way of the itinerary's position, as Spark moves a filter
    on the list alone to below the explode, where it makes what :func:`lowest_traveler` gives twice."""
    n = F.size("travelerPricings")
    if "itinerary_pos" not in leg_rows.columns:
        return n > 0
    return n + F.col("itinerary_pos") > F.col("itinerary_pos")


def _dropping_empty(exploded: DataFrame, position: str) -> DataFrame:
    """Turn an outer explode into an inner one: only an empty or null list has no position.

    For an inner explode Spark first filters on the size of the array, which computes an
    array that is not a plain column twice.
    """
    return exploded.filter(F.col(position).isNotNull())


def _leg_head() -> tuple[str, ...]:
    return (*_HEAD, "itinerary_pos", "n_segments", "escale")


def _carrier(kind: str) -> Column:
    """Marketing carrier of segment 1, or the first operating carrier named by any segment."""
    if kind == "marketing":
        return F.get("segments", 0)["carrierCode"]
    if kind == "operating":
        return F.get(F.array_compact(F.col("segments.operating.carrierCode")), 0)
    raise ValueError(f"carrier must be one of {CARRIERS}, not {kind!r}")


__all__ = [
    "CARRIERS",
    "REQUEST_KEY",
    "STOPS",
    "add_fare",
    "bookable_offers",
    "check_stops",
    "connecting_legs",
    "dedup_offers",
    "direct_legs",
    "itineraries",
    "legs",
    "lowest_traveler",
    "offer_fares",
    "smallest_rows",
    "survivor_order",
    "travelers",
    "with_fare",
]

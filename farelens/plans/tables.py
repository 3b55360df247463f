"""The given tables in the shape of the inputs: offers, airports, airlines, tickets.

Every mapping is a projection of one table. An offer document is built from one line item,
so building documents moves no data and no document can grow with the table.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.schemas import AIRLINE, AIRPORT, OFFER, TICKET

ORIGINS, DESTINATIONS, MAX_ADULTS = ["AAA", "AAB"], ["BBA", "BBB", "BBC"], 4

#: Stops are numbered below 30, airports below 25: the rest are codes that nothing names.
STOPS = 30

MAX_SEGMENTS, MAX_TRAVELERS = 6, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def offers(
    spark: SparkSession, sf_dir: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One offer document per line item.

    ``prepare`` chooses or orders line items, which then have the columns of the offer's key, before
    documents are built from them: a document is many times as wide.

    Origins follow the supplier, destinations and passenger counts the order. The request
    date is the Monday of the shipping week and the id is the order key, so lines of one order
    shipped in one week from one origin are copies of one offer. The first itinerary has
    ``l_linenumber - 1`` segments (modulo 7), hopping from airport to airport by a step of
    ``l_partkey``. For an even quantity a direct second itinerary follows; for an odd one and
    no segments the itineraries are null. Up to three travellers are listed, last one first.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        "l_extendedprice",
        "l_quantity",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
    )
    keys = {
        "origin": _pick(ORIGINS, F.col("l_suppkey") % len(ORIGINS)),
        "destination": _pick(DESTINATIONS, F.col("l_orderkey") % len(DESTINATIONS)),
        "request_date": F.trunc("ship_date", "week"),
        "adults": (1 + F.col("l_orderkey") % MAX_ADULTS).cast("int"),
        "id": F.col("l_orderkey").cast("string"),
    }
    if prepare:
        lines = prepare(lines.withColumns(keys))
        keys = {name: F.col(name) for name in keys}
    places = range(1, MAX_SEGMENTS + 1)
    lines = lines.withColumns(
        {
            "stops": F.array(*map(_stop, range(MAX_SEGMENTS + 1))),
            "carriers": F.array(*(F.expr(f"l_suppkey div {i}").cast("string") for i in places)),
            "departs": F.array(*(_at(3 * (i - 1)) for i in places)),
            "arrives": F.array(*(_at(3 * (i - 1) + 2) for i in places)),
            "silent": (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"),
        }
    )
    n_segments = (F.col("l_linenumber") - 1) % (MAX_SEGMENTS + 1)
    main = F.struct(_segments(n_segments.cast("int")).alias("segments"))
    back = F.struct(F.array(_return_segment()).alias("segments"))
    even = F.col("l_quantity").cast("long") % 2 == 0

    n_travelers = (1 + F.col("l_orderkey") % MAX_TRAVELERS).cast("int")
    columns = keys | {
        "lastTicketingDate": F.date_sub("ship_date", 7).cast("string"),
        "numberOfBookableSeats": (1 + F.col("l_orderkey") % 9).cast("int"),
        "itineraries": F.when(even, F.array(main, back)).when(n_segments > 0, F.array(main)),
        "price": F.struct(
            F.lit("EUR").alias("currency"),
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("grandTotal"),
        ),
        "travelerPricings": _last(
            map(_traveler, range(MAX_TRAVELERS, 0, -1)), n_travelers
        ),
    }
    return lines.select(*[columns[name].alias(name) for name in OFFER.names])


def _last(items, n: Column) -> Column:
    items = list(items)
    return F.slice(F.array(*items), len(items) + 1 - n, n)


def _segments(n: Column) -> Column:
    """Segments 1 to ``n``: the airport moves on, the carrier key is the supplier's over the number.

    Line items with flag N name no operating carrier on segment 1, those with A and F on none.
    Arrays are zipped and not put together segment by segment, which a higher-order function does
    interpreted. The one for the operating carriers stays: beside it Spark cuts the code generated for
    the zips into methods; without it they are one of more than the 8,000 bytes that the JVM compiles.
    """
    silent = F.col("silent"), F.col("silent") | (F.col("l_returnflag") == "N")
    operating = F.transform(
        F.slice("carriers", F.lit(1), n),
        lambda carrier, i: F.when(
            ~F.when(i == 0, silent[1]).otherwise(silent[0]), F.struct(carrier.alias("carrierCode"))
        ),
    )
    numbers = F.lit([str(i) for i in range(1, MAX_SEGMENTS + 1)])
    parts = {
        "id": numbers,
        "departure": _leg_ends(F.col("stops"), F.col("departs")),
        "arrival": _leg_ends(F.slice("stops", 2, MAX_SEGMENTS), F.col("arrives")),
        "carrierCode": F.col("carriers"),
        "operating": operating,
    }
    return F.arrays_zip(*(F.slice(part, F.lit(1), n).alias(name) for name, part in parts.items()))


def _leg_ends(codes: Column, at: Column) -> Column:
    return F.arrays_zip(codes.alias("iataCode"), at.alias("at"))


def _return_segment() -> Column:
    return F.struct(
        F.lit("1").alias("id"),
        _leg_end(F.get("stops", F.lit(1)), _at(12)).alias("departure"),
        _leg_end(F.get("stops", F.lit(0)), _at(14)).alias("arrival"),
        F.get("carriers", F.lit(1)).alias("carrierCode"),
        F.lit(None).cast("struct<carrierCode:string>").alias("operating"),
    )


def _leg_end(code: Column, at: Column) -> Column:
    return F.struct(code.alias("iataCode"), at.alias("at"))


def _at(hour: int) -> Column:
    return F.concat("day", F.lit(f"T{hour:02d}:00:00"))


def _stop(i: int) -> Column:
    number = (F.col("l_suppkey") + i * F.col("l_partkey")) % STOPS
    return _pick([f"{n:03d}" for n in range(STOPS)], number.cast("int"))


def _traveler(number: int) -> Column:
    """Traveller ``number``; untaxed lines list no fare, so their cabin is unknown."""
    cabin = _pick(["CABIN-0", "CABIN-1", "CABIN-2"], (F.col("l_linenumber") + number) % 3)
    fare = F.struct(F.lit("1").alias("segmentId"), cabin.alias("cabin"))
    return F.struct(
        F.lit(str(number)).alias("travelerId"),
        F.when(F.col("l_tax") > 0, F.array(fare)).alias("fareDetailsBySegment"),
    )


def _pick(texts: list[str], index: Column) -> Column:
    """Item ``index`` of a constant list, which Spark folds into one literal."""
    return F.get(F.array(*[F.lit(t) for t in texts]), index)


def code(number: Column) -> Column:
    return F.lpad(number.cast("string"), 3, "0")


def airport_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in the layout of the airports file."""
    nations = table(spark, sf_dir, "nation")
    known = {
        "ID": F.col("n_nationkey").cast("string"),
        "City": F.col("n_name"),
        "IATA": code(F.col("n_nationkey")),
    }
    return _in_layout(nations, AIRPORT, known)


def airline_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the layout of the airlines file; those in debt have no code."""
    known = {
        "ID": F.col("s_suppkey").cast("string"),
        "Airline_name": F.col("s_name"),
        "IATA": F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey").cast("string")),
    }
    return _in_layout(table(spark, sf_dir, "supplier"), AIRLINE, known)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airport_file_rows(spark, sf_dir).select("City", "IATA")


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airline_file_rows(spark, sf_dir).select("Airline_name", "IATA").na.drop("any")


def airline_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airlines under the names they had: a first one up to June 1995, then a second. Those with even
    keys have both for half a year; those with odd keys end with 1997."""
    names, even = airlines(spark, sf_dir), F.col("IATA").cast("long") % 2 == 0
    day = {d: F.lit(d).cast("date") for d in ("1995-01-01", "1995-06-17", "1995-06-18", "1997-12-31")}
    first = names.select(
        "IATA", "Airline_name", F.lit(None).cast("date").alias("valid_from"), day["1995-06-17"].alias("valid_to")
    )
    second = names.select(
        "IATA",
        F.concat("Airline_name", F.lit(" Group")).alias("Airline_name"),
        F.when(even, day["1995-01-01"]).otherwise(day["1995-06-18"]).alias("valid_from"),
        F.when(~even, day["1997-12-31"]).alias("valid_to"),
    )
    return first.union(second)


def order_tickets(orders: DataFrame, **extra: Column) -> DataFrame:
    """Orders as tickets: who, when, how much. ``extra`` columns follow those of the layout."""
    at = F.col("o_orderdate")
    known = {
        "id": F.col("o_orderkey").cast("string"),
        "Aeroport_de_depart": code(F.col("o_custkey") % 25),
        "date_de_depart": at,
        "aeroport_darrivee": code(F.col("o_orderkey") % 25),
        "date_darrivee": at + F.expr("interval 3 hours"),
        "Company": F.col("o_orderpriority"),
        "price": F.col("o_totalprice"),
        "currency": F.lit("EUR"),
        "escale": F.lit("false"),
        "lastTicketingDate": at.cast("date").cast("string"),
    }
    return _in_layout(orders, TICKET, known, typed=False, **extra)


def line_tickets(lines: DataFrame, **extra: Column) -> DataFrame:
    """Line items as tickets of the company that is their supplier."""
    known = {
        "id": F.col("l_orderkey").cast("string"),
        "date_de_depart": F.col("l_shipdate"),
        "Company": F.col("l_suppkey").cast("string"),
        "price": F.col("l_extendedprice"),
        "currency": F.lit("EUR"),
    }
    return _in_layout(lines, TICKET, known, typed=False, **extra)


def _in_layout(
    df: DataFrame, layout, known: dict[str, Column], typed: bool = True, **extra: Column
) -> DataFrame:
    """Project to the columns of ``layout``; those not in ``known`` are null."""
    columns = []
    for field in layout.fields:
        column = known.get(field.name, F.lit(None).cast(field.dataType))
        if typed:
            column = column.cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns, *(column.alias(name) for name, column in extra.items()))

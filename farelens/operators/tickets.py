"""Fares to tickets: airline and city names, and the 16-column ticket table.

The dimensions carry no broadcast hint on purpose. Spark broadcasts them when their
measured size is under ``spark.sql.autoBroadcastJoinThreshold``, at planning time or, with
adaptive execution, from the real size at run time. Beyond that it sort-merges, and adaptive
skew handling splits the partition of a carrier or airport that holds much of the data.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions import as_date, as_event_time, as_number
from farelens.operators.offers import check_stops, offer_fares
from farelens.schemas import OFFER_KEY, TICKET

#: Column order of the two ticket variants.
DIRECT_COLUMNS = (
    "id",
    "Aeroport_de_depart",
    "ville_de_depart",
    "date_de_depart",
    "Aeroport_darrive",
    "Ville_darrivee",
    "date_darrivee",
    "escale",
    "currency",
    "prices",
    "Cabin",
    "Company",
    "lastTicketingDate",
)
CONNECTING_COLUMNS = (
    "id",
    "Aeroport_de_depart",
    "ville_de_depart",
    "date_de_depart",
    "ville_descale",
    "aeroport_descale",
    "date_darrivee_escale",
    "date_depart_escale",
    "aeroport_darrivee",
    "ville_darrivee",
    "date_darrivee",
    "escale",
    "currency",
    "prices",
    "Cabin",
    "Company",
    "lastTicketingDate",
)


def with_company(fares: DataFrame, airlines: DataFrame, code: str = "carrier") -> DataFrame:
    """Add the airline's name; a fare with an unknown carrier is dropped."""
    names = airlines.select(F.col("IATA").alias(code), F.col("Airline_name").alias("Company"))
    return fares.join(names, code, "inner")


def with_city(fares: DataFrame, airports: DataFrame, code: str, city: str) -> DataFrame:
    """Add the city of the airport in ``code``; call once per role of the airport table.

    A fare with an unknown code is dropped, and a code listed twice gives two rows.
    """
    cities = airports.select(F.col("IATA").alias(code), F.col("City").alias(city))
    return fares.join(cities, code, "inner")


def with_cities(
    fares: DataFrame,
    airports: DataFrame,
    roles: dict[str, str],
    key: tuple[str, ...] = OFFER_KEY,
) -> DataFrame:
    """The cities of several roles (code column to city column) by one join.

    For an airport table too large to broadcast: role by role, whole fares are shuffled once per
    role. Here the roles of a fare become rows, of which only the first carries the fare; these are
    joined once and put back together by ``key``, which must tell fares apart. Unknown codes drop
    a fare and codes listed twice multiply it, as in :func:`with_city`.
    """
    known = airports.filter("IATA IS NOT NULL").groupBy(F.col("IATA").alias("code"))
    known = known.agg(F.collect_list(F.struct("City")).alias("cities"))
    fare = F.struct(*fares.columns)
    kind = fares.select(fare.alias("fare")).schema["fare"].dataType
    nothing = F.lit(None).cast(kind)
    places = F.array(
        *(
            F.struct(
                F.lit(n).alias("role"), F.col(code).alias("code"), (nothing if n else fare).alias("fare")
            )
            for n, code in enumerate(roles)
        )
    )
    rows = fares.select(*key, F.explode(places).alias("place")).select(*key, "place.*")
    named = rows.join(known, "code")
    found = {f"cities{n}": F.when(F.col("role") == n, F.col("cities")) for n in range(len(roles))}
    parts = {"fare": F.col("fare")} | found
    back = named.groupBy(*key).agg(*(F.first(c, ignorenulls=True).alias(n) for n, c in parts.items()))
    back = back.dropna("any", subset=list(found)).select(*parts)
    for n, city in enumerate(roles.values()):
        back = back.withColumn(f"cities{n}", F.explode(f"cities{n}"))
    cities = (F.col(f"cities{n}.City").alias(city) for n, city in enumerate(roles.values()))
    return back.select("fare.*", *cities)


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    start: str = "valid_from",
    end: str = "valid_to",
    bucket_days: int = 90,
    span: tuple[date | None, date | None] | None = None,
) -> DataFrame:
    """Rows joined to the versions of their ``key`` that hold on their ``day``, a date.

    ``versions`` has ``key``, the dates ``start`` and ``end`` (both included, null for open) and any
    other columns, which are added. Overlapping versions multiply a row; a row without a version on
    its day, or without a day, is dropped.

    A version is listed once for each bucket of ``bucket_days`` that it touches and that any row can
    fall into, and joined on key and bucket. A row meets the versions of its bucket and not all of
    its key, and a key with most rows is spread over the days. ``span`` is a first and last day between
    which all rows lie, if the caller knows one; without it the rows are computed once more for it.
    """
    names = [c for c in versions.columns if c not in (key, start, end)]
    first, last = span or rows.agg(F.min(day), F.max(day)).first()

    def bucket(column):
        return F.floor(F.datediff(column, F.lit("1970-01-01").cast("date")) / bucket_days)

    low = F.greatest(F.col(start), F.lit(first).cast("date"))
    high = F.least(F.col(end), F.lit(last).cast("date"))
    listed = versions.filter(low <= high).select(
        key, start, end, *names, F.explode(F.sequence(bucket(low), bucket(high))).alias("_bucket")
    )
    found = rows.withColumn("_bucket", bucket(day)).join(listed, [key, "_bucket"])
    holds = (F.col(start).isNull() | (F.col(start) <= F.col(day))) & (
        F.col(end).isNull() | (F.col(day) <= F.col(end))
    )
    return found.filter(holds).select(*rows.columns, *names)


def direct_tickets(
    fares: DataFrame, airports: DataFrame, airlines: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Direct fares with names, in 13 columns after those named in ``keep``."""
    return (
        fares.transform(with_company, airlines)
        .transform(with_city, airports, "arrival_airport", "Ville_darrivee")
        .transform(with_city, airports, "departure_airport", "ville_de_depart")
        .withColumnsRenamed(
            {
                "departure_airport": "Aeroport_de_depart",
                "departure_time": "date_de_depart",
                "arrival_airport": "Aeroport_darrive",
                "arrival_time": "date_darrivee",
            }
        )
        .select(*keep, *DIRECT_COLUMNS)
    )


def connecting_tickets(
    fares: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    keep: tuple[str, ...] = (),
    one_pass: bool = False,
) -> DataFrame:
    """Connecting fares with names, in 17 columns after those named in ``keep``. ``one_pass`` is for
    airports too many to broadcast, see :func:`with_cities`; fares then are one per offer."""
    roles = {
        "layover_airport": "ville_descale",
        "departure_airport": "ville_de_depart",
        "arrival_airport": "ville_darrivee",
    }
    if one_pass:
        named = with_company(with_cities(fares, airports, roles), airlines)
    else:
        named = with_company(fares, airlines)
        for code, city in roles.items():
            named = with_city(named, airports, code, city)
    return (
        named.withColumnsRenamed(
            {
                "departure_airport": "Aeroport_de_depart",
                "departure_time": "date_de_depart",
                "layover_airport": "aeroport_descale",
                "layover_arrival_time": "date_darrivee_escale",
                "layover_departure_time": "date_depart_escale",
                "arrival_airport": "aeroport_darrivee",
                "arrival_time": "date_darrivee",
            }
        )
        .select(*keep, *CONNECTING_COLUMNS)
    )


def plane_tickets(
    offers: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    stops: str = "connecting",
    adults: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Offer documents to the direct or the connecting ticket variant."""
    fares = offer_fares(offers, check_stops(stops), adults)
    build = direct_tickets if stops == "direct" else connecting_tickets
    return build(fares, airports, airlines, keep)


def ticket_table(tickets: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Either variant as the 16-column ticket table, with parsed price and times.

    Direct tickets have null layover columns. Text that does not parse becomes null.
    """
    if "aeroport_descale" not in tickets.columns:
        tickets = tickets.withColumnsRenamed(
            {"Aeroport_darrive": "aeroport_darrivee", "Ville_darrivee": "ville_darrivee"}
        ).withColumns(
            {
                name: F.lit(None).cast("string")
                for name in (
                    "ville_descale",
                    "aeroport_descale",
                    "date_darrivee_escale",
                    "date_depart_escale",
                )
            }
        )
    times = ("date_de_depart", "date_darrivee", "date_darrivee_escale", "date_depart_escale")
    parsed = {name: as_event_time(tickets, name) for name in times}
    parsed["lastTicketingDate"] = as_date("lastTicketingDate")
    parsed["price"] = as_number("prices")
    return tickets.withColumns(parsed).select(*keep, *TICKET.names)

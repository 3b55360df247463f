"""Fixed schemas of the inputs. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T

_LEG_END = T.StructType(
    [
        T.StructField("iataCode", T.StringType()),
        T.StructField("at", T.StringType()),
    ]
)

SEGMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("departure", _LEG_END),
        T.StructField("arrival", _LEG_END),
        T.StructField("carrierCode", T.StringType()),
        T.StructField(
            "operating", T.StructType([T.StructField("carrierCode", T.StringType())])
        ),
    ]
)

TRAVELER = T.StructType(
    [
        T.StructField("travelerId", T.StringType()),
        T.StructField(
            "fareDetailsBySegment",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("segmentId", T.StringType()),
                        T.StructField("cabin", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

#: One flight offer, as landed: the parameters of the request it answers, then the document.
OFFER = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("request_date", T.DateType()),
        T.StructField("adults", T.IntegerType()),
        T.StructField("id", T.StringType()),
        T.StructField("lastTicketingDate", T.StringType()),
        T.StructField("numberOfBookableSeats", T.IntegerType()),
        T.StructField(
            "itineraries",
            T.ArrayType(T.StructType([T.StructField("segments", T.ArrayType(SEGMENT))])),
        ),
        T.StructField(
            "price",
            T.StructType(
                [
                    T.StructField("currency", T.StringType()),
                    T.StructField("grandTotal", T.StringType()),
                ]
            ),
        ),
        T.StructField("travelerPricings", T.ArrayType(TRAVELER)),
    ]
)

#: Columns that identify a request, and with the offer id an offer. Offer ids are only
#: unique within one answer, so the request belongs to the key. The id leads it, as sorting
#: by the key is fastest when its first column tells most rows apart.
REQUEST_KEY = ("origin", "destination", "request_date", "adults")
OFFER_KEY = ("id", *REQUEST_KEY)

#: Airports file: comma separated, no header, bound by position.
AIRPORT = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Airport_name", T.StringType()),
        T.StructField("City", T.StringType()),
        T.StructField("Country", T.StringType()),
        T.StructField("IATA", T.StringType()),
        T.StructField("ICAO", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Altitude", T.StringType()),
        T.StructField("Timezone_hours", T.IntegerType()),
        T.StructField("Daylight_savings_time", T.StringType()),
        T.StructField("Timezone_area", T.StringType()),
        T.StructField("Type_airport", T.StringType()),
    ]
)

#: Airlines file: comma separated, no header, bound by position.
AIRLINE = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Airline_name", T.StringType()),
        T.StructField("Alias", T.StringType()),
        T.StructField("IATA", T.StringType()),
        T.StructField("ICAO", T.StringType()),
        T.StructField("CallSign", T.StringType()),
        T.StructField("Country", T.StringType()),
        T.StructField("Active", T.StringType()),
    ]
)

#: Ticket exchange file: CSV with header, bound by position. Dates stay text here;
#: the operators parse them.
TICKET = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("Aeroport_de_depart", T.StringType()),
        T.StructField("ville_de_depart", T.StringType()),
        T.StructField("date_de_depart", T.StringType()),
        T.StructField("aeroport_darrivee", T.StringType()),
        T.StructField("ville_darrivee", T.StringType()),
        T.StructField("date_darrivee", T.StringType()),
        T.StructField("Company", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("escale", T.StringType()),
        T.StructField("ville_descale", T.StringType()),
        T.StructField("aeroport_descale", T.StringType()),
        T.StructField("date_darrivee_escale", T.StringType()),
        T.StructField("date_depart_escale", T.StringType()),
        T.StructField("lastTicketingDate", T.StringType()),
    ]
)

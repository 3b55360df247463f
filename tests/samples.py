"""Hand-written offer documents and dimensions."""

from datetime import date


def segment(number, start, end, carrier="AF", operating="same"):
    """Segment ``number`` leaving at hour 2n and landing an hour later."""
    flown_by = carrier if operating == "same" else operating
    return {
        "id": str(number),
        "departure": {"iataCode": start, "at": f"2023-01-14T{2 * number:02d}:00:00"},
        "arrival": {"iataCode": end, "at": f"2023-01-14T{2 * number + 1:02d}:00:00"},
        "carrierCode": carrier,
        "operating": None if flown_by is None else {"carrierCode": flown_by},
    }


def traveler(number, cabin):
    return {
        "travelerId": str(number),
        "fareDetailsBySegment": [{"segmentId": "1", "cabin": cabin}],
    }


def offer(id, *itineraries, **changes):
    document = {
        "origin": "CDG",
        "destination": "LIS",
        "request_date": date(2023, 1, 14),
        "adults": 2,
        "id": id,
        "lastTicketingDate": "2023-01-10",
        "numberOfBookableSeats": 4,
        "itineraries": [{"segments": segments} for segments in itineraries],
        "price": {"currency": "EUR", "grandTotal": "120.50"},
        "travelerPricings": [traveler(1, "ECONOMY")],
    }
    return document | changes


DIRECT = [segment(1, "CDG", "LIS")]
VIA_MADRID = [segment(1, "CDG", "MAD"), segment(2, "MAD", "LIS", carrier="IB")]

AIRPORTS = [("Paris", "CDG"), ("Madrid", "MAD"), ("Lisbon", "LIS"), ("Nowhere", None)]
AIRLINES = [("Air One", "AF"), ("Air Two", "IB")]


def airports(spark, rows=AIRPORTS):
    return spark.createDataFrame(rows, "City string, IATA string")


def airlines(spark, rows=AIRLINES):
    return spark.createDataFrame(rows, "Airline_name string, IATA string")

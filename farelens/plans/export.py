"""The date sweep: all requests of a sweep in one job, to one set of ticket files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.operators.tickets import plane_tickets, ticket_table
from farelens.schemas import REQUEST_KEY
from farelens.sources.exports import replace_dates
from farelens.sources.tickets import write_tickets


def tickets_for_requests(
    requests: DataFrame,
    offers: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    stops: str = "connecting",
) -> DataFrame:
    """The ticket table of the requested routes and dates, after the requested ``dep_date``.

    The first and last date asked for prune the folders of landed offers before they are
    read. Pass ``requests`` from files (see ``workspace.stored``) to let Spark weigh its size
    before planning the semi join.
    """
    first = requests.agg(F.min("request_date")).scalar()
    last = requests.agg(F.max("request_date")).scalar()
    asked = offers.filter(F.col("request_date").between(first, last)).join(
        requests.select(*REQUEST_KEY), list(REQUEST_KEY), "left_semi"
    )
    tickets = plane_tickets(asked, airports, airlines, stops, keep=("request_date",))
    table = ticket_table(tickets, keep=("request_date",))
    return table.withColumnRenamed("request_date", "dep_date")


def ticket_export(
    requests: DataFrame,
    offers: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    path: str,
    stops: str = "connecting",
) -> None:
    """Write those tickets as CSV, one folder per departure date."""
    write_tickets(tickets_for_requests(requests, offers, airports, airlines, stops), path)


def ticket_reexport(
    requests: DataFrame,
    offers: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    path: str,
    stops: str = "connecting",
) -> int:
    """Replace the requested dates, and only those, in an export kept by
    :mod:`farelens.sources.exports`; returns its new version. The dates come to the driver: they are
    days of a calendar."""
    days = requests.select(F.col("request_date").cast("string").alias("day")).distinct()
    tickets = tickets_for_requests(requests, offers, airports, airlines, stops)
    return replace_dates(tickets, path, [r.day for r in days.collect()])

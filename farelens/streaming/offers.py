"""Landed offers to fares and tickets as a stream.

The table holds per offer the row that survives de-duplication, the smallest in the fixed order of
:func:`farelens.operators.offers.dedup_offers`: each batch adds its own survivors, and of these the
smallest is read. The smallest of smallest rows is the smallest, so the result does not depend on how
copies fall into batches, and the table is all that has to be kept: a state beside it would hold
every offer twice more, on the executors and in the checkpoint.
Names are joined when the table is read: airports and airlines may change between two reads, and an
offer whose row changes must not keep names of its former one.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.operators import offers as ops
from farelens.operators import tickets as tix
from farelens.schemas import OFFER_KEY
from farelens.streaming.runner import run_table, run_to_table
from farelens.workspace import scratch_dir


def stream_offer_fares(
    offers: DataFrame,
    stops: str = "connecting",
    adults: int | None = None,
    watermark: str | None = None,
    path: str | None = None,
    **options,
) -> DataFrame:
    """Documents to one fare per offer; equals :func:`farelens.operators.offers.offer_fares`.

    The table has a row per offer and batch that had it, until a snapshot leaves one. With ``watermark``
    there is a state, in which offers whose request date lies so far behind the latest one are
    forgotten, and documents that come even later are left out. ``path``
    is the table to go on with, by default a new one; ``options`` as in
    :func:`farelens.streaming.runner.start_table`.
    """
    bookable = ops.lowest_traveler(ops.bookable_offers(offers, adults))
    fares = ops.add_fare(ops.legs(ops.itineraries(bookable), stops))
    columns, path = fares.columns, path or scratch_dir(offers.sparkSession, "fares")
    if watermark:
        day = F.col("request_date").cast("timestamp").alias("request_time")
        fares = fares.select("*", day).withWatermark("request_time", watermark)
        key = ("request_time", *OFFER_KEY)
        table = run_to_table(ops.smallest_rows(fares, key), path, key, **options)
    else:
        table = run_table(fares, path, _survivors, change=ops.smallest_rows, **options)
    return table.select(*columns).drop("traveler_number", "travelerId")


def _survivors(changes: DataFrame) -> DataFrame:
    """Of the rows that the batches kept for each offer, the smallest."""
    return ops.smallest_rows(changes.drop("batch_id"))


def stream_plane_tickets(
    offers: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    stops: str = "connecting",
    keep: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """Documents to the direct or the connecting ticket variant, by way of a table of fares."""
    fares = stream_offer_fares(offers, tix.check_stops(stops), **options)
    build = tix.direct_tickets if stops == "direct" else tix.connecting_tickets
    return build(fares, airports, airlines, keep)

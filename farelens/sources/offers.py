"""Flight offers: landed JSON or Parquet, rows in memory, JSON text, and the request sweep."""

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.schemas import OFFER, REQUEST_KEY
from farelens.sources.tickets import stream_files


def read_offers(
    spark: SparkSession, path: str | list[str], fmt: str = "json", corrupt: str | None = None
) -> DataFrame:
    """Landed offers. Folders named ``column=value`` fill that column and can be pruned.

    A line that is not an offer gives an all-null row, which the seats filter drops. With
    ``corrupt`` a JSON line that cannot be read is in the column of that name, so it can be
    counted or set aside.
    """
    if corrupt is None:
        return spark.read.schema(OFFER).format(fmt).load(path).select(*OFFER.names)
    schema = T.StructType([*OFFER.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.schema(schema).format(fmt).option("columnNameOfCorruptRecord", corrupt)
    return reader.load(path).select(*OFFER.names, corrupt)


def stream_offers(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Landed offers as a stream; see :func:`farelens.sources.tickets.stream_files`."""
    stream = stream_files(spark, path, OFFER, fmt, max_files=max_files, max_bytes=max_bytes)
    return stream.select(*OFFER.names)


def write_offers(offers: DataFrame, path: str, fmt: str = "json") -> None:
    """Land offers, one folder per request.

    ``rebalance`` sizes the files: small requests share a task, one that holds much of the
    data is split over several.
    """
    keys = [F.col(c) for c in REQUEST_KEY]
    writer = offers.hint("rebalance", *keys).write.partitionBy(*REQUEST_KEY).format(fmt)
    if fmt == "json":
        writer = writer.option("compression", "gzip")
    writer.mode("overwrite").save(path)


def offers_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Offers held by the caller, e.g. a decoded answer. No rows give an empty table."""
    return spark.createDataFrame(list(rows), OFFER)


def offers_from_text(df: DataFrame, text: str) -> DataFrame:
    """Offers from a column of JSON text. Text that is not JSON gives an all-null row, and so does none.

    Spark interprets ``from_json`` with all that it merges into it. The text is named twice, which keeps
    an expression that makes it in a projection of its own, with generated code.
    """
    offer = F.when(F.col(text).isNotNull(), F.from_json(text, OFFER))
    return df.select(offer.alias("offer")).select("offer.*")


def request_sweep(
    routes: DataFrame, start: date | None, end: date | None, last_day_of_month: int = 27
) -> DataFrame:
    """One request per route and day from ``start`` to ``end``; none without an end.

    Days of the month after ``last_day_of_month`` are not asked for. ``routes`` has
    origin, destination and adults.
    """
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return routes.select(
        "origin", "destination", F.explode(days).alias("request_date"), "adults"
    ).filter(F.dayofmonth("request_date") <= last_day_of_month)

"""Price metrics over a ticket table.

Each function takes a batch or a streaming DataFrame. A batch result comes sorted; a stream
has no order, so sort when reading its result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions import as_date, as_event_time


def mean(value: str, exact: int | None = None) -> Column:
    """The average. With ``exact`` it is the exact sum of values of so many decimals over their
    count, so it does not depend on the order in which tasks finish; values must stay below
    10^(18 - exact), as an overflow is an error. Without it, it is a plain average of doubles."""
    if exact is None:
        return F.avg(value)
    total = F.sum(F.col(value).cast(f"decimal(18,{exact})")).cast("double")
    return F.try_divide(total, F.count(value))


def avg_price_by_window(
    tickets: DataFrame,
    width: str = "30 days",
    time: str = "date_de_depart",
    price: str = "price",
    watermark: str | None = None,
    exact: int | None = None,
) -> DataFrame:
    """Average price per tumbling departure window, aligned to 1970-01-01.

    ``exact`` is as in :func:`mean`.

    Rows without a readable time are left out. ``watermark`` bounds the state of a stream
    at the price of ignoring rows later than that; by default every row counts. Spark takes
    a watermark on instants only, so with one the session time zone should be UTC.
    """
    rows = tickets.select(as_event_time(tickets, time).alias("time"), F.col(price).alias("price"))
    kind = rows.schema["time"].dataType
    if watermark:
        rows = rows.withColumn("time", F.col("time").cast("timestamp"))
        rows = rows.withWatermark("time", watermark)
    windows = rows.groupBy(F.window("time", width)).agg(mean("price", exact).alias("avg_price"))
    result = windows.select(
        F.col("window.start").cast(kind).alias("window_start"),
        F.col("window.end").cast(kind).alias("window_end"),
        "avg_price",
    )
    return _sorted(result, F.col("window_start"))


def avg_price_by_company(
    tickets: DataFrame, company: str = "Company", price: str = "price", exact: int | None = None
) -> DataFrame:
    """Average price per company over all rows. ``exact`` is as in :func:`mean`."""
    result = tickets.groupBy(company).agg(mean(price, exact).alias("avg_price"))
    return _sorted(result, F.col(company))


def ticket_counts(tickets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, ``n``. Its keys are the distinct keys, which the next level counts."""
    return tickets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def tickets_by_company(
    tickets: DataFrame,
    key_cols: Sequence[str] = ("id",),
    company: str = "Company",
    time: str = "date_de_depart",
    watermark: str | None = None,
) -> DataFrame:
    """Distinct tickets per company, most first; a null id counts as one ticket.

    ``watermark`` is as in :func:`distinct_rows`.
    """
    return company_totals(distinct_rows(tickets, (*key_cols, company), time, watermark), company)


def company_totals(distinct_tickets: DataFrame, company: str = "Company") -> DataFrame:
    """Second level of :func:`tickets_by_company`, over rows that are distinct already."""
    result = distinct_tickets.groupBy(company).agg(F.count(F.lit(1)).alias("n_tickets"))
    return _sorted(result, F.desc("n_tickets"), F.col(company))


def avg_price_by_weekday(
    tickets: DataFrame,
    time: str = "date_de_depart",
    price: str = "price",
    id_col: str = "id",
    watermark: str | None = None,
    exact: int | None = None,
) -> DataFrame:
    """Average price per weekday, 1 = Sunday, over distinct (departure, price, id).

    Departures that are not a date form a group of their own, with a null weekday.
    ``watermark`` is as in :func:`distinct_rows`, ``exact`` as in :func:`mean`.
    """
    distinct = distinct_rows(tickets, (time, price, id_col), time, watermark)
    return weekday_averages(distinct, time, price, exact)


def weekday_averages(
    distinct_prices: DataFrame,
    time: str = "date_de_depart",
    price: str = "price",
    exact: int | None = None,
) -> DataFrame:
    """Second level of :func:`avg_price_by_weekday`, over rows that are distinct already."""
    weekday = F.dayofweek(as_date(time)).alias("weekday")
    result = distinct_prices.groupBy(weekday).agg(mean(price, exact).alias("avg_price"))
    return _sorted(result, F.col("weekday"))


def distinct_rows(
    tickets: DataFrame, keys: Sequence[str], time: str, watermark: str | None = None
) -> DataFrame:
    """The distinct keys.

    A stream remembers every key. With ``watermark`` it forgets a key once departures have
    moved on by that much: the state is bounded, but a later copy counts again and a row
    later than that is ignored. A table is not affected.
    """
    if not (watermark and tickets.isStreaming):
        return tickets.select(*keys).dropDuplicates()
    instant = as_event_time(tickets, time).cast("timestamp")
    rows = tickets.select(*keys, instant.alias("event_time"))
    known = rows.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(keys))
    return known.select(*keys)


def _sorted(df: DataFrame, *order: Column) -> DataFrame:
    return df if df.isStreaming else df.orderBy(*order)

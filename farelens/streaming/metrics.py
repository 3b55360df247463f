"""The ticket metrics as streams.

A metric over distinct tickets has two levels, and the table holds the second: a batch adds what
its *new* keys contribute, so reading costs the groups and not the tickets. The stream's state knows
per key the time of the first and of the last batch that had it; a key is new where both are the
same. Unlike a streaming ``dropDuplicates`` this combines equal keys before the shuffle, so one ticket
repeated very often does not overload the task that owns it. Batch times are kept in the checkpoint,
so a repeated batch finds the same new keys and replaces its own rows.

With a watermark, companies and their tickets are counted from a table of the distinct keys, as a key
that state has forgotten must not count twice.

All take the same options: ``name`` of the query; ``state_partitions``; ``exact`` as in
:func:`farelens.operators.metrics.mean`; ``path`` of the result table, to go on from an earlier
run, by default a new one in the shared folder; and, where the metric has a departure time,
``watermark``. With a watermark, state of departures that lie so far behind the latest one is
forgotten, and rows that come even later are left out. The table keeps its rows.
"""

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions import as_date, as_event_time
from farelens.operators import metrics
from farelens.streaming.runner import (
    append_to_files,
    run_table,
    run_to_table,
    start_table,
    summed_rows,
)
from farelens.workspace import scratch_dir


def stream_avg_price_by_window(
    tickets: DataFrame,
    width: str = "30 days",
    time: str = "date_de_depart",
    price: str = "price",
    watermark: str | None = None,
    exact: int | None = None,
    **options,
) -> DataFrame:
    averages = metrics.avg_price_by_window(tickets, width, time, price, watermark, exact)
    return _table(averages, ["window_start"], **options).orderBy("window_start")


def stream_avg_price_by_company(
    tickets: DataFrame,
    company: str = "Company",
    price: str = "price",
    exact: int | None = None,
    **options,
) -> DataFrame:
    """One state per company, so there is nothing for a watermark to bound."""
    averages = metrics.avg_price_by_company(tickets, company, price, exact)
    return _table(averages, [company], **options).orderBy(company)


def stream_tickets_by_company(
    tickets: DataFrame,
    key_cols: tuple[str, ...] = ("id",),
    company: str = "Company",
    time: str = "date_de_depart",
    watermark: str | None = None,
    **options,
) -> DataFrame:
    keys = (*key_cols, company)
    if watermark is not None:
        return metrics.company_totals(_distinct(tickets, keys, time, watermark, **options), company)
    added = partial(_new_tickets, company=company)
    table = _sums(first_seen(tickets, keys), added, [company], **options)
    return table.orderBy(F.desc("n_tickets"), company)


def stream_avg_price_by_weekday(
    tickets: DataFrame,
    time: str = "date_de_depart",
    price: str = "price",
    id_col: str = "id",
    watermark: str | None = None,
    exact: int | None = None,
    **options,
) -> DataFrame:
    keys = (time, price, id_col)
    if watermark is not None:
        distinct = _distinct(tickets, keys, time, watermark, **options)
        return metrics.weekday_averages(distinct, time, price, exact)
    added = partial(_new_prices, time=time, price=price, exact=exact)
    sums = _sums(first_seen(tickets, keys), added, ["weekday"], **options)
    average = F.try_divide(F.col("total").cast("double"), F.col("n")).alias("avg_price")
    return sums.select("weekday", average).orderBy("weekday")


def stream_closed_windows(
    tickets: DataFrame,
    path: str,
    watermark: str,
    width: str = "30 days",
    time: str = "date_de_depart",
    price: str = "price",
    exact: int | None = None,
    **options,
) -> tuple[DataFrame, list[dict]]:
    """Average price of each departure window, written once, when it is closed.

    A window is closed when the latest departure of earlier batches lies ``watermark`` past its end;
    windows that are still open are not in the table. Rows later than that are left out and counted:
    returns the table under ``path`` and the progress of each batch with its ``late_rows``.
    """
    averages = metrics.avg_price_by_window(tickets, width, time, price, watermark, exact)
    progress = append_to_files(averages, path, **options)
    table = tickets.sparkSession.read.schema(averages.schema).parquet(path)
    return table.orderBy("window_start"), progress


def stream_distinct_for(
    tickets: DataFrame,
    keys: tuple[str, ...],
    keep: str,
    path: str,
    clock: str = "arrival",
    time: str = "date_de_depart",
    salts: int = 16,
    **options,
) -> tuple[DataFrame, list[dict]]:
    """Distinct keys from a state that forgets: a key is written when it is first seen, and its
    copies are left out for ``keep``, such as "1 hour", after that. Once forgotten, a key that comes
    again is written again.

    The ``clock`` is "arrival", the time of the batch that has a row, or "event", the departure
    time; then rows later than the watermark are left out and counted.

    By arrival all rows of a batch are of one age, so the state is what the table has of the last
    ``keep``: a batch writes its keys that are not among those. Keys are combined before the shuffle, so
    one that comes very often is no more than one row per task. A batch reads the keys of that span, in
    sequence; a state store is asked for each row and goes through all its keys to forget some.

    By departure state is in Spark's de-duplication, bounded by the keys of about twice the span. That does
    not combine before the shuffle, so copies of one key are first reduced per salt, which follows the
    task that reads a row, and then over salts.

    Returns the table under ``path`` and the progress of each batch, in which ``state_rows`` are those of
    a state store.
    """
    if clock not in ("arrival", "event"):
        raise ValueError(f"clock must be arrival or event, not {clock!r}")
    if clock == "arrival":
        rows = tickets.select(*keys, F.current_timestamp().alias("arrived"))
        running = start_table(
            rows,
            path,
            _all_rows,
            against=partial(_unseen, keys=keys, keep=keep),
            order=("arrived", *keys),
            reports=100_000,
            **options,
        )
        running.wait()
        return running.table.read().select(*keys), running.progress()
    now = as_event_time(tickets, time).cast("timestamp")
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")
    rows = tickets.select(*keys, now.alias("clock"), salt).withWatermark("clock", keep)
    once = rows.dropDuplicatesWithinWatermark([*keys, "salt"]).drop("salt")
    found = once.dropDuplicatesWithinWatermark(list(keys)).select(*keys)
    progress = append_to_files(found, path, **options)
    return tickets.sparkSession.read.schema(found.schema).parquet(path), progress


def _all_rows(changes: DataFrame) -> DataFrame:
    return changes.drop("batch_id")


def _unseen(batch: DataFrame, table: DataFrame, keys: tuple[str, ...], keep: str) -> DataFrame:
    """The distinct keys of a batch that the table has not had for ``keep``. Nulls are equal."""
    first = batch.select(F.unix_micros("arrived")).first()
    if first is None:
        return batch
    now = F.timestamp_micros(F.lit(first[0]))
    held = table.filter(F.col("arrived") >= now - F.lit(keep).cast("interval"))
    both = batch.select(*keys, F.lit(False).alias("held")).union(held.select(*keys, F.lit(True)))
    known = both.groupBy(*keys).agg(F.max("held").alias("held"))
    return known.filter(~F.col("held")).select(*keys, now.alias("arrived"))


def first_seen(tickets: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys with the time of the first and of the last batch that had them."""
    rows = tickets.select(*keys, F.current_timestamp().alias("batch_time"))
    return rows.groupBy(*keys).agg(
        F.min("batch_time").alias("first_seen"), F.max("batch_time").alias("last_seen")
    )


def _new_tickets(batch: DataFrame, company: str) -> DataFrame:
    new = batch.filter("first_seen = last_seen").groupBy(company)
    return new.agg(F.count(F.lit(1)).alias("n_tickets"))


def _new_prices(batch: DataFrame, time: str, price: str, exact: int | None) -> DataFrame:
    value = F.col(price) if exact is None else F.col(price).cast(f"decimal(18,{exact})")
    new = batch.filter("first_seen = last_seen").groupBy(F.dayofweek(as_date(time)).alias("weekday"))
    return new.agg(F.sum(value).alias("total"), F.count(price).alias("n"))


def _sums(
    result: DataFrame, added, keys: list[str], path: str | None = None, **options
) -> DataFrame:
    path = path or scratch_dir(result.sparkSession, "table")
    return run_table(result, path, partial(summed_rows, keys=keys), change=added, **options)


def _distinct(
    tickets: DataFrame, keys: tuple[str, ...], time: str, watermark: str, **options
) -> DataFrame:
    """Distinct keys, counted per departure, which the watermark can forget."""
    instant = as_event_time(tickets, time).cast("timestamp")
    rows = tickets.select(*keys, instant.alias("event_time")).withWatermark("event_time", watermark)
    keyed = ("event_time", *keys)
    counts = rows.groupBy(*keyed).agg(F.count(F.lit(1)).alias("n"))
    return _table(counts, keyed, **options).select(*keys).distinct()


def _table(result: DataFrame, keys, path: str | None = None, **options) -> DataFrame:
    return run_to_table(result, path or scratch_dir(result.sparkSession, "table"), keys, **options)

"""The ticket exchange files: write them per departure date, read them as table or stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.schemas import TICKET

_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def write_tickets(tickets: DataFrame, path: str, date_col: str = "dep_date") -> None:
    """CSV with header, one folder per value of ``date_col``.

    ``rebalance`` gives each date about one file, and several to a date too large for one.
    """
    (
        tickets.hint("rebalance", F.col(date_col))
        .select(date_col, *TICKET.names)
        .write.partitionBy(date_col)
        .option("header", True)
        .option("timestampNTZFormat", _TIME)
        .option("timestampFormat", _TIME)
        .mode("overwrite")
        .csv(path)
    )


def write_ticket_files(
    tickets: DataFrame, path: str, by: str | None = None, rows_per_file: int = 1_000_000
) -> None:
    """CSV with header, cut by row count; with ``by`` in one folder per value of that column."""
    if by:
        writer = tickets.hint("rebalance", by).select(by, *TICKET.names).write.partitionBy(by)
    else:
        writer = tickets.select(*TICKET.names).write
    (
        writer.option("header", True)
        .option("timestampNTZFormat", _TIME)
        .option("timestampFormat", _TIME)
        .option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite")
        .csv(path)
    )


def read_tickets(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Ticket files under folders or matching a glob, as one table.

    Columns bind by position; header names are skipped, not compared. ``multi_line`` reads
    quoted text with line breaks; such a file cannot be split over tasks.
    """
    reader = spark.read.schema(TICKET).option("header", True).option("multiLine", multi_line)
    return reader.option("escape", '"').csv(path).select(*TICKET.names)


def ticket_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The same table under a name for SQL."""
    tickets = read_tickets(spark, path)
    tickets.createOrReplaceTempView(name)
    return tickets


def stream_tickets(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Ticket files as a stream; see :func:`stream_files` for the rate limits."""
    stream = stream_files(
        spark, path, TICKET, "csv", max_files=max_files, max_bytes=max_bytes, header=True
    )
    return stream.select(*TICKET.names)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    **options,
) -> DataFrame:
    """Files of a folder or glob as a stream with a fixed schema.

    ``max_files=1`` takes one file per micro-batch. For many files bound the batch by
    ``max_bytes`` instead, as each batch costs a state-store commit whatever its size.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files and max_bytes:
        raise ValueError("give max_files or max_bytes, not both")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows, as ``show()`` prints them. Sort first if "first" shall mean something."""
    return df.limit(rows)

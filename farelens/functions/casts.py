"""Casts that turn malformed text into null instead of failing the job under ANSI mode."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_number(col: str | Column) -> Column:
    return _column(col).try_cast("double")


def as_date(col: str | Column) -> Column:
    return _column(col).try_cast("date")


def as_event_time(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp.

    Airport times are local wall-clock times without an offset, so text becomes
    TIMESTAMP_NTZ, whose value does not depend on the session time zone. Columns that
    are timestamps already stay as they are.
    """
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return F.col(name).try_cast("timestamp_ntz")


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col

"""Reading one entry of a map column."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def entry_values(col: str | Column, key: str) -> Column:
    """The values under ``key`` as an array: one item, or none when the key is missing."""
    return F.map_values(F.map_filter(col, lambda k, _: k == F.lit(key)))


def entry_text(col: str | Column, key: str) -> Column:
    """The same array printed as text, ``[value]``."""
    return entry_values(col, key).cast("string")

"""Cutting and testing text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_item(col: str | Column, pattern: str, index: int) -> Column:
    """Item ``index`` (from 0) of the text split by a regular expression, null when absent."""
    return F.get(F.split(col, pattern), index)


def tail_from(col: str | Column, position: int) -> Column:
    """The text from the 1-based ``position`` to its end."""
    return F.substring(col, F.lit(position), F.length(col))


def between_ends(col: str | Column) -> Column:
    """The text without its first and last character, e.g. ``[x]`` to ``x``."""
    return F.substring(col, F.lit(2), F.length(col) - 2)


def replace_all(col: str | Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, pattern, replacement)


def word_repeats(col: Column, word: str) -> Column:
    """Whether ``word`` stands in the text at least twice, as a whole word."""
    return col.rlike(rf"\b{word}\b.*\b{word}\b")

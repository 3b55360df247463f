"""Column helpers. Each returns a built-in JVM expression, never a Python UDF."""

from farelens.functions.casts import as_date, as_event_time, as_number
from farelens.functions.maps import entry_text, entry_values
from farelens.functions.text import (
    between_ends,
    replace_all,
    split_item,
    tail_from,
    word_repeats,
)

__all__ = [
    "as_date",
    "as_event_time",
    "as_number",
    "between_ends",
    "entry_text",
    "entry_values",
    "replace_all",
    "split_item",
    "tail_from",
    "word_repeats",
]

"""Text as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every white-space character that the sources may hold, line separators and the byte-order mark among them.
SPACE = "[\\s\\u00A0\\uFEFF\\u2028\\u2029\\u1680\\u2000-\\u200A\\u202F\\u205F\\u3000\\u000B]+"


def collapse(text: Column) -> Column:
    """White space to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def word_count(text: Column) -> Column:
    clean = collapse(text)
    return F.when(clean == "", 0).otherwise(F.size(F.split(clean, " ")))


def set_array(values: Column) -> Column:
    """A set-valued array in its canonical form: each value once, in the order of UTF-16 units."""
    keyed = F.transform(F.array_distinct(values), lambda v: F.struct(F.encode(v, "UTF-16BE").alias("units"), v.alias("value")))
    return F.transform(F.array_sort(keyed), lambda x: x["value"])


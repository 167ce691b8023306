"""Reading single values out of nested columns.

``F.get`` returns null outside the bounds, where ``[]`` raises under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import empty_to_null


def first_element(array: str | Column) -> Column:
    """The first element; null for a null or empty array."""
    return F.get(array, 0)


def first_leaf(lists: str | Column) -> Column:
    """The first string of the first inner list, with ``""`` read as null."""
    return empty_to_null(first_element(first_element(lists)))


def first_key(entries: str | Column) -> Column:
    """The key of the entry stored first (not of the smallest value)."""
    return first_element(F.map_keys(entries))


def first_value(entries: str | Column) -> Column:
    """The value of the entry stored first (not the smallest value)."""
    return first_element(F.map_values(entries))


def size_or_null(array: str | Column) -> Column:
    """The length, repeats included; null for a null or empty array."""
    return F.when(F.size(array) > 0, F.size(array))

"""Means over the items that an item's list points to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import is_valid_number
from shelfwise.functions.nested import size_or_null
from shelfwise.operators.attach import DEFAULT_SKEW, Skew, attach


def list_edges(items: DataFrame, key: str, neighbours: str, to: str) -> DataFrame:
    """One row per list element; null and empty lists give none."""
    return items.select(key, F.explode(neighbours).alias(to))


def neighbour_means(
    items: DataFrame,
    key: str,
    value: str,
    neighbours: str,
    mean_name: str,
    skip_nan: bool = False,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Mean ``value`` over the listed items, per ``key`` that has any.

    An id listed twice counts twice, an id held by several items counts each
    of them, and ids without an item or without a value count not at all. One
    NaN makes the mean NaN unless ``skip_nan``.

    Values are first added up per id, so an id that is both listed often and
    held by many items adds one row per listing, not one per pair.
    """
    has_value = is_valid_number(value) if skip_nan else F.col(value).isNotNull()
    to, total, number = "__to", "__total", "__number"
    values = (
        items.filter(F.col(key).isNotNull() & has_value)
        .groupBy(F.col(key).alias(to))
        .agg(F.sum(F.col(value).cast("double")).alias(total), F.count(value).alias(number))
    )
    edges = list_edges(items, key, neighbours, to)
    return (
        attach(edges, values, to, "inner", skew)
        .groupBy(key)
        .agg((F.sum(total) / F.sum(number)).alias(mean_name))
    )


def attach_neighbour_price(
    items: DataFrame,
    key: str = "asin",
    value: str = "price",
    neighbours: str = "related.also_viewed",
    mean_name: str = "meanPriceAlsoViewed",
    count_name: str = "countAlsoViewed",
    skip_nan: bool = False,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """(key, list length, mean value of the listed items), one row per item.

    The length is null for a null or empty list and counts repeats and ids
    that point nowhere. ``neighbours`` may be a dotted path into a map or a
    struct.
    """
    means = neighbour_means(items, key, value, neighbours, mean_name, skip_nan, skew)
    lengths = items.select(key, size_or_null(neighbours).alias(count_name))
    return attach(lengths, means, key, "left", skew)

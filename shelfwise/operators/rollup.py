"""Per-key summaries attached to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.attach import DEFAULT_SKEW, Skew, attach


def mean_and_count(df: DataFrame, key: str, value: str, mean_name: str, count_name: str) -> DataFrame:
    """Mean and non-null count of ``value`` per ``key``.

    A key whose values are all null has a null mean and a count of 0.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(value).alias(mean_name), F.count(value).alias(count_name))
    )


def attach_rating(
    items: DataFrame,
    ratings: DataFrame,
    key: str = "asin",
    value: str = "overall",
    mean_name: str = "meanRating",
    count_name: str = "countRating",
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Every item with the mean and number of its ratings.

    An item that nobody rated has a null mean and a null count, not 0; ratings
    of unknown items are dropped; repeated items stay repeated.
    """
    return attach(items, mean_and_count(ratings, key, value, mean_name, count_name), key, "left", skew)

"""Flattening nested category and rank columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.functions.nested import first_key, first_leaf, first_value


def flatten_category_and_rank(
    items: DataFrame,
    categories: str = "categories",
    ranks: str = "salesRank",
    category_name: str = "category",
    best_category_name: str = "bestSalesCategory",
    best_rank_name: str = "bestSalesRank",
) -> DataFrame:
    """Adds the first category and the first entry of the rank map.

    "Best" is the entry stored first, whatever its rank. A narrow projection.
    """
    return items.withColumns(
        {
            category_name: first_leaf(categories),
            best_category_name: first_key(ranks),
            best_rank_name: first_value(ranks),
        }
    )

"""Filling in missing numbers and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import fill_if_missing, text_or, to_float, valid_number
from shelfwise.operators.order import in_order, ranges_of


def value_counts(df: DataFrame, number: str) -> DataFrame:
    """(value, n, range, place): how often each valid number occurs, in order.

    Reads ``df`` once, when called. Rows are counted per distinct value, combined before the
    shuffle; only the counts are put in order, by ranges, and written.
    """
    column = F.col(number)
    counts = df.where(column.isNotNull() & ~F.isnan(column)).groupBy(column.alias("value")).agg(F.count("*").alias("n"))
    return in_order(counts, "value")


def median(df: DataFrame, number: str) -> DataFrame:
    """One row ``median``: the middle value of ``number`` (the lower of two).

    Exact, and the same in every run. Nulls and NaN are passed over; without a number the
    result is null.
    """
    return _middle(value_counts(df, number))


def _middle(counts: DataFrame) -> DataFrame:
    """The counts of each range tell in which the middle lies; only the values of that one
    are looked at further."""
    ranges = ranges_of(counts, "n")
    middle = ranges.middle()
    inside = counts.where(F.lit(False) if middle is None else F.col("range") == middle)
    until = F.sum("n").over(Window.partitionBy("range").orderBy("value")) + ranges.before[middle or 0]
    reached = inside.select("value", until.alias("until")).where(2 * F.col("until") >= ranges.total)
    return reached.agg(F.min("value").alias("median"))


def fill_values(df: DataFrame, number: str) -> DataFrame:
    """One row ``fills`` = struct(mean, median) over the valid numbers, from one written
    table of counts.

    Without any valid number both are 0.0.
    """
    counts = value_counts(df.select(valid_number(to_float(number)).alias("valid")), "valid")
    total = F.sum(F.col("value").cast("double") * F.col("n"))
    return counts.agg(F.coalesce(total / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("mean")).select(
        F.struct("mean", F.coalesce(_middle(counts).scalar().cast("double"), F.lit(0.0)).alias("median")).alias("fills")
    )


def impute_number(
    df: DataFrame,
    number: str = "price",
    mean_name: str = "meanImputedPrice",
    median_name: str = "medianImputedPrice",
) -> DataFrame:
    """``number`` as a float, plus copies filled with the mean and the median.

    ``df`` is read twice in all: to count its values, when this is called, and to
    fill the gaps. The two fill values come to the driver and enter as literals, so the result
    reads ``df`` alone.
    """
    fills = fill_values(df, number).first()["fills"]
    as_float = to_float(number)
    return df.withColumns(
        {
            number: as_float,
            mean_name: fill_if_missing(as_float, F.lit(fills["mean"])),
            median_name: fill_if_missing(as_float, F.lit(fills["median"])),
        }
    )


def impute_text(
    df: DataFrame,
    text: str = "title",
    name: str = "unknownImputedTitle",
    default: str = "unknown",
) -> DataFrame:
    """Adds ``text`` with null and ``""`` replaced by ``default``."""
    return df.withColumn(name, text_or(text, default))

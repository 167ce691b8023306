"""Missing numbers and missing text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def empty_to_null(text: str | Column) -> Column:
    """``""`` becomes null; a blank such as ``" "`` is kept."""
    return F.nullif(_as_column(text), F.lit(""))


def text_or(text: str | Column, default: str) -> Column:
    """``default`` where the text is null or ``""``."""
    return F.coalesce(empty_to_null(text), F.lit(default))


def to_float(number: str | Column) -> Column:
    """32-bit float; text that is no number becomes null."""
    return _as_column(number).try_cast("float")


def is_valid_number(number: str | Column) -> Column:
    """True where the number is neither null nor NaN."""
    column = _as_column(number)
    return column.isNotNull() & ~F.isnan(column)


def valid_number(number: str | Column) -> Column:
    """The number, with NaN read as null."""
    column = _as_column(number)
    return F.when(~F.isnan(column), column)


def fill_if_missing(number: str | Column, fill: Column) -> Column:
    """The number as a double, with null and NaN replaced by ``fill``."""
    return F.coalesce(valid_number(number).cast("double"), fill)

"""Summary statistics of many columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(
    df: DataFrame,
    means: Sequence[str] = (),
    variances: Sequence[str] = (),
    nulls: Sequence[str] = (),
    distincts: Sequence[str] = (),
    matches: Mapping[str, tuple[str, object]] | None = None,
) -> DataFrame:
    """One row: the row count and the statistics asked for.

    Named ``count_total``, ``mean_<c>``, ``variance_<c>`` (sample variance),
    ``numNulls_<c>``, ``countDistinct_<c>`` (exact, null not counted);
    ``matches`` maps an output name to (column, value) and counts equal rows.
    Means and variances pass over null but not over NaN. The counts over an
    empty table are 0.

    All but the distinct counts come from one aggregate. Each distinct count is an
    aggregate of its own over the different values of its column, found within every task before
    they are shuffled: it reads that column once more, where one aggregate for several
    distinct columns would first copy every row for each of them.
    """
    statistics = [F.count("*").alias("count_total")]
    statistics += [F.avg(c).alias(f"mean_{c}") for c in means]
    statistics += [F.var_samp(c).alias(f"variance_{c}") for c in variances]
    statistics += [null_count(c).alias(f"numNulls_{c}") for c in nulls]
    counted = [
        match_count(c, value).alias(name) for name, (c, value) in (matches or {}).items()
    ]
    record = df.agg(*statistics, *counted)
    different = [df.select(c).distinct().agg(F.count(c).alias("n")).scalar().alias(f"countDistinct_{c}") for c in distincts]
    split = len(statistics)
    return record.select(*record.columns[:split], *different, *record.columns[split:])


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def match_count(column: str, value: object) -> Column:
    return F.count_if(F.col(column) == F.lit(value))

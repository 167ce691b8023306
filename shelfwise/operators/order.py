"""Putting a whole table in order without meeting it in one task."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.shared import written


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """The rows with ``range`` and ``place``: ranges follow each other in the order of
    ``keys``, and places count from 0 within a range.

    Rows are dealt out by sampled key ranges and sorted within these; the result is
    written once, so ranges and places stay what they are. Keys should tell
    rows apart, or ties are placed in any order.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(ranged.withColumns({"range": F.spark_partition_id(), "place": place}), "ordered")


@dataclass(frozen=True)
class Ranges:
    """What lies in each range and before it, on the driver: one number a range."""

    here: list[int]
    before: list[int]
    total: int

    def offset(self) -> Column:
        """What lies before the range of a row."""
        return F.element_at(F.lit(self.before), F.col("range") + 1).cast("long")

    def middle(self) -> int | None:
        """The first range that reaches half of the total; none where the total is 0."""
        return next((r for r, (h, b) in enumerate(zip(self.here, self.before, strict=True)) if h and 2 * (b + h) >= self.total), None)


def ranges_of(ordered: DataFrame, weight: str | None = None) -> Ranges:
    """The rows, or sums of ``weight``, by range. One job, which brings one row a range to the driver."""
    each = ordered.groupBy("range").agg(F.sum(F.lit(1) if weight is None else F.col(weight)).alias("here")).collect()
    found = {row["range"]: row["here"] for row in each}
    here = [found.get(r, 0) for r in range(max(found, default=0) + 1)]
    return Ranges(here, [0, *accumulate(here)][:-1], sum(here))

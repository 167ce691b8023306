"""Joining a table to a lookup that holds one row per key.

Adaptive execution splits a skewed side only where its bytes stand out, and many
narrow rows of one key are few bytes. ``attach`` therefore spreads hot keys itself:
the rows of a hot key are dealt out to several parts, and its single lookup row is
copied to each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.names import unused

#: Tasks that merge the sketches of all tasks before the last one merges theirs.
_MERGERS = 32


@dataclass(frozen=True)
class Skew:
    """When a key counts as hot.

    ``rows_per_task``: a key with more rows than this is spread over
    ``ceil(rows / rows_per_task)`` parts.
    ``tracked``: size of the sketch of frequent keys. At most a quarter as many keys,
    those with the most rows, count as hot. The others take the ordinary join, so the
    result does not depend on this number.
    """

    rows_per_task: int = 1_000_000
    tracked: int = 4096


DEFAULT_SKEW = Skew()


def hot_keys(df: DataFrame, key: str, skew: Skew = DEFAULT_SKEW) -> list[tuple[int, int]]:
    """(xxhash64 of the key, parts) of the keys with more than ``rows_per_task`` rows.

    One job reads the key column once. Each task keeps a sketch of its frequent keys, the
    sketches are merged in two steps, and at most a quarter of ``tracked`` rows come out, so
    neither memory nor what is shuffled grows with the number of keys. Counts are exact
    while there are no more keys than the sketch tracks. Beyond that they are a lower
    bound, and a key with less than about ``3.5 / tracked`` of all rows (one in a
    thousand) may be missed: its rows then stay in one task, as in any join. Null is a key.
    """
    taker, accumulate = F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("taker"), f"approx_top_k_accumulate(hash, {skew.tracked})"
    hashes = df.select(F.xxhash64(F.col(f"`{key}`")).alias("hash"), taker)
    merged = hashes.groupBy("taker").agg(F.expr(accumulate).alias("some")).groupBy(F.lit("all").alias("group")).agg(F.expr(f"approx_top_k_combine(some, {skew.tracked})").alias("sketch"))
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {max(1, skew.tracked // 4)})").alias("top")).collect()  # no row for an empty table
    return [(row["item"], -(-row["count"] // skew.rows_per_task)) for r in found for row in r["top"] if row["count"] > skew.rows_per_task]


def attach(
    table: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    skew: Skew = DEFAULT_SKEW,
    hot: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Join ``table`` to ``lookup`` on ``key``; ``how`` is left or inner.

    ``lookup`` must hold one row per key (an aggregate by ``key``), so the
    result never has more rows than ``table``. ``table`` may repeat keys
    without limit, null included, which joins with nothing.

    A job finds the hot keys when this is called. It reads the key column of ``table``,
    so a table that is costly to make should be written first, or ``hot`` given as found by
    ``hot_keys`` in a narrow table with the same keys. Without hot keys
    the result is the ordinary join of one scan of each side. With them it still is one
    join of one scan each, on the key and a part number: rows of hot keys are dealt
    out, all others are part 0. Keys of different types are not spread.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    alike = table.schema[key].dataType == lookup.schema[key].dataType
    if hot is None:
        hot = hot_keys(table, key, skew) if alike else []
    if not hot or not alike:
        return table.join(lookup, key, how)
    hash_, parts, part = (unused(name, table, lookup) for name in ("hash", "parts", "part"))
    rows = ", ".join(f"({h}L, {p})" if h != -(1 << 63) else f"(bigint('{h}'), {p})" for h, p in hot)
    known = F.broadcast(table.sparkSession.sql(f"select * from values {rows} as hot(`{hash_}`, `{parts}`)"))  # at most a quarter of ``tracked`` rows

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn(hash_, F.xxhash64(F.col(f"`{key}`"))).join(known, hash_, "left").drop(hash_)

    dealt = dealt_out(marked(table), F.col(parts), part).drop(parts)
    last = F.coalesce(F.col(parts), F.lit(1)) - 1
    copies = marked(lookup).withColumn(part, F.explode(F.sequence(F.lit(0), last))).drop(parts)
    columns = [key, *[c for c in table.columns if c != key], *[c for c in lookup.columns if c != key]]
    return dealt.join(copies, [key, part], how).drop(part).select(*[F.col(f"`{c}`") for c in columns])


def dealt_out(df: DataFrame, parts: Column, name: str) -> DataFrame:
    """Adds a part number that goes round within each input partition; 0 where ``parts``
    is null.

    The rows to deal out are put in order first, so equal rows are dealt out
    evenly too, and a recomputed task repeats its numbers whatever order its
    rows come in: rows that tie are equal. All other rows tie.
    """
    hashable = [
        field.name
        for field in df.schema.fields
        if not any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
    ]
    orderable = [F.col(f"`{c}`") for c in hashable if _orderable(df, c)]
    some = parts.isNotNull()
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c in hashable])
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = df.sortWithinPartitions(*[F.when(some, c) for c in (whole_row, *orderable)])
    return ordered.withColumn(name, F.when(some, F.pmod(place + F.spark_partition_id(), parts)).otherwise(0).cast("int"))


def _orderable(df: DataFrame, column: str) -> bool:
    return "interval" not in df.schema[column].dataType.simpleString()

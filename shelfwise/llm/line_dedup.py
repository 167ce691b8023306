"""Removal of boilerplate lines that appear on many sites (DataFrame functions only).

A HyperLogLog sketch of sites per line hash, merged by the aggregation, estimates on
how many sites a line appears. Lines whose estimate lies near the threshold get an
exact distinct count. Boilerplate stays where it comes first, in the document with
the smallest id, and goes everywhere else.

Lines are told apart by a 64-bit hash and must be equal to the byte. A line without
a word (only ASCII white space) is never boilerplate. The sketches have a relative
standard error of 1.6 %; the band that is counted exactly is 10 % to either side of
the threshold, and one site at least.

Defined results: a null text stays null and has no lines, an empty one has one blank
line; a null site counts for no site; lines of rows with a null id are never the
first unless all are; repeated rows (same id, same text) are one document, each row
with its result; an empty table gives an empty table; texts are split whole, however long.
Columns of the input that have the name of a result are replaced, all others are kept,
whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.names import unused
from shelfwise.operators.attach import attach
from shelfwise.sources.shared import written

MIN_SITES = 5
BAND = 0.1
SKETCH_BITS = 12


def _row_key(id: Column, text: Column) -> Column:  # noqa: A002
    return F.xxhash64(id, text)


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Of lines (line, site, id), those on ``min_sites`` sites or more: line and
    first, the smallest id that has it."""
    band = max(1, math.ceil(BAND * min_sites))
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min("id").alias("first"))
    estimated = written(
        spread.select("line", "first", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("sites")).where(
            F.col("sites") >= min_sites - band
        ),
        "spread",
    )
    near = estimated.where(F.col("sites") <= min_sites + band)
    exact = (
        attach(lines.select("line", "site"), near.select("line"), "line", "inner")
        .distinct()
        .groupBy("line")
        .agg(F.count("site").alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    sure = estimated.where(F.col("sites") > min_sites + band).select("line", "first")
    return sure.unionByName(near.join(exact, "line").select("line", "first"))


def line_dedup(
    docs: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    n_lines: str = "n_lines",
    n_removed: str = "n_removed",
) -> DataFrame:
    """The input with boilerplate lines taken out of ``text``, and the columns
    ``n_lines`` (before) and ``n_removed``."""
    left = docs.drop(n_lines, n_removed)
    own_id, own_text = F.col(f"`{id}`"), F.col(f"`{text}`")
    split = F.split(own_text, "\n")
    lines = (
        left.where(own_text.isNotNull())
        .select(
            own_id.alias("id"),
            _row_key(own_id, own_text).alias("key"),
            F.col(f"`{site}`").cast("string").alias("site"),
            F.posexplode(split).alias("place", "words"),
        )
        .where(F.col("words").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("line", F.xxhash64("words"))
    )
    common = written(boilerplate(lines.select("line", "site", "id"), min_sites), "boilerplate")
    met = attach(lines.select("id", "key", "place", "line"), common, "line", "inner")
    at = F.struct("line", "place", F.col("id").eqNullSafe(F.col("first")).alias("home"))
    found = met.groupBy("id", "key").agg(F.array_sort(F.collect_set(at)).alias("found"))

    def goes(line: Column, i: Column) -> Column:
        """At home the first of equal lines stays."""
        again = F.coalesce(F.get("found", i - 1)["line"] == line["line"], F.lit(False))
        return ~line["home"] | again

    of_id, of_key, removed = (unused(name, left) for name in ("of_id", "of_key", "removed"))
    places = found.select(
        F.col("id").alias(of_id), F.col("key").alias(of_key), F.transform(F.filter("found", goes), lambda x: x["place"]).alias(removed)
    )
    with_places = left.join(
        places, (_row_key(own_id, own_text) == F.col(of_key)) & own_id.eqNullSafe(F.col(of_id)), "left"
    )
    parts, gone = F.split(own_text, "\n"), F.size(removed)
    kept = F.when(F.coalesce(gone, F.lit(0)) <= 0, own_text).otherwise(
        F.array_join(
            F.element_at(
                F.transform(
                    F.array(F.struct(parts.alias("parts"))),
                    lambda x: F.transform(
                        F.array_except(F.sequence(F.lit(0), F.size(x["parts"]) - 1), F.col(removed)), lambda i: F.get(x["parts"], i)
                    ),
                ),
                1,
            ),
            "\n",
        )
    )
    columns = [kept.alias(c) if c == text else F.col(f"`{c}`") for c in left.columns]
    return with_places.select(
        *columns,
        F.when(own_text.isNull(), 0).otherwise(F.size(parts)).cast("long").alias(n_lines),
        F.greatest(F.coalesce(gone, F.lit(0)), F.lit(0)).cast("long").alias(n_removed),
    )

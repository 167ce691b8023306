"""Hold-out splits that a rerun repeats."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the number that a row gets, by digest.
_BITS = {"xxhash64": 64, "md5": 60}
_LARGEST = (1 << 63) - 1


def number(keys: Sequence[str], seed: int, digest: str = "xxhash64") -> Column:
    """A whole number that depends on ``seed`` and the key values alone.

    Null is a value of its own, at its place among the keys. ``xxhash64`` gives a
    signed 64-bit number. ``md5`` gives the leading 60 bits of the hash of the text
    ``seed:key1:key2..``, with a zero character for null, so that other engines can
    compute it too; it is slower.
    """
    if digest == "xxhash64":
        marked = [c for k in keys for c in (F.col(k), F.col(k).isNull())]
        return F.xxhash64(F.lit(seed), *marked)
    if digest == "md5":
        texts = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
        return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts)), 1, 15), 16, 10).cast("long")
    raise ValueError(f"digest must be 'xxhash64' or 'md5', not {digest!r}")


def bounds(weights: Sequence[float], digest: str = "xxhash64") -> list[int]:
    """The number below which the first part lies, the first two, and so on; all
    parts but the last."""
    if any(not w >= 0 for w in weights) or not sum(weights) > 0:
        raise ValueError(f"weights must not be negative, nor all zero: {list(weights)}")
    total, bits = sum(map(Fraction, weights)), _BITS[digest]
    low = -(1 << 63) if digest == "xxhash64" else 0
    return [low + round(reached / total * (1 << bits)) for reached in accumulate(map(Fraction, weights[:-1]))]


def assign_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float],
    seed: int,
    name: str = "split",
    digest: str = "xxhash64",
) -> DataFrame:
    """Adds the number of the part each row belongs to, in the given weights.

    ``randomSplit`` depends on how the rows are partitioned and ordered; this
    does not, so a recomputed partition lands where it was. Rows with equal
    ``keys`` stay together: choose keys that tell rows apart, or one common
    key decides the sizes. The shares are kept to 60 bits or more. A narrow
    projection.
    """
    part = F.lit(len(weights) - 1)
    found = number(keys, seed, digest)
    for i, bound in reversed(list(enumerate(bounds(weights, digest)))):
        below = F.lit(True) if bound > _LARGEST else found < bound
        part = F.when(below, i).otherwise(part)
    return df.withColumn(name, part)


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float],
    seed: int,
    digest: str = "xxhash64",
) -> list[DataFrame]:
    """The parts of ``assign_split`` as separate DataFrames."""
    name = "__split"
    assigned = assign_split(df, keys, weights, seed, name, digest)
    return [assigned.filter(F.col(name) == i).drop(name) for i in range(len(weights))]

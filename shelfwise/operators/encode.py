"""Categories to indices, indicator vectors and principal components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, OneHotEncoder, OneHotEncoderModel, PCAModel, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.order import in_order, ranges_of


def count_levels(df: DataFrame, category: str) -> DataFrame:
    """(label, n, position, share) of every category; ``""`` is one, null is not.

    Position 0 is the most frequent; ties go by label, in code point order. An
    ordinary grouping, combined before the shuffle, so that the rows of all
    categories do not meet in one task as they do in ``StringIndexer``. The counts are
    put in order by ranges: a label's position is its place in its range, after all
    ranges before it, so no task orders all labels either. Reads ``df`` once, when
    called, and writes the counts to the shared folder.
    """
    counts = df.where(F.col(category).isNotNull()).groupBy(F.col(category).alias("label")).agg(F.count("*").alias("n"))
    ordered = in_order(counts, F.desc("n"), F.asc("label"))
    places = ranges_of(ordered)
    total = ordered.agg(F.sum("n").alias("rows")).scalar()
    return ordered.select("label", "n", (places.offset() + F.col("place")).alias("position"), (F.col("n") / total).alias("share"))


def fit_index(df: DataFrame, category: str, output: str, handle_invalid: str = "error") -> StringIndexerModel:
    """Index 0 is the most frequent category; ties go by label.

    Like a fitted ``StringIndexer``, but for ties between labels beyond the basic
    plane, which go by code point here. The labels pass through the driver, as in
    any index model. Nulls are passed over here; on transform they and unseen
    categories raise unless ``handle_invalid`` says otherwise.
    """
    labels = [row["label"] for row in count_levels(df, category).orderBy("position").select("label").collect()]
    return StringIndexerModel.from_labels(labels, category, output, handle_invalid)


def fit_onehot(df: DataFrame, index: str, output: str) -> OneHotEncoderModel:
    """Sparse indicators with one position per category, none dropped."""
    return OneHotEncoder(inputCol=index, outputCol=output, dropLast=False).fit(df.select(index))


def fit_pca(df: DataFrame, vector: str, output: str, k: int = 15) -> PCAModel:
    """The first ``k`` principal components; ``k`` may not exceed the width.

    The covariance (width x width) is added up on the executors and factored
    on the driver; Spark allows widths up to 65,535.
    """
    return PCA(k=k, inputCol=vector, outputCol=output).fit(df.select(vector))


def shares_of(levels: DataFrame) -> DataFrame:
    """One row ``shares``: the mean indicator vector, from the counts."""
    return levels.agg(_in_position("share").alias("shares"))


def _in_position(value: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("position", value))), lambda x: x[value])


@dataclass(frozen=True)
class Contrast:
    """An axis within the ``size`` categories of one count: the ``index`` first of them
    against the next."""

    count: int
    first: int
    index: int
    variance: float

    def entry(self) -> Column:
        at, j = F.col("position") - self.first, self.index
        inside = F.when(at < j, 1.0).when(at == j, -float(j)).otherwise(0.0) / float((j * (j + 1)) ** 0.5)
        return F.when(F.col("n") == self.count, inside).otherwise(0.0)


@dataclass(frozen=True)
class Root:
    """An axis over all categories, whose variance is ``pole + off`` rows (not a share)."""

    pole: int
    off: float
    length: float
    variance: float

    def entry(self) -> Column:
        return F.col("n") / ((F.col("n") - self.pole) - F.lit(self.off)) / self.length


@dataclass(frozen=True)
class Components:
    """The first principal axes of indicator vectors."""

    axes: tuple[Contrast | Root, ...]
    total_variance: float

    @property
    def variances(self) -> list[float]:
        """Of the rows around their mean, divided by their number."""
        return [axis.variance for axis in self.axes]

    @property
    def explained(self) -> list[float]:
        return [axis.variance / self.total_variance if self.total_variance else 0.0 for axis in self.axes]

    def of(self, levels: DataFrame, name: str = "components") -> DataFrame:
        """``levels`` with the encoded indicator of each category, an array of one entry an
        axis. Rows are encoded by joining them to this table."""
        return levels.withColumn(name, F.array(*[axis.entry() for axis in self.axes]))


def onehot_components(levels: DataFrame, k: int = 15) -> Components:
    """The first ``k`` principal components of the indicator vectors, from ``count_levels``.

    With shares p the covariance is ``diag(p) - pp'``: a diagonal matrix changed by one
    vector. Its variances and axes follow from the counts alone. Where m categories have
    one count, m - 1 axes lie among them, with their share as variance. Besides, there
    is one variance between each two neighbouring shares, the root of the secular equation
    ``sum p**2 / (p - x) = 1``, and at last 0. As shares add up to 1, that is ``sum p / (p - x) = 0``
    for other roots than 0, which loses no digits in taking 1 off. Nor do entries ``p / (p - x)``, as
    roots are kept as distances from the nearest share.

    Categories of one count count once, and counts that differ add up to the number of rows: on the
    driver is one row for each different count, at most the square root of twice the number
    of rows. Any width will do; ``k`` beyond it raises ``ValueError``. Each axis has its first
    nonzero entry positive.
    """
    groups = sorted((-row["n"], row["size"]) for row in levels.groupBy("n").agg(F.count("*").alias("size")).collect())
    counts, sizes = np.array([-n for n, _ in groups], np.int64), np.array([size for _, size in groups], np.int64)
    width, rows = int(sizes.sum()), int((counts * sizes).sum())
    if not 1 <= k <= width:
        raise ValueError(f"{k} components of {width} categories")
    axes: list[Contrast | Root] = []
    first = 0
    for g, (count, size) in enumerate(zip(counts.tolist(), sizes.tolist(), strict=True)):
        axes += [Contrast(count, first, j, count / rows) for j in range(1, min(size, k - len(axes) + 1))]
        if len(axes) < k:
            pole, off = _root(counts, sizes, g)
            entries = counts / ((counts - pole) - off)
            axes.append(Root(pole, off, float(np.sqrt((sizes * entries**2).sum())), (pole + off) / rows))
        if len(axes) >= k:
            break
        first += size
    shares = counts / rows
    return Components(tuple(axes), float(1 - (sizes * shares**2).sum()))


def _root(counts: np.ndarray, sizes: np.ndarray, g: int) -> tuple[int, float]:
    """(pole, off) of the root below the g-th count: it is ``pole + off``, in rows."""
    if g + 1 == len(counts):
        return 0, 0.0
    high, low = int(counts[g]), int(counts[g + 1])

    def beyond(pole: int, off: float) -> bool:
        """Whether the root is below ``pole + off``."""
        return (sizes * counts / ((counts - pole) - off)).sum() > 0

    half = (high - low) / 2
    pole = low if beyond(low, half) else high
    least, most = (0.0, half) if pole == low else (-half, 0.0)
    while True:
        middle = (least + most) / 2
        if middle in (least, most):
            return pole, (most if pole == low else least)
        least, most = (least, middle) if beyond(pole, middle) else (middle, most)


def vector_mean(df: DataFrame, **means: str) -> DataFrame:
    """One row: ``count_total`` and, per ``name=column``, the mean vector."""
    return df.agg(
        F.count("*").alias("count_total"),
        *[Summarizer.mean(F.col(c)).alias(name) for name, c in means.items()],
    )


def vector_rows(df: DataFrame, vector: str, position: str = "position", value: str = "value") -> DataFrame:
    """The elements of ``vector`` as (position, value) rows."""
    return df.select(F.posexplode(vector_to_array(vector)).alias(position, value))

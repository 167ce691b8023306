"""Whitening of embeddings along their principal components.

Entries become whole numbers, so sums, means and deviations are exact. Every task
reduces the centred rows it reads to one triangular factor, block by block with QR; the
factors are reduced by the same step over a shuffle until one is left, so no task sees more than
a block of rows and one factor (width x width) at a time. That last factor goes to the
driver, is made bidiagonal and gives the components, see ``bidiagonal_qd``.

Defined results: a null vector, or one with a null, NaN or infinite entry, is left out; repeated
rows count and come out each; a null id is an id like any other; components
without variance beyond rounding are left out, so one vector, or only equal ones, give no
rows, as do an empty table and vectors without entries; vectors of unequal widths and entries
beyond 2**40 raise ``ValueError``. Of the input only ``id`` and ``vector`` are looked at, so other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bidiagonal_qd import singular
from shelfwise.llm.shipping import ship
from shelfwise.sources.shared import written

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
LARGEST = float(1 << 40)
#: Tasks that reduce the factors of all tasks before the last one.
REDUCERS = 64
#: Bytes of the rows that are reduced at once.
BLOCK_BYTES = 8 << 20


def whole_rows(vectors: DataFrame, id: str, vector: str, scale: int, offset: int) -> DataFrame:  # noqa: A002
    """(id, x): the sound vectors as whole numbers."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    found = vectors.select(F.col(f"`{id}`").alias("id"), entries.alias("v")).where(F.col("v").isNotNull() & sound)

    def as_whole(c: Column) -> Column:
        too_large = F.raise_error(F.lit("an entry of a vector is too large to be a whole number")).cast("long")
        return F.when(F.abs(c) <= LARGEST, F.floor(c * scale).cast("long") + offset).otherwise(too_large)

    return found.select("id", F.transform("v", as_whole).alias("x"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x width) of runs of the rows of a batch."""
    lists = batch.column(batch.schema.names.index("x"))
    if not len(lists):
        return
    offsets = lists.offsets.to_numpy()
    width = int(offsets[1] - offsets[0])
    if np.any(np.diff(offsets) != width):
        raise ValueError("vectors of unequal widths")
    table = lists.values.to_numpy()[offsets[0] : offsets[-1]].reshape(len(lists), width)
    step = max(1, BLOCK_BYTES // max(8, 8 * width))
    for first in range(0, len(table), step):
        yield first, table[first : first + step]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the number of its vectors, and total, least and largest for each dimension."""
    n, total, least, most = 0, None, None, None
    for batch in batches:
        for _, x in _blocks(batch):
            if total is None:
                total, least, most = np.zeros(x.shape[1], np.int64), x[0].copy(), x[0].copy()
            if len(total) != x.shape[1]:
                raise ValueError("vectors of unequal widths")
            n += len(x)
            total += x.sum(axis=0)
            if x.shape[1]:
                least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
    if total is not None and len(total):
        width = len(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(total), pa.array(least), pa.array(most)],
            names=["place", "n", "total", "least", "most"],
        )


def _factor(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of some rows, square even where there are fewer rows than columns."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def _as_rows(r: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, r.size + 1, r.shape[1]), pa.int32()), pa.array(r.ravel()))
    return pa.RecordBatch.from_arrays([lists], names=["r"])


def _reduce_centred(n: int, total: np.ndarray):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, len(total)))
        for batch in batches:
            for _, x in _blocks(batch):
                r = _factor(np.vstack([r, (n * x - total) / n]))
        if len(r):
            yield _as_rows(r)

    return reduce


def _reduce(width: int):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy().reshape(-1, width)
            step = max(1, BLOCK_BYTES // (8 * width))
            for at in range(0, len(rows), step):
                r = _factor(np.vstack([r, rows[at : at + step]]))
        if len(r):
            yield _as_rows(r)

    return reduce


def _project(n: int, total: np.ndarray, axes: np.ndarray, fits: bool):
    """Per row its exact deviation and its whitened coordinates."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.decimal128(38, 0)
        for batch in batches:
            for first, x in _blocks(batch):
                apart = n * x - total
                if fits:
                    deviations = (apart * apart).sum(axis=1).tolist()
                else:
                    deviations = [sum(c * c for c in row) for row in apart.tolist()]
                whitened = (apart / n) @ axes
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, whitened.size + 1, axes.shape[1]), pa.int32()), pa.array(whitened.ravel())
                )
                exact = pa.array([Decimal(d) for d in deviations], kind)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(x)), exact, lists], names=["id", "deviation", "whitened"])

    return project


def _identity_error(projected: DataFrame, k: int) -> float:
    """The largest entry, in size, of the covariance of the whitened rows minus the identity."""
    w = [F.col("whitened")[i] for i in range(k)]
    means = projected.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(w)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    products = projected.agg(*[F.avg((w[i] - means[i]) * (w[j] - means[j])).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(products, pairs, strict=True))


def whiten(
    vectors: DataFrame,
    id: str = "vec_id",  # noqa: A002
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    into: str = "whitening",
) -> DataFrame:
    """One row per sound vector and component: ``id`` and the struct ``into``.

    Its fields: ``component`` (from 1, by falling variance), ``n`` (vectors), ``deviation`` (the
    exact sum over dimensions of ``(n * x - sum of x) ** 2``, decimal), ``whitened``, ``explained`` (share
    of the variance) and ``identity_error``. x is ``floor(scale * entry) + offset``.

    On the driver: sums per dimension and one factor, of the width of a vector and its square.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = whole_rows(vectors, id, vector, scale, offset)
    kind = rows.schema["id"].dataType.simpleString()
    fields = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    sums = rows.select("x").mapInArrow(_sums, "place long, n long, total long, least long, most long")
    summed = sums.groupBy("place").agg(*[f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "total"), (F.min, "least"), (F.max, "most"))])
    per_place = sorted(summed.collect(), key=lambda row: row["place"])  # one row a dimension
    if len({row["n"] for row in per_place}) > 1:
        raise ValueError("vectors of unequal widths")

    found = None
    if per_place:
        n, width = per_place[0]["n"], len(per_place)
        total = np.array([row["total"] for row in per_place], np.int64)
        spread = n * max(row["most"] - row["least"] for row in per_place)
        if n * max(max(abs(row["least"]), abs(row["most"])) for row in per_place) >= 1 << 62:
            raise ValueError("too many vectors for exact sums in 64 bits")
        shape = "r array<double>"
        partial = rows.select("x").mapInArrow(_reduce_centred(n, total), shape)
        fewer = partial.repartition(REDUCERS).mapInArrow(_reduce(width), shape)
        last = fewer.coalesce(1).mapInArrow(_reduce(width), shape).collect()
        squares, axes, all_squares = singular(np.array([row["r"] for row in last]), components)
        if len(squares):
            found = axes / np.sqrt(squares / n)
    if found is None:
        nothing = F.lit(None).cast(f"struct<{', '.join(field.replace(' ', ':', 1) for field in fields.split(', '))}>")
        return rows.where(F.lit(False)).select(F.col("id").alias(id), nothing.alias(into))

    fits = width * spread * spread < 1 << 62
    shape = f"id {kind}, deviation decimal(38,0), whitened array<double>"
    projected = written(rows.mapInArrow(_project(n, total, found, fits), shape), "whitened")
    error = _identity_error(projected, len(squares))
    shares = F.array(*[F.lit(float(s / all_squares)) for s in squares])
    each = projected.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        F.col("id").alias(id),
        F.struct(
            (F.col("place") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(shares, F.col("place") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        ).alias(into),
    )

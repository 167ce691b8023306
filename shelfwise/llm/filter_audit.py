"""How filters of documents interact, for every order in which they could be applied.

Only which filters a document fails matters, so documents are first counted by their
mask of failed filters, per part; five filters leave 32 masks a part, whatever the size
of the corpus.

**Min-plus removal ranks.** A mask matrix holds 0 where a mask fails a filter and
infinity where it does not. A position matrix holds, for each order, the step of each
filter: the inverse of the permutation. Their product in which sums are taken for products
and minima for sums is the step at which each mask is removed in each order. The counts of
the masks are scattered to these steps; what a filter would have removed later is
redundant.

Defined results: a null or empty text has no words and one common content; null parts are
the empty string; a null id is neither smaller nor larger than another; rows of one id and
text are no copies of each other; several label rows of an id count as one, which is good or
toxic if one of them is; an empty table gives an empty table; texts are read whole. Of
the input only the named columns are looked at, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shipping import ship
from shelfwise.operators.attach import attach
from shelfwise.sources.shared import written

#: Orders of more filters than this are too many to report.
MOST_FILTERS = 7


def removal_ranks(fails: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The step at which each mask goes in each order, infinite where it stays.

    ``fails`` is masks x filters and boolean, ``positions`` orders x filters.
    """
    cost = np.where(fails, 0.0, np.inf)
    return (cost[:, None, :] + positions[None, :, :]).min(axis=2)


def _tables(n: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """All orders, the steps of the filters in them, and which filters each mask fails."""
    orders = list(permutations(range(n)))
    positions = np.argsort(np.array(orders), axis=1) + 1
    fails = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1 == 1
    return orders, positions, fails


def interactions(masks: np.ndarray, weights: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Of ``weights`` (masks x kinds; the first kind counts documents): removed and kept (orders x
    steps x kinds), redundant (orders x steps), unique (filters) and shapley (filters)."""
    orders, positions, fails = _tables(n)
    held = np.zeros((1 << n, weights.shape[1]), np.int64)
    np.add.at(held, masks, weights)
    ranks = removal_ranks(fails, positions)
    steps = np.where(np.isinf(ranks), n + 1, ranks).astype(np.int64) - 1
    scattered = np.zeros((len(orders), n + 1, weights.shape[1]), np.int64)
    np.add.at(scattered, (np.arange(len(orders))[None, :], steps), held[:, None, :])
    removed = scattered[:, :n]
    kept = held.sum(axis=0) - np.cumsum(removed, axis=1)
    order = np.array(orders)
    late = fails[:, order] & (steps[:, :, None] < np.arange(n)[None, None, :])  # masks x orders x steps
    redundant = np.tensordot(held[:, 0], late.astype(np.int64), axes=(0, 0))
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, order, removed[:, :, 0])
    return {"removed": removed, "kept": kept, "redundant": redundant, "unique": held[1 << np.arange(n), 0], "shapley": shapley}


def filter_audit(failures: DataFrame, filters: Sequence[str], part: str, lost: Sequence[str] = ()) -> DataFrame:
    """One row per value of ``part``, order of the filters and step in it.

    ``failures`` has a boolean column for each of ``filters`` (null: passes) and an integer column
    for each of ``lost``, whose sums over removed rows are reported. Columns: ``part``,
    ``filter_order`` (the names in order, joined), ``step`` (from 1), ``filter`` (its name), the
    counts ``kept`` (after the step), ``removed``, ``redundant`` (fail the filter, went before),
    ``unique_fails`` (fail nothing else), ``<name>_lost`` for each of ``lost``, and ``shapley`` (what
    the filter removes, summed over all orders).
    """
    n = len(filters)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {n}")
    ship(failures.sparkSession)
    mask = sum((F.when(F.col(f"`{name}`"), 1 << k).otherwise(0) for k, name in enumerate(filters)), F.lit(0))
    weights = [F.coalesce(F.col(f"`{name}`").cast("long"), F.lit(0)).alias(f"w{k}") for k, name in enumerate(lost)]
    counted = (
        failures.select(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), mask.alias("mask"), *weights)
        .groupBy("part", "mask")
        .agg(F.count("*").alias("n"), *[F.sum(f"w{k}").alias(f"w{k}") for k in range(len(lost))])
    )
    counts = "kept long, removed long, redundant long, unique_fails long, " + "".join(f"`{name}_lost` long, " for name in lost)
    schema = f"part string, filter_order string, step int, filter string, {counts}shapley long"
    return counted.groupBy("part").applyInPandas(_report(list(filters), list(lost)), schema)  # 2**n rows a part at most


def _report(filters: list[str], lost: list[str]):
    def report(rows: pd.DataFrame) -> pd.DataFrame:
        n = len(filters)
        kinds = ["n", *[f"w{k}" for k in range(len(lost))]]
        found = interactions(rows["mask"].to_numpy(np.int64), rows[kinds].to_numpy(np.int64), n)
        order = np.array(list(permutations(range(n)))).ravel()
        repeats = len(order) // n
        table = {
            "part": rows["part"].iloc[0],
            "filter_order": np.repeat(["".join(filters[k] for k in o) for o in permutations(range(n))], n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), repeats),
            "filter": np.array(filters)[order],
            "kept": found["kept"][:, :, 0].ravel(),
            "removed": found["removed"][:, :, 0].ravel(),
            "redundant": found["redundant"].ravel(),
            "unique_fails": found["unique"][order],
        }
        table |= {f"{name}_lost": found["removed"][:, :, k + 1].ravel() for k, name in enumerate(lost)}
        return pd.DataFrame(table | {"shapley": found["shapley"][order]})

    return report


def text_failures(
    docs: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    keep: Mapping[str, str] | None = None,
) -> DataFrame:
    """``id``, the columns ``keep`` (new name -> column), and whether each text fails five filters:

    ``A`` under 100 words; ``B`` under 80 % distinct words; ``C`` over 10 % capitals A-Z;
    ``D`` holds one of ``#$%&*|``; ``E`` is identical to the text of a smaller id. Texts are
    told apart by 128 bits (MD5). Written once: ids and flags, not texts.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{column}`").alias(f"keep_{name}") for name, column in (keep or {}).items()]
    split = docs.select(F.col(f"`{id}`").alias("id"), *kept, body.alias("body")).withColumn("words", _words(F.col("body")))
    capitals = F.length(F.regexp_replace("body", "[^A-Z]+", ""))
    judged = split.select(
        "id",
        *[f"keep_{name}" for name in keep or {}],
        F.unhex(F.md5("body")).alias("content"),
        (F.size("words") < 100).alias("A"),
        (100 * F.size(F.array_distinct("words")) < 80 * F.size("words")).alias("B"),
        (100 * capitals > 10 * F.length("body")).alias("C"),
        F.col("body").rlike("[#$%&*|]").alias("D"),
    )
    judged = written(judged, "judged")
    first = judged.groupBy("content").agg(F.min("id").alias("least"))  # combined before the shuffle, so a hot text is no large group
    again = F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("E")
    flags = attach(judged, first, "content")
    return flags.select(F.col("id").alias(id), *[F.col(f"keep_{name}").alias(name) for name in keep or {}], "A", "B", "C", "D", again)


def _words(body: Column) -> Column:
    return F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def with_labels(failures: DataFrame, labels: DataFrame, id: str, wanted: Mapping[str, Column]) -> DataFrame:  # noqa: A002
    """Adds a 0/1 column for each of ``wanted`` (name -> condition on ``labels``); 0 where there is no label."""
    named = labels.where(F.col(f"`{id}`").isNotNull()).select(
        F.col(f"`{id}`").alias(id), *[F.coalesce(condition.cast("int"), F.lit(0)).alias(name) for name, condition in wanted.items()]
    )
    known = named.groupBy(F.col(f"`{id}`")).agg(*[F.max(name).alias(name) for name in wanted])
    return failures.join(known, id, "left").fillna(0, list(wanted))

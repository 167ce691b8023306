"""Regression trees: fitting, scoring, choosing the depth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.keep import kept
from shelfwise.operators.split import hash_split


def rmse_of(label: str, prediction: str) -> Column:
    """Root mean squared error as an aggregate; null over no rows."""
    error = F.col(label) - F.col(prediction)
    return F.sqrt(F.avg(error * error))


def rmse(df: DataFrame, label: str, prediction: str = "prediction", name: str = "rmse") -> DataFrame:
    """One row with the root mean squared error."""
    return df.agg(rmse_of(label, prediction).alias(name))


def tree(features: str, label: str, depth: int, seed: int) -> DecisionTreeRegressor:
    """A regression tree of at most ``depth`` levels (0 to 30)."""
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=depth, seed=seed)


def tree_rmse(
    train: DataFrame,
    test: DataFrame,
    seed: int,
    features: str = "features",
    label: str = "overall",
    depth: int = 5,
    name: str = "test_rmse",
) -> DataFrame:
    """One row: the error on ``test`` of a tree fitted on ``train``."""
    model = tree(features, label, depth, seed).fit(train.select(features, label))
    return rmse(model.transform(test.select(features, label)), label, name=name)


@dataclass(frozen=True)
class DepthChoice:
    """Validation error and model per depth, and the depth chosen."""

    errors: Mapping[int, float]
    models: Mapping[int, DecisionTreeRegressionModel]
    depth: int

    @property
    def model(self) -> DecisionTreeRegressionModel:
        return self.models[self.depth]


def choose_depth(
    train: DataFrame,
    keys: Sequence[str],
    seed: int,
    depths: Sequence[int] = (5, 7, 9, 12),
    features: str = "features",
    label: str = "overall",
    train_share: float = 0.75,
    digest: str = "xxhash64",
    parallelism: int = 2,
) -> DepthChoice:
    """Fits one tree per depth on ``train_share`` of the rows, scores the rest.

    The smallest validation error wins, a tie the shallower depth. The models
    stay as fitted on that share; none is refitted on all rows. ``keys`` tell
    rows apart for the split.

    ``parallelism`` fits run at a time, each holding its own binned copy of
    the training rows, on disk where memory runs out. All models are scored in
    one pass over the validation rows.
    """
    depths = sorted(set(depths))
    wanted = list(dict.fromkeys([*keys, features, label]))
    parts = hash_split(train.select(*wanted), keys, [train_share, 1 - train_share], seed, digest)
    fitting, validation = (part.select(features, label) for part in parts)

    with kept(fitting) as (fitting,):
        base = tree(features, label, depths[0], seed)
        fits = base.fitMultiple(fitting, [{base.maxDepth: d} for d in depths])
        next_fit = inheritable_thread_target(train.sparkSession)(lambda _: next(fits))
        with ThreadPool(min(parallelism, len(depths))) as pool:
            models = {depths[i]: model for i, model in pool.imap_unordered(next_fit, depths)}

    scored = validation
    for depth in depths:
        model = models[depth]
        scored = model.transform(scored, {model.predictionCol: f"at_{depth}"})
    errors = scored.agg(*[rmse_of(label, f"at_{d}").alias(str(d)) for d in depths]).first().asDict()
    if None in errors.values():
        raise ValueError("the validation part is empty")
    by_depth = {d: errors[str(d)] for d in depths}
    return DepthChoice(by_depth, models, min(depths, key=lambda d: (by_depth[d], d)))

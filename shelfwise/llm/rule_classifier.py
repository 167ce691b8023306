"""A quality classifier from a sparse ensemble of rules.

Statistics of whole texts feed a small random forest; every path from a root to a
node becomes a conjunctive rule; a logistic regression with an L1 penalty weighs the
rules and drops most; the rest is compiled into one Spark column expression. Scoring
is therefore a projection, without Python and without a shuffle.

It is fitted on a sample of labelled rows that ``sample_rows`` bounds: those with the
smallest hashes of their ids.

Defined results: a null or empty text has statistics of 0 and gets a score; repeated
rows are scored each; a document with several labels counts as their mean, at least
one half being good; without two kinds of labels the score is the share of good ones
(one half without any). Columns of the input that have the name of a result are
replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.shared import written


SAMPLE_ROWS = 20_000
TREES, DEPTH, PENALTY, SEED = 16, 3, 0.002, 7

#: A condition of a rule: statistic, whether it must lie above, threshold.
Condition = tuple[str, bool, float]


def text_statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text (not null), none of them null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    chars, n_words, n_lines = (F.greatest(x, F.lit(1)) for x in (F.length(text), F.size(words), F.size(lines)))

    def per_char(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    return {
        "words": F.size(words).cast("double"),
        "word_length": F.length(text) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "line_words": n_words / n_lines,
        "symbols": per_char(r"[#*$%&|<>]"),
        "marks": per_char(r"[!?]"),
        "capitals": per_char(r"[A-Z]"),
        "digits": per_char(r"[0-9]"),
        "stops": per_char(r"[.,;]"),
    }


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules over statistics; the score is the logistic of their sum."""

    intercept: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...] = field(default=())

    def score(self, statistics: Column) -> Column:
        total = reduce(
            Column.__add__,
            [F.when(holds(conditions, statistics), weight).otherwise(0.0) for weight, conditions in self.rules],
            F.lit(self.intercept),
        )
        return 1 / (1 + F.exp(-total))


def holds(conditions: tuple[Condition, ...], statistics: Column) -> Column:
    return reduce(
        Column.__and__, [statistics[name] > value if above else statistics[name] <= value for name, above, value in conditions]
    )


def tree_paths(description: str, names: list[str]) -> set[tuple[Condition, ...]]:
    """The conditions of every node of a tree but its root, from Spark's description."""
    paths, path = set(), []
    for line in description.splitlines():
        if found := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(found[1])
            path = [(d, c) for d, c in path if d < depth]
            path.append((depth, (names[int(found[2])], found[3] == ">", float(found[4]))))
            paths.add(_narrowed([c for _, c in path]))
    return paths


def _narrowed(conditions: list[Condition]) -> tuple[Condition, ...]:
    """The same conjunction with one bound for each statistic and side."""
    best: dict[tuple[str, bool], float] = {}
    for name, above, value in conditions:
        old = best.get((name, above), value)
        best[name, above] = max(old, value) if above else min(old, value)
    return tuple((name, above, value) for (name, above), value in sorted(best.items()))


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    label: str = "quality",
    usable: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> RuleModel:
    """Fits on labelled documents; ``usable`` selects rows of ``labels``."""
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    known = known if usable is None else known.where(usable)
    good = known.groupBy(F.col(id).alias("of")).agg((F.avg(label) >= 0.5).cast("double").alias("label"))
    sample = good.orderBy(F.xxhash64("of"), "of").limit(sample_rows)
    statistics = text_statistics(F.coalesce(F.col("whole"), F.lit("")))
    names = list(statistics)
    texts = docs.select(F.col(f"`{id}`").alias("of"), F.col(f"`{text}`").alias("whole"))
    rows = texts.join(F.broadcast(sample), "of")  # at most sample_rows rows
    table = written(rows.select("of", "label", *[c.alias(n) for n, c in statistics.items()]), "labelled")
    counts = table.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("good")).first()
    if counts["good"] in (0, counts["n"]):
        share = min(max((counts["good"] + 0.5) / (counts["n"] + 1), 1e-6), 1 - 1e-6)
        return RuleModel(_logit(share))
    fitting = table.repartition(4, "of").sortWithinPartitions("of", *names)
    vectors = fitting.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.5, featureSubsetStrategy="onethird", seed=SEED).fit(vectors)
    rules = sorted(set().union(*[tree_paths(tree.toDebugString, names) for tree in forest.trees]))
    if not rules:
        return RuleModel(_logit(counts["good"] / counts["n"]))
    whole_row = F.struct(*names)
    marks = fitting.withColumn("row", whole_row).select(
        "label", array_to_vector(F.array(*[holds(r, F.col("row")).cast("double") for r in rules])).alias("features")
    )
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100, standardization=False).fit(marks)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), tuple((w, r) for w, r in zip(weights, rules, strict=True) if w))


def _logit(share: float) -> float:
    return log(share / (1 - share))


def score_documents(docs: DataFrame, model: RuleModel, text: str = "text", into: str = "score") -> DataFrame:
    """The input with the column ``into``."""
    statistics = f"{into}_statistics_"
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    with_them = docs.withColumn(statistics, F.struct(*[c.alias(n) for n, c in text_statistics(whole).items()]))
    return with_them.withColumn(into, model.score(F.col(statistics))).drop(statistics)

"""Quality rules whose cutoffs come from the data (DataFrame functions only).

Each document gets fixed base rules, and rates that are compared with fences
from mergeable quantile sketches per language and source.

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources form groups of their own; repeated rows are judged
each; an empty table gives an empty table. A column of the input that has the
name of the result is replaced; any other column is passed on, whatever its name; texts are
judged whole, however long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.shared import written


WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Rate -> two quantiles, how often their distance is added to the outer one, and a slack. Rates
#: are whole numbers per 10,000, word_length is in hundredths of a code point. Repeats are 0 in
#: most documents, so their fences come from the upper tail; quartiles would be 0 as well.
#: The quantiles are exact in binary, so every engine takes the same rows.
FENCES = {
    "symbol_rate": (0.25, 0.75, 3, 300),
    "repeat_rate": (0.875, 0.984375, 2, 100),
    "dup_line_rate": (0.875, 0.984375, 2, 100),
    "word_length": (0.25, 0.75, 3, 150),
}
TWO_SIDED = ("word_length",)
MIN_GROUP = 100
SKETCH_SIZE = 4096


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words_in_repeats(words: Column, n_words: Column) -> Column:
    """The number of words inside windows that occur twice or more in the text."""
    hashes = F.when(
        n_words >= WINDOW,
        F.transform(F.sequence(F.lit(0), n_words - WINDOW), lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        """Words under windows at the sorted ``places``."""
        steps = F.transform(
            places,
            lambda p, i: F.when(i + 1 < F.size(places), F.least(F.lit(WINDOW), F.get(places, i + 1) - p)).otherwise(WINDOW),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(ordered: Column) -> Column:
        """Places of windows with an equal neighbour in the sorted windows."""
        same = F.filter(
            ordered,
            lambda w, i: F.coalesce(F.get(ordered, i - 1)["h"] == w["h"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["h"] == w["h"], F.lit(False)),
        )
        return F.array_sort(F.transform(same, lambda w: w["p"]))

    def count(found: Column) -> Column:
        pairs = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(
            _let(_let(F.array_sort(pairs), repeated), covered)
        )

    return _let(hashes, count).cast("long")


def statistics(docs: DataFrame, text: str, into: str, drop: Sequence[str] = ()) -> DataFrame:
    """The input with a struct column of the base statistics of whole texts."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words, lines = f"{into}_words_", f"{into}_lines_"
    split = docs.withColumns(
        {
            words: F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), ""),
            lines: F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    w, n = F.col(words), F.size(words)
    counted = split.withColumn(
        into,
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("long").alias("n_dup_lines"),
            _words_in_repeats(w, n).alias("n_repeat_words"),
        ),
    )
    return counted.drop(words, lines, *drop)


def _rates(s: Column) -> dict[str, Column]:
    def share(part: str, whole: str, scale: int) -> Column:
        return F.floor(scale * s[part] / F.greatest(s[whole], F.lit(1)))

    return {
        "symbol_rate": share("n_symbols", "word_chars", 10_000),
        "repeat_rate": share("n_repeat_words", "n_words", 10_000),
        "dup_line_rate": share("n_dup_lines", "n_lines", 10_000),
        "word_length": share("word_chars", "n_words", 100),
    }


def _failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def fences(stats: DataFrame, into: str, lang: str, source: str, min_group: int = MIN_GROUP) -> DataFrame:
    """Per language and source, the least and the largest rates that pass.

    A sketch of each group is made where its rows lie and merged; groups of
    fewer than ``min_group`` rows take the fences of their language, whose
    sketches are the merged ones of its groups. Where a language has fewer rows
    too, there are no fences (null).
    """
    s = F.col(into)
    passed = stats.where(~_failed(s)).select(F.col(lang).alias("lang"), F.col(source).alias("source"), *[c.alias(r) for r, c in _rates(s).items()])
    groups = passed.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_bigint(r, SKETCH_SIZE).alias(r) for r in FENCES]
    )
    groups = written(groups, "sketches")
    langs = groups.groupBy(F.col("lang").alias("of")).agg(
        F.sum("n").alias("lang_n"), *[F.kll_merge_agg_bigint(r, SKETCH_SIZE).alias(f"lang_{r}") for r in FENCES]
    )
    both = groups.join(langs, groups["lang"].eqNullSafe(langs["of"]), "left")
    large, fair = F.col("n") >= min_group, F.col("lang_n") >= min_group
    limits = []
    for rate, (lower, upper, spreads, slack) in FENCES.items():
        sketch = F.when(large, F.col(rate)).when(fair, F.col(f"lang_{rate}"))
        low, high = (F.kll_sketch_get_quantile_bigint(sketch, F.lit(q)) for q in (lower, upper))
        limits.append((high + spreads * (high - low) + slack).alias(f"most_{rate}"))
        if rate in TWO_SIDED:
            limits.append((low - spreads * (high - low) - slack).alias(f"least_{rate}"))
    return both.select("lang", "source", *limits)


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    into: str = "quality_rules",
    drop: Sequence[str] = (),
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """The input, without the columns ``drop``, with a struct column ``into``:
    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    base_failed and kept.

    A document is kept if it passes the base rules and each of its rates lies
    within the fences of its language and source. The statistics are written
    once to the shared folder; the fences and the verdict both read them.
    """
    keys = {f"{into}_lang_": F.col(f"`{lang}`"), f"{into}_source_": F.col(f"`{source}`")}
    stats = written(statistics(docs.withColumns(keys), text, into, drop), "statistics")
    bounds = written(fences(stats, into, *keys, min_group), "fences")
    s = F.col(into)
    rates = _rates(s)
    names = [c for c in bounds.columns if c not in ("lang", "source")]
    fence = bounds.select(
        F.col("lang").alias(f"{into}_l_"), F.col("source").alias(f"{into}_s_"), F.struct(*names).alias(f"{into}_fence_")
    )
    limit = F.col(f"{into}_fence_")
    within = F.lit(True)
    for rate in FENCES:
        within &= F.coalesce(rates[rate] <= limit[f"most_{rate}"], F.lit(True))
        if rate in TWO_SIDED:
            within &= F.coalesce(rates[rate] >= limit[f"least_{rate}"], F.lit(True))
    on = F.col(f"{into}_lang_").eqNullSafe(F.col(f"{into}_l_")) & F.col(f"{into}_source_").eqNullSafe(F.col(f"{into}_s_"))
    verdict = s.withField("base_failed", _failed(s)).withField("kept", ~_failed(s) & within)
    left = [c for c in docs.columns if c not in drop and c != into]
    return stats.join(fence, on, "left").select(*[F.col(f"`{c}`") for c in left], verdict.alias(into))

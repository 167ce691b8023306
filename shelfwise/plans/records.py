"""The nine result records: tables in, one row of statistics out.

Column names are those of the result records. Records are DataFrames; save one
with ``shelfwise.sources.catalog.save_record``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import valid_number
from shelfwise.functions.text import space_tokens
from shelfwise.operators.attach import DEFAULT_SKEW, Skew
from shelfwise.operators.embedding import fit_embedding, nearest
from shelfwise.operators.encode import count_levels, onehot_components, shares_of
from shelfwise.operators.flatten import flatten_category_and_rank
from shelfwise.operators.impute import impute_number, impute_text
from shelfwise.operators.neighbours import attach_neighbour_price
from shelfwise.operators.profile import profile
from shelfwise.operators.rollup import attach_rating
from shelfwise.operators.trees import choose_depth, rmse, tree_rmse


def warmup_profile(product: DataFrame, skip_nan: bool = False) -> DataFrame:
    """count_total, mean_price; one NaN makes the mean NaN unless ``skip_nan``."""
    price = valid_number("price") if skip_nan else F.col("price")
    return profile(product.select(price.alias("price")), means=["price"])


def rating_profile(review: DataFrame, product: DataFrame, skew: Skew = DEFAULT_SKEW) -> DataFrame:
    """Statistics of meanRating and countRating over all products."""
    columns = ["meanRating", "countRating"]
    rated = attach_rating(product.select("asin"), review, skew=skew)
    return profile(rated, means=columns, variances=columns, nulls=columns)


def category_profile(product: DataFrame) -> DataFrame:
    """Statistics of bestSalesRank, category and bestSalesCategory."""
    labels = ["category", "bestSalesCategory"]
    return profile(
        flatten_category_and_rank(product),
        means=["bestSalesRank"],
        variances=["bestSalesRank"],
        nulls=labels,
        distincts=labels,
    )


def neighbour_profile(product: DataFrame, skip_nan: bool = False, skew: Skew = DEFAULT_SKEW) -> DataFrame:
    """Statistics of meanPriceAlsoViewed and countAlsoViewed."""
    columns = ["meanPriceAlsoViewed", "countAlsoViewed"]
    priced = attach_neighbour_price(product, skip_nan=skip_nan, skew=skew)
    return profile(priced, means=columns, variances=columns, nulls=columns)


def impute_profile(product: DataFrame) -> DataFrame:
    """Statistics of both imputed prices, and the number of unknown titles."""
    columns = ["meanImputedPrice", "medianImputedPrice"]
    return profile(
        impute_text(impute_number(product.select("price", "title"))),
        means=columns,
        variances=columns,
        nulls=columns,
        matches={"numUnknowns_unknownImputedTitle": ("unknownImputedTitle", "unknown")},
    )


def title_embedding(
    processed: DataFrame,
    words: Sequence[str],
    seed: int,
    k: int = 10,
    on_missing: str = "skip",
    **fit_options: int,
) -> DataFrame:
    """count_total, size_vocabulary, and per word its nearest ``k``.

    ``word_<i>_synonyms`` is an array of (word, similarity), best first.
    """
    tokens = space_tokens("title").alias("titleArray")
    vectors = fit_embedding(processed, tokens, "titleVector", seed, **fit_options).getVectors()
    found = nearest(vectors, words, k, on_missing=on_missing)
    synonym = F.struct("rank", "word", "similarity")
    per_word = [
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("query") == word, synonym))),
            lambda s: F.struct(s["word"].alias("word"), s["similarity"].alias("similarity")),
        ).alias(f"word_{i}_synonyms")
        for i, word in enumerate(words)
    ]
    lists = found.agg(F.struct(*per_word).alias("lists"))
    size = vectors.agg(F.count("*").alias("n"))
    record = processed.agg(F.count("*").alias("count_total"))
    return record.withColumns({"size_vocabulary": size.scalar(), "lists": lists.scalar()}).select(
        "count_total", "size_vocabulary", "lists.*"
    )


def category_means(processed: DataFrame) -> DataFrame:
    """count_total and the mean indicator vector; any number of categories."""
    return _means(processed, count_levels(processed, "category"))


def category_encoding(processed: DataFrame, k: int = 15, partial: bool = False) -> DataFrame:
    """count_total and the mean indicator and mean component vectors.

    One pass over the category column counts the categories; the counts are kept in
    the shared folder. The shares are the mean indicator vector, and fix the
    components too, for any number of categories. The projection is linear and not centred, so
    the mean of the projected rows is the sum of the encoded categories, each times its share.
    Fewer categories than ``k`` raise ``ValueError``; with ``partial`` the component vector
    is null instead and the rest of the record is there.
    """
    levels = count_levels(processed, "category")
    record = _means(processed, levels)
    try:
        components = onehot_components(levels, k)
    except ValueError:
        if not partial:
            raise
        return record.withColumn("meanVector_categoryPCA", F.lit(None).cast("array<double>"))
    encoded = components.of(levels)
    sums = [F.sum(F.col("share") * F.col("components")[i]) for i in range(k)]
    return record.withColumn("meanVector_categoryPCA", encoded.agg(F.array(*sums).alias("mean")).scalar())


def _means(processed: DataFrame, levels: DataFrame) -> DataFrame:
    """A row without a category raises when the result is made."""
    counts = processed.agg(F.count("*").alias("count_total"), F.count_if(F.col("category").isNull()).alias("without"))
    message = F.concat(F.col("without").cast("string"), F.lit(" rows have no category"))
    total = F.when(F.col("without") == 0, F.col("count_total")).otherwise(F.raise_error(message))
    return counts.select(total.alias("count_total"), shares_of(levels).scalar().alias("meanVector_categoryOneHot"))


def tree_baseline(train: DataFrame, test: DataFrame, seed: int) -> DataFrame:
    """test_rmse of a tree of depth 5."""
    return tree_rmse(train, test, seed)


def depth_selection(
    train: DataFrame, test: DataFrame, keys: Sequence[str] | None = None, seed: int = 0, **options: object
) -> DataFrame:
    """test_rmse of the chosen tree, and valid_rmse_depth_<d> per depth.

    Without ``keys`` a row is told from others by its id, if it has one, and by its
    features and rating.
    """
    if keys is None:
        row = "__row"
        ids = [c for c in train.columns if c not in ("features", "overall")]
        train = train.withColumn(row, F.to_json(F.struct(*ids, vector_to_array("features").alias("features"), "overall")))
        keys = [row]
    choice = choose_depth(train, keys, seed, **options)
    scored = choice.model.transform(test.select("features", "overall"))
    errors = {f"valid_rmse_depth_{d}": F.lit(e) for d, e in choice.errors.items()}
    return rmse(scored, "overall", name="test_rmse").withColumns(errors)

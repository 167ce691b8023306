"""Registered queries: (spark, sf_dir) -> DataFrame over the test tables.

Floating-point outputs are rounded to six places so that another engine's
summation order does not show.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import space_tokens
from shelfwise.operators.attach import attach
from shelfwise.operators.embedding import fit_embedding, nearest, vocabulary
from shelfwise.operators.encode import (
    count_levels,
    fit_index,
    fit_onehot,
    fit_pca,
    onehot_components,
    vector_mean,
    vector_rows,
)
from shelfwise.operators.flatten import flatten_category_and_rank
from shelfwise.operators.impute import impute_number, impute_text
from shelfwise.operators.neighbours import attach_neighbour_price
from shelfwise.operators.profile import profile
from shelfwise.operators.rollup import attach_rating, mean_and_count
from shelfwise.operators.split import assign_split, hash_split
from shelfwise.operators.trees import rmse, tree_rmse
from shelfwise.plans import records
from shelfwise.sources import views
from shelfwise.sources.catalog import preview, save_record
from shelfwise.sources.shared import shared_dir

SEED = 7
TEST_SEED = 11
TEST_SPLIT = [0.8, 0.2]
VALID_SPLIT = [0.75, 0.25]
LOOKUP_ASIN = 100
QUERY_WORDS = ["and", "der", "de"]
QUERY_VECTORS = [3, 141, 414]
#: First characters of the order priorities.
PLANTED_TOPICS = "12345"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def rating_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.product(spark, sf_dir).select("asin")
    return rounded(attach_rating(items, views.review(spark, sf_dir)), "meanRating")


def rating_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = records.rating_profile(views.review(spark, sf_dir), views.product(spark, sf_dir))
    return rounded(
        record, "mean_meanRating", "variance_meanRating", "mean_countRating", "variance_countRating"
    )


def category_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_category_and_rank(views.product(spark, sf_dir))
    return flat.select("asin", "category", "bestSalesCategory", "bestSalesRank")


def category_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = records.category_profile(views.product(spark, sf_dir))
    return rounded(record, "mean_bestSalesRank", "variance_bestSalesRank")


def neighbour_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = attach_neighbour_price(views.product(spark, sf_dir), skip_nan=True)
    return rounded(priced, "meanPriceAlsoViewed")


def neighbour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = records.neighbour_profile(views.product(spark, sf_dir), skip_nan=True)
    return rounded(
        record,
        "mean_meanPriceAlsoViewed",
        "variance_meanPriceAlsoViewed",
        "mean_countAlsoViewed",
        "variance_countAlsoViewed",
    )


def impute_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.product(spark, sf_dir).select("asin", "price", "title")
    imputed = impute_text(impute_number(items))
    return rounded(imputed.drop("price", "title"), "meanImputedPrice", "medianImputedPrice")


def impute_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = records.impute_profile(views.product(spark, sf_dir))
    return rounded(
        record,
        "mean_meanImputedPrice",
        "variance_meanImputedPrice",
        "mean_medianImputedPrice",
        "variance_medianImputedPrice",
    )


def _nan_apart(df: DataFrame, *columns: str) -> DataFrame:
    """A flag for NaN, and the number where it is one."""
    flags = {f"is_nan_{c}": F.coalesce(F.isnan(c), F.lit(False)) for c in columns}
    return rounded(df.withColumns(flags).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns}), *columns)


def price_mean_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One NaN price makes the mean NaN."""
    return _nan_apart(records.warmup_profile(views.product(spark, sf_dir)), "mean_price")


def neighbour_price_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nan_apart(attach_neighbour_price(views.product(spark, sf_dir)), "meanPriceAlsoViewed")


def neighbour_profile_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = records.neighbour_profile(views.product(spark, sf_dir))
    means = _nan_apart(record, "mean_meanPriceAlsoViewed", "variance_meanPriceAlsoViewed")
    return rounded(means, "mean_countAlsoViewed", "variance_countAlsoViewed")


def record_saved(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """The rating record of all products, with the statistics of a column that is always
    null, saved and read back."""
    rated = attach_rating(views.product(spark, sf_dir).select("asin"), views.review(spark, sf_dir))
    columns = ["meanRating", "countRating", "never"]
    record = profile(rated.withColumn("never", F.lit(None).cast("double")), means=columns, variances=columns, nulls=columns)
    path = save_record(record, root or shared_dir(spark), f"rating_record-{uuid.uuid4().hex}")
    kept = spark.read.text(path)
    read = spark.read.schema(record.schema).json(path)
    keys = kept.select(F.size(F.json_object_keys("value")).alias("n_keys")).scalar()
    statistics = [f"{kind}_{c}" for c in columns for kind in ("mean", "variance")]
    return rounded(read.withColumn("n_keys", keys), *statistics)


def preview_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows and columns a preview has, and that its rows are of the table."""
    items = views.product(spark, sf_dir)
    shown = preview(items, 5)
    known = shown.join(items.select("asin", F.col("title").alias("known_title")), "asin")
    same = F.col("title").eqNullSafe(F.col("known_title"))
    return known.agg(F.count("*").alias("n_rows"), F.lit(len(shown.columns)).alias("n_columns"), F.count_if(same).alias("n_known"))


def title_embedding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = title_embedding(spark, sf_dir)
    lengths = [F.size(f"word_{i}_synonyms").alias(f"word_{i}_length") for i in range(len(QUERY_WORDS))]
    return record.select("count_total", "size_vocabulary", *lengths)


def category_encoding_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At full width the squared length of the mean component vector depends neither
    on signs nor on axes."""
    items = views.categories(spark, sf_dir)
    record = records.category_encoding(items, items.select("category").distinct().count())
    squares = F.aggregate(F.transform("meanVector_categoryPCA", lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    rows = record.select("count_total", squares.alias("squared_mean"), F.posexplode("meanVector_categoryOneHot").alias("position", "share"))
    return rounded(rows, "squared_mean", "share")


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row encoded at full width."""
    items = views.categories(spark, sf_dir)
    levels = count_levels(items, "category")
    encoded = onehot_components(levels, levels.count()).of(levels, "v")
    return attach(items, encoded.select(F.col("label").alias("category"), "v"), "category", "inner")


def category_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row encoded at full width, where its squared length must be 1."""
    squares = F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    return rounded(_encoded(spark, sf_dir).select("asin", F.size("v").alias("width"), squares.alias("squared_length")), "squared_length")


def category_variances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variance of every component over all encoded rows: falling, and the roots of the
    secular equation, as no other axes have it."""
    each = _encoded(spark, sf_dir).select(F.posexplode("v").alias("at", "value"))
    found = each.groupBy((F.col("at") + 1).alias("component")).agg(F.var_pop("value").alias("variance"))
    return found.select("component", F.round(F.abs("variance"), 9).alias("variance"))


def planted_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest words of each of the planted words, by a repeatable fit."""
    planted = views.planted_words(spark, sf_dir)
    model = fit_embedding(planted, "words", "vector", SEED, num_partitions=1, max_iter=8, step_size=0.1)
    names = [f"{topic}_{i}" for topic in PLANTED_TOPICS for i in range(6)]
    near = nearest(model.getVectors(), names, 5)
    return near.groupBy("query").agg(F.array_join(F.sort_array(F.collect_list("word")), ",").alias("neighbours"))


def tree_baseline_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _type_parts(spark, sf_dir)
    return rounded(records.tree_baseline(train, test, SEED), "test_rmse")


def price_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.product(spark, sf_dir)
    return preview(items.where(F.col("asin") == LOOKUP_ASIN), 5, "asin", "title", "price")


def product_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(views.product(spark, sf_dir), 5, "asin")


def price_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(records.warmup_profile(views.product(spark, sf_dir), skip_nan=True), "mean_price")


def tokens_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(views.titles(spark, sf_dir), space_tokens("title"))


def embedding_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = space_tokens("title").alias("titleArray")
    return fit_embedding(views.titles(spark, sf_dir), tokens, "titleVector", SEED).getVectors().select("word")


def nearest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = space_tokens("title").alias("titleArray")
    model = fit_embedding(views.titles(spark, sf_dir), tokens, "titleVector", SEED)
    return rounded(nearest(model.getVectors(), QUERY_WORDS), "similarity")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = views.table(spark, sf_dir, "embeddings")
    return rounded(
        nearest(vectors, QUERY_VECTORS, word="vec_id", vector="embedding"), "similarity"
    )


def title_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.title_embedding(views.titles(spark, sf_dir), QUERY_WORDS, SEED)


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.categories(spark, sf_dir)
    return fit_index(items, "category", "categoryIndex").transform(items)


def _onehot(items: DataFrame) -> DataFrame:
    indexed = fit_index(items, "category", "categoryIndex").transform(items)
    return fit_onehot(indexed, "categoryIndex", "categoryOneHot").transform(indexed)


def onehot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _onehot(views.categories(spark, sf_dir))
    mean = vector_mean(encoded, meanVector="categoryOneHot")
    return rounded(vector_rows(mean, "meanVector", "position", "share"), "share")


def pca_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = records.category_encoding(views.categories(spark, sf_dir))
    means = record.select(F.posexplode("meanVector_categoryPCA").alias("component", "mean"))
    return rounded(means, "mean")


def pca_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a full-width projection keeps whatever its signs and rotation."""
    encoded = _onehot(views.categories(spark, sf_dir)).select("asin", "categoryOneHot")
    width = encoded.schema["categoryOneHot"].metadata["ml_attr"]["num_attrs"]
    projected = fit_pca(encoded, "categoryOneHot", "categoryPCA", width).transform(encoded)
    summary = projected.agg(
        Summarizer.metrics("mean", "variance").summary(F.col("categoryPCA")).alias("s")
    ).select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("variance"))
    totals = summary.select(F.explode(F.arrays_zip("mean", "variance")).alias("c")).agg(
        F.count("*").alias("components"),
        F.sum(F.col("c.mean") * F.col("c.mean")).alias("squared_mean"),
        F.sum("c.variance").alias("total_variance"),
    )
    return rounded(totals, "squared_mean", "total_variance")


def category_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.category_encoding(views.categories(spark, sf_dir))


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.ml_features(spark, sf_dir).select("vec_id")
    return assign_split(rows, ["vec_id"], VALID_SPLIT, SEED, digest="md5")


def rmse_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = views.review(spark, sf_dir).filter(F.col("overall").isNotNull())
    means = mean_and_count(rated, "asin", "overall", "prediction", "uses")
    return rounded(rmse(attach(rated, means, "asin", "inner"), "overall"), "rmse")


def _features_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return hash_split(views.ml_features(spark, sf_dir), ["vec_id"], TEST_SPLIT, TEST_SEED)


def tree_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _features_parts(spark, sf_dir)
    return rounded(records.tree_baseline(train, test, SEED), "test_rmse")


def depth_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _features_parts(spark, sf_dir)
    return records.depth_selection(train, test, ["vec_id"], SEED)


def _type_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Indicators of p_type to predict p_size: the tree must find the group means."""
    part = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asin"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("double").alias("overall"),
    )
    features = _onehot(part).select("asin", F.col("categoryOneHot").alias("features"), "overall")
    return hash_split(features, ["asin"], TEST_SPLIT, TEST_SEED, digest="md5")


def tree_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _type_parts(spark, sf_dir)
    return rounded(tree_rmse(train, test, SEED), "test_rmse")


def tree_depth_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree without a split predicts the training mean."""
    parts = hash_split(views.ml_features(spark, sf_dir), ["vec_id"], TEST_SPLIT, TEST_SEED, digest="md5")
    return rounded(tree_rmse(*parts, SEED, depth=0), "test_rmse")


def depth_selection_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All depths separate the types, so the tie must go to the shallowest."""
    train, test = _type_parts(spark, sf_dir)
    record = records.depth_selection(train, test, ["asin"], SEED, digest="md5")
    return rounded(record, *record.columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "price_lookup": price_lookup,
    "product_preview": product_preview,
    "price_mean": price_mean,
    "price_mean_nan": price_mean_nan,
    "neighbour_price_nan": neighbour_price_nan,
    "neighbour_profile_nan": neighbour_profile_nan,
    "record_saved": record_saved,
    "preview_whole": preview_whole,
    "title_embedding_counts": title_embedding_counts,
    "category_encoding_full": category_encoding_full,
    "category_pca": category_pca,
    "category_variances": category_variances,
    "planted_neighbours": planted_neighbours,
    "tree_baseline_by_type": tree_baseline_by_type,
    "rating_rollup": rating_rollup,
    "rating_profile": rating_profile,
    "category_flatten": category_flatten,
    "category_profile": category_profile,
    "neighbour_price": neighbour_price,
    "neighbour_profile": neighbour_profile,
    "impute_prices": impute_prices,
    "impute_profile": impute_profile,
    "tokens_vocabulary": tokens_vocabulary,
    "embedding_vocabulary": embedding_vocabulary,
    "nearest_words": nearest_words,
    "nearest_vectors": nearest_vectors,
    "title_embedding": title_embedding,
    "category_index": category_index,
    "onehot_mean": onehot_mean,
    "pca_mean": pca_mean,
    "pca_energy": pca_energy,
    "category_encoding": category_encoding,
    "hash_split": split_rows,
    "rmse_metric": rmse_metric,
    "tree_rmse": tree_baseline,
    "tree_by_type": tree_by_type,
    "tree_depth_zero": tree_depth_zero,
    "depth_sweep": depth_selection,
    "depth_sweep_by_type": depth_selection_by_type,
}

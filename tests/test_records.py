"""The names in every result record."""

import pytest

from shelfwise.operators.split import hash_split
from shelfwise.plans import records
from shelfwise.plans.queries import QUERY_WORDS
from shelfwise.sources import views


def statistics(column):
    return {f"mean_{column}", f"variance_{column}", f"numNulls_{column}"}


def parts(spark, sf_dir):
    return hash_split(views.ml_features(spark, sf_dir), ["vec_id"], [0.8, 0.2], 3)


RECORDS = {
    "warmup": (
        lambda s, d: records.warmup_profile(views.product(s, d)),
        {"count_total", "mean_price"},
    ),
    "rating": (
        lambda s, d: records.rating_profile(views.review(s, d), views.product(s, d)),
        {"count_total"} | statistics("meanRating") | statistics("countRating"),
    ),
    "category": (
        lambda s, d: records.category_profile(views.product(s, d)),
        {
            "count_total",
            "mean_bestSalesRank",
            "variance_bestSalesRank",
            "numNulls_category",
            "countDistinct_category",
            "numNulls_bestSalesCategory",
            "countDistinct_bestSalesCategory",
        },
    ),
    "neighbour": (
        lambda s, d: records.neighbour_profile(views.product(s, d)),
        {"count_total"} | statistics("meanPriceAlsoViewed") | statistics("countAlsoViewed"),
    ),
    "impute": (
        lambda s, d: records.impute_profile(views.product(s, d)),
        {"count_total", "numUnknowns_unknownImputedTitle"}
        | statistics("meanImputedPrice")
        | statistics("medianImputedPrice"),
    ),
    "embedding": (
        lambda s, d: records.title_embedding(views.titles(s, d), QUERY_WORDS, 1),
        {"count_total", "size_vocabulary", "word_0_synonyms", "word_1_synonyms", "word_2_synonyms"},
    ),
    "encoding": (
        lambda s, d: records.category_encoding(views.categories(s, d)),
        {"count_total", "meanVector_categoryOneHot", "meanVector_categoryPCA"},
    ),
    "baseline": (lambda s, d: records.tree_baseline(*parts(s, d), 1), {"test_rmse"}),
    "depth": (
        lambda s, d: records.depth_selection(*parts(s, d), ["vec_id"], 1),
        {"test_rmse"} | {f"valid_rmse_depth_{d}" for d in (5, 7, 9, 12)},
    ),
}


@pytest.mark.parametrize("name", RECORDS)
def test_record_names(spark, sf_dir, name):
    build, names = RECORDS[name]
    record = build(spark, sf_dir)
    assert set(record.columns) == names
    assert record.count() == 1

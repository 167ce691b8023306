"""The summary values recorded in FIXTURES.md for sf0.01."""

import pytest
from helpers import close, record

from shelfwise.plans import records
from shelfwise.plans.queries import tokens_vocabulary
from shelfwise.sources import views

SF_DIR = "/root/testdata/sf0.01"


def check(df, expected):
    found = record(df)
    for name, value in expected.items():
        assert close(found[name], value, 1e-9), (name, found[name], value)


@pytest.fixture(scope="module")
def product(spark):
    return views.product(spark, SF_DIR)


def test_rating(spark, product):
    check(
        records.rating_profile(views.review(spark, SF_DIR), product),
        {
            "count_total": 2000,
            "mean_meanRating": 3.0076202911583763,
            "variance_meanRating": 0.08177314216743502,
            "numNulls_meanRating": 200,
            "mean_countRating": 25.705555555555556,
            "variance_countRating": 25.362948551664438,
            "numNulls_countRating": 200,
        },
    )


def test_category(product):
    check(
        records.category_profile(product),
        {
            "count_total": 2000,
            "mean_bestSalesRank": 25.52842377260982,
            "variance_bestSalesRank": 204.32175136005526,
            "numNulls_category": 251,
            "countDistinct_category": 6,
            "numNulls_bestSalesCategory": 452,
            "countDistinct_bestSalesCategory": 6,
        },
    )


def test_neighbour(product):
    check(
        records.neighbour_profile(product, skip_nan=True),
        {
            "count_total": 2000,
            "mean_meanPriceAlsoViewed": 949.8202484056409,
            "variance_meanPriceAlsoViewed": 659.1724110454584,
            "numNulls_meanPriceAlsoViewed": 497,
            "mean_countAlsoViewed": 2.5005767012687428,
            "variance_countAlsoViewed": 1.2507209597799953,
            "numNulls_countAlsoViewed": 266,
        },
    )


def test_impute(product):
    check(
        records.impute_profile(product),
        {
            "mean_meanImputedPrice": 949.97169449577,
            "variance_meanImputedPrice": 649.2294869162,
            "mean_medianImputedPrice": 949.977950012207,
            "variance_medianImputedPrice": 649.2296249193,
            "numNulls_meanImputedPrice": 0,
            "numNulls_medianImputedPrice": 0,
            "numUnknowns_unknownImputedTitle": 262,
        },
    )


def test_vocabulary(spark):
    words = tokens_vocabulary(spark, SF_DIR)
    assert words.count() == 296
    assert words.groupBy().sum("uses").first()[0] == 142_190

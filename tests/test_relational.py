"""Edge cases of the rating, neighbour, imputation and profile steps."""

import math

import pytest
from helpers import close, plan, record, rows
from pyspark.sql import functions as F

from shelfwise.operators.impute import fill_values, impute_number, impute_text, median
from shelfwise.operators.neighbours import attach_neighbour_price
from shelfwise.operators.profile import profile
from shelfwise.operators.rollup import attach_rating
from shelfwise.plans import records


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(
        [("a", 5.0), ("a", 3.0), ("a", None), ("b", None), ("x", 1.0), (None, 2.0)],
        "asin string, overall double",
    )


def test_rating_rollup(spark, reviews):
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), (None,)], "asin string")
    assert rows(attach_rating(items, reviews)) == sorted(
        [("a", 4.0, 2), ("a", 4.0, 2), ("b", None, 0), ("c", None, None), (None, None, None)], key=repr
    )


def test_rating_profile(spark, reviews):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "asin string")
    assert record(records.rating_profile(reviews, items)) == {
        "count_total": 3,
        "mean_meanRating": 4.0,
        "variance_meanRating": None,
        "numNulls_meanRating": 2,
        "mean_countRating": 1.0,
        "variance_countRating": 2.0,
        "numNulls_countRating": 1,
    }


def test_rating_of_nan_is_nan_but_counted(spark):
    items = spark.createDataFrame([("a",)], "asin string")
    ratings = spark.createDataFrame([("a", float("nan")), ("a", 1.0)], "asin string, overall double")
    _, mean, count = attach_rating(items, ratings).first()
    assert math.isnan(mean) and count == 2


NEIGHBOURS = """
    select * from values
      ('a', 10f,                 array('b', 'b', 'c', 'gone')),
      ('b', 20f,                 array('c')),
      ('c', cast(null as float), array('n')),
      ('n', cast('NaN' as float), cast(null as array<string>)),
      ('e', 50f,                 cast(array() as array<string>)),
      ('f', 1f,                  array('d', 'n', 'a')),
      ('d', 4f,                  array('a')),
      ('d', 6f,                  array('a'))
    as t(asin, price, viewed)
"""

AS_MAP = "map('also_viewed', viewed, 'other', array('a'))"
AS_STRUCT = "named_struct('also_viewed', viewed)"


@pytest.mark.parametrize("related", [AS_MAP, AS_STRUCT])
def test_neighbours_without_nan(spark, related):
    items = spark.sql(NEIGHBOURS).selectExpr("asin", "price", f"{related} as related")
    assert rows(attach_neighbour_price(items, skip_nan=True)) == sorted(
        [
            ("a", 4, 20.0),
            ("b", 1, None),
            ("c", 1, None),
            ("n", None, None),
            ("e", None, None),
            ("f", 3, (4.0 + 6.0 + 10.0) / 3),
            ("d", 1, 10.0),
            ("d", 1, 10.0),
        ],
        key=repr,
    )


def test_neighbours_keep_nan_by_default(spark):
    items = spark.sql(NEIGHBOURS).selectExpr("asin", "price", f"{AS_MAP} as related")
    means = {asin: mean for asin, _, mean in attach_neighbour_price(items).collect()}
    assert math.isnan(means["c"]) and math.isnan(means["f"]) and means["a"] == 20.0
    summary = record(records.neighbour_profile(items))
    assert math.isnan(summary["mean_meanPriceAlsoViewed"])
    assert summary["numNulls_meanPriceAlsoViewed"] == 3
    assert summary["numNulls_countAlsoViewed"] == 2


def test_missing_map_entry(spark):
    items = spark.sql("select 'a' as asin, 1f as price, map('bought', array('a')) as related")
    assert rows(attach_neighbour_price(items)) == [("a", None, None)]


def test_category_profile(spark):
    items = spark.sql(
        """select * from values
             (array(array('x', 'y')), map('r', 30, 's', 2)),
             (array(array('')),       map('r', 10)),
             (array(array('z')),      cast(null as map<string,int>)),
             (cast(null as array<array<string>>), cast(map() as map<string,int>))
           as t(categories, salesRank)"""
    )
    assert record(records.category_profile(items)) == {
        "count_total": 4,
        "mean_bestSalesRank": 20.0,
        "variance_bestSalesRank": 200.0,
        "numNulls_category": 2,
        "countDistinct_category": 2,
        "numNulls_bestSalesCategory": 2,
        "countDistinct_bestSalesCategory": 1,
    }


def test_impute_number_from_text(spark):
    items = spark.createDataFrame([("1",), ("2",), ("6",), ("NaN",), ("free",), (None,)], "price string")
    found = impute_number(items).select("meanImputedPrice", "medianImputedPrice").collect()
    assert sorted(map(tuple, found)) == [(1.0, 1.0), (2.0, 2.0), (3.0, 2.0), (3.0, 2.0), (3.0, 2.0), (6.0, 6.0)]


def test_impute_without_valid_number_fills_zero(spark):
    items = spark.createDataFrame([("NaN",), (None,)], "price string")
    assert rows(impute_number(items).select("meanImputedPrice", "medianImputedPrice")) == [(0.0, 0.0)] * 2
    empty = items.limit(0)
    assert fill_values(empty, "price").first()[0].asDict() == {"mean": 0.0, "median": 0.0}


def test_median_is_exact(spark):
    prices = spark.range(0, 200_000, 1, 16).selectExpr("cast(id as float) as price")
    assert fill_values(prices, "price").first()[0]["median"] == 99_999


@pytest.mark.parametrize(
    "values",
    [
        [],
        [3.0],
        [2.0, 1.0],
        [-1.0, 0.0, 1.0],
        [-5.5, -5.25, -1e30, 1e-40, 0.0],
        [1e38, 1e37, -1e38, 5.0],
        [7.0] * 9 + [1.0, 8.0],
        [float("inf"), 1.0, float("-inf")],
        [float("nan"), 4.0, 6.0, 9.0],
        [1.0 + k / 8 for k in range(50)] + [-k / 3 for k in range(40)],
    ],
)
def test_median_by_hand(spark, values):
    known = sorted(v for v in map(float, spark.createDataFrame([(v,) for v in values], "v float").toPandas()["v"]) if not math.isnan(v))
    found = median(spark.createDataFrame([(v,) for v in [*values, None]], "v float").repartition(3), "v").first()["median"]
    assert found == (known[(len(known) - 1) // 2] if known else None)


def test_no_task_orders_many_values(spark):
    """Half a million different prices: the windows see the bins, and one bin."""
    prices = spark.range(0, 500_000, 1, 8).selectExpr("cast(id / 7 as float) as price")
    assert median(prices, "price").first()["median"] == prices.selectExpr("percentile_disc(0.5) within group (order by price)").first()[0]


def reads(spark, work):
    """How many rows of a table of 2,000 ``work`` reads, by a count within the tasks."""
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    table = spark.range(0, 2000, 1, 4).selectExpr("cast(id % 97 as double) as price")
    work(table.mapInPandas(counting, table.schema))
    return read.value


def test_imputing_reads_a_table_twice(spark):
    def filled(table):
        assert impute_number(table).agg(F.sum("meanImputedPrice"), F.sum("medianImputedPrice")).first() is not None

    assert reads(spark, filled) == 4000
    assert reads(spark, lambda table: median(table, "price").first()) == 2000


def test_imputed_rows_come_from_the_table_alone(spark):
    items = spark.createDataFrame([(1.0,), (5.0,), (None,), (float("inf"),)], "price double")
    filled = impute_number(items).select("meanImputedPrice", "medianImputedPrice")
    assert "Scan parquet" not in plan(filled) and "Subquery" not in plan(filled)
    assert rows(filled) == [(1.0, 1.0), (5.0, 5.0), (math.inf, 5.0), (math.inf, math.inf)]


def test_median_of_doubles_in_a_narrow_range(spark):
    prices = spark.range(0, 300_001, 1, 6).selectExpr("1 + (id * 7919 % 300001) * 1e-12 as price")
    assert median(prices, "price").first()["median"] == 1 + 150_000 * 1e-12


def test_several_distinct_counts_copy_no_rows(spark):
    items = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), (None, 2, None), ("b", 2, 3.0)], "x string, y int, z double")
    found = profile(items, means=["z"], nulls=["x", "y"], distincts=["x", "y"], matches={"n": ("x", "a")})
    assert "Expand" not in plan(found)
    assert record(found) == {
        "count_total": 4, "mean_z": 2.0, "numNulls_x": 1, "numNulls_y": 1, "countDistinct_x": 2, "countDistinct_y": 2, "n": 2,
    }


def test_impute_profile(spark):
    items = spark.createDataFrame(
        [(2.0, "unknown"), (4.0, ""), (None, None), (float("nan"), " ")], "price float, title string"
    )
    summary = record(records.impute_profile(items))
    assert summary["count_total"] == 4
    assert summary["mean_meanImputedPrice"] == 3.0
    assert close(summary["variance_meanImputedPrice"], 2 / 3)
    assert summary["mean_medianImputedPrice"] == 2.5
    assert summary["numNulls_meanImputedPrice"] == summary["numNulls_medianImputedPrice"] == 0
    assert summary["numUnknowns_unknownImputedTitle"] == 3


def test_impute_text_keeps_input(spark):
    items = spark.createDataFrame([("",), ("t",)], "title string")
    assert rows(impute_text(items)) == [("", "unknown"), ("t", "t")]


def test_warmup_profile(spark):
    items = spark.createDataFrame([(1.0,), (None,), (3.0,)], "price float")
    assert record(records.warmup_profile(items)) == {"count_total": 3, "mean_price": 2.0}
    with_nan = spark.createDataFrame([(1.0,), (float("nan"),)], "price float")
    assert math.isnan(record(records.warmup_profile(with_nan))["mean_price"])
    assert record(records.warmup_profile(with_nan, skip_nan=True))["mean_price"] == 1.0


def test_profile_of_empty_table(spark):
    empty = spark.createDataFrame([], "c double")
    summary = record(profile(empty, means=["c"], variances=["c"], nulls=["c"], distincts=["c"], matches={"n": ("c", 1.0)}))
    assert summary == {
        "count_total": 0,
        "mean_c": None,
        "variance_c": None,
        "numNulls_c": 0,
        "countDistinct_c": 0,
        "n": 0,
    }


def test_profile_of_one_row_has_no_variance(spark):
    assert record(profile(spark.createDataFrame([(1.0,)], "c double"), variances=["c"]))["variance_c"] is None

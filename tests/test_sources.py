"""Declared schemas, the catalogue, previews and saved records."""

import pytest
from helpers import record, rows
from pyspark.ml.linalg import Vectors

from shelfwise.plans import records
from shelfwise.sources import catalog, shared, views


def test_catalogue_round_trip(spark, tmp_path):
    product = spark.sql(
        """select 'a' as asin, 'T' as title, 2f as price, array(array('c')) as categories,
                  map('z', 9, 'b', 1) as salesRank, map('also_viewed', array('a')) as related"""
    )
    product.write.parquet(f"{tmp_path}/product")
    spark.createDataFrame([("a", 4.0)], catalog.REVIEW).write.parquet(f"{tmp_path}/review")
    spark.createDataFrame([("r1", Vectors.dense([1.0, 2.0]), 3.0)], catalog.ML_FEATURES).write.parquet(f"{tmp_path}/train")
    tables = catalog.load_catalog(
        spark,
        {"product": f"{tmp_path}/product", "review": f"{tmp_path}/review", "ml_features_train": f"{tmp_path}/train"},
    )
    assert record(records.rating_profile(tables["review"], tables["product"]))["mean_meanRating"] == 4.0
    assert record(records.category_profile(tables["product"]))["mean_bestSalesRank"] == 9.0
    assert tables["ml_features_train"].first()["features"] == Vectors.dense([1.0, 2.0])
    assert spark.table("review").count() == 1


def test_json_with_declared_schema(spark, tmp_path):
    path = tmp_path / "product.json"
    path.write_text(
        '{"asin": "a", "price": 1.5, "salesRank": {"z": 9, "b": 1}, "related": {"also_viewed": ["a", "q"]}}\n'
        '{"asin": "b", "categories": [["x", "y"]]}\n'
    )
    product = catalog.load_catalog(spark, {"product": str(path)}, fmt="json")["product"]
    found = record(records.category_profile(product))
    assert found["mean_bestSalesRank"] == 9.0
    assert found["numNulls_category"] == 1
    assert record(records.neighbour_profile(product))["mean_meanPriceAlsoViewed"] == 1.5


def test_unknown_table(spark):
    with pytest.raises(KeyError):
        catalog.load_catalog(spark, {"nonsense": "/nowhere"})


def test_preview(spark):
    numbers = spark.range(100).withColumn("b", spark.range(1).select("id").scalar())
    assert catalog.preview(numbers).count() == 5
    assert catalog.preview(numbers, 3, "id").columns == ["id"]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_saved_record_is_replaced(spark, tmp_path, fmt):
    first = spark.sql("select 1 as count_total, array(0.5D) as meanVector")
    path = catalog.save_record(first, str(tmp_path), "profile", fmt)
    assert rows(spark.read.format(fmt).load(path).select("count_total", "meanVector")) == [(1, [0.5])]
    catalog.save_record(spark.sql("select 2 as count_total"), str(tmp_path) + "/", "profile", fmt)
    assert rows(spark.read.format(fmt).load(path)) == [(2,)]


def test_views_use_every_source_row(spark, sf_dir):
    def size(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").count()

    assert views.review(spark, sf_dir).count() == size("lineitem")
    assert views.product(spark, sf_dir).count() == size("part")
    assert views.titles(spark, sf_dir).count() == size("documents")
    assert views.categories(spark, sf_dir).count() == size("part")
    assert views.ml_features(spark, sf_dir).count() == size("embeddings")


def test_saved_record_keeps_null_and_nan(spark, tmp_path):
    one = spark.sql("select 1L as count_total, cast(null as double) as variance_x, double('NaN') as mean_x, cast(null as string) as s")
    path = catalog.save_record(one, str(tmp_path), "one")
    (line,) = [r["value"] for r in spark.read.text(path).collect()]
    assert line == '{"count_total":1,"variance_x":null,"mean_x":"NaN","s":null}'
    back = spark.read.schema(one.schema).json(path).first()
    assert back["variance_x"] is None and back["mean_x"] != back["mean_x"]


def test_failed_save_leaves_the_record_that_was_there(spark, tmp_path):
    catalog.save_record(spark.sql("select 1 as count_total"), str(tmp_path), "one")
    bad = spark.range(0, 4, 1, 4).selectExpr("if(id < 3, id, cast(raise_error('no') as bigint)) as count_total")
    with pytest.raises(Exception, match="no"):
        catalog.save_record(bad, str(tmp_path), "one")
    assert rows(spark.read.json(f"{tmp_path}/one")) == [(1,)]
    with pytest.raises(Exception, match="no"):
        catalog.save_record(bad, str(tmp_path), "two")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["one"]


def test_written_tables_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_dir", lambda session: str(tmp_path))
    shared.written(spark.range(5), "numbers")
    (own,) = tmp_path.iterdir()
    assert len(list(own.iterdir())) == 1
    shared.remove_written(spark)
    shared.remove_written(spark)
    assert not list(tmp_path.iterdir())

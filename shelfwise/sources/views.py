"""The input tables of the result records, derived from the test tables.

The test tables hold no nested columns and hardly any nulls, so fixed rules on
the key add both. Every row of the source table is used.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns in use; declaring them saves a job per table to infer them.
COLUMNS = {
    "lineitem": "l_partkey bigint, l_linenumber int, l_quantity double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "documents": "doc_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asin, overall); one asin in ten is unknown, some ratings are null."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("case when l_partkey % 10 = 0 then -1 - l_partkey else l_partkey end").alias("asin"),
        F.expr(
            "case when l_linenumber = 7 then null"
            " else cast(1 + cast(l_quantity as int) % 5 as double) end"
        ).alias("overall"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asin, title, price, categories, salesRank, related)."""
    part = table(spark, sf_dir, "part")
    ids = part.agg((F.max("p_partkey") + 1).alias("n")).scalar()
    some_ids = "p_partkey * 7 % n, p_partkey * 7 % n, p_partkey * 3 % (n * 5 div 4), p_partkey * 11 % n"
    return part.withColumn("n", ids).select(
        F.col("p_partkey").alias("asin"),
        F.expr(
            "case when p_partkey % 13 = 0 then '' when p_partkey % 17 = 0 then null else p_name end"
        ).alias("title"),
        F.expr(
            "case when p_partkey % 7 = 0 then null when p_partkey % 11 = 0 then cast('NaN' as float)"
            " else cast(p_retailprice as float) end"
        ).alias("price"),
        F.expr(
            "case when p_partkey % 19 = 0 then null when p_partkey % 23 = 0 then array()"
            " when p_partkey % 29 = 0 then array(array(''))"
            " else array(array(p_type, p_brand), array(p_brand)) end"
        ).alias("categories"),
        F.expr(
            "case when p_partkey % 5 = 0 then null when p_partkey % 31 = 0 then map()"
            " else map(p_type, p_size, p_brand, 2 * p_size) end"
        ).alias("salesRank"),
        F.expr(
            "map('also_viewed', case when p_partkey % 9 = 0 then null"
            " when p_partkey % 41 = 0 then cast(array() as array<bigint>)"
            f" else slice(array({some_ids}), 1, cast(1 + p_partkey % 4 as int)) end)"
        ).alias("related"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title): whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("title"))


def categories(spark: SparkSession, sf_dir: str, column: str = "p_brand") -> DataFrame:
    """(asin, category)."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("asin"), F.col(column).alias("category"))


def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features, overall)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("overall"),
    )


def planted_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, words): ten words of every order, all of the six words of its priority.

    Words of one priority stand among each other only, so an embedding must find them
    to be each other's neighbours.
    """
    word = "concat(lower(substr(o_orderpriority, 1, 1)), '_', cast((o_orderkey * (i + 1) + o_custkey + i) % 6 as string))"
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(f"transform(sequence(0, 9), i -> {word})").alias("words"))

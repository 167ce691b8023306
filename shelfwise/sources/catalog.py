"""Named tables with declared schemas, and saved result records."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise.sources.shared import move_folder, remove_folder

REVIEW = T.StructType().add("asin", T.StringType()).add("overall", T.DoubleType())

PRODUCT = (
    T.StructType()
    .add("asin", T.StringType())
    .add("title", T.StringType())
    .add("price", T.FloatType())
    .add("categories", T.ArrayType(T.ArrayType(T.StringType())))
    .add("salesRank", T.MapType(T.StringType(), T.IntegerType()))
    .add("related", T.MapType(T.StringType(), T.ArrayType(T.StringType())))
)

PRODUCT_PROCESSED = (
    T.StructType().add("asin", T.StringType()).add("title", T.StringType()).add("category", T.StringType())
)

#: Files without a row id read as null ids.
ML_FEATURES = T.StructType().add("id", T.StringType()).add("features", VectorUDT()).add("overall", T.DoubleType())

SCHEMAS: Mapping[str, T.StructType] = {
    "review": REVIEW,
    "product": PRODUCT,
    "product_processed": PRODUCT_PROCESSED,
    "ml_features_train": ML_FEATURES,
    "ml_features_test": ML_FEATURES,
}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A table; with a ``schema`` nothing is read before the first action."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def load_catalog(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    schemas: Mapping[str, T.StructType] = SCHEMAS,
) -> dict[str, DataFrame]:
    """The named tables, each also registered as a temporary view."""
    unknown = sorted(set(paths) - set(schemas))
    if unknown:
        raise KeyError(f"no schema declared for {unknown}")
    tables = {name: read_table(spark, path, schemas[name], fmt) for name, path in paths.items()}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def preview(df: DataFrame, n: int = 5, *columns: str) -> DataFrame:
    """``n`` rows in no particular order, of all or some columns."""
    return (df.select(*columns) if columns else df).limit(n)


def save_record(record: DataFrame, root: str, name: str, fmt: str = "json") -> str:
    """Writes a one-row result under its name, replacing an earlier one.

    Every key is kept: a null statistic is written as null, NaN as NaN. The record is
    written under another name and then renamed, so a job that fails leaves what was there
    before, never half a record.
    """
    root = root.rstrip("/")
    path, fresh = f"{root}/{name}", f"{root}/.{name}-{uuid.uuid4().hex}"
    writer = record.write.format(fmt)
    spark = record.sparkSession
    try:
        (writer.option("ignoreNullFields", "false") if fmt == "json" else writer).save(fresh)
        move_folder(spark, fresh, path)
    finally:
        remove_folder(spark, fresh)
    return path

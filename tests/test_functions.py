"""Null, NaN and empty rules of the column expressions, under ANSI mode."""

import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import (
    empty_to_null,
    fill_if_missing,
    is_valid_number,
    text_or,
    to_float,
    valid_number,
)
from shelfwise.functions.nested import first_key, first_leaf, first_value, size_or_null
from shelfwise.functions.text import space_tokens


def one(spark, sql, column):
    return spark.sql(f"select {sql} as c").select(column).first()[0]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("cast(null as array<array<string>>)", None),
        ("cast(array() as array<array<string>>)", None),
        ("cast(array(array()) as array<array<string>>)", None),
        ("array(array(''))", None),
        ("array(array(cast(null as string)))", None),
        ("array(array(' '))", " "),
        ("array(array('a', 'b'), array('c'))", "a"),
        ("array(cast(array() as array<string>), array('c'))", None),
    ],
)
def test_first_leaf(spark, sql, expected):
    assert one(spark, sql, first_leaf("c")) == expected


@pytest.mark.parametrize(
    "sql, key, value",
    [
        ("cast(null as map<string,int>)", None, None),
        ("cast(map() as map<string,int>)", None, None),
        ("map('z', 9, 'a', 1)", "z", 9),
        ("map('z', cast(null as int), 'a', 1)", "z", None),
    ],
)
def test_first_entry_is_first_stored(spark, sql, key, value):
    assert one(spark, sql, first_key("c")) == key
    assert one(spark, sql, first_value("c")) == value


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("cast(null as array<string>)", None),
        ("cast(array() as array<string>)", None),
        ("array('a', 'a')", 2),
        ("array(cast(null as string))", 1),
    ],
)
def test_size_or_null(spark, sql, expected):
    assert one(spark, sql, size_or_null("c")) == expected


@pytest.mark.parametrize("sql, expected", [("''", None), ("cast(null as string)", None), ("' '", " "), ("'x'", "x")])
def test_empty_to_null(spark, sql, expected):
    assert one(spark, sql, empty_to_null("c")) == expected


@pytest.mark.parametrize(
    "sql, expected",
    [("''", "unknown"), ("cast(null as string)", "unknown"), ("' '", " "), ("'unknown'", "unknown"), ("'x'", "x")],
)
def test_text_or(spark, sql, expected):
    assert one(spark, sql, text_or("c", "unknown")) == expected


@pytest.mark.parametrize("sql, expected", [("'abc'", None), ("''", None), ("'1.5'", 1.5), ("2.25D", 2.25)])
def test_to_float(spark, sql, expected):
    assert one(spark, sql, to_float("c")) == expected


def test_to_float_keeps_nan(spark):
    assert math.isnan(one(spark, "'NaN'", to_float("c")))


@pytest.mark.parametrize(
    "sql, valid, value",
    [
        ("cast(null as float)", False, None),
        ("cast('NaN' as float)", False, None),
        ("cast(1.5 as float)", True, 1.5),
    ],
)
def test_valid_number(spark, sql, valid, value):
    assert one(spark, sql, is_valid_number("c")) is valid
    assert one(spark, sql, valid_number("c")) == value


def test_filling_widens_to_double(spark):
    filled = spark.sql("select cast(9.99 as float) as c").select(fill_if_missing("c", F.lit(0.0)).alias("d"))
    assert filled.dtypes == [("d", "double")]
    assert filled.first()[0] == 9.989999771118164


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("'Big  Red '", ["big", "", "red", ""]),
        ("''", [""]),
        ("cast(null as string)", None),
        ("'a.b'", ["a.b"]),
    ],
)
def test_space_tokens(spark, sql, expected):
    assert one(spark, sql, space_tokens("c")) == expected

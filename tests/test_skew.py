"""Hot keys: spread over parts, with the same rows as the ordinary join."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shelfwise.operators.attach import Skew, attach, dealt_out, hot_keys
from shelfwise.operators.neighbours import attach_neighbour_price
from shelfwise.operators.rollup import attach_rating

ALWAYS = Skew(rows_per_task=50)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 7, a third are null, and exact copies abound."""
    return spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("asin"),
        (F.col("id") % 2).alias("payload"),
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 2000).select(F.col("id").alias("asin"), (F.col("id") * 10).alias("value"))


def hashes(spark, keys):
    """xxhash64 of each key, as longs."""
    table = spark.createDataFrame([(k,) for k in keys], "asin long")
    return {r["asin"]: r["hash"] for r in table.withColumn("hash", F.xxhash64("asin")).collect()}


def test_hot_keys_are_found(spark, skewed):
    """Null is a key like any other."""
    found = hashes(spark, [7, None])
    assert sorted(hot_keys(skewed, "asin", ALWAYS)) == sorted([(found[7], 21), (found[None], 20)])


def test_hot_keys_are_bounded(spark):
    many = spark.range(0, 5000).select((F.col("id") % 500).alias("asin"))
    assert len(hot_keys(many, "asin", Skew(rows_per_task=1, tracked=64))) <= 16


def test_hot_keys_of_an_empty_table(spark):
    assert hot_keys(spark.range(0), "id") == []
    assert attach(spark.range(0), spark.range(5).withColumn("x", F.lit(1)), "id").collect() == []


def test_counts_are_exact_while_all_keys_are_tracked(spark):
    """10 to 109 rows a key, with the limit amid their counts."""
    rows_of = {k: 10 + k % 100 for k in range(600)}
    keys = spark.createDataFrame(list(rows_of.items()), "asin long, n int").select("asin", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    found = hashes(spark, rows_of)
    wanted = {(found[k], -(-n // 60)) for k, n in rows_of.items() if n > 60}
    for parts in (1, 3, 8):
        assert set(hot_keys(keys.repartition(parts, "i"), "asin", Skew(rows_per_task=60, tracked=4096))) == wanted


@pytest.mark.parametrize("tracked", [64, 128, 1024])
def test_joins_do_not_depend_on_what_is_tracked(spark, tracked):
    rows_of = {k: 10 + k % 100 for k in range(600)}
    keys = spark.createDataFrame(list(rows_of.items()), "asin long, n int").select("asin", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    lookup = keys.groupBy("asin").agg(F.count("*").alias("n"))
    for parts in (1, 8):
        found = attach(keys.repartition(parts, "i"), lookup, "asin", skew=Skew(rows_per_task=60, tracked=tracked))
        per_key = found.groupBy("asin").agg(F.count("*").alias("rows"), F.min("n").alias("lo"), F.max("n").alias("hi"))
        assert per_key.where("rows <> lo or rows <> hi or lo is null").count() == 0
        assert found.count() == sum(rows_of.values())


def test_many_even_keys_are_an_ordinary_join(spark):
    """Far more rows than a sketch could count key by key, and no hot key among them: however many
    keys there are, nothing is counted or read beyond the one narrow pass."""
    even = spark.range(0, 2_000_000, 1, 8).select((F.col("id") % 500_000).alias("asin"))
    skew = Skew(rows_per_task=1000, tracked=256)
    assert hot_keys(even, "asin", skew) == []
    lookup = even.groupBy("asin").agg(F.count("*").alias("n"))
    assert plan(attach(even, lookup, "asin", skew=skew)).count("Join") == plan(even.join(lookup, "asin", "left")).count("Join")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("tracked", [64, 4096])
def test_spread_join_changes_nothing(skewed, lookup, how, tracked):
    skew = Skew(50, tracked=tracked)
    found = attach(skewed, lookup, "asin", how, skew)
    plain = skewed.join(lookup, "asin", how)
    assert found.columns == plain.columns
    assert rows(found) == rows(plain)


@pytest.fixture()
def shuffled_joins(spark):
    """Tiny partitions stay apart, and tiny tables are not broadcast."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in off.items():
        spark.conf.set(name, value)
    yield
    for name in off:
        spark.conf.unset(name)


def tasks(joined, hot):
    """Rows of a key by the task that joins them."""
    chosen = joined.filter(F.col("asin").eqNullSafe(F.lit(hot)))
    return [r["count"] for r in chosen.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("hot", [7, None])
def test_hot_rows_reach_many_tasks(skewed, lookup, shuffled_joins, hot):
    spread = attach(skewed, lookup, "asin", "left", ALWAYS)
    assert "SortMergeJoin" in plan(spread) and "NestedLoop" not in plan(spread)
    assert len(tasks(skewed.join(lookup, "asin", "left"), hot)) == 1
    assert len(tasks(spread, hot)) > 1


def test_many_narrow_rows_of_one_key_with_default_settings(spark, tmp_path):
    """20 million rows of one key in a small file: no part beyond a tenth of its share."""
    spark.range(0, 20_000_000, 1, 4).select(F.lit(7).alias("asin")).write.parquet(f"{tmp_path}/hot")
    table = spark.read.parquet(f"{tmp_path}/hot")
    assert [parts for _, parts in hot_keys(table, "asin")] == [20]
    dealt = dealt_out(table.withColumn("parts", F.lit(20)), F.col("parts"), "part")
    assert all(abs(r["count"] - 1_000_000) <= 100_000 for r in dealt.groupBy("part").count().collect())
    lookup = spark.createDataFrame([(7, 1.0)], "asin int, value double").groupBy("asin").agg(F.sum("value").alias("value"))
    assert attach(table, lookup, "asin").agg(F.sum("value")).first()[0] == 20_000_000


def test_equal_rows_of_one_partition_are_dealt_out(spark):
    equal = spark.range(0, 4_000_000, 1, 1).select(F.lit(7).alias("asin"), F.lit(3).alias("length"), F.lit(10).alias("parts"))
    found = dealt_out(equal, F.col("parts"), "part").groupBy("part").count().collect()
    assert len(found) == 10 and all(abs(r["count"] - 400_000) <= 40_000 for r in found)


def test_helper_columns_clash_with_none(skewed, lookup):
    """Columns of the user that bear the names of helpers are kept."""
    table = skewed.withColumns({"hash": F.lit("a"), "PARTS": F.lit("b"), "part": F.lit("c")})
    found = attach(table, lookup.withColumn("part_", F.lit("d")), "asin", "left", ALWAYS)
    assert found.columns == ["asin", "payload", "hash", "PARTS", "part", "value", "part_"]
    assert found.where("hash = 'a' and PARTS = 'b' and part = 'c'").count() == 3000


def test_keys_of_two_types_are_joined_as_usual(skewed, lookup):
    found = attach(skewed, lookup.withColumn("asin", F.col("asin").cast("int")), "asin", "left", ALWAYS)
    assert rows(found) == rows(skewed.join(lookup, "asin", "left"))


def test_map_columns_are_carried(spark, skewed, lookup):
    with_map = skewed.withColumn("m", F.create_map(F.lit("k"), "payload"))
    found = attach(with_map, lookup, "asin", "left", ALWAYS)
    assert found.count() == 3000
    assert found.filter("m['k'] = payload").count() == 3000


def test_only_left_and_inner(skewed, lookup):
    with pytest.raises(ValueError):
        attach(skewed, lookup, "asin", "full")


def test_rating_rollup_with_a_hot_item(spark, skewed):
    reviews = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("asin"),
        (F.col("id") % 5).cast("double").alias("overall"),
    )
    assert rows(attach_rating(skewed, reviews, skew=ALWAYS)) == rows(attach_rating(skewed, reviews))


def test_neighbours_with_a_hot_target(spark):
    """Every list names item 1, which a third of the items also are."""
    items = spark.range(0, 900, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("asin"),
        (F.col("id") % 7).cast("float").alias("price"),
        F.create_map(F.lit("also_viewed"), F.array(F.lit(1), F.lit(1), F.col("id"))).alias("related"),
    )
    price = {i: float(i % 7) for i in range(900)}
    named = {}  # item -> prices of the rows that bear its number
    for i in range(900):
        named.setdefault(1 if i % 3 == 0 else i, []).append(price[i])
    seen = {}
    for i in range(900):
        for to in (1, 1, i):
            seen.setdefault(1 if i % 3 == 0 else i, []).extend(named.get(to, []))
    expected = sorted((asin, round(sum(p) / len(p), 9)) for asin, p in seen.items())
    for skew in (ALWAYS, Skew()):
        found = attach_neighbour_price(items, skew=skew)
        assert found.count() == 900
        assert rows(found.select("asin", F.round("meanPriceAlsoViewed", 9)).distinct(), "asin") == expected

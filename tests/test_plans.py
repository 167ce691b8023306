"""What the plans must and must not contain."""

import re

import pytest
from helpers import plan
from pyspark.sql import functions as F

from shelfwise.functions.text import space_tokens
from shelfwise.operators.attach import Skew, attach
from shelfwise.operators.embedding import vocabulary
from shelfwise.operators.rollup import attach_rating
from shelfwise.plans.queries import QUERIES
from shelfwise.sources import views
from shelfwise.sources.catalog import preview


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan(query(spark, sf_dir)) for name, query in QUERIES.items()}


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def read_columns(text):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    return {column.split(":")[0] for schema in schemas for column in re.split(r",(?=\w+:)", schema)}


def test_no_cross_join_and_no_python(plans):
    for name, text in plans.items():
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert operator not in text, (name, operator)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("rating_rollup", {"l_partkey", "l_linenumber", "l_quantity", "p_partkey"}),
        ("rating_profile", {"l_partkey", "l_linenumber", "l_quantity", "p_partkey"}),
        ("category_profile", {"p_partkey", "p_brand", "p_type", "p_size"}),
        ("neighbour_profile", {"p_partkey", "p_retailprice"}),
        ("impute_profile", {"p_partkey", "p_name", "p_retailprice"}),
        ("price_mean", {"p_partkey", "p_retailprice"}),
        ("tokens_vocabulary", {"text"}),
        ("onehot_mean", {"p_brand"}),
        ("hash_split", {"vec_id"}),
        ("rmse_metric", {"l_partkey", "l_linenumber", "l_quantity"}),
    ],
)
def test_only_needed_columns_are_read(plans, name, columns):
    assert read_columns(plans[name]) == columns


def test_lookup_is_pushed_to_the_scan(plans):
    assert "EqualTo(p_partkey,100)" in plans["price_lookup"]


def exchanges(text):
    return re.findall(r"^\(\d+\) Exchange", text, re.M)


def final_plan(df):
    """The plan that ran, once adaptive execution knew the sizes."""
    df.collect()
    whole = df._jdf.queryExecution().executedPlan().toString()
    return whole.split("\n+- == Initial Plan ==")[0]  # subqueries have initial plans of their own, further in


def shuffles(text):
    """What was shuffled in the plan that ran; a reused shuffle counts once."""
    return re.findall(r"(?<!Reused)Exchange hashpartitioning\(", text)


def test_vocabulary_combines_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["tokens_vocabulary"](spark, sf_dir))
    assert "partial_count" in text
    assert len(exchanges(text)) == 1
    assert text.count("split(") == 1  # not once more in a filter


def test_listed_tokens_are_split_once(spark, sf_dir):
    tokens = views.titles(spark, sf_dir).select(space_tokens("title").alias("words"))
    assert plan(vocabulary(tokens, "words")).count("split(") == 1


def test_ranking_limits_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["nearest_vectors"]


def test_rating_rollup_shuffles_once_per_side(spark, sf_dir, no_broadcast):
    text = final_plan(QUERIES["rating_rollup"](spark, sf_dir))
    assert "SortMergeJoin" in text
    assert len(shuffles(text)) == 2


def test_bucketed_tables_are_joined_in_place(spark, sf_dir, no_broadcast, tmp_path):
    """Tables bucketed by the key are neither shuffled to count nor to join."""
    tables = {"review": views.review(spark, sf_dir), "product": views.product(spark, sf_dir).select("asin", "title")}
    for name, df in tables.items():
        writer = df.write.bucketBy(4, "asin").sortBy("asin").mode("overwrite").option("path", f"{tmp_path}/{name}")
        writer.saveAsTable(f"bucketed_{name}")
    try:
        rated = attach_rating(spark.table("bucketed_product"), spark.table("bucketed_review"))
        assert shuffles(final_plan(rated)) == []
        assert rated.count() == tables["product"].count()
    finally:
        for name in tables:
            spark.sql(f"drop table bucketed_{name}")


def test_neighbour_profile_shuffles(spark, sf_dir, no_broadcast):
    """Edges, values, means and items by key, and one row per task at the end."""
    text = final_plan(QUERIES["neighbour_price"](spark, sf_dir))
    assert len(shuffles(text)) == 4


def initial_plan(df):
    """The plan as it is made, before adaptive execution drops or merges anything."""
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"(?:FileScan|Range \(|Scan ExistingRDD)", text)


def jobs_of(spark, group, work):
    """How many jobs ``work`` runs, and what it returns."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        result = work()
        return len(context.statusTracker().getJobIdsForGroup(group)), result
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("skew", [Skew(), Skew(rows_per_task=1)])
def test_attach_reads_each_side_once(spark, sf_dir, no_broadcast, skew):
    """Hot keys or not, the join has one scan of the table and one exchange a side, besides that of
    the lookup's own aggregate; before it, one narrow pass over the key looks for hot keys."""
    items = views.table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    lookup = items.groupBy("l_partkey").agg(F.count("*").alias("n"))
    jobs, joined = jobs_of(spark, f"attach-{skew.rows_per_task}", lambda: attach(items, lookup, "l_partkey", skew=skew))
    text = initial_plan(joined)
    assert len(scans(text)) == 2
    # the ordinary join needs the lookup's aggregate in place; spread, both sides move once more
    assert len(re.findall("Exchange hashpartitioning", text)) == (2 if skew == Skew() else 3)
    assert "LocalTableScan" in text or skew == Skew()
    assert 1 <= jobs <= 3  # one query; adaptive execution runs its stages as jobs


@pytest.mark.parametrize("name, read, moved", [("rating_rollup", 3, 2), ("neighbour_price", 6, 4)])
def test_scans_and_exchanges_of_the_initial_plan(spark, sf_dir, no_broadcast, name, read, moved):
    """Scans include those of the subquery of the product view."""
    text = initial_plan(QUERIES[name](spark, sf_dir))
    assert len(scans(text)) <= read
    assert len(re.findall("Exchange hashpartitioning", text)) == moved


def test_preview_stops_early(spark):
    assert "CollectLimit" in plan(preview(spark.range(1000), 5))

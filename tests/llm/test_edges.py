"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import pickle
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import decontaminate as module
from shelfwise.llm.decontaminate import compile_items, decontaminate
from shelfwise.llm.jaccard import jaccard_groups, keep_one_of_each_group
from shelfwise.llm.license_scan import license_scan
from shelfwise.llm.line_dedup import line_dedup
from shelfwise.llm.quality_rules import quality_rules
from shelfwise.llm.rule_classifier import fit_rules, score_documents
from shelfwise.llm.secret_scan import secret_scan
from shelfwise.llm.sentence_pieces import decode_pieces, encode_pieces
from shelfwise.llm.suffix_dedup import suffix_dedup
from shelfwise.llm.url_filter import url_filter
from shelfwise.llm.words import NON_ALNUM, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, found string"
LONG = " ".join(f"w{i % 977}x{i % 7}" for i in range(60_000))
PASSAGE = "one line that very many sites have in common, as a footer of theirs has it"
ROWS = [
    (1, None, None, None, 5, "x"),
    (2, "", "en", "a", None, None),
    (3, " \n\t ", "en", None, 1, "y"),
    (4, LONG, "en", "a", 1, "y"),
    (4, LONG, "en", "a", 1, "y"),
    (None, PASSAGE + "\nalone", "en", "b", 1, "y"),
    *[(10 + i, PASSAGE + f"\nown line {i} of a document", "de", f"s{i}", 1, "y") for i in range(6)],
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "quality": lambda d: quality_rules(d, into="n_words"),
    "lines": lambda d: line_dedup(d, n_lines="n_words"),
    "secrets": lambda d: secret_scan(d, into="found"),
    "licenses": lambda d: license_scan(d, into="found"),
    "suffixes": lambda d: suffix_dedup(d, into="found"),
    "pieces": lambda d: encode_pieces(d, ids="found"),
    "benchmark": lambda d: decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text").where("item_id = 10"), into="found"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_gets_a_result_and_other_columns_stay(docs, name):
    result = OPERATORS[name](docs)
    rows = result.collect()
    assert len(rows) == len(ROWS)
    assert {"doc_id", "text", "lang", "source", "n_words", "found"} <= set(result.columns)
    assert len(set(result.columns)) == len(result.columns)
    assert sorted(str(r["source"]) for r in rows) == sorted(str(r[3]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).collect() == []


def test_quality_of_odd_texts(docs):
    found = {r["doc_id"]: r["quality_rules"] for r in quality_rules(docs).collect()}
    for blank in (1, 2, 3):
        assert found[blank]["n_words"] == 0 and found[blank]["base_failed"] and not found[blank]["kept"]
    assert found[4]["n_words"] == 60_000


def test_lines_stay_where_they_are_first(docs):
    found = line_dedup(docs, min_sites=5).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    texts = {r["doc_id"]: (r["text"], r["n_removed"]) for r in found}
    assert texts[10] == (PASSAGE + "\nown line 0 of a document", 0)
    assert texts[11] == ("own line 1 of a document", 1)
    assert texts[None] == ("alone", 1)
    assert texts[1] == (None, 0) and texts[2] == ("", 0)


def test_lines_below_the_threshold_stay(docs):
    assert line_dedup(docs, min_sites=8).agg(F.sum("n_removed")).first()[0] == 0
    assert line_dedup(docs, min_sites=7).agg(F.sum("n_removed")).first()[0] == 6


def test_suffixes_of_odd_texts(docs):
    found = {r["doc_id"]: r["repeats"] for r in suffix_dedup(docs).collect()}
    assert found[1]["n_bytes"] == 0 and found[1]["kept"] == b""
    assert found[4]["n_removed"] == 0  # the same id is no smaller one
    assert found[None]["n_removed"] == 0
    assert found[10]["n_removed"] == 0
    own = (PASSAGE + "\nown line 1 of a document").encode()
    shared = len(PASSAGE + "\nown line ")
    assert found[11]["spans"] == [0, shared] and found[11]["kept"] == own[shared:]


def test_groups_of_odd_texts(docs):
    found = [tuple(r) for r in jaccard_groups(docs, size=3, percent=90).select("doc_id", "n_shingles", "component_id").collect()]
    for blank in (1, 2, 3):
        assert (blank, 0, blank) in found
    assert found.count((4, 6839, 4)) == 2
    kept = [r["doc_id"] for r in keep_one_of_each_group(docs).collect()]
    assert sorted(x for x in kept if x is not None) == [1, 2, 3, 4, *range(10, 16)]


def test_groups_of_an_empty_table(none):
    assert jaccard_groups(none).collect() == []
    assert keep_one_of_each_group(none).collect() == []


def test_pieces_and_back(docs):
    encoded = encode_pieces(docs).withColumnRenamed("text", "before")
    for row in decode_pieces(encoded).collect():
        assert row["before"] == row["text"]
        assert (row["piece_ids"] is None) == (row["before"] is None)


def test_empty_benchmark_and_items_without_words(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, items).where("contamination.n_hit > 0").count() == 0
    items = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "alone"), (7, "alone")], "item_id long, text string")
    hit = decontaminate(docs, items).where("contamination.n_hit > 0").collect()
    assert [(r["doc_id"], r["contamination"]["items"]) for r in hit] == [(None, ["7"])]


def test_items_in_blocks(docs, spark):
    items = spark.createDataFrame([(i, f"own line {i} of a document") for i in range(6)], "item_id long, text string")
    whole = decontaminate(docs, items, drop=("text",)).collect()
    assert sorted(decontaminate(docs, items, drop=("text",), block_bytes=30).collect(), key=repr) == sorted(whole, key=repr)


def test_repeated_items_are_collected_once(docs, spark, monkeypatch):
    once = [(i, f"own line {i} of a document") for i in range(6)]
    items = spark.createDataFrame(once + [once[0]] * 500 + [(None, "alone")] * 2, "item_id long, text string")
    sizes, compiled = [], module.compile_items
    monkeypatch.setattr(module, "compile_items", lambda some, window: sizes.append(len(some)) or compiled(some, window))
    found = decontaminate(docs, items, drop=("text",)).collect()
    assert sizes == [7]
    whole = decontaminate(docs, spark.createDataFrame(once + [(None, "alone")], items.schema), drop=("text",)).collect()
    assert sorted(found, key=repr) == sorted(whole, key=repr)
    sizes.clear()
    decontaminate(docs, items, drop=("text",), block_bytes=30).collect()
    assert len(sizes) <= 6 and sum(sizes) == 7  # 7 texts of 5 or 24 bytes


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.EXAMPLE.org/es/x?q"), (4, "http://A.EXAMPLE.org/es/x?q"), (5, "http://org"),
         (6, "http://example.org/en/12#/es/"), (7, "http://notexample.org/es/"), (None, "x://example.org/en/2")],
        "page_id long, url string",
    )
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("example.org", "/en/1", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    found = sorted((tuple(r) for r in url_filter(pages, rules).collect()), key=repr)
    assert found == sorted(
        [
            (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
            (4, "a.example.org", "/es/x", "example.org/es/", "block"), (4, "a.example.org", "/es/x", "example.org/es/", "block"),
            (5, "org", "", None, "allow"), (6, "example.org", "/en/12", "example.org/en/1", "block"),
            (7, "notexample.org", "/es/", "org/", "allow"), (None, "example.org", "/en/2", "org/", "allow"),
        ],
        key=repr,
    )
    assert url_filter(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_filter(pages, rules.limit(0)).collect()} == {"allow"}


def test_scores_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    scores = {r["score"] for r in score_documents(docs, fit_rules(docs, labels)).collect()}
    assert scores == {0.5}
    labels = spark.createDataFrame([(2, 1), (4, None), (None, 0), (10, 1)], "doc_id long, quality int")
    scored = score_documents(docs, fit_rules(docs, labels)).collect()
    assert len(scored) == len(ROWS) and all(0.5 < r["score"] < 1 for r in scored)


def test_hash_of_nothing(docs):
    found = secret_scan(docs).where("doc_id = 1").select(F.sha2(F.array_join(F.transform("secrets", lambda s: s["kind"]), ","), 256)).first()[0]
    assert found == hashlib.sha256(b"").hexdigest()


HELPERS = "a b at bucket content count first found gram group hash id key kinds label least line node of of_id of_key part parts place removed row rows" \
    " site spans spans_ of_id_ text_key whole words".split()
CLASHING = {
    **OPERATORS,
    "near duplicates": keep_one_of_each_group,
    "scores": lambda d: score_documents(d, fit_rules(d, d.select(F.col("doc_id"), (F.col("doc_id") % 2).alias("quality")))),
    "quality stage": lambda d: corpus_pipeline.quality(d.sparkSession, d, ""),
    "line stage": lambda d: corpus_pipeline.lines(d.sparkSession, d.withColumn("n_chars", F.lit(0)), "").drop("n_chars"),
    "near-duplicate stage": lambda d: corpus_pipeline.near_duplicates(d.sparkSession, d, ""),
    "piece stage": lambda d: corpus_pipeline.pieces(d.sparkSession, d, ""),
}


@pytest.mark.parametrize("name", CLASHING)
def test_columns_with_names_of_helpers_are_kept(docs, name):
    table = docs.drop("found").withColumns({h: F.concat(F.lit(h), F.col("doc_id").cast("string")) for h in HELPERS if h not in OPERATORS})
    result = CLASHING[name](table)
    assert set(table.columns) <= set(result.columns) and len(set(result.columns)) == len(result.columns)
    own = [h for h in HELPERS if h != "found"]
    rows = result.where("doc_id is not null").select("doc_id", *[f"`{h}`" for h in own]).collect()
    assert rows and all(r[h] == f"{h}{r['doc_id']}" for r in rows for h in own)


def test_a_block_of_items_is_small():
    """8 MB of different words: what is broadcast, and what compiling takes besides."""
    words = [f"w{i * 7919 % 1_000_003:x}" for i in range(1_300_000)]
    texts = [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)]
    assert sum(map(len, texts)) > 7 << 20
    tracemalloc.start()
    tables = compile_items(texts, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pickle.dumps(tables)) < 200e6 and peak < 500e6


def test_a_common_pair_of_words_costs_no_more_than_others():
    """Windows that end alike share a bucket, and a text repeats their end: still one look-up a place."""
    texts = [" ".join([*(f"x{i}y{k}" for k in range(8)), "of", "the"]) for i in range(50_000)]
    (patterns,) = compile_items(texts, 10)
    low = ("of the " * 200_000 + texts[7]).encode()
    data = np.frombuffer(low, np.uint8)
    places, numbers = patterns.search(words_of(data, np.array([0, len(data)]), NON_ALNUM), low)
    assert places.tolist() == [400_000] and patterns.owners[patterns.bounds[numbers[0]]] == 7

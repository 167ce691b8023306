"""What the near-duplicate join reads and leaves: texts are read for sets that may link only."""

import os
import random

import pytest

from shelfwise.llm import jaccard
from shelfwise.llm.jaccard import differing, jaccard_groups, keep_one_of_each_group, wide_sketch
from shelfwise.sources import shared


@pytest.fixture(scope="module")
def texts():
    """Long texts, a third of each the same in all; 5 is a near copy of 3."""
    deal = random.Random(5)
    word = lambda: "".join(deal.choices("abcdefghijklmnop", k=8))
    common = [word() for _ in range(2000)]
    found = {k: [word() for _ in range(2000)] + common + [word() for _ in range(2000)] for k in range(1, 9)}
    found[5] = [w if k % 1000 else word() for k, w in enumerate(found[3])]
    return {k: " ".join(words) for k, words in found.items()}


def test_long_sets_that_share_a_passage_are_not_compared(spark, texts, monkeypatch):
    read = []

    def spied(df, name, beside=None):
        table = shared.written(df, name, beside)
        if name == "texts":
            read.append({r["node"] for r in table.select("node").collect()})
        return table

    monkeypatch.setattr(jaccard, "written", spied)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["component_id"], r["node"]) for r in jaccard_groups(docs).collect()}
    assert {k: c for k, (c, _) in found.items()} == {k: 3 if k == 5 else k for k in texts}
    assert set.union(*read) == {found[3][1], found[5][1]}


def test_tables_that_nothing_reads_any_more_go(spark, texts):
    folder = shared._own_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in keep_one_of_each_group(docs).collect()) == [1, 2, 3, 4, 6, 7, 8]
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"sets", "components", "groups", "kept"}


def test_texts_and_pairs_in_slices_give_the_same(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "DOCS_OF_A_JOIN", 2)
    monkeypatch.setattr(jaccard, "ROWS_OF_A_JOIN", 1000)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_groups(docs).collect()}
    assert found == {k: 3 if k == 5 else k for k in texts}


def test_wide_sketches_never_differ_on_more_bits_than_the_sets():
    import numpy as np

    draw = np.random.default_rng(7)
    for most in (3, 500, 600, 5000):
        both = draw.integers(0, 1 << 63, most, dtype=np.uint64)
        for own in (0, 1, most // 4, most):
            other = draw.integers(0, 1 << 63, own, dtype=np.uint64)
            apart = differing(wide_sketch(np.unique(both)), wide_sketch(np.unique(np.concatenate([both, other]))))
            assert apart <= len(np.setdiff1d(other, both))
    alone = [np.unique(draw.integers(0, 1 << 63, 20_000, dtype=np.uint64)) for _ in range(2)]
    assert differing(*map(wide_sketch, alone)) > 40_000 * 20 / 180

"""Random small tables against plain Python, with and without spreading."""

import math
import random
from collections import Counter, defaultdict
from statistics import fmean

import pytest
from helpers import close

from shelfwise.functions.text import space_tokens
from shelfwise.operators.attach import Skew
from shelfwise.operators.embedding import nearest, vocabulary
from shelfwise.operators.impute import impute_number
from shelfwise.operators.neighbours import attach_neighbour_price
from shelfwise.operators.rollup import attach_rating

NAN = float("nan")
SKEWS = [Skew(), Skew(rows_per_task=5)]
PRODUCT = "asin string, price float, related map<string,array<string>>"


def random_products(rng, n):
    """A third share one key, and a third of the list entries are one id."""
    ids = [None] + [f"p{i}" for i in range(n // 2)]

    def some_id():
        return "p1" if rng.random() < 0.33 else rng.choice(ids)

    def some_list():
        kind = rng.random()
        if kind < 0.1:
            return None
        return {} if kind < 0.2 else {"also_viewed": [some_id() for _ in range(rng.randrange(5))]}

    return [
        (some_id(), rng.choice([None, NAN, float(rng.randrange(1, 40))]), some_list()) for _ in range(n)
    ]


def as_key(value):
    if value is None:
        return ""
    return "nan" if isinstance(value, float) and math.isnan(value) else round(value, 9)


def neighbour_means(products, skip_nan):
    prices = defaultdict(list)
    for asin, price, _ in products:
        if asin is not None and price is not None and not (skip_nan and math.isnan(price)):
            prices[asin].append(price)
    seen = defaultdict(list)
    for asin, _, related in products:
        for other in (related or {}).get("also_viewed") or []:
            seen[asin] += prices.get(other, [])
    return {asin: fmean(found) for asin, found in seen.items() if asin is not None and found}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("skip_nan", [False, True])
def test_neighbours(spark, seed, skip_nan):
    products = random_products(random.Random(seed), 120)
    means = neighbour_means(products, skip_nan)
    expected = Counter(
        (asin or "", len((related or {}).get("also_viewed") or []), as_key(means.get(asin)))
        for asin, _, related in products
    )
    items = spark.createDataFrame(products, PRODUCT)
    for skew in SKEWS:
        found = attach_neighbour_price(items, skip_nan=skip_nan, skew=skew).collect()
        assert Counter((asin or "", size or 0, as_key(mean)) for asin, size, mean in found) == expected
        assert all(size is None or size > 0 for _, size, _ in found)


@pytest.mark.parametrize("seed", range(3))
def test_ratings(spark, seed):
    rng = random.Random(seed)
    items = [("p1",) if rng.random() < 0.33 else (rng.choice([None, f"p{rng.randrange(30)}"]),) for _ in range(100)]
    ratings = [
        ("p1" if rng.random() < 0.33 else rng.choice([None, f"p{rng.randrange(40)}"]), rng.choice([None, 1.0, 4.0, 5.0]))
        for _ in range(300)
    ]
    by_item = defaultdict(list)
    for asin, rating in ratings:
        by_item[asin].append(rating)

    def expected_of(asin):
        if asin is None or asin not in by_item:
            return (asin or "", "", "")
        given = [r for r in by_item[asin] if r is not None]
        return (asin, as_key(fmean(given)) if given else "", len(given))

    expected = Counter(expected_of(asin) for (asin,) in items)
    for skew in SKEWS:
        found = attach_rating(
            spark.createDataFrame(items, "asin string"),
            spark.createDataFrame(ratings, "asin string, overall double"),
            skew=skew,
        ).collect()
        assert Counter((a or "", as_key(m), "" if c is None else c) for a, m, c in found) == expected


@pytest.mark.parametrize("seed", range(2))
def test_imputation(spark, seed):
    rng = random.Random(seed)
    prices = [rng.choice([None, "x", "NaN", str(rng.randrange(1, 50))]) for _ in range(201)]
    valid = sorted(float(p) for p in prices if p not in (None, "x", "NaN"))
    mean, median = fmean(valid), valid[math.ceil(len(valid) / 2) - 1]
    found = impute_number(spark.createDataFrame([(p,) for p in prices], "price string"))
    for price, (kept, by_mean, by_median) in zip(prices, found.collect()):
        known = price not in (None, "x", "NaN")
        assert close(by_mean, float(price) if known else mean)
        assert by_median == (float(price) if known else median)
        assert kept is None or math.isnan(kept) or kept == float(price)


def test_vocabulary(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["A", "a", "b", "", "Ça", "x.y"]) for _ in range(rng.randrange(30))) for _ in range(60)]
    expected = Counter(word for text in texts for word in text.lower().split(" "))
    found = vocabulary(spark.createDataFrame([(t,) for t in texts + [None]], "t string"), space_tokens("t"), min_count=20)
    assert {r["word"]: r["uses"] for r in found.collect()} == {w: n for w, n in expected.items() if n >= 20}


def test_nearest(spark):
    rng = random.Random(9)
    vectors = {f"w{i}": [rng.uniform(-1, 1) for _ in range(6)] for i in range(80)}

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b))

    queries = ["w3", "w70", "w41"]
    table = spark.createDataFrame(list(vectors.items()), "word string, vector array<double>")
    found = nearest(table.repartition(5), queries, 7).collect()
    for query in queries:
        ranked = sorted((-cosine(vectors[query], v), w) for w, v in vectors.items() if w != query)[:7]
        ours = sorted((r["rank"], r["word"], r["similarity"]) for r in found if r["query"] == query)
        assert [(rank, word) for rank, word, _ in ours] == [(i + 1, w) for i, (_, w) in enumerate(ranked)]
        assert all(close(s, -negative) for (_, _, s), (negative, _) in zip(ours, ranked))

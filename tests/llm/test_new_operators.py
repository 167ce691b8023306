"""Whitening, the audit of filters and SimHash groups against plain Python."""

from decimal import Decimal
from itertools import permutations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import simhash
from shelfwise.llm.bidiagonal_qd import bidiagonal, singular, squares_by_dqds
from shelfwise.llm.filter_audit import filter_audit, removal_ranks, text_failures, with_labels
from shelfwise.llm.queries import op11_embedding_whitening, op13_simhash_dedup
from shelfwise.llm.simhash import fingerprint, links, simhash_groups
from shelfwise.llm.whitening import whiten

WHITE = " \t\n\x0b\x0c\r"


# -- SimHash


def words_by_hand(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out = [""]
    for c in low:
        if c in WHITE:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def fingerprint_by_hand(text, size=3):
    words = words_by_hand(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints):
    """Least id by links, for (id, fingerprint) pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(prints):
        for j, (_, y) in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(prints))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\t\n\x85 ß.", max_size=60))
def test_fingerprint(text):
    assert fingerprint(text.encode()) == fingerprint_by_hand(text)


def test_fingerprint_of_a_long_text_and_of_spark_hashes(spark):
    text = " ".join(f"w{i * i % 977}" for i in range(90_000))
    assert fingerprint(text.encode()) == fingerprint_by_hand(text)
    assert spark.sql("select xxhash64('one two three')").first()[0] % 2**64 == fingerprint(b"One  two\tthree")


def test_simhash_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], fingerprint_by_hand(r["text"])) for r in docs]
    expected = sorted(zip([p[0] for p in prints], [f"{p[1]:016x}" for p in prints], groups_by_hand(prints), strict=True))
    assert sorted(tuple(r) for r in op13_simhash_dedup(spark, sf_dir).collect()) == expected


def signed(x):
    return x - 2**64 if x >> 63 else x


@pytest.mark.parametrize("crowded", [0, 3, 64])
def test_links_of_close_and_crowded_fingerprints(spark, crowded):
    """Every pair up to two bits apart is connected, whichever way a bucket is matched, and no other pair."""
    draw = np.random.default_rng(3)
    centres = [int(x) for x in draw.integers(0, 2**64, 12, np.uint64)]
    nodes = set(centres)
    for centre in centres:
        for _ in range(25):
            near = centre
            for bit in draw.integers(0, 64, draw.integers(1, 6)):
                near ^= 1 << int(bit)
            nodes.add(near)
    nodes |= {7 << 32 | i for i in range(120)}  # many share blocks
    nodes = sorted(nodes)
    found = links(spark.createDataFrame([(signed(x),) for x in nodes], "node long"), crowded).collect()
    assert all(0 < ((r["a"] ^ r["b"]) % 2**64).bit_count() <= 2 for r in found)
    parent = {signed(x): signed(x) for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        parent[root(r["a"])] = root(r["b"])
    by_hand = groups_by_hand([(i, x) for i, x in enumerate(nodes)])
    together = {}
    for x, group in zip(nodes, by_hand, strict=True):
        together.setdefault(group, set()).add(root(signed(x)))
    assert all(len(roots) == 1 for roots in together.values())
    assert len(set().union(*together.values())) == len(together)


def test_simhash_groups_of_odd_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (9, " \n", 3), (4, "One two", 4), (7, "one\ttwo", 5), (7, "one two", 6), (None, "one two", 7),
            (None, "alone in the world", 8), (8, "w " * 40_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long").withColumn("component", F.lit("x")).withColumn("bucket", F.lit(0))
    found = sorted((tuple(r) for r in simhash_groups(docs).collect()), key=repr)
    pair = signed(fingerprint_by_hand("one two"))
    alone, long = signed(fingerprint_by_hand("alone in the world")), signed(fingerprint_by_hand("w " * 5))
    assert found == sorted(
        [(5, 0, 3), (3, 0, 3), (9, 0, 3), (4, pair, 4), (7, pair, 4), (7, pair, 4), (None, pair, 4), (None, alone, None), (8, long, 8)], key=repr
    )
    assert simhash_groups(docs.limit(0)).collect() == []


def test_simhash_of_many_copies(spark):
    """A third of the rows are one text: one node, one group."""
    docs = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a b c d").otherwise(F.concat(F.lit("t "), F.md5(F.col("id").cast("string")))).alias("text"))
    found = simhash_groups(docs).groupBy("component_id").count().orderBy(F.desc("count")).first()
    assert (found["component_id"], found["count"]) == (0, 1000)


def test_blocks_are_keys_of_two(spark):
    one = spark.createDataFrame([(5,)], "node long").select(simhash.block_keys(F.col("node")).alias("k")).first()["k"]
    assert len(set(one)) == 6


# -- filters


def audit_by_hand(docs, labels):
    """docs: (id, part, text); labels: (id, quality, toxic)."""
    good, toxic = ({i for i, *flags in labels if i is not None and flags[k] == 1} for k in (0, 1))
    judged = []
    for key, part, text in docs:
        text = text or ""
        words = [w for w in "".join(" " if c in WHITE else c for c in text).split(" ") if w]
        judged.append((part or "", key, {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": key is not None and any(k is not None and k < key and (t or "") == text for k, _, t in docs),
        }))
    out = []
    for part in {j[0] for j in judged}:
        own = [(key, fails) for p, key, fails in judged if p == part]
        shapley, rows = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, name in enumerate(order, 1):
                removed = [x for x in left if x[1][name]]
                redundant = sum(x[1][name] for x in gone)
                left = [x for x in left if not x[1][name]]
                gone = gone + removed
                shapley[name] += len(removed)
                unique = sum(x[1][name] and sum(x[1].values()) == 1 for x in own)
                rows.append([part, "".join(order), step, len(left), len(removed), redundant, unique,
                             sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed), name])
        out += [(*row[:-1], shapley[row[-1]]) for row in rows]
    return sorted(out)


ODD_DOCS = [
    (1, "en", "Word " * 5), (2, "en", "Word " * 5), (2, "en", "Word " * 5), (3, "de", "Word " * 5), (4, None, None), (5, "", ""), (None, "en", "Word " * 5),
    (6, "en", " ".join(f"w{i}" for i in range(120))), (7, "en", "#" + " ".join(f"w{i}" for i in range(120))), (8, "en", "AB\tC | d\x85e"),
    (9, "en", " ".join(f"w{i % 977}" for i in range(60_000))), (10, "fr", "ÀÉ ÀÉ"), (11, "en", "a" * 500_000),
]
ODD_LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (None, 1, 1), (99, 1, 1), (7, 1, 0), (9, 0, 1)]


def audit(docs, labels):
    wanted = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    failures = with_labels(text_failures(docs, keep={"part": "lang"}), labels, "doc_id", wanted)
    columns = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return filter_audit(failures, list("ABCDE"), "part", list(wanted)).select(*columns)


def test_audit_of_odd_texts(spark):
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, lang string, text string")
    clashing = docs.withColumns({"A": F.lit(1), "words": F.lit("x"), "content": F.lit("x"), "mask": F.lit(0), "n": F.lit(0), "least": F.lit(0)})
    labels = spark.createDataFrame(ODD_LABELS, "doc_id long, quality int, toxic int").withColumn("good", F.lit(1))
    expected = audit_by_hand(ODD_DOCS, ODD_LABELS)
    assert sorted(tuple(r) for r in audit(docs, labels).collect()) == expected
    assert sorted(tuple(r) for r in audit(clashing, labels).collect()) == expected
    assert audit(docs.limit(0), labels).collect() == []
    assert len(audit(docs, labels.limit(0)).collect()) == len(expected)


def test_audit_of_a_hot_text(spark):
    docs = spark.range(0, 3000, 1, 6).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    flags = text_failures(docs, keep={"part": "lang"})
    assert flags.where("E").count() == 999 and flags.where("E and doc_id = 0").count() == 0


def test_removal_ranks():
    fails = np.array([[False, False], [True, False], [False, True], [True, True]])
    positions = np.array([[1, 2], [2, 1]])
    assert removal_ranks(fails, positions).tolist() == [[np.inf, np.inf], [1, 2], [2, 1], [1, 1]]


def test_number_of_filters(spark):
    flags = spark.createDataFrame([("x", True, None, 2), ("x", False, True, 3)], "p string, one boolean, two boolean, w int")
    found = sorted(tuple(r) for r in filter_audit(flags, ["one", "two"], "p", ["w"]).collect())
    assert found == [
        ("x", "onetwo", 1, "one", 1, 1, 0, 1, 2, 2), ("x", "onetwo", 2, "two", 0, 1, 0, 1, 3, 2),
        ("x", "twoone", 1, "two", 1, 1, 0, 1, 3, 2), ("x", "twoone", 2, "one", 0, 1, 0, 1, 2, 2),
    ]
    with pytest.raises(ValueError):
        filter_audit(flags, list("abcdefgh"), "p")


# -- whitening


def check_whitening(rows, vectors, components=8):
    """rows: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    sound = [(i, np.array(v, float)) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([np.floor(v * 1024) + 100_000 for _, v in sound])
    n, centred = len(x), x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    total = [sum(int(c) for c in column) for column in x.T]
    deviations = [sum((n * int(c) - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    assert sorted((r[0], r[1]) for r in rows) == sorted((i, c + 1) for i, _ in sound for c in range(k))
    by_id = {}
    for (i, _), d, row in zip(sound, deviations, centred, strict=True):
        by_id.setdefault(i, []).append((d, row))
    table = np.zeros((n, k))
    order = {i: j for j, (i, _) in enumerate(sound)}
    assert len(order) == n, "give unique ids"
    for i, component, count, deviation, whitened, explained, error in rows:
        assert count == n and Decimal(deviation) == by_id[i][0][0] and error <= 1e-4
        assert abs(explained - values[component - 1] / values.sum()) <= 1e-9 * explained
        table[order[i], component - 1] = whitened
    assert np.abs(table.T @ table / n - np.eye(k)).max() < 1e-9
    for c in range(k):
        gaps = [abs(values[c] - values[o]) / values[c] for o in (c - 1, c + 1) if 0 <= o < len(values)]
        if all(g > 1e-6 for g in gaps):
            expected = centred @ axes[:, c] / np.sqrt(values[c])
            assert min(np.abs(table[:, c] - expected).max(), np.abs(table[:, c] + expected).max()) < 1e-6


def flat(df):
    return [(r[0], *r[1]) for r in df.collect()]


def test_whitening_query(spark, sf_dir):
    vectors = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    columns = "vec_id component n deviation whitened explained identity_error".split()
    check_whitening([tuple(r) for r in op11_embedding_whitening(spark, sf_dir).select(*columns).collect()], vectors)


def test_whitening_of_odd_vectors(spark):
    draw = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in draw.standard_normal(5) * [3, 3, 1, 1, 0]]) for i in range(200)]
    vectors += [(1000, None), (1001, [1.0, None, 2.0, 0.0, 0.0]), (1002, [float("nan")] * 5), (1003, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    vectors += [(300 + i, vectors[i][1]) for i in range(50)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns({"x": F.lit(1), "v": F.lit("a"), "id": F.lit(0), "component": F.lit(0)})
    check_whitening(flat(whiten(table)), vectors)
    check_whitening(flat(whiten(table, components=2)), vectors, 2)
    repeated = whiten(table.unionByName(table.where("vec_id = 300"))).where("vec_id = 300")
    assert repeated.count() == 8


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_whitening_without_variance(spark, vectors):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = whiten(table)
    assert found.collect() == [] and found.columns == ["vec_id", "whitening"]


def test_whitening_where_deviations_outgrow_64_bits(spark):
    vectors = [(i, [float((-1) ** i * 1e6), float(i * 1000)]) for i in range(40)]
    check_whitening(flat(whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))), vectors)


@pytest.mark.parametrize("vectors", [[(1, [1.0]), (2, [1.0, 2.0])], [(1, [1e300]), (2, [0.0])]])
def test_whitening_of_what_has_no_covariance(spark, vectors):
    with pytest.raises(Exception, match="widths|too large"):
        whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("name", ["gauss", "ties", "graded", "close", "rank", "wilkinson", "repeated"])
def test_singular_values_and_vectors(name):
    draw = np.random.default_rng(11)
    q, w = np.linalg.qr(draw.standard_normal((100, 30)))[0], np.linalg.qr(draw.standard_normal((30, 30)))[0]
    few = draw.standard_normal((500, 4))
    matrix = {
        "gauss": draw.standard_normal((500, 64)),
        "ties": q @ np.diag([5.0] * 10 + [1.0] * 20) @ w.T,
        "graded": q @ np.diag([10.0**-i for i in range(30)]) @ w.T,
        "close": q @ np.diag([5 + 1e-9 * i for i in range(10)] + [4.999] * 5 + [1e-8] * 15) @ w.T,
        "rank": draw.standard_normal((5, 30)),
        "wilkinson": np.linalg.cholesky(np.diag(np.abs(np.arange(10, -11, -1)) + 5.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
        "repeated": np.hstack([few, few, few]),
    }[name]
    r = np.linalg.qr(matrix, mode="r")
    r = np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])
    expected = np.linalg.svd(matrix, compute_uv=False) ** 2
    squares = squares_by_dqds(*bidiagonal(r)[:2])
    assert np.abs(squares[: len(expected)] - expected).max() < 1e-13 * expected[0]
    values, v, total = singular(r, 8)
    assert len(values) == min(8, {"rank": 5, "repeated": 4}.get(name, 8))
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix.T @ (matrix @ v) - v * values).max() < 1e-12 * expected[0]
    assert abs(total - expected.sum()) < 1e-12 * total


def test_small_bidiagonal_values_are_accurate():
    """dqds keeps relative accuracy where forming B'B would lose all digits."""
    diagonal, upper = np.array([1.0, 1e-6, 1e-12]), np.array([1.0, 1e-6])
    product = float(np.prod(diagonal)) ** 2
    assert abs(np.prod(squares_by_dqds(diagonal, upper)) / product - 1) < 1e-13

"""Jaccard join of documents on word shingles by XOR parity sketches.

**Sketch.** The hash of each shingle of a set is XORed into one place of a sketch.
A place on which two sketches differ was touched by a shingle that only one set
has, so the number of differing places (the Hamming distance) never exceeds the
symmetric difference. Places are single bits in the short sketch, and blocks of 64
bits in the sketch that is joined. The wide sketch has one to two bits for each shingle of the set.

**Pigeonhole.** Sets of a and b shingles that share at least P % of their union
differ in at most ``(100 - P) * (a + b) / (100 + P)`` shingles, so in at most as many
blocks. A set with more blocks than that which are not zero shares one of these with each
partner. Zero blocks, which unlike sets have in common, are therefore left out, except by the few
sets whose other blocks are too few for this. The number of blocks
depends on the sizes, so sets are joined per size band: band g holds sizes of its
own and of the band below, wide enough that partners always meet in the band of
the larger one. It is just large enough that hardly any set needs its zero blocks.

**Pairs.** In each block bucket the sets are paired with the least one of the
bucket, short sketches reject pairs, and so do wide ones, as short ones are full for sets of more than some
thousand shingles. The rest are compared shingle by shingle, which reads the texts of these sets only. Sets that are linked by then need no more comparing with each other. Buckets that
still hold several components pair their members with a hub, the one that is in the most such buckets:
near copies that are far from each other are all close to what they were made from. Only
buckets that hold several components after that pair members of different
components. No link between different components can be lost, and a bucket of n
alike sets costs n comparisons.

Blocks are dealt with in slices, one after the other, and so are texts and the pairs that meet wide sketches,
which bounds the disk that they need at a time. Nothing else depends on the number of slices. Tables that
nothing will read any more go at once.

Equal sets (such as exact copies) are one node throughout. Nodes and shingles are
64-bit hashes.

Defined results: a null, empty or blank text has no shingles, no node, and its own id as
component; a text of fewer words than a shingle is one shingle; texts are read whole; repeated
rows are a row each; a null id is never the smallest unless nothing else is in the
component; two different texts with one id are two documents; an empty table gives an
empty table; of the input only ``id`` and ``text`` are looked at, so other columns may have any
name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.shipping import ship
from shelfwise.llm.words import LOWER, WHITE, Words, mix, runs, words_of
from shelfwise.functions.names import unused
from shelfwise.operators.attach import attach, hot_keys
from shelfwise.sources.shared import dropped, written

SHINGLE = 5
PERCENT = 80
SLICES = 4
#: Rows of buckets, and documents, that are worth a slice of their own in a join.
ROWS_OF_A_JOIN, DOCS_OF_A_JOIN = 2_000_000, 10_000
#: Rounds in which the members of a bucket are paired with its hub.
HUB_ROUNDS = 1
#: 64-bit words of the short sketch of a set.
SHORT = 8
_U = np.uint64
_PER_BATCH = 1 << 18


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles, sorted; all words of a text of fewer
    than ``size`` words are one shingle."""
    hashes, whole = words.windows(size)
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if last - first >= size:
            found = np.sort(hashes[first : last - size + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif last > first:
            total = _U(last - first)
            for h in words.hashes[first:last]:
                total = mix(np.array([total ^ h], np.uint64) * _U(0x9E3779B97F4A7C15))[0]
            yield np.array([total], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def most_different(total: int, percent: int) -> int:
    """The largest symmetric difference of linked sets with ``total`` shingles together."""
    return (100 - percent) * total // (100 + percent)


@lru_cache(4096)
def bands(percent: int, size: int) -> tuple[tuple[int, int, int], ...]:
    """The two bands of a set, each with its number of blocks and how many of them can differ."""
    least, band, following = 1, 0, 100 // percent + 1
    below = 1
    while following <= size:
        below, least, band, following = least, following, band + 1, 100 * following // percent + 1
    beyond = 100 * following // percent + 1
    out = []
    for number, smallest, end in ((band, below, following), (band + 1, least, beyond)):
        differ = most_different(2 * (end - 1), percent)
        out.append((number, _blocks(smallest, differ), differ))
    return tuple(out)


@lru_cache(4096)
def _blocks(smallest: int, differ: int) -> int:
    """So many blocks that, of sets of ``smallest`` shingles, nearly all have more than ``differ`` that are not zero."""
    blocks = differ + 1
    while blocks < 4 * differ:
        empty = blocks * math.exp(-smallest / blocks)
        if blocks - empty - 2.5 * math.sqrt(empty) > differ:
            break
        blocks += 1
    return blocks


def node_of(shingles: np.ndarray) -> int:
    total = np.add.reduce(mix(shingles + _U(1))) + _U(len(shingles))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The bits of the sketch: how often each was flipped, modulo 2."""
    spots = (mix(shingles ^ _U(0x5851F42D4C957F2D)) >> _U(32)) * _U(bits) >> _U(32)
    return np.bincount(spots.astype(np.int64), minlength=bits).astype(np.uint8) & 1


def packed(sketch: np.ndarray) -> np.ndarray:
    return np.packbits(sketch).view(np.uint64)


def wide_sketch(shingles: np.ndarray) -> bytes:
    """A parity sketch of as many bits as the least power of 2 that is not below the number of shingles."""
    bits = max(64 * SHORT, 1 << (len(shingles) - 1).bit_length())
    spots = mix(shingles ^ _U(0xD6E8FEB86659FD93)) & _U(bits - 1)
    return np.packbits(np.bincount(spots.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """On how many bits two wide sketches differ, the larger one folded to the bits of the smaller."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def buckets(shingles: np.ndarray, percent: int) -> np.ndarray:
    """A key for each block of the sorted set that is not zero, in the band of its size and the
    next; for zero blocks too where the others are too few."""
    until = np.concatenate([[_U(0)], np.bitwise_xor.accumulate(shingles)])
    out = []
    for band, blocks, differ in bands(percent, len(shingles)):
        places = (shingles >> _U(32)) * _U(blocks) >> _U(32)
        edges = np.searchsorted(places, np.arange(blocks + 1, dtype=np.uint64))
        keys = until[edges[1:]] ^ until[edges[:-1]]
        names = np.arange(blocks, dtype=np.uint64) * _U(0xD1342543DE82EF95) + _U(band + 1)
        some = keys != 0
        if some.sum() <= differ:
            some[:] = True
        out.append(mix(keys[some] ^ mix(names[some])))
    return np.concatenate(out)


def _texts(batch: pa.RecordBatch, name: str, size: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in runs(batch.column(batch.schema.names.index(name))):
        yield from shingle_sets(words_of(LOWER[data], offsets, WHITE), size)


def _describe(size: int):
    """Per text: number of shingles, node, wide and short sketch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, wide, sketches = [], [], [], []
            for shingles in _texts(batch, "text", size):
                counts.append(len(shingles))
                nodes.append(node_of(shingles) if len(shingles) else None)
                wide.append(wide_sketch(shingles) if len(shingles) else None)
                sketches.append(packed(parity(shingles, 64 * SHORT)).view(np.int64))
            table = np.array(sketches, np.int64).reshape(-1, SHORT)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(wide, pa.binary()),
                    *[pa.array(np.ascontiguousarray(table[:, k])) for k in range(SHORT)],
                ],
                names=["id", "key", "n", "node", "wide", *[f"s{k}" for k in range(SHORT)]],
            )

    return describe


def _emit(size: int, percent: int, part: int, parts: int):
    """Bucket and node, for each block of each text whose bucket is in a slice."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(keys, nodes):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.repeat(np.array(nodes, np.int64), [len(k) for k in keys])),
                ],
                names=["bucket", "node"],
            )

        for batch in batches:
            keys, nodes, held, seen = [], [], 0, set()
            for shingles in _texts(batch, "text", size):
                if not len(shingles) or (node := node_of(shingles)) in seen:
                    continue
                seen.add(node)
                found = buckets(shingles, percent)
                keys.append(found[found % _U(parts) == part])
                nodes.append(node)
                held += len(keys[-1])
                if held >= _PER_BATCH:
                    yield batch_of(keys, nodes)
                    keys, nodes, held = [], [], 0
            if keys:
                yield batch_of(keys, nodes)

    return emit


def _close(percent: int):
    """The pairs whose wide sketches leave a link possible."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.names.index(c)) for c in ("x_wide", "y_wide")]
            apart = [differing(x.as_py(), y.as_py()) for x, y in zip(*columns, strict=True)]
            together = sum(batch.column(batch.schema.names.index(c)).to_numpy() for c in ("x_n", "y_n"))
            yield batch.select(["a", "b"]).filter(pa.array(np.array(apart, np.int64) * (100 + percent) <= (100 - percent) * together, pa.bool_()))

    return close


def _compare(size: int, percent: int):
    """The pairs whose texts share enough shingles."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, last, kept = [], None, None
            lefts = batch.column(batch.schema.names.index("a_text"))
            rights = iter(_texts(batch, "b_text", size))
            for left, right in zip(lefts, rights, strict=True):
                if last is None or left.as_py() != last:
                    last = left.as_py()
                    one = pa.RecordBatch.from_arrays([pa.array([last])], names=["text"])
                    kept = next(iter(_texts(one, "text", size)))
                both = len(np.intersect1d(kept, right, assume_unique=True))
                linked.append(100 * both >= percent * (len(kept) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return compare


def _near(percent: int) -> Column:
    """Whether the sizes and short sketches of a pair, x_ and y_, leave a link possible."""
    apart = [F.bit_count(F.col(f"x_s{k}").bitwiseXOR(F.col(f"y_s{k}"))) for k in range(SHORT)]
    sizes = F.least("x_n", "y_n") * 100 >= percent * F.greatest("x_n", "y_n")
    return sizes & (reduce(Column.__add__, apart) * (100 + percent) <= (100 - percent) * (F.col("x_n") + F.col("y_n")))


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def jaccard_groups(
    docs: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    slices: int = SLICES,
) -> DataFrame:
    """One row per document: ``id``, ``text_key``, ``n_shingles``, ``node`` and
    ``component_id``, the smallest id reachable by links. ``text_key`` is the
    xxhash64 of the text (null for null), to join the rows of a repeated id.

    Two documents link when their sets of ``size``-word shingles share at least
    ``percent`` % of their union. Words are separated by ASCII white space; A-Z
    count as lower case.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    source = source.withColumn("key", F.when(F.col("text").isNotNull(), F.col("key")))
    kind = source.schema["id"].dataType.simpleString()
    shape = f"id {kind}, key long, n long, node long, wide binary, " + ", ".join(f"s{k} long" for k in range(SHORT))
    sets = written(source.mapInArrow(_describe(size), shape), "sets")
    text_slices = max(1, min(slices, sets.count() // DOCS_OF_A_JOIN))

    shared = None
    for part in range(slices):
        members = written(source.select("text").mapInArrow(_emit(size, percent, part, slices), "bucket long, node long"), "members")
        joins = max(1, min(slices, members.count() // ROWS_OF_A_JOIN))
        for join in range(joins):
            some = members.where(F.pmod(F.shiftright("bucket", 8), F.lit(joins)) == join)
            ends = some.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))  # combined before the shuffle
            met = attach(some, ends.where("least < most").select("bucket", "least"), "bucket", "inner").distinct()
            shared = written(met, "buckets", beside=shared)
        dropped(members)

    nodes = sets.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "key")).alias("of"), *[F.first(c).alias(c) for c in ("n", *(f"s{k}" for k in range(SHORT)))]
    )
    crowded = shared.select("node").distinct()
    sketches = written(nodes.join(crowded, "node", "left_semi"), "sketches")
    wide = written(sets.join(sketches.select("node"), "node", "left_semi").select("node", "n", "wide").dropDuplicates(["node"]), "wide")
    n_nodes = max(1, sketches.count())

    def close(pairs: DataFrame) -> DataFrame:
        """Of written pairs those whose wide sketches leave a link possible, written. There can be many more pairs
        than nodes, so they are dealt with in slices of as many as there are nodes."""
        x, y = _named(wide, "x_").withColumnRenamed("x_node", "a"), _named(wide, "y_").withColumnRenamed("y_node", "b")
        found, parts = None, max(1, -(-pairs.count() // n_nodes))
        for part in range(parts):
            some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part)
            met = attach(attach(some, x, "a", "inner"), y, "b", "inner", hot=hot_keys(some, "b"))
            found = written(met.mapInArrow(_close(percent), "a long, b long"), "close", beside=found)
        dropped(pairs)
        return found

    def texts_of(pairs: DataFrame) -> DataFrame:
        """The texts of all nodes of pairs, written."""
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        of = written(sketches.join(wanted, "node", "left_semi").select(F.col("of.key").alias("of_key"), F.col("of.id").alias("of_id"), "node"), "wanted")
        texts = None
        for part in range(text_slices):
            rows = source.where(F.pmod("key", F.lit(text_slices)) == part).join(
                of.where(F.pmod("of_key", F.lit(text_slices)) == part).hint("merge"),
                F.col("key").eqNullSafe(F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id")),
            )
            texts = written(rows.select("node", "text").dropDuplicates(["node"]), "texts", beside=texts)
        dropped(of)
        return texts

    def linked(pairs: DataFrame) -> DataFrame:
        """Of written pairs (a, b) of nodes those that link, written."""
        some = close(pairs)
        if some.isEmpty():
            return some
        texts = texts_of(some)
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
        with_texts = attach(some.join(b, "b"), a, "a", "inner", hot=hot_keys(some, "a")).select("a", "b", "a_text", "b_text")
        links = written(with_texts.mapInArrow(_compare(size, percent), "a long, b long"), "links")
        for table in (texts, some):
            dropped(table)
        return links

    def possible(pairs: DataFrame) -> DataFrame:
        """Of written pairs those whose short sketches leave a link possible, written. One node can
        be in very many pairs."""
        x, y = _named(sketches.drop("of"), "x_").withColumnRenamed("x_node", "a"), _named(sketches.drop("of"), "y_").withColumnRenamed("y_node", "b")
        met = attach(attach(pairs, x, "a", "inner"), y, "b", "inner", hot=hot_keys(pairs, "b"))
        found = written(met.where(_near(percent)).select("a", "b"), "possible")
        dropped(pairs)
        return found

    first = linked(possible(written(shared.where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), "pairs")))

    def mixed(links: DataFrame) -> DataFrame:
        """The members, with sketches, of buckets that hold several components, written."""
        of = components(links)
        placed = shared.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
        several = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        found = written(placed.join(several.select("bucket"), "bucket", "left_semi").join(sketches.drop("of"), "node"), "rest")
        dropped(of)
        return found

    rest, links = mixed(first), [first]
    for _ in range(HUB_ROUNDS):
        degrees = rest.groupBy("node").agg(F.count("*").alias("degree"))
        hubs = rest.select("bucket", "node").join(degrees, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("top"))
        spokes = attach(rest.select("bucket", "node"), hubs.select("bucket", F.col("top.node").alias("hub")), "bucket", "inner")
        pairs = spokes.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        links.append(linked(possible(written(pairs.distinct(), "pairs"))))
        dropped(rest)
        rest = mixed(reduce(DataFrame.unionByName, links))
    dropped(shared)
    met = _named(rest, "x_").join(
        _named(rest, "y_"),
        (F.col("x_bucket") == F.col("y_bucket"))
        & (F.col("x_node") < F.col("y_node"))
        & (F.col("x_component") != F.col("y_component"))
        & (F.col("x_node") != F.col("x_least"))
        & _near(percent),
    )
    second = written(met.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct(), "second")
    dropped(rest)
    links.append(linked(second))
    final = components(reduce(DataFrame.unionByName, links))
    for table in (sketches, wide, *links):
        dropped(table)

    placed = attach(sets.select("id", "key", "n", "node"), final, "node").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.where("node is not null").groupBy("component").agg(F.min("id").alias("smallest"))
    return attach(placed, smallest, "component").select(
        F.col("id").alias(id),
        F.col("key").alias("text_key"),
        F.col("n").alias("n_shingles"),
        "node",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"),
    )


def keep_one_of_each_group(
    docs: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """The documents without shingles, and of each component of ``jaccard_groups`` the
    one with the smallest id. Rows of one id and text, too, are one document; of two
    texts with the smallest id, that with the smaller hash stays. All columns are kept, whatever
    their names."""
    groups = written(jaccard_groups(docs, id, text, size, percent), "groups").withColumnRenamed(id, "of_id")
    of_id, of_key, rows = (unused(name, docs) for name in ("of_id", "of_key", "rows"))
    linked = groups.where("node is not null")
    kept = linked.groupBy("component_id").agg(F.min(F.struct("of_id", "text_key")).alias("kept")).select("kept.*")
    repeats = linked.groupBy(F.col("of_id").alias("id"), F.col("text_key").alias("key")).agg(F.count("*").alias("rows"))
    counted = written(
        kept.join(repeats, F.col("of_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))).select("id", "key", "rows"), "kept"
    )
    bare = groups.where("node is null").select(F.col("of_id").alias("id"), F.col("text_key").alias("key"), F.lit(1).alias("rows")).distinct()
    chosen = counted.unionByName(bare).select(F.col("id").alias(of_id), F.col("key").alias(of_key), F.col("rows").alias(rows))
    own_id, key = F.col(f"`{id}`"), F.when(F.col(f"`{text}`").isNotNull(), F.xxhash64(F.col(f"`{text}`")))
    found = docs.join(chosen, own_id.eqNullSafe(F.col(of_id)) & key.eqNullSafe(F.col(of_key))).drop(of_id, of_key)
    if counted.where("rows > 1").isEmpty():
        return found.drop(rows)
    repeated = found.where(F.col(rows) > 1).drop(rows).dropDuplicates([id, text])
    return found.where(F.col(rows) == 1).drop(rows).unionByName(repeated)

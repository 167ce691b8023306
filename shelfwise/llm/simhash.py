"""Near-duplicates by SimHash fingerprints, joined on pigeonhole blocks.

**Fingerprint.** Each shingle of a text, repeats included, is hashed to 64 bits; a
bit of the fingerprint is 1 if it is set in over half of the hashes.

**Blocks.** A fingerprint is split into four blocks of 16 bits. Two fingerprints that
differ in at most two bits agree on two blocks or more, so they share at least one
of six keys, each made of two blocks. Fingerprints are joined on these keys and the
Hamming distance of each pair is verified. Keys of 32 bits keep buckets small
where a single block of 22 bits would not.

**Crowded buckets.** Templates give many different fingerprints with equal blocks,
whose pairs would grow with the square of the bucket. Members of a bucket with over
``CROWDED`` of them are matched without pairs: each emits itself and its 64
neighbours at one bit. Two fingerprints share one of these exactly if they
differ in at most two bits, and no value has more than 65 fingerprints around it, so the
work is linear and every group is bounded. Both ways find the same links.

Equal fingerprints (such as those of exact copies) are one node throughout, and
the least id of each is found before any shuffle.

Defined results: a null, empty or blank text has the fingerprint 0, which links like any
other; a text of fewer words than a shingle is one shingle; repeated rows are a
row each; a null id is never the smallest unless nothing else is in the component; an
empty table gives an empty table; texts are read whole, however long; of the input only
``id`` and ``text`` are looked at, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from shelfwise.llm.components import components
from shelfwise.llm.shipping import ship
from shelfwise.llm.words import LOWER
from shelfwise.operators.attach import attach
from shelfwise.sources.shared import written

SHINGLE = 3
SEED = 42
BITS = 64
#: The largest number of differing bits of a link. The neighbours at one bit of
#: crowded buckets rest on it.
DISTANCE = 2
BLOCKS = 4
#: Members of a bucket up to which its pairs are compared. Results do not depend on it.
CROWDED = 64
_LOWER = LOWER.tobytes()
_CHUNK = 1 << 15


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The SimHash of a text in UTF-8. Words are separated by ASCII white space, A-Z
    count as lower case."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    size = min(size, len(words))
    total = len(words) - size + 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "<u8", total)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py() or b"", size) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "node"])

    return describe


def block_keys(node: Column) -> Column:
    """An array of the bucket of each choice of blocks; equal buckets of different
    blocks are possible but only cost a comparison."""
    width = BITS // BLOCKS
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE)):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        keys.append(F.xxhash64(F.lit(number), node.bitwiseAND(F.lit(_signed(mask)))))
    return F.array(*keys)


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def links(nodes: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints ``node`` that connect all that differ in
    at most two bits: every such pair, or in crowded buckets a star for each neighbour."""
    keyed = nodes.select("node", F.explode(F.array_distinct(block_keys(F.col("node")))).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = written(attach(keyed, sizes, "bucket", "inner"), "buckets")

    few = met.where(F.col("members") <= crowded)
    a, b = few.select("bucket", F.col("node").alias("a")), few.select("bucket", F.col("node").alias("b"))
    pairs = a.join(b, "bucket").where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)

    flips = [F.col("node").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(BITS)]
    many = met.where(F.col("members") > crowded).select("node").distinct()
    around = many.select("node", F.explode(F.array("node", *flips)).alias("value"))
    stars = around.groupBy("value").agg(F.sort_array(F.collect_set("node")).alias("nodes")).where(F.size("nodes") > 1)
    spokes = stars.select(F.col("nodes")[0].alias("a"), F.explode(F.slice("nodes", 2, BITS)).alias("b"))
    return written(pairs.select("a", "b").unionByName(spokes).distinct(), "links")


def simhash_groups(
    docs: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    size: int = SHINGLE,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per document: ``id``, ``fingerprint`` (a long) and ``component_id``, the
    smallest id reachable by links. Two documents link when their fingerprints differ in
    at most two bits."""
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    described = written(source.mapInArrow(_fingerprints(size), f"id {kind}, node long"), "fingerprints")
    nodes = written(described.groupBy("node").agg(F.min("id").alias("least")), "nodes")

    joined = components(links(nodes.select("node"), crowded))
    placed = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = written(attach(placed.select("node", "component"), smallest, "component").select("node", "component_id"), "smallest")
    return attach(described, of_node, "node").select(F.col("id").alias(id), F.col("node").alias("fingerprint"), "component_id")

"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of consecutive item words. A shift table over blocks of
two words tells how far a search position may jump; where the shift is 0 the
pattern is looked up in the bucket of that block by the hash of its words, then compared word by
word and byte by byte. Positions of many texts advance together as numpy arrays.

The items are taken in blocks of bounded size, each searched in all texts, so
that what every task holds does not grow with the benchmark. Items are held as one
text with arrays of its words, and windows are places in it: a block of 8 MB of text takes some
70 MB. A further block reads and writes the documents once more.

Defined results: null and empty texts have no words and no hits; an item without
words has no window and never occurs; items with a null id occur like others but
their id is left out of the list; an empty benchmark leaves everything clean, and an empty
table stays empty; repeated rows are judged each; texts are read whole, and what a long one
needs beyond its words is bounded. Columns of the input that have the name of the
result are replaced, all others are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shipping import ship
from shelfwise.llm.words import LOWER, NON_ALNUM, Words, mix, runs, words_of
from shelfwise.sources.shared import written

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: Slots of the shift table for each different block of two words, one byte each.
SLOTS = 4
#: Search positions of long texts are split so that all advance about equally often.
LANE = 256
#: Candidates compared at once.
CHUNK = 1 << 18
_U = np.uint64


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """A hash of each two neighbouring words."""
    return mix(hashes[:-1] * _U(0x9E3779B97F4A7C15) + hashes[1:])


class Items:
    """The lower-case words of some texts, as one text with a space between words."""

    def __init__(self, texts: list[str]):
        parts, starts, hashes, counts, at = [], [], [], [], 0
        for _, _, data, offsets in runs(pa.array(texts, pa.string())):
            lowered = LOWER[data]
            words = words_of(lowered, offsets, NON_ALNUM)
            lengths = words.ends - words.starts + 1
            begins = np.cumsum(lengths) - lengths
            inner = np.arange(lengths.sum()) - np.repeat(begins, lengths)
            joined = np.append(lowered, np.uint8(0x20))[np.repeat(words.starts, lengths) + inner]
            joined[begins + lengths - 1] = 0x20
            parts.append(joined)
            starts.append((begins + at).astype(np.int64))
            hashes.append(words.hashes)
            counts.append(words.counts)
            at += len(joined)
        none = np.zeros(0, np.int64)
        self.text = np.concatenate([np.zeros(0, np.uint8), *parts])
        self.starts = np.concatenate([none, *starts, [at]])
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.counts = np.concatenate([none, *counts])
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def window(self, word: int, length: int) -> bytes:
        return self.text[self.starts[word] : self.starts[word + length] - 1].tobytes()

    def hashes_of(self, length: int) -> np.ndarray:
        return Words(self.starts[:-1], self.starts[1:] - 1, self.hashes, self.first).windows(length)[0]


class Patterns:
    """The different windows of one length, with the tables to search for them."""

    def __init__(self, items: Items, length: int, window: int):
        self.length, self.items = length, items
        self.span = min(2, length)  # words in a block
        chosen = np.flatnonzero(np.minimum(items.counts, window) == length)
        repeats = items.counts[chosen] - length + 1
        inner = np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        places, owners = np.repeat(items.first[chosen], repeats) + inner, np.repeat(chosen, repeats)
        whole = items.hashes_of(length)[places]
        order = np.argsort(whole, kind="stable")
        places, owners, whole = places[order], owners[order], whole[order]
        same = np.concatenate([[False], whole[1:] == whole[:-1]])
        for k in range(length):
            same[1:] &= items.hashes[places[1:] + k] == items.hashes[places[:-1] + k]
        firsts = np.flatnonzero(~same)
        #: first words of the windows, their items, and where those of each window start
        self.places, self.owners, self.bounds = places[firsts].astype(np.int32), owners.astype(np.int32), np.append(firsts, len(places))
        blocks = self._blocks(items.hashes)
        across = length - self.span + 1  # blocks in a window
        self.shift = np.full(1 << max(10, int(len(np.unique(blocks)) * SLOTS - 1).bit_length()), min(across, 255), np.uint8)
        self.mask = _U(len(self.shift) - 1)
        for j in range(max(0, across - 255), across):
            np.minimum.at(self.shift, (blocks[self.places + j] & self.mask).astype(np.int64), np.uint8(across - 1 - j))
        keys = self._keys(blocks[self.places + across - 1], whole[firsts])
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]

    def _blocks(self, hashes: np.ndarray) -> np.ndarray:
        return _pairs(hashes) if self.span == 2 else hashes

    @staticmethod
    def _keys(last_block: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Within the bucket of its last block a window is found by the hash of its words."""
        return mix(last_block ^ mix(whole))

    def search(self, words: Words, low: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows found, and the numbers of their patterns."""
        m, none = self.length, np.zeros(0, np.int64)
        if len(words.hashes) < m:
            return none, none
        blocks, whole = self._blocks(words.hashes), words.windows(m)[0]
        first, stop = words.first[:-1], words.first[1:] - m + 1  # of the search positions
        lanes = np.maximum(-(-(stop - first) // LANE), 0)
        lane = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(first, lanes) + lane * LANE
        end = np.minimum(at + LANE, np.repeat(stop, lanes))
        found = []
        while len(at):
            shift = self.shift[(blocks[at + m - self.span] & self.mask).astype(np.int64)]
            found.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            going = at < end
            at, end = at[going], end[going]
        places = np.concatenate([none, *found])
        wanted = self._keys(blocks[places + m - self.span], whole[places])
        lo, hi = np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")
        some = hi > lo
        places, lo, hi = places[some], lo[some], hi[some]
        pairs = [self._compared(words, low, places[k : k + CHUNK], lo[k : k + CHUNK], hi[k : k + CHUNK]) for k in range(0, len(places), CHUNK)]
        return np.concatenate([none, *(p for p, _ in pairs)]), np.concatenate([none, *(n for _, n in pairs)])

    def _compared(self, words: Words, low: bytes, places: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, sizes = self.length, hi - lo
        places = np.repeat(places, sizes)
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        numbers = self.order[np.repeat(lo, sizes) + inner]
        for k in range(m):
            same = words.hashes[places + k] == self.items.hashes[self.places[numbers] + k]
            places, numbers = places[same], numbers[same]
        exact = np.fromiter(
            (
                b" ".join(low[s:e] for s, e in zip(words.starts[p : p + m], words.ends[p : p + m], strict=True)) == self.items.window(w, m)
                for p, w in zip(places.tolist(), self.places[numbers].tolist(), strict=True)
            ),
            bool,
            len(places),
        )
        return places[exact], numbers[exact].astype(np.int64)


def compile_items(texts: list[str], window: int) -> list[Patterns]:
    """Search tables for the windows of some texts, by window length."""
    items = Items(texts)
    lengths = np.unique(np.minimum(items.counts, window))
    return [Patterns(items, int(length), window) for length in lengths if length]


def _hits(tables: list[Patterns], words: Words, low: bytes) -> tuple[np.ndarray, list[set[int]]]:
    """Which words are hit, and the items that occur in each text."""
    edges = np.zeros(len(words.hashes) + 1, np.int64)
    found: list[set[int]] = [set() for _ in words.counts]
    for patterns in tables:
        places, numbers = patterns.search(words, low)
        np.add.at(edges, places, 1)
        np.add.at(edges, places + patterns.length, -1)
        texts = np.searchsorted(words.first, places, "right") - 1
        for text, number in set(zip(texts.tolist(), numbers.tolist(), strict=True)):
            found[text].update(patterns.owners[patterns.bounds[number] : patterns.bounds[number + 1]].tolist())
    return np.cumsum(edges[:-1]) > 0, found


def _spans(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of words that are hit, alternating."""
    return np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).tolist()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    into: str = "contamination",
    drop: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The input, without the columns ``drop``, with a struct column ``into``:
    n_words, n_hit, spans (starts and ends of the runs of hit words, alternating)
    and items (the ids, as text, of the items with occurring windows, sorted).

    A window is ``window`` consecutive words of an item, or all words of an item
    that has fewer. Words are runs of ASCII digits and letters, case apart, and
    of everything beyond ASCII.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text")).dropna(subset=["text"])
    # repeated rows of an item have one hash, so they count and are collected once
    sizes = items.groupBy(F.xxhash64("id", "text")).agg(F.max(F.octet_length("text")).alias("size"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    keep = [c for c in docs.columns if c != into]
    result = T.StructField(into, T.StructType.fromDDL("n_words long, n_hit long, spans array<int>, items array<string>"))
    found = docs.select(*[F.col(f"`{c}`") for c in keep])
    for block in range(blocks):
        chosen = [(row["id"], row["text"]) for row in items.where(part == block).distinct().collect()]
        names = [name for name, _ in chosen]
        shared = spark.sparkContext.broadcast((compile_items([t for _, t in chosen], window), names))
        last = block + 1 == blocks
        left = [c for c in keep if not (last and c in drop)]
        schema = T.StructType([docs.schema[c] for c in left] + [result])
        found = found.mapInArrow(_searcher(shared, text, into, left), schema)
        if not last:
            found = written(found, "searched")
    return found


def _searcher(shared, text: str, into: str, left: list[str]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, ids = shared.value
        kind = pa.struct(
            [("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
        )
        for batch in batches:
            names = batch.schema.names
            before = batch.column(names.index(into)).to_pylist() if into in names else None
            rows = []
            for start, _, data, offsets in runs(batch.column(names.index(text))):
                lowered = LOWER[data]
                words = words_of(lowered, offsets, NON_ALNUM)
                hit, found = _hits(tables, words, lowered.tobytes())
                counts = words.counts
                totals = np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])
                for k, owners in enumerate(found):
                    spans, items = [], sorted({ids[o] for o in owners if ids[o] is not None})
                    n_hit = int(totals[k])
                    old = before[start + k] if before else None
                    if n_hit or (old and old["n_hit"]):
                        own = hit[words.first[k] : words.first[k + 1]].copy()
                        if old:
                            for s, e in zip(old["spans"][::2], old["spans"][1::2], strict=True):
                                own[s:e] = True
                            items = sorted({*items, *old["items"]})
                        n_hit, spans = int(own.sum()), _spans(own)
                    rows.append({"n_words": int(counts[k]), "n_hit": n_hit, "spans": spans, "items": items})
            kept = [batch.column(names.index(c)) for c in left]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, kind)], names=[*left, into])

    return search

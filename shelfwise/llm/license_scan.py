"""License scans: exact phrases, and short notices with a bounded number of errors.

A notice that occurs with at most k errors holds one of its k + 1 parts unchanged.
The parts are looked up as exact seeds in the normalized text; around each seed the
bounded-error matching of the ``regex`` library verifies the notice and reports its
span and errors.

Defined results: a null text is empty; a text without words has no places, no
labels and score 0; repeated rows are scanned each; an empty table gives an empty
table. A column of the input that has the name of the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shipping import ship
from shelfwise.llm.words import LOWER, NON_ALNUM, Words, runs, words_of

#: Phrase and label.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
#: The openings of well-known notices and their labels, as words.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("subject to the terms of the mozilla public license version 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
)
#: One error per so many characters of a notice.
CHARS_PER_ERROR = 12

_SPAN = "array<struct<first_word:int,last_word:int,label:string,errors:int>>"
_RESULT = f"n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, spans {_SPAN}"


def normalized(lowered: np.ndarray, words: Words) -> tuple[bytes, np.ndarray]:
    """All words with a space after each, a line end after the last of a text; and
    where each word starts."""
    sizes = words.ends - words.starts
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    out = np.full(int((sizes + 1).sum()), ord(" "), np.uint8)
    total = int(sizes.sum())
    within = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(starts, sizes) + within] = lowered[np.repeat(words.starts, sizes) + within]
    last = words.first[1:][words.counts > 0] - 1
    out[starts[last] + sizes[last]] = ord("\n")
    return out.tobytes(), starts


def _places(flat: bytes, part: bytes) -> Iterator[int]:
    at = flat.find(part)
    while at >= 0:
        yield at
        at = flat.find(part, at + 1)


def split_seeds(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` parts of about equal length, each with its offset."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def most_errors(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_ERROR)


@lru_cache(256)
def _matcher(notice: str, errors: int):
    return regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={errors}}}")


@lru_cache(1 << 14)
def verify(notice: str, errors: int, window: str) -> tuple[int, int, int] | None:
    """Start, end and errors of the best match of the notice in the window."""
    found = _matcher(notice, errors).search(window)
    return (found.start(), found.end(), sum(found.fuzzy_counts)) if found else None


def _fuzzy(flat: bytes, starts: np.ndarray, words: Words, notices) -> list[tuple[int, int, int, str, int, int]]:
    """(text, first word, last word, label, errors, most errors) of the notices."""
    out, seen = set(), set()
    borders = np.append(starts, len(flat))[words.first]
    for notice, label in notices:
        errors = most_errors(notice)
        for offset, seed in split_seeds(notice, errors):
            for at in _places(flat, seed.encode()):
                text = int(np.searchsorted(borders, at, "right")) - 1
                # 4 bytes for each character that an error may add
                a = max(int(borders[text]), at - offset - 4 * errors)
                b = min(int(borders[text + 1]), at - offset + len(notice) + 4 * errors)
                while a > borders[text] and flat[a] & 0xC0 == 0x80:
                    a -= 1
                while b < borders[text + 1] and flat[b] & 0xC0 == 0x80:
                    b += 1
                if (notice, a, b) in seen:
                    continue
                seen.add((notice, a, b))
                window = flat[a:b].decode()
                if hit := verify(notice, errors, window):
                    first_byte = a + len(window[: hit[0]].encode())
                    last_byte = a + len(window[: hit[1]].encode()) - 1
                    first, last = np.searchsorted(starts, [first_byte, last_byte], "right") - 1 - words.first[text]
                    out.add((text, int(first), int(last), label, hit[2], errors))
    return sorted(out)


def _base(flat: bytes, starts: np.ndarray, phrases) -> list[tuple[int, str]]:
    """(word, label) of the places of whole phrases."""
    out = []
    for phrase, label in phrases:
        part = phrase.encode()
        for at in _places(flat, part):
            if (at == 0 or flat[at - 1] in b" \n") and flat[at + len(part)] in b" \n":
                out.append((int(np.searchsorted(starts, at)), label))
    return out


def license_scan(
    docs: DataFrame,
    text: str = "text",
    into: str = "licenses",
    drop: Sequence[str] = (),
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """The input, without the columns ``drop``, with a struct column ``into``:
    n_words, n_base (places where a phrase stands), first_word and last_word (of
    those), base_labels, labels (with those of the notices), score, and spans
    (first_word, last_word, label, errors) of the notices.

    The score is 1 for a phrase, 1 - errors / (most errors + 1) for the best notice,
    else 0. Words are as in the decontamination: lower-cased runs of ASCII digits and
    letters and of everything beyond ASCII.
    """
    ship(docs.sparkSession)
    left = [c for c in docs.columns if c != into and c not in drop]
    schema = T.StructType([docs.schema[c] for c in left] + [T.StructField(into, T.StructType.fromDDL(_RESULT))])
    return docs.mapInArrow(_scanner(text, into, left, tuple(phrases), tuple(notices)), schema)


def _scanner(text: str, into: str, left: list[str], phrases, notices):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("label", pa.string()), ("errors", pa.int32())])
        kind = pa.struct(
            [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
            + [("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()), ("spans", pa.list_(span))]
        )
        for batch in batches:
            names, rows = batch.schema.names, []
            for _, _, data, offsets in runs(batch.column(names.index(text))):
                lowered = LOWER[data]
                words = words_of(lowered, offsets, NON_ALNUM)
                flat, starts = normalized(lowered, words)
                own = [
                    {"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base_labels": set(), "labels": set(), "score": 0.0, "spans": []}
                    for n in words.counts
                ]
                for word, label in _base(flat, starts, phrases):
                    k = int(np.searchsorted(words.first, word, "right")) - 1
                    row, at = own[k], word - int(words.first[k])
                    row["n_base"] += 1
                    row["first_word"] = at if row["first_word"] is None else min(at, row["first_word"])
                    row["last_word"] = at if row["last_word"] is None else max(at, row["last_word"])
                    row["base_labels"].add(label)
                    row["labels"].add(label)
                    row["score"] = 1.0
                for k, first, last, label, errors, most in _fuzzy(flat, starts, words, notices):
                    own[k]["labels"].add(label)
                    own[k]["score"] = max(own[k]["score"], 1 - errors / (most + 1))
                    own[k]["spans"].append({"first_word": first, "last_word": last, "label": label, "errors": errors})
                rows += [r | {"base_labels": sorted(r["base_labels"]), "labels": sorted(r["labels"])} for r in own]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(names.index(c)) for c in left], pa.array(rows, kind)], names=[*left, into]
            )

    return scan

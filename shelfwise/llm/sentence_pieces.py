"""SentencePiece encoding and decoding of whole texts.

The model is a file of the ``sentencepiece`` library, read on the driver; its pieces
(of a fixed vocabulary) are broadcast. Texts are kept as they are: the model's own
normalization must be the identity, with a space supplied in front.

Defined results: null gives null ids and a null text; an empty text has no ids;
repeated rows are encoded each; an empty table gives an empty table. U+2581 stands
for a space in the model and is decoded as one. Columns of the input that have the
name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.piece_model import Encoder, PieceModel
from shelfwise.llm.shipping import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RUN_CHARS = 4 << 20


def _text_runs(column: pa.Array) -> Iterator[list[str | None]]:
    held: list[str | None] = []
    size = 0
    for text in column:
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= RUN_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_pieces(
    docs: DataFrame, text: str = "text", ids: str = "piece_ids", drop: tuple[str, ...] = (), model: str = MODEL, decoded: str | None = None
) -> DataFrame:
    """The input, without the columns ``drop``, with the column ``ids`` and, if a
    name is given, the texts ``decoded`` from the ids again."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(PieceModel.load(model))
    left = [c for c in docs.columns if c not in (ids, decoded, *drop)]
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded is not None:
        added.append(T.StructField(decoded, T.StringType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            names = batch.schema.names
            lists, texts = [], []
            for run in _text_runs(batch.column(names.index(text))):
                found, offsets = encoder.encode([t or "" for t in run])
                absent = pa.array([t is None for t in run])
                lists.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()), mask=absent))
                if decoded is not None:
                    back = encoder.decode(found, offsets)
                    texts += [None if t is None else b for t, b in zip(run, back, strict=True)]
            kept = [batch.column(names.index(c)) for c in left]
            kind = pa.list_(pa.int32())
            encoded = pa.concat_arrays(lists) if lists else pa.array([], kind)
            columns = [*kept, encoded] if decoded is None else [*kept, encoded, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*left, *[f.name for f in added]])

    return docs.mapInArrow(encode, T.StructType([docs.schema[c] for c in left] + added))


def decode_pieces(docs: DataFrame, ids: str = "piece_ids", text: str = "text", model: str = MODEL) -> DataFrame:
    """The input with the column ``text`` decoded from ``ids``; null gives null."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(PieceModel.load(model))
    left = [c for c in docs.columns if c != text]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            lists = [np.array(x.as_py() or [], np.int64) for x in column]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            back = encoder.decode(np.concatenate(lists) if lists else np.zeros(0, np.int64), offsets)
            texts = [b if x.is_valid else None for x, b in zip(column, back, strict=True)]
            kept = [batch.column(batch.schema.names.index(c)) for c in left]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*left, text])

    return docs.mapInArrow(decode, T.StructType([docs.schema[c] for c in left] + [T.StructField(text, T.StringType())]))

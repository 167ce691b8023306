"""A corpus pipeline of five stages, each made of one training-data operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes the
result of each to the shared folder and gives it to the next. All but the last
return the columns of ``documents``; the last adds the piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.jaccard import keep_one_of_each_group
from shelfwise.llm.line_dedup import line_dedup
from shelfwise.llm.quality_rules import quality_rules
from shelfwise.llm.sentence_pieces import encode_pieces
from shelfwise.sources.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    judged = quality_rules(docs)
    return judged.where(F.col("quality_rules.kept")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; ``n_chars`` follows the text. Every document stays."""
    cleaned = line_dedup(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return keep_one_of_each_group(docs).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, items)
    return found.where(F.col("contamination.n_hit") == 0).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the SentencePiece ids of the text, ``piece_ids``."""
    return encode_pieces(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding", pieces),
]

#: SQL cannot express the merges of the last stage; ``tests/llm`` holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.filter_audit import filter_audit, text_failures, with_labels
from shelfwise.llm.jaccard import jaccard_groups
from shelfwise.llm.license_scan import license_scan
from shelfwise.llm.line_dedup import line_dedup
from shelfwise.llm.piece_model import SPACE
from shelfwise.llm.quality_rules import quality_rules
from shelfwise.llm.rule_classifier import fit_rules, score_documents
from shelfwise.llm.secret_scan import BASE_RULES, as_text, secret_scan
from shelfwise.llm.sentence_pieces import encode_pieces
from shelfwise.llm.simhash import simhash_groups
from shelfwise.llm.suffix_dedup import suffix_dedup
from shelfwise.llm.url_filter import url_filter
from shelfwise.llm.whitening import whiten

#: Rules of op8: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit_rules(docs, labels, usable=~held_out)
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("repeats")
    return suffix_dedup(docs, drop=("text",)).select(
        "doc_id",
        found["n_bytes"].alias("n_bytes"),
        found["n_removed"].alias("n_removed"),
        (F.size(found["spans"]) / 2).cast("long").alias("n_spans"),
        F.sha2(found["kept"], 256).alias("kept_sha256"),
    )


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_pieces(docs, decoded="decoded")
    return encoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.translate("text", SPACE, " ")).alias("round_trip"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), drop=("text",))
    s = F.col("quality_rules")
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return judged.select("doc_id", *[s[c].alias(c) for c in columns])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["number"] < len(BASE_RULES))
    counts = [_of_kind(rule.kind).alias(f"n_{rule.kind}") for rule in BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("secrets")).alias("spans"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    s = F.col("licenses")
    return found.select(
        "doc_id",
        *[s[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        *[F.array_join(s[c], ",").alias(c) for c in ("base_labels", "labels")],
        s["score"].alias("score"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), size=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = F.col("contamination")
    return decontaminate(docs, benchmark, drop=("text",)).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        (found["n_hit"] > 0).alias("contaminated"),
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    s = F.col("whitening")
    columns = "component n whitened explained identity_error".split()
    return found.select("vec_id", *[s[c].alias(c) for c in columns], s["deviation"].cast("long").alias("deviation"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    wanted = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    failures = with_labels(text_failures(docs, keep={"part": "lang"}), table(spark, sf_dir, "labels"), "doc_id", wanted)
    return filter_audit(failures, list("ABCDE"), "part", list(wanted)).drop("filter")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


QUERIES = {
    "op1_rule_classifier": op1_rule_classifier,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_license_scan": op7_license_scan,
    "op8_url_filter": op8_url_filter,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontaminate": op10_decontaminate,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_simhash_dedup": op13_simhash_dedup,
}

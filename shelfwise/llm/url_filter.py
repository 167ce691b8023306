"""URL rules by hash lookup of host-suffix and path-prefix expressions.

A rule is a host and a path. It fits its host and all subdomains if the path of
the URL starts with the rule's. Of the rules that fit, the longest decides; of
equally long ones that with the longer host, then a blocking one.

Each URL is expanded into the expressions that some rule could equal: its host
suffixes with as many labels as a rule has, and its path prefixes as long as a
rule's. They meet the rules on the first 4 bytes of a SHA-256 digest, and the
full digests confirm.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no rule; repeated rows are judged each; without rules every URL gets the
default verdict; rules with a null field are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), _rest(url))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), _rest(url))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``."""
    return F.substring(url, F.locate("://", url) + 3, F.length(url))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def url_filter(
    pages: DataFrame, rules: DataFrame, page: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """Columns ``page``, host, path, rule (null if none fits) and verdict.

    ``rules`` has host, path and verdict (allow or block).
    """
    clean = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    shapes = clean.agg(
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"), F.collect_set(F.length("rule_path")).alias("lengths")
    ).first()
    keyed = clean.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS)
    )
    base = pages.select(
        F.col(f"`{page}`").alias("page"), F.col(f"`{url}`").alias("url"), url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path")
    )
    label_counts = F.array(*[F.lit(n) for n in sorted(shapes["labels"])]).cast("array<int>")
    lengths = F.array(*[F.lit(n) for n in sorted(shapes["lengths"])]).cast("array<int>")
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(label_counts, lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expanded = (
        base.where(F.col("host") != "")
        .select("page", "url", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("page", "url", "suffix", F.explode("prefixes").alias("start"))
        .withColumn("own_digest", _digest(F.col("suffix"), F.col("start")))
    )
    met = expanded.join(
        keyed, (F.substring("own_digest", 1, PREFIX_DIGITS) == F.col("prefix")) & (F.col("own_digest") == F.col("digest"))
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("long"),
        F.length("rule_host").alias("host_long"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = met.groupBy(F.col("page").alias("of"), F.col("url").alias("of_url")).agg(F.max(rank).alias("best"))
    return base.join(best, F.col("page").eqNullSafe(F.col("of")) & F.col("url").eqNullSafe(F.col("of_url")), "left").select(
        F.col("page").alias(page),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), default).when(F.col("best.blocks"), "block").otherwise("allow").alias("verdict"),
    )

"""Secret scans through a trigram index (DataFrame functions only).

From each regular expression follows a Boolean query of trigrams that any match
must contain. The postings of the trigrams asked for (trigram, document) are
intersected per document, and only candidates are searched with the expression. An
expression without mandatory trigrams is searched in every document. Documents are
keyed by a hash of the whole row, so that copies of a text do not meet in one task; a
collision could only add a candidate.

Defined results: a null text is empty; very long texts and texts of very many matches
are searched whole (see ``running_sums`` for the cost of matches); repeated rows are scanned each; an empty
table gives an empty table. A column of the input that has the name of the result
is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.trigrams import Query, trigram_query


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``, which has no ``.`` and no
    flags; those whose ``group`` is shorter than ``least`` code points are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The kinds that the scan must report, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further public formats of keys.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("service_key", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", 0, 30),
    Rule("payment_key", r"sk_live_[A-Za-z0-9]+", 0, 24),
)
RULES = BASE_RULES + MORE_RULES
#: Numbers that are summed up in one run of ``running_sums``.
RUN = 256


def postings(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram, key) of texts (key, text) for the ``trigrams`` asked for."""
    low = F.lower("text")
    present = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), t) for t in trigrams]))
    return texts.select("key", F.explode(present).alias("trigram"))


def _holds(query: Query) -> Column:
    """Whether the trigrams of a document satisfy the query."""
    contains = {t: F.array_contains("trigrams", t) for t in query.trigrams}

    def alternative(trigrams) -> Column:
        return reduce(Column.__and__, [contains[t] for t in sorted(trigrams)])

    clauses = [reduce(Column.__or__, map(alternative, sorted(clause, key=sorted))) for clause in query.clauses]
    return reduce(Column.__and__, clauses)


def candidates(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, kinds): the kinds, of rules with trigrams, that may occur in each text."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    asked = sorted({t for query in queries.values() for t in query.trigrams})
    present = postings(texts, asked).groupBy("key").agg(F.collect_set("trigram").alias("trigrams"))
    kinds = F.array_compact(F.array(*[F.when(_holds(query), kind) for kind, query in queries.items()]))
    return present.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def running_sums(numbers: Column) -> Column:
    """The sum of each number of an array of int and of all before it.

    An aggregate that appends copies its array at every step, so sums are taken in runs
    of ``RUN`` numbers, and the sums of whole runs are carried to the next ones: the
    cost is linear up to some RUN * RUN numbers.
    """
    none = F.array().cast("array<int>")

    def appended(numbers: Column) -> Column:
        return F.aggregate(numbers, none, lambda sums, x: F.concat(sums, F.array(F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0)) + x)))

    def joined(numbers: Column) -> Column:
        count = F.ceil(F.size(numbers) / RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda k: appended(F.slice(numbers, (k - 1) * RUN + 1, F.lit(RUN))))
        return _let(runs, carried)

    def carried(runs: Column) -> Column:
        totals = appended(F.transform(runs, lambda run: F.coalesce(F.get(run, F.size(run) - 1), F.lit(0))))
        before = F.concat(F.array(F.lit(0)), F.slice(totals, F.lit(1), F.size(totals) - 1))
        return F.flatten(F.zip_with(runs, before, lambda run, base: F.transform(run, lambda x: x + base)))

    return _let(numbers, joined)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Matches of one rule in a text: characters before (since the last), of the match, of the group.
_FOUND = "array<struct<gap:int,size:int,judged:int>>"


def _found(text: Column, rule: Rule) -> Column:
    """The matches of a rule, of type ``_FOUND``, in code points."""
    pattern = f"({rule.pattern})"
    gaps = F.regexp_extract_all(text, F.lit(r"\G([\s\S]*?)" + pattern), F.lit(1))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group + 1))
    sizes = F.zip_with(gaps, whole, lambda g, w: F.struct(F.length(g).alias("gap"), F.length(w).alias("size")))
    return F.zip_with(sizes, judged, lambda x, j: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), F.length(j).alias("judged")))


def _spans(rule: Column) -> Column:
    """Structs (start, number, end, kind) of a rule's (number, kind, least, found)."""
    ends = running_sums(F.transform(rule["found"], lambda x: x["gap"] + x["size"]))
    placed = F.zip_with(rule["found"], ends, lambda x, end: F.struct(x["size"].alias("size"), x["judged"].alias("judged"), end.alias("end")))
    return F.transform(
        F.filter(placed, lambda x: x["judged"] >= rule["least"]),
        lambda x: F.struct((x["end"] - x["size"]).alias("start"), rule["number"].alias("number"), x["end"].alias("end"), rule["kind"].alias("kind")),
    )


def _likely(rule: Rule) -> str:
    """The expression with its least length, where that is the length of the last run."""
    return rule.pattern[:-1] + "{%d,}" % rule.least if rule.pattern.startswith("[") and rule.pattern.endswith("]+") else rule.pattern


def secret_scan(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, into: str = "secrets") -> DataFrame:
    """The input with the column ``into``: an array of (start, number, end, kind) of
    all matches, by start, then in the order of ``rules``; code points, end exclusive."""
    left = docs.drop(into)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.xxhash64(*[f"`{f.name}`" for f in left.schema if "map<" not in f.dataType.simpleString()])
    indexed = [rule for rule in rules if trigram_query(rule.pattern).clauses]
    kinds, joined = f"{into}_kinds_", left
    if indexed:
        texts = left.select(key.alias("key"), whole.alias("text"))
        likely = candidates(texts, indexed).select(F.col("key").alias(f"{into}_of_"), F.col("kinds").alias(kinds))
        joined = left.join(likely, key == F.col(f"{into}_of_"), "left")
    none = F.array().cast(_FOUND)
    found = [
        F.when(F.array_contains(kinds, rule.kind) if rule in indexed else whole.rlike(_likely(rule)), _found(whole, rule)).otherwise(none)
        for rule in rules
    ]
    each = F.array(
        *[
            F.struct(F.lit(k).alias("number"), F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"), matches.alias("found"))
            for k, (rule, matches) in enumerate(zip(rules, found, strict=True))
        ]
    )
    spans = F.flatten(F.transform(each, _spans))
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], F.array_sort(spans).alias(into))


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

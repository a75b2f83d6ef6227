"""Secret scans with a trigram inverted index.

Each rule is a regular expression.  From its parsed form follow the trigrams that every
match must contain: an OR of alternatives, each an AND of (lower-case) trigrams.  The
corpus is indexed under all trigrams that some rule asks for, as postings (trigram,
document); a rule's alternatives intersect their postings, and only the documents that
remain are searched with the expression.  Rules without a mandatory trigram scan all
documents.

Only DataFrame operations are used.  Spans are in code points, end exclusive: the texts
between and in the matches of a rule, measured and added up, give their places.

Defined results: NULL and empty texts have no spans; very long texts are searched whole;
spans that begin at one place are listed in the order of the rules; repeated rows get equal results; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, same_row


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of one of its groups."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Base kinds first; spans with one start are listed in this order.  For access and hex
#: the least length is part of the expression: each takes whole runs, so a run that is
#: too short has no other match.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("code_host", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url_password", r"://[^\s:@/]+:[^\s:@/]+@"),
)
BASE_KINDS = ("assign", "access", "hex")

#: Alternatives of a trigram query beyond which it is not refined further.
MOST_ALTERNATIVES = 64


def _trigrams(run: str) -> frozenset[str]:
    return frozenset(run[i : i + 3] for i in range(len(run) - 2))


def _closed(states: set) -> set:
    """Every open run of literals ends here; its trigrams are mandatory."""
    return {(grams | _trigrams(run), "") for grams, run in states}


def _follow(parsed, states: set) -> set:
    """States (mandatory trigrams, open run of literals) after a parsed sequence."""
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            states = {(grams, run + chr(value).lower()) for grams, run in states}
        elif name == "IN" and len(value) <= 5 and all(str(k) == "LITERAL" for k, _ in value):
            letters = {chr(v).lower() for _, v in value}
            states = {(grams, run + c) for grams, run in states for c in letters}
        elif name == "BRANCH":
            states = set().union(*(_follow(branch, states) for branch in value[1]))
        elif name == "SUBPATTERN":
            states = _follow(value[-1], states)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, item = value
            if (low, high) == (0, 1):
                states = states | _follow(item, states)
            elif low == 0:
                states = _closed(states)
            else:
                states = _closed(_follow(item, states))
        elif name not in ("AT", "ASSERT", "ASSERT_NOT"):
            states = _closed(states)
        if len(states) > MOST_ALTERNATIVES:
            states = _closed(states)
    return states


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, one of which holds for every text with a match.

    Each is a set of lower-case trigrams that the lower-case text contains.  Empty if the
    expression has a match without mandatory trigrams.
    """
    ends = _closed(_follow(re._parser.parse(pattern), {(frozenset(), "")}))
    sets = {grams for grams, _ in ends}
    least = [s for s in sets if not any(other < s for other in sets)]
    return [] if frozenset() in sets else sorted(least, key=sorted)


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: ``trigram``, ``doc_id``, ``text_key`` for the trigrams asked for."""
    low = keyed.select("doc_id", "text_key", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams)))
    return low.select("doc_id", "text_key", F.explode_outer(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``doc_id``, ``text_key`` and ``kinds``: the rules whose trigram query the document meets.

    Each alternative counts the distinct trigrams it has met, as bits of a long.
    """
    spark = index.sparkSession
    terms = [
        (kind, number, gram, 1 << place, (1 << min(len(grams), 63)) - 1)
        for kind, alternatives in queries.items()
        for number, grams in enumerate(alternatives)
        for place, gram in enumerate(sorted(grams)[:63])  # fewer terms only admit more
    ]
    asked = spark.createDataFrame(
        terms, "kind string, alternative int, trigram string, bit long, full long"
    )
    return (
        index.join(F.broadcast(asked), "trigram")  # one row per trigram of the rules
        .groupBy("doc_id", "text_key", "kind", "alternative", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .filter("bits = full")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """All matches of a rule in a text, as structs (start, rank, end)."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.coalesce(F.char_length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        real = F.coalesce(F.char_length(x["value"]) >= rule.least, F.lit(False))
        return F.struct(
            end.alias("at"), F.when(real, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")
        )

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.aggregate(found, zero, add, lambda acc: acc["out"])


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, ``text_key`` and ``spans`` (kind, start, end) of each row of ``docs``."""
    keyed = row_key(docs)
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: q for kind, q in queries.items() if q}
    if indexed:
        grams = sorted(set().union(*(s for q in indexed.values() for s in q)))
        hits = candidates(postings(keyed, grams), indexed)
        searched = keyed.alias("d").join(hits.alias("c"), same_row("d", "c"), "left").select("d.*", "kinds")
    else:
        searched = keyed.withColumn("kinds", F.lit(None).cast("array<string>"))
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    parts = []
    for rank, rule in enumerate(rules):
        asked = F.array_contains("kinds", rule.kind) if rule.kind in indexed else text.rlike(rule.pattern)
        parts.append(F.when(asked, rule_spans(text, rule, rank)).otherwise(none))
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    return searched.select("doc_id", "text_key", F.array_sort(F.concat(*parts)).alias("found")).select(
        "doc_id",
        "text_key",
        F.transform(
            "found",
            lambda s: F.struct(
                F.element_at(kinds, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            ),
        ).alias("spans"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any secret, with all their columns."""
    bad = find(docs).filter(F.size("spans") > 0).select("doc_id", "text_key").distinct()
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    return keyed.alias("d").join(bad.alias("b"), same_row("d", "b"), "left_anti").select("row.*")

"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item, or all words of a shorter
one.  The fingerprint of a window is the least of the hashes of its ``GRAM``-word grams.
Equal windows have equal fingerprints, and a document's consecutive windows mostly share
theirs, so a document has few fingerprints (two in w + 1 words for w grams a window) and
every shared window is found.  Fingerprints of documents and items are joined; a hit is
extended to the windows around it, which count only if all their words are equal.

Only DataFrame operations are used.  Documents pass once for their word counts and once for
each window length that occurs (one, where no item is shorter than a window), without a
shuffle of texts; the sides that are broadcast come from the benchmark and are counted first.

Defined results: NULL texts have no words; items without words are ignored, items
without id mark words but are not listed; very long texts are searched whole; of windows with
equal fingerprints those with equal words count; items are listed in the order of their ids
as text; repeated rows get equal results; empty tables give no hits; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, same_row, small_join, stored

WINDOW = 13
GRAM = 6
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before that.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text; only A-Z change case."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def with_fingerprints(df: DataFrame, length: int) -> DataFrame:
    """``df`` (with ``words``) and ``prints``: the fingerprint of each window of ``length`` words."""
    gram = min(GRAM, length)
    grams = F.transform(
        "words", lambda w, i: F.xxhash64(w, *(F.get("words", i + j) for j in range(1, gram)))
    )
    starts = F.greatest(F.size("words") - (length - 1), F.lit(0))

    def least(g: Column, i: Column) -> Column:
        others = [F.get("grams", i + j) for j in range(1, length - gram + 1)]
        return F.least(g, *others) if others else g

    return (
        df.withColumn("grams", grams)
        .withColumn("prints", F.transform(F.slice("grams", 1, starts), least))
        .drop("grams")
    )


def window_text(length: int) -> Column:
    """The window at ``start``; its words contain no space."""
    return F.array_join(F.slice("words", F.col("start") + 1, F.lit(length)), " ")


def lengths_in(df: DataFrame) -> list[int]:
    """The window lengths that occur: ``WINDOW`` of them at most."""
    return sorted(r.length for r in df.select("length").distinct().collect())


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id``, ``length``, ``print`` and ``window`` of every window of every item.

    Arrays are exploded with their outer form: for the inner one Spark adds a filter on
    the array's size, which would compute the array once more for each row.
    """
    items = stored(
        benchmark.select(
            F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")
        )
        .withColumn("length", F.least(F.size("words"), F.lit(window)))
        .filter("length > 0"),
        "items",
    )
    parts = items.select("item_id", "length", F.lit(0).cast("long").alias("print"), F.lit("").alias("window")).limit(0)
    for length in lengths_in(items):
        rows = (
            with_fingerprints(items.filter(F.col("length") == length), length)
            .select("item_id", "length", "words", F.posexplode_outer("prints").alias("start", "print"))
            .select("item_id", "length", "print", window_text(length).alias("window"))
        )
        parts = parts.unionByName(rows)
    return parts.distinct()


def matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``length`` and ``window`` of every shared window.

    ``windows`` are those of ``item_windows``, stored.  ``start`` counts words from 0.
    """
    keyed = row_key(docs).select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    known = stored(windows.select("length", "window").distinct(), "windows")
    n_known = known.count()
    parts = None
    for length in lengths_in(windows) or [WINDOW]:
        prints = windows.filter(F.col("length") == length).select("print").distinct()
        hits = small_join(
            with_fingerprints(keyed, length).select(
                "doc_id", "text_key", "words", "prints", F.explode_outer(F.array_distinct("prints")).alias("print")
            ),
            prints,
            ["print"],
            prints.count(),
            F.struct("doc_id", "text_key"),
        )
        extended = hits.withColumn(
            "starts",
            F.filter(
                F.transform("prints", lambda p, i: F.when(p == F.col("print"), i)), lambda i: i.isNotNull()
            ),
        ).select("doc_id", "text_key", "words", F.explode_outer("starts").alias("start"))
        rows = small_join(
            extended.select(
                "doc_id", "text_key", "start", F.lit(length).alias("length"), window_text(length).alias("window")
            ),
            known,
            ["length", "window"],
            n_known,
            F.struct("doc_id", "text_key"),
        )
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.select("doc_id", "text_key", "start", "length", "window")


def words_hit(spans: Column) -> Column:
    """How many words sorted (start, length) spans cover."""

    def add(acc: Column, x: Column) -> Column:
        end = x["start"] + x["length"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], x["start"]))
        return F.struct(
            F.greatest(acc["end"], end).alias("end"), (acc["n"] + new.cast("long")).alias("n")
        )

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, words hit, spans, items and the verdict.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.  ``spans`` are the
    (start, length) windows in words, ``items`` the sorted ids of items that share one.
    """
    windows = stored(item_windows(benchmark), "benchmark")
    found = stored(matches(docs, windows), "matches")
    spans = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans")
    )
    of_items = windows.filter("item_id IS NOT NULL").select("window", "item_id").distinct()
    shared = found.select("doc_id", "text_key", "window").distinct()
    items = (
        small_join(shared, of_items, ["window"], of_items.count(), F.struct("doc_id", "text_key"))
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    hits = spans.alias("s").join(items.alias("i"), same_row("s", "i"), "left").select(
        "s.*", F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
    counted = row_key(docs).select(
        "doc_id",
        "text_key",
        F.coalesce(F.regexp_count("text", F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long").alias("n_words"),
    )
    joined = counted.alias("d").join(hits.alias("h"), same_row("d", "h"), "left")
    n_hit = F.coalesce(words_hit(F.col("spans")), F.lit(0).cast("long"))
    return joined.select(
        "d.doc_id",
        "d.text_key",
        "n_words",
        n_hit.alias("n_hit"),
        "spans",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = report(docs, benchmark).filter("contaminated").select("doc_id", "text_key").distinct()
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    return keyed.alias("d").join(bad.alias("b"), same_row("d", "b"), "left_anti").select("row.*")

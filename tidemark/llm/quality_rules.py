"""Quality rules with thresholds that the corpus sets itself.

Every document is measured once.  The measures of each (language, source) go into
mergeable quantile sketches: integer log-linear histograms whose buckets keep six
significant bits, so a quantile is right within 1/32 and two sketches merge by adding
counts, in any order and with the same result.  Fences far outside the middle half
of a group replace fixed cutoffs; a group with few documents takes the sketch of its
language, or of the corpus.  Documents then meet the fences of their group in one join.

Defined results: a NULL or empty text has no words and fails the base rule; NULL
languages and sources are groups of their own; repeated rows are measured and returned
each; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, small_join, stored

#: Fixed values of the base rule: symbols that are counted, and the two limits.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Documents below which a group uses its parent's sketch.
MIN_GROUP = 200
#: A fence stands this many interquartile ranges from its quartile ...
RANGES = 6
#: ... and at least this far, in units of the measure.  Each: (numerator, denominator,
#: scale, least distance, whether a low value counts too).
MEASURES = {
    "symbols": ("n_symbols", "n_words", 1000, 300, False),
    "word_length": ("word_chars", "n_words", 100, 300, True),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 300, False),
    "repeat_words": ("n_repeat_words", "n_words", 1000, 300, False),
}

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long"
)


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The base measures of one text; lines are those with a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()  # on ASCII white space only, as for all bytes
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    symbols = sum(data.count(s) for s in SYMBOLS)
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    repeats = 0
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) < len(grams):
        first: dict = {}
        twice = bytearray(len(words))
        for at, gram in enumerate(grams):
            before = first.setdefault(gram, at)
            if before != at:
                twice[at : at + 3] = b"\1\1\1"
                twice[before : before + 3] = b"\1\1\1"
        repeats = sum(twice)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with the base measures of ``text``."""
    return map_texts(docs.select(*keep, text), lambda: measure, FIELDS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def ratio(name: str) -> Column:
    """A measure as an integer, NULL where it has no denominator."""
    top, bottom, scale, _, _ = MEASURES[name]
    return F.expr(f"CASE WHEN {bottom} > 0 THEN ({scale} * {top}) DIV {bottom} END")


def bucket(value: Column) -> Column:
    """The lower end of the value's histogram bucket: its six leading bits stay."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - 6)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def group_key(name: str) -> Column:
    """A group's value as text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def sketches(rows: DataFrame) -> DataFrame:
    """``(lang_key, source_key, measure, bucket, n)`` of documents that pass the base rule."""
    values = F.array(
        *(F.struct(F.lit(m).alias("measure"), ratio(m).alias("value")) for m in MEASURES)
    )
    return (
        rows.filter(~base_failed())
        .select("lang_key", "source_key", F.explode(values).alias("v"))
        .filter("v.value IS NOT NULL")
        .groupBy("lang_key", "source_key", "v.measure", bucket(F.col("v.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches with the same ``keys``, merged."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantile(quarters: int) -> Column:
    """The first bucket of ``b`` at which the running count reaches so many quarters."""
    reached = F.aggregate(
        "b",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at")),
        lambda acc, x: F.struct(
            (acc["seen"] + x["n"]).alias("seen"),
            F.coalesce(
                acc["at"],
                F.when(4 * (acc["seen"] + x["n"]) >= quarters * F.col("total"), x["bucket"]),
            ).alias("at"),
        ),
    )
    return reached["at"]


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group its number of documents and, per measure, ``low_*`` and ``high_*``.

    A sketch has a bounded number of buckets (64 for each doubling of the value), which
    meet in one array per group and measure.
    """
    per_measure = (
        sketch.groupBy(*keys, "measure")
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b"), F.sum("n").alias("total"))
        .withColumns({"q1": quantile(1), "q3": quantile(3)})
    )
    columns = [F.max("total").alias("total")]
    for name, (_, _, _, least, both) in MEASURES.items():
        far = F.greatest(RANGES * (F.col("q3") - F.col("q1")), F.lit(least))
        own = F.col("measure") == name
        columns.append(F.max(F.when(own, F.col("q3") + far)).alias(f"high_{name}"))
        if both:
            columns.append(F.max(F.when(own, F.col("q1") - far)).alias(f"low_{name}"))
    return per_measure.groupBy(*keys).agg(*columns)


def thresholds(sketch: DataFrame) -> DataFrame:
    """The fences that hold for each (language, source) of the sketch."""
    fixed = F.lit(0).alias("corpus")
    own = fences(sketch, ["lang_key", "source_key"]).withColumn("corpus", fixed)
    lang = fences(merged(sketch, ["lang_key"]), ["lang_key"])
    whole = fences(merged(sketch.withColumn("corpus", fixed), ["corpus"]), ["corpus"])  # one row
    names = [c for c in own.columns if c.startswith(("high_", "low_"))]
    joined = (
        own.alias("o")
        .join(lang.alias("l"), "lang_key")
        .join(F.broadcast(whole).alias("w"), "corpus")
    )
    return joined.select(
        "lang_key",
        "source_key",
        *(
            F.when(F.col("o.total") >= MIN_GROUP, F.col(f"o.{n}"))
            .when(F.col("l.total") >= MIN_GROUP, F.col(f"l.{n}"))
            .otherwise(F.col(f"w.{n}"))
            .alias(n)
            for n in names
        ),
    )


def inside() -> Column:
    """Whether every measure lies within its fences; a measure without value does."""
    ok = F.lit(True)
    for name, (_, _, _, _, both) in MEASURES.items():
        ok = ok & F.coalesce(ratio(name) <= F.col(f"high_{name}"), F.lit(True))
        if both:
            ok = ok & F.coalesce(ratio(name) >= F.col(f"low_{name}"), F.lit(True))
    return ok


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` for each row of ``docs``.

    ``docs`` has doc_id, text, lang and source.
    """
    rows = stored(
        measured(
            docs.select(
                "doc_id", group_key("lang").alias("lang_key"), group_key("source").alias("source_key"), "text"
            ),
            keep=("doc_id", "lang_key", "source_key"),
        ),
        "measures",
    )
    limits = stored(thresholds(sketches(rows)), "fences")
    joined = small_join(
        rows, limits, ["lang_key", "source_key"], limits.count(), F.monotonically_increasing_id(), "left"
    )
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & inside()).alias("kept"),
    )

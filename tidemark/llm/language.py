"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1.  One binary classifier per bit, a logistic
regression over hashed character n-grams, predicts that bit; the language whose codeword
has the least weighted loss against the predictions wins.  A classifier's loss counts
for a language as much as the classifier was right on that language in training.  A
document whose two best languages are close is flagged as ambiguous.

For up to ``EXHAUSTIVE`` languages all distinct splits of the languages are bits; for more,
pseudo-random codewords of a length that grows with the logarithm of their number.

Learned from at most ``PER_LANGUAGE`` documents of each language, those with the least
hashes of their ids; an id that comes with several texts counts once per language, with the
text of the least hash; a document counts as one vector of fixed length.  Prediction reads
whole texts; a word's n-grams are added up once per task and word.

Defined results: texts that are NULL or have no letter are ``und`` with score 0, and so
is everything if no language is known; very long texts are read whole; of two languages that
are equally near the first by name wins, and the document is ambiguous; repeated rows are predicted each; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_documents, map_texts

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
PER_LANGUAGE = 300
EXHAUSTIVE = 6
#: Least lead of the best language over the second; below it a document is ambiguous.
LEAST_MARGIN = 0.2
#: Words a task remembers before it forgets them all; no result depends on it.
REMEMBERED = 200_000
SCALE = 60.0
ROUNDS = 120

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The lower-case words of a text; a word has a letter."""
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))] if text else []


def gram_buckets(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: the buckets of the words' n-grams, and where each word's begin.

    Words are marked at both ends, so each has at least one n-gram of every length.
    """
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    text = "><".join(words)
    codes = np.frombuffer(f"<{text}>".encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    out = []
    for n in (1, 2, 3):
        places = len(codes) - n + 1
        value = np.full(places, n, dtype=np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + codes[j : j + places]
        value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xD6E8FEB86659FD93)
        within = owner[:places] == owner[n - 1 :]
        buckets = (value >> np.uint64(64 - BUCKET_BITS))[within].astype(np.int64)
        out.append((buckets, np.cumsum(lengths - n + 1) - (lengths - n + 1)))
    return out


def bucket_counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs in a text."""
    words = words_of(text)
    parts = [b for b, _ in gram_buckets(words)] if words else [np.empty(0, dtype=np.int64)]
    return np.bincount(np.concatenate(parts), minlength=BUCKETS)


class Summer:
    """Adds up, over the words of texts, one vector per word; remembers the vectors."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.astype(np.float64)
        self.rows: dict[str, int] = {}
        self.table = np.empty((1024, weights.shape[1] + 1))

    def learn(self, words: list[str]) -> None:
        """Vectors of new words: the weights of their n-grams, and how many these are."""
        at, end = len(self.rows), len(self.rows) + len(words)
        while end > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        parts = gram_buckets(words)
        self.table[at:end, :-1] = sum(np.add.reduceat(self.weights[b], s, axis=0) for b, s in parts)
        self.table[at:end, -1] = 3 * np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 3
        self.rows.update(zip(words, range(at, end)))

    def totals(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [words_of(text) for text in texts]
        if len(self.rows) > REMEMBERED:
            self.rows.clear()
        if new := list(set(chain.from_iterable(split)).difference(self.rows)):
            self.learn(new)
        get = self.rows.__getitem__
        return [
            self.table[np.fromiter(map(get, words), dtype=np.int64, count=len(words))].sum(axis=0)
            for words in split
        ]


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language."""
    if n <= EXHAUSTIVE:
        splits = [(1, *rest) for rest in product((1, -1), repeat=n - 1)]
        return np.array([s for s in splits if -1 in s], dtype=np.int8).reshape(-1, n).T
    bits = int(np.ceil(12 * np.log2(n)))
    drawn = np.random.default_rng(n).integers(0, 2, (n, bits)) * 2 - 1
    return drawn[:, np.abs(drawn.sum(axis=0)) < n].astype(np.int8)


@dataclass
class Model:
    """Languages, their codewords, one weight column per bit, and loss weights."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, totals: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and ambiguity from the summed weights and the n-gram count."""
        if not totals[-1] or not self.languages:
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = totals[:-1] * SCALE / totals[-1] + self.bias
        losses = (self.trust * np.logaddexp(0, -self.codes * margins)).sum(axis=1)
        chances = np.exp(losses.min() - losses)
        chances /= chances.sum()
        best, second = np.argsort(-chances, kind="stable")[:2]
        return self.languages[best], float(chances[best]), bool(chances[best] - chances[second] < LEAST_MARGIN)


def fit(languages: list[str], counts: np.ndarray) -> Model:
    """``counts``: a row of bucket counts for each entry of ``languages``."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.ones((0, 0)), np.zeros((BUCKETS, 0)), np.zeros(0), np.ones((0, 0)))
    codes = codewords(len(names)) if len(names) > 1 else np.ones((len(names), 0), dtype=np.int8)
    index = np.array([names.index(x) for x in languages], dtype=np.int64)
    features = counts.reshape(len(index), BUCKETS) * SCALE
    features /= np.maximum(features.sum(axis=1, keepdims=True) / SCALE, 1)
    targets = codes[index].astype(np.float32)
    weights = np.zeros((BUCKETS, codes.shape[1]), dtype=np.float32)
    bias = np.zeros(codes.shape[1], dtype=np.float32)
    # every language weighs the same in every bit
    share = 1 / np.maximum(np.bincount(index, minlength=len(names)), 1)[index] / len(names)
    moment, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, ROUNDS + 1 if codes.shape[1] else 0):  # Adam over the whole sample
        slope = -targets / (1 + np.exp(np.clip(targets * (features @ weights + bias), -30, 30)))
        slope *= share[:, None].astype(np.float32)
        gradient = features.T @ slope + 1e-5 * weights
        moment = 0.9 * moment + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights -= 0.05 * moment / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        bias -= 0.5 * slope.sum(axis=0)
    right = (targets * (features @ weights + bias) > 0).astype(np.float64)
    trust = np.array([right[index == k].mean(axis=0) for k in range(len(names))]).reshape(len(names), -1)
    trust = trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9) * codes.shape[1]
    return Model(names, codes, weights, bias, trust)


def learn(docs: DataFrame, usable: Column) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) for which ``usable`` holds."""
    per_lang = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        docs.filter(usable & F.col("lang").isNotNull())
        .groupBy("lang", "doc_id")  # of a repeated id, the text of the least hash
        .agg(F.min(F.xxhash64("text")).alias("text_key"))
        .withColumn("rank", F.row_number().over(per_lang))
        .filter(F.col("rank") <= PER_LANGUAGE)
        .select("doc_id", "text_key", F.col("lang").alias("label"))
    )
    # ``PER_LANGUAGE`` rows per language at most
    rows = docs.select("doc_id", F.col("lang").alias("label"), F.xxhash64("text").alias("text_key"), "text")
    chosen = rows.join(F.broadcast(ids), ["doc_id", "label", "text_key"]).select("doc_id", "label", "text")

    def counted(text: str | None) -> tuple[bytes]:
        return (bucket_counts(text).astype(np.float32).tobytes(),)

    # vectors come as bytes: a list of numbers would take many times their size in the driver
    found = (
        map_texts(chosen, lambda: counted, "counts binary")
        .dropDuplicates(["doc_id", "label"])
        .orderBy("label", "doc_id")
        .toArrow()
    )
    counts = np.frombuffer(b"".join(found.column("counts").to_pylist()), dtype=np.float32)
    return fit(found.column("label").to_pylist(), counts)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, ``score`` and ``ambiguous`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        summer = Summer(model.weights)
        return lambda texts: list(zip(*map(model.decode, summer.totals(texts.to_pylist())))) or [[]] * 3

    fields = "lang_pred string, score double, ambiguous boolean"
    return map_documents(docs.select(*keep, "text"), make, fields)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language that is not ambiguous, with all columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = predict(rows, model, ("row",))
    return found.filter((F.col("lang_pred") != "und") & ~F.col("ambiguous")).select("row.*")

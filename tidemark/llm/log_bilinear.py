"""Scoring of texts by a log-bilinear language model.

*Words* are runs of anything but ASCII white space, with A-Z in lower case; a text ends with
an end token.  All words of the training texts are counted.  The most frequent ones are
*symbols* of the model; any other word is the symbol of its class (its last byte), and is
chosen within the class by its own count.  So every word, seen or not, has a probability, and
those that can follow add up to one.

The model is log-bilinear with a context of two symbols: the vectors of both, each weighted
by its position, are added to a prediction, and a symbol's score is the product of the
prediction with its vector, plus its bias.  It is trained in numpy with noise-contrastive
estimation on every token of the training texts: each round, every task starts from the
common parameters, learns from its own texts, and Spark averages the results, weighted by
tokens.  Sums are made over fixed-point numbers, so no order of rows changes them.

Because both context vectors enter by addition, the normaliser of every pair of symbols comes
from one product of two matrices, and a token's log-probability is three table reads.

Only parameters of stated size are broadcast: ``SYMBOLS`` symbols and the ``HEAD`` most
frequent words.  Counts of all other words meet the texts' words in a join.

Defined results: a NULL or empty text is the end token alone; very long texts and words are
read whole; repeated rows count and are scored each; ties of equally frequent words are
ordered by their bytes; rows without ``doc_id`` are scored and not learned from; an empty
table gives no row; without any text to learn from, every token has count 0 and the model
knows the end token only; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import arrow_schema, map_documents, ship, stored

#: Symbols of the model, the numbers of a vector, and the noise words of a batch.
SYMBOLS, WIDTH, NOISE = 2048, 24, 32
#: Most frequent words whose counts every task has; none of them is longer than this.
HEAD, LONGEST = 1 << 18, 64
#: Tokens of a batch, rounds over all training texts, first step.
BATCH, ROUNDS, STEP = 2048, 2, 0.15
#: Words that a task counts before it hands them on.
COUNTED = 500_000
#: Fractions of averaged parameters.
FIXED = 1 << 24

END = b""
#: Classes of words: by last byte, lower-case letters and digits as such, other ASCII, beyond ASCII.
CLASSES = 38


def _class_of_byte(b: int) -> int:
    if 97 <= b <= 122:
        return b - 97
    if 48 <= b <= 57:
        return 26 + b - 48
    return 36 if b < 128 else 37


_CLASS = [_class_of_byte(b) for b in range(256)]


def words(text: str | None) -> list[bytes]:
    """``bytes`` splits at ASCII white space and lowers A-Z, and nothing else."""
    return text.encode().lower().split() if text else []


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (bytes; the end token is empty) and ``n`` over all texts."""
    ship(docs.sparkSession)
    schema = arrow_schema(StructType.fromDDL("word binary, n long"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counted():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], schema=schema
            )

        for batch in batches:
            for value in batch.column(0):
                seen.update(words(value.as_py()))
                seen[END] += 1
                if len(seen) >= COUNTED:
                    yield counted()
                    seen.clear()
        if seen:
            yield counted()

    counts = docs.select("text").mapInArrow(work, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the training words: all of them as a table, the most frequent as arrays."""

    counts: DataFrame
    tokens: int  # N
    words: int  # V
    head: list[bytes]
    head_counts: np.ndarray
    #: Words with a symbol of their own: the end token and the first ``own`` of the head.
    own: int
    end_count: int
    class_tokens: np.ndarray  # over words without a symbol
    class_words: np.ndarray

    @property
    def symbol_counts(self) -> np.ndarray:
        """End, classes, own words."""
        return np.concatenate([[self.end_count], self.class_tokens, self.head_counts[: self.own]])


def vocabulary(docs: DataFrame) -> Vocabulary:
    counts = stored(count_words(docs), "lm-counts")
    last = F.when(F.octet_length("word") > 0, F.conv(F.hex(F.expr("substring(word, -1, 1)")), 16, 10).cast("int"))
    by_byte = counts.groupBy(last.alias("byte")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    rows = (
        counts.filter(F.octet_length("word").between(1, LONGEST))
        .orderBy(F.desc("n"), "word")
        .limit(HEAD)
        .toArrow()
    )
    head, head_counts = rows.column("word").to_pylist(), rows.column("n").to_numpy().astype(np.int64)
    own = min(len(head), SYMBOLS - 1 - CLASSES)
    tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    end = 0
    for r in by_byte:  # 257 at most
        if r["byte"] is None:
            end = r["n"]
        else:
            tokens[_CLASS[r["byte"]]] += r["n"]
            distinct[_CLASS[r["byte"]]] += r["words"]
    for word, n in zip(head[:own], head_counts):
        tokens[_CLASS[word[-1]]] -= n
        distinct[_CLASS[word[-1]]] -= 1
    return Vocabulary(
        counts,
        sum(r["n"] for r in by_byte),
        sum(r["words"] for r in by_byte),
        head,
        head_counts,
        own,
        end,
        tokens,
        distinct,
    )


def _once(name: str, make: Callable):
    """What ``make`` gives, made once per Python worker."""
    if name not in _made:
        _made.clear()  # of the models that a worker has used, the last one
        _made[name] = make()
    return _made[name]


_made: dict = {}


class _Head(dict):
    """Index in the head by word; other words are noted and give their class below zero."""

    def __missing__(self, word: bytes) -> int:
        self.rest[word] += 1
        return -1 - _CLASS[word[-1]]


def encode(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Texts as symbols, with what the most frequent words add to their scores.

    ``row`` (unique), the columns of ``docs`` but ``text``, ``n_tokens``, ``symbols`` (two
    bytes each), ``n_known``, ``base`` and ``within`` (sums of logarithms over the words of
    the head), and ``rest``: the other words and how often they come.
    """
    spark, name = docs.sparkSession, f"head-{uuid.uuid4().hex}"
    sizes = known.tokens + known.words + 1
    in_class = known.class_tokens + known.class_words + 1
    shared = spark.sparkContext.broadcast(
        (b"\n".join(known.head), known.head_counts, known.own, known.end_count, in_class)
    )
    others = [c for c in docs.columns if c != "text"]

    def make():
        blob, counts, own, end, in_class = shared.value
        listed = blob.split(b"\n") if blob else []
        table = _Head(zip(listed, range(len(listed))))
        classes = np.array([_CLASS[w[-1]] for w in listed], np.int64)
        index, none = np.arange(len(listed)), np.zeros(CLASSES)
        # negative indexes reach the classes, which are stored backwards at the end
        symbols = np.where(index < own, 1 + CLASSES + index, 1 + classes)
        symbols = np.concatenate([symbols, np.arange(CLASSES, 0, -1)])
        base = np.concatenate([np.log10((counts + 1) / sizes), none])
        within = np.where(index < own, 0.0, np.log10((counts + 1) / in_class[classes]))
        within = np.concatenate([within, none])
        return table, symbols.astype(np.uint16), base, within, math.log10((end + 1) / sizes), end > 0

    def start():
        table, symbols, base, within, end_base, end_known = _once(name, make)

        def one(text):
            table.rest = rest = Counter()
            at = np.array(list(map(table.__getitem__, words(text))), np.int64)
            n_rest = rest.total()
            return (
                len(at) + 1,
                np.append(symbols[at], np.uint16(0)).tobytes(),
                len(at) - n_rest + end_known,
                float(base[at].sum()) + end_base,
                float(within[at].sum()),
                [{"word": w, "n": n} for w, n in rest.items()],
            )

        return lambda texts: list(zip(*map(one, texts.to_pylist()))) or [[]] * 6

    found = map_documents(
        docs.select(*others, "text"),
        start,
        "n_tokens long, symbols binary, n_known long, base double, within double, "
        "rest array<struct<word:binary,n:long>>",
    )
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "lm-encoded")


@dataclass
class Parameters:
    """Context and target vectors, biases, and the weights of the two positions."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    position: np.ndarray

    @staticmethod
    def start(counts: np.ndarray) -> Parameters:
        rng = np.random.default_rng(13)
        m = len(counts)
        return Parameters(
            rng.normal(0, 0.3, (m, WIDTH)).astype(np.float32),
            np.zeros((m, WIDTH), np.float32),
            np.log((counts + 1) / (counts + 1).sum()).astype(np.float32),
            np.ones((2, WIDTH), np.float32),
        )

    def rows(self) -> np.ndarray:
        """A row per symbol and one per position, all of one width."""
        top = np.hstack([self.context, self.target, self.bias[:, None]])
        low = np.zeros((2, top.shape[1]), np.float32)
        low[:, :WIDTH] = self.position
        return np.vstack([top, low])

    @staticmethod
    def of_rows(rows: np.ndarray) -> Parameters:
        top = rows[:-2].astype(np.float32)
        return Parameters(
            top[:, :WIDTH].copy(),
            top[:, WIDTH : 2 * WIDTH].copy(),
            top[:, -1].copy(),
            rows[-2:, :WIDTH].astype(np.float32),
        )


def contexts(symbols: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token its symbol and the two before it, and where texts begin.

    Before a text comes the end token.
    """
    flat = np.frombuffer(b"".join(symbols), np.uint16)
    starts = np.concatenate([[0], np.cumsum([len(s) // 2 for s in symbols])[:-1]]).astype(np.int64)
    one, two = np.empty_like(flat), np.empty_like(flat)
    one[1:], two[2:] = flat[:-1], flat[:-2]
    one[starts] = two[starts] = 0
    two[(starts + 1)[starts + 1 < len(flat)]] = 0  # a text of one token is followed by another's start
    return flat, one, two, starts


class Learner:
    """Noise-contrastive estimation with steps that shrink per parameter (Adagrad)."""

    def __init__(self, parameters: Parameters, counts: np.ndarray, seed: int):
        self.p = parameters
        self.rng = np.random.default_rng(seed)
        noise = (counts + 1) / (counts + 1).sum()
        self.cumulated = np.cumsum(noise)
        self.log_noise = np.log(NOISE * noise).astype(np.float32)
        self.past = {k: np.full_like(getattr(parameters, k), 1e-2) for k in ("context", "target", "bias", "position")}

    def _step(self, name: str, at, gradient: np.ndarray) -> None:
        self.past[name][at] += gradient**2
        getattr(self.p, name)[at] -= STEP * gradient / np.sqrt(self.past[name][at])

    def batch(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """One step down the mean loss of these tokens."""
        p = self.p
        scale = np.float32(1 / len(word))
        noise = np.searchsorted(self.cumulated, self.rng.random(NOISE)).clip(max=len(self.cumulated) - 1)
        ahead, behind = p.context.take(one, axis=0), p.context.take(two, axis=0)
        guess = ahead * p.position[0] + behind * p.position[1]
        target, drawn = p.target.take(word, axis=0), p.target[noise]
        # the loss falls as words look like data and draws like noise
        data = np.einsum("ij,ij->i", guess, target) + p.bias[word] - self.log_noise[word]
        other = guess @ drawn.T + (p.bias[noise] - self.log_noise[noise])
        miss = (-scale / (1 + np.exp(data.clip(-30, 30))))[:, None]
        taken = scale / (1 + np.exp(-other.clip(-30, 30)))
        wrong = miss * target + taken @ drawn
        at, rows = _added(word, miss * guess)
        self._step("target", at, rows)
        self._step("target", *_added(noise, taken.T @ guess))
        at, rows = _added(np.concatenate([word, noise]), np.concatenate([miss[:, 0], taken.sum(axis=0)]))
        self._step("bias", at, rows)
        position = np.stack([np.einsum("ij,ij->j", wrong, ahead), np.einsum("ij,ij->j", wrong, behind)])
        at, rows = _added(
            np.concatenate([one, two]), np.vstack([wrong * p.position[0], wrong * p.position[1]])
        )
        self._step("context", at, rows)
        self._step("position", slice(None), position)


def _added(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of each symbol."""
    order = np.argsort(at.astype(np.uint16), kind="stable")  # 16 bits are sorted by counting
    at = at[order]
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[starts], np.add.reduceat(rows.take(order, axis=0), starts, axis=0)


def train(encoded: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Parameters:
    """Parameters from all tokens of ``encoded``, averaged after each round."""
    spark = encoded.sparkSession
    ship(spark)
    counts = known.symbol_counts
    parameters = Parameters.start(counts)
    m, width = parameters.rows().shape
    names = [f"p{i}" for i in range(width)]
    fields = "symbol int, tokens long, " + ", ".join(f"{n} long" for n in names)
    schema = arrow_schema(StructType.fromDDL(fields))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((parameters, counts))

        def work(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            start, counts = shared.value
            learner = Learner(Parameters.of_rows(start.rows()), counts, turn)
            tokens = 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                flat, one, two, _ = contexts(batch.column(0).to_pylist())
                order = learner.rng.permutation(len(flat))
                flat, one, two = (x[order].astype(np.intp) for x in (flat, one, two))
                for at in range(0, len(flat), BATCH):
                    learner.batch(flat[at : at + BATCH], one[at : at + BATCH], two[at : at + BATCH])
                tokens += len(flat)
            if tokens:
                rows = np.rint(learner.p.rows().astype(np.float64) * FIXED).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(m), pa.int32()), pa.array(np.full(m, tokens))]
                    + [pa.array(column) for column in rows.T],
                    schema=schema,
                )

        parts = encoded.select("symbols").mapInArrow(work, fields)
        weighted = [F.sum(F.col(n).cast("decimal(20,0)") * F.col("tokens")).alias(n) for n in names]
        mean = parts.groupBy("symbol").agg(F.sum("tokens").alias("tokens"), *weighted)
        mean = mean.select("symbol", *((F.col(n) / F.col("tokens") / FIXED).cast("double").alias(n) for n in names))
        rows = mean.toArrow()  # ``SYMBOLS`` + 2 rows
        if not rows.num_rows:
            break
        found = np.empty((m, width))
        found[rows.column("symbol").to_numpy()] = np.stack([rows.column(n).to_numpy() for n in names], axis=1)
        parameters = Parameters.of_rows(found)
        shared.unpersist()
    return parameters


class Tables:
    """Log-probability of each symbol after each pair of symbols, from three tables."""

    def __init__(self, p: Parameters):
        self.one = (p.context * p.position[0]) @ p.target.T
        self.two = (p.context * p.position[1]) @ p.target.T + p.bias
        for t in (self.one, self.two):
            t -= t.max(axis=1, keepdims=True)  # a shift per context, which the normaliser takes back
        self.norm = np.log((np.exp(self.one) @ np.exp(self.two).T).clip(min=np.float32(1e-37)))

    def log_probability(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.one[one, word] + self.two[two, word] - self.norm[one, two]


def score(encoded: DataFrame, known: Vocabulary, parameters: Parameters) -> DataFrame:
    """The rows of ``encoded`` with ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    spark, name = encoded.sparkSession, f"tables-{uuid.uuid4().hex}"
    shared = spark.sparkContext.broadcast(parameters)

    def start():
        tables = _once(name, lambda: Tables(shared.value))

        def work(symbols: pa.Array):
            texts = symbols.to_pylist()
            if not texts:
                return [[]]
            word, one, two, starts = contexts(texts)
            found = tables.log_probability(word, one, two).astype(np.float64)
            return [np.add.reduceat(found, starts) / math.log(10)]

        return work

    others = [c for c in encoded.columns if c not in ("symbols", "rest")]
    scored = map_documents(encoded.select(*others, "symbols"), start, "chosen double")

    # the words outside the head, by their own counts
    sizes = float(known.tokens + known.words + 1)
    in_class = F.array(*[F.lit(float(x)) for x in known.class_tokens + known.class_words + 1])
    rest = encoded.select("row", F.inline("rest"))
    rest = rest.join(known.counts.withColumnRenamed("n", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    byte = F.conv(F.hex(F.expr("substring(word, -1, 1)")), 16, 10).cast("int")
    kind = F.element_at(F.array(*[F.lit(x) for x in _CLASS]), byte + 1)
    more = rest.groupBy("row").agg(
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(sizes))).alias("_base"),
        F.sum(F.col("n") * F.log10((c + 1) / F.element_at(in_class, kind + 1))).alias("_within"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_known"),
    )
    zero = F.lit(0.0)
    return scored.join(more, "row", "left").select(
        *(c for c in others if c not in ("row", "base", "within", "n_known")),
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", zero)).alias("base_score"),
        (F.col("chosen") + F.col("within") + F.coalesce("_within", zero)).alias("score"),
    )


def log_probabilities(docs: DataFrame, usable: Column, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of
    every text, learned from the texts for which ``usable`` holds (of ``doc_id``)."""
    known = vocabulary(docs.filter(usable))
    encoded = encode(docs.select("doc_id", "text"), known)
    return score(encoded, known, train(encoded.filter(usable), known, rounds))

"""Toxicity with a convolutional text classifier.

A word's embedding is the sum of hashed rows: one for the word, one for each of its
beginnings and ends of some letters, so that unseen forms of a word resemble it.  Filters of one, two and three words run over the text, each filter keeps its
largest response, and a logistic layer over those gives the logit.  All is trained here,
in numpy, on every labelled document: these are dealt by id hash into parts of about
``PART`` texts, the first part gives a start by ``EPOCHS`` passes, and then in each of
``ROUNDS`` rounds every part is passed over in a task of its own and what the tasks have
learned is averaged, a row of the table over those that moved it.

Thresholds are calibrated by language: a fifth of the labelled documents is kept from
training, and for each language, told from function words of the text, the logit that
separates all of these best (counted in steps of 1/``STEPS``) is moved to ``THRESHOLD``.  Every language with a toxic document there has its own cut: between
the one that fits its documents and the common one, nearer to its own the more toxic
documents it has.  The common one in the same way lies between the one that fits all
documents and 0, where training, which weighs both labels alike, would cut.

Scoring reads whole texts.  Defined results: NULL and empty texts are scored like a text
without words; very long texts are read whole; without labelled rows every score is 0; of
equally good cuts the highest is taken; repeated rows are scored each, and of an id with
several texts the one of the least hash is learned from; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import labelled, map_groups, map_texts, stored

#: Training texts of one task.
PART = 4000
#: Passes over all parts after the start, each followed by an average.
ROUNDS = 2
#: Every so many labelled documents one is kept for calibration.
HELD = 5
#: Steps of a logit in which calibration counts.
STEPS = 256
#: Learned numbers become integers of this scale, so that sums do not depend on their order.
FIXED = 1 << 24
BUCKETS = 1 << 16
#: Lengths of beginnings and ends of words that have a row; the first row is the word's.
STARTS = (3, 4, 5, 6, 7)
ENDS = (4, 6)
ROWS = 1 + len(STARTS) + len(ENDS)
#: Of a word of so many letters, or more, the pieces that have a row.
_CUTS = [
    [
        slice(None),
        *(slice(n + 1) if size > n else None for n in STARTS),
        *(slice(-n - 1, None) if size > n else None for n in ENDS),
    ]
    for size in range(max(*STARTS, *ENDS) + 2)
]
DIMS = 12
FILTERS = 12
WIDTHS = (1, 2, 3)
EPOCHS = 8
BATCH = 16
THRESHOLD = 0.7
#: Toxic documents that the common cut counts as, against a language's own, and 0 against it.
COMMON = 15
#: Words a task remembers before it forgets those of one text only; no result depends on it.
REMEMBERED = 100_000

WORD = re.compile(r"\w+")
#: ASCII characters in lower case, all but those of words as blanks.
_ASCII = {c: chr(c).lower() if WORD.match(chr(c)) else " " for c in range(128)}
#: Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and is that for was with this are".split(),
    "de": "der die das und ist nicht den mit ein eine".split(),
    "fr": "le les des et est une du dans que pour".split(),
    "es": "el los las por y con una del se no".split(),
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_VOTES = {w: i for i, words in enumerate(FUNCTION_WORDS.values()) for w in words}


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case; most texts are ASCII, where no pattern is needed."""
    if not text:
        return []
    return text.translate(_ASCII).split() if text.isascii() else WORD.findall(text.lower())


def buckets_of(word: str) -> tuple[int, ...]:
    """The rows of a word; -1 is the table's zero row."""
    crc32, whole, cuts = zlib.crc32, f"<{word}>", _CUTS[min(len(word), len(_CUTS) - 1)]
    if whole.isascii():  # bytes are characters
        data = whole.encode()
        return tuple([-1 if cut is None else crc32(data[cut]) % BUCKETS for cut in cuts])
    return tuple([-1 if cut is None else crc32(whole[cut].encode()) % BUCKETS for cut in cuts])


@dataclass
class Model:
    """Embeddings, filters, output layer and the logit that counts as the threshold."""

    table: np.ndarray
    filters: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    cut: dict[str, float] = field(default_factory=dict)
    _flat: np.ndarray | None = field(default=None, init=False, repr=False, compare=False)

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """For each width, the filters' responses at each place of a text of vectors ``x``.

        ``x`` ends with as many zero rows as the widest filter has words, less one.
        """
        places = len(x) - WIDTHS[-1] + 1
        return [
            sum(x[j : j + places] @ self.filters[w][j] for j in range(w)) + self.offsets[w] for w in WIDTHS
        ]

    @staticmethod
    def start() -> Model:
        rng = np.random.default_rng(17)
        table = rng.normal(0, 0.05, (BUCKETS + 1, DIMS)).astype(np.float32)
        table[-1] = 0
        return Model(
            table,
            {w: rng.normal(0, 0.4, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS},
            {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS},
            rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
            0.0,
        )

    def layers(self) -> np.ndarray:
        """All but the table, in rows as wide as the table's."""
        flat = [*(self.filters[w].ravel() for w in WIDTHS), *self.offsets.values(), self.out, [self.bias]]
        flat = np.concatenate(flat)
        return np.concatenate([flat, np.zeros(-len(flat) % DIMS)]).reshape(-1, DIMS)

    def with_rows(self, at: np.ndarray, rows: np.ndarray) -> Model:
        """The model with these rows; those after the table's last are the layers'."""
        table, layers = self.table.copy(), self.layers()
        own = at < BUCKETS
        table[at[own]] = rows[own]
        layers[at[~own] - BUCKETS] = rows[~own]
        flat, filters, offsets = layers.ravel().astype(np.float32), {}, {}
        for w in WIDTHS:
            filters[w], flat = flat[: w * DIMS * FILTERS].reshape(w, DIMS, FILTERS).copy(), flat[w * DIMS * FILTERS :]
        for w in WIDTHS:
            offsets[w], flat = flat[:FILTERS].copy(), flat[FILTERS:]
        out = flat[: FILTERS * len(WIDTHS)].copy()
        return Model(table, filters, offsets, out, float(flat[len(out)]))

    def logit(self, x: np.ndarray) -> float:
        """The logit of a text; the filters of all places are applied in one product."""
        if self._flat is None:
            self._flat = np.concatenate([self.filters[w][j].T for w in WIDTHS for j in range(w)])
        places, tops, at = len(x) - WIDTHS[-1] + 1, [], 0
        found = self._flat @ x.T
        for w in WIDTHS:
            r = found[at : at + FILTERS, :places]
            for j in range(1, w):
                r = r + found[at + j * FILTERS : at + (j + 1) * FILTERS, j : j + places]
            at += w * FILTERS
            tops.append(r.max(axis=1) + self.offsets[w])
        return float(np.maximum(np.concatenate(tops), 0) @ self.out + self.bias)

    def score(self, logit: float, language: str) -> float:
        """0 to 1; the language's threshold becomes ``THRESHOLD``."""
        if not self.cut:
            return 0.0
        moved = logit - self.cut.get(language, self.cut["all"]) + np.log(THRESHOLD / (1 - THRESHOLD))
        return float(1 / (1 + np.exp(-np.clip(moved, -30, 30))))


class Words:
    """Ids of words; for each the table rows, the language vote, and the first and the last
    text that had it, in growing arrays."""

    def __init__(self):
        self.ids: dict[str, int] = defaultdict(count().__next__)
        self.rows = np.empty((1024, ROWS), dtype=np.int32)
        self.votes = np.empty(1024, dtype=np.int8)
        self.met = np.empty((2, 1024), dtype=np.int32)
        self.texts = 0

    def frequent(self) -> tuple[Words, np.ndarray]:
        """Of these the words that came again in a later text, and their ids here.

        No words, if these are more than half of ``REMEMBERED``, so that memory stays bounded.
        """
        old, found = np.flatnonzero(self.met[0, : len(self.ids)] < self.met[1, : len(self.ids)]), Words()
        if len(old) > REMEMBERED // 2:
            old = old[:0]
        names = list(self.ids)
        found.ids.update((names[k], found.ids.default_factory()) for k in old)
        blank = max(1024 - len(old), 0)
        found.rows = np.pad(self.rows[old], ((0, blank), (0, 0)))
        found.votes = np.pad(self.votes[old], (0, blank))
        found.met = np.zeros((2, len(found.rows)), dtype=np.int32)
        return found, old

    def look_up(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        ids, at = self.ids, len(self.ids)
        found = np.fromiter(map(ids.__getitem__, words), dtype=np.int32, count=len(words))
        self.texts += 1
        if (end := len(ids)) > at:
            while end > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                self.votes = np.concatenate([self.votes, np.empty_like(self.votes)])
                self.met = np.concatenate([self.met, np.empty_like(self.met)], axis=1)
            new = [*islice(reversed(ids), end - at)][::-1]
            self.rows[at:end] = [buckets_of(word) for word in new]
            self.votes[at:end] = [_VOTES.get(word, len(FUNCTION_WORDS)) for word in new]
            self.met[0, at:end] = self.texts
        self.met[1, found] = self.texts
        return found


def language_of(votes: np.ndarray) -> str:
    """The language with most function words; ``votes`` has one entry per word."""
    counts = np.bincount(votes, minlength=len(LANGUAGES))[:-1]
    return LANGUAGES[int(counts.argmax())] if counts.max(initial=0) else "other"


def _padded(ids: np.ndarray, blank: int) -> np.ndarray:
    """The words of a text, and blanks at its end for the widest filter."""
    return np.concatenate([ids, np.full(WIDTHS[-1] - 1 + (len(ids) == 0), blank, dtype=ids.dtype)])


def train(
    texts: list[np.ndarray], rows_of: np.ndarray, labels: np.ndarray, model: Model | None = None,
    epochs: int = EPOCHS, seed: int = 23,
) -> Model:
    """``model`` after more passes over texts.

    ``texts``: padded word ids for each label; ``rows_of``: the table rows of each word.
    """
    rng = np.random.default_rng(seed)
    model = model or Model.start()
    table = model.table
    seen = {k: np.full_like(v, 1e-3) for k, v in (("table", table), ("out", model.out))}
    seen |= {("f", w): np.full_like(model.filters[w], 1e-3) for w in WIDTHS}
    seen |= {("o", w): np.full_like(model.offsets[w], 1e-3) for w in WIDTHS}
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)

    def step(key, value, gradient, rows=slice(None), rate=0.05):  # Adagrad
        seen[key][rows] += gradient**2
        value[rows] -= rate * gradient / np.sqrt(seen[key][rows])

    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            d_out = np.zeros_like(model.out)
            d_filters = {w: np.zeros_like(model.filters[w]) for w in WIDTHS}
            d_offsets = {w: np.zeros_like(model.offsets[w]) for w in WIDTHS}
            d_bias, touched, d_rows = 0.0, [], []
            for k in chosen:
                rows = rows_of[texts[k]]
                x = table[rows].sum(axis=1)
                found = model.responses(x)
                places = [r.argmax(axis=0) for r in found]
                tops = [r[p, np.arange(FILTERS)] for r, p in zip(found, places)]
                pooled = np.maximum(np.concatenate(tops), 0)
                logit = pooled @ model.out + model.bias
                slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[k]) * weight[k] / len(chosen)
                d_out += slope * pooled
                d_bias += slope
                back = slope * model.out * (pooled > 0)
                for n, w in enumerate(WIDTHS):
                    own = back[n * FILTERS : (n + 1) * FILTERS]
                    d_offsets[w] += own
                    for j in range(w):
                        where = places[n] + j
                        d_filters[w][j] += x[where].T * own
                        touched.append(rows[where])
                        d_rows.append((model.filters[w][j] * own).T)
            step("out", model.out, d_out)
            model.bias -= 0.05 * d_bias
            for w in WIDTHS:
                step(("f", w), model.filters[w], d_filters[w])
                step(("o", w), model.offsets[w], d_offsets[w])
            moved, place = np.unique(np.concatenate(touched).ravel(), return_inverse=True)
            gradient = np.zeros((len(moved), DIMS), dtype=np.float32)
            np.add.at(gradient, place.ravel(), np.repeat(np.concatenate(d_rows), ROWS, axis=0))
            step("table", table, gradient, moved)
            table[-1] = 0
    return model


def best_cut(logits: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None) -> float:
    """The middle of the gap at which the F1 value is largest.

    At each of the different ``logits`` are ``rows`` texts (one if not given), ``toxic`` of them toxic.
    """
    order = np.argsort(-logits, kind="stable")
    right = np.cumsum(toxic[order])
    above = np.arange(1, len(order) + 1) if rows is None else np.cumsum(rows[order])
    f1 = 2 * right / (above + max(1, toxic.sum()))
    at = int(f1.argmax())
    below = logits[order[at + 1]] if at + 1 < len(order) else logits[order[at]] - 2
    return float((logits[order[at]] + below) / 2)


def cuts(spoken: np.ndarray, steps: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> dict[str, float]:
    """The common cut, and one for each language with a toxic text, from counts by logit step."""

    def cut(where):
        at, place = np.unique(steps[where], return_inverse=True)
        return best_cut(at / STEPS, np.bincount(place, toxic[where]), np.bincount(place, rows[where]))

    everywhere, n = np.ones(len(steps), dtype=bool), float(toxic.sum())
    found = {"all": n * cut(everywhere) / (n + COMMON)}
    for language in LANGUAGES:
        there = spoken == language
        if n := float(toxic[there].sum()):
            found[language] = (n * cut(there) + COMMON * found["all"]) / (n + COMMON)
    return found


def look_up_all(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, list[str]]:
    """Padded word ids of each text, the table rows of each word, and the texts' languages."""
    words = Words()
    ids = [words.look_up(text) for text in texts]
    blank = len(words.ids)
    rows_of = np.concatenate([words.rows[:blank], np.full((1, ROWS), -1, dtype=np.int32)])
    return [_padded(i, blank) for i in ids], rows_of, [language_of(words.votes[i]) for i in ids]


def fit(sample: list[tuple[str | None, int]]) -> Model:
    """Learn from a list: train on four fifths of it, calibrate on the rest."""
    texts, rows_of, spoken = look_up_all([text for text, _ in sample])
    labels = np.array([label for _, label in sample], dtype=np.float32)
    held = np.arange(len(sample)) % HELD == 0
    if not labels[~held].any() or labels[~held].all():
        return Model.start()
    model = train([t for t, h in zip(texts, held) if not h], rows_of, labels[~held])
    own = np.flatnonzero(held)
    logits = np.array([model.logit(model.table[rows_of[texts[k]]].sum(axis=1)) for k in own])
    model.cut = cuts(np.array(spoken)[own], np.rint(logits * STEPS), labels[own], np.ones(len(own)))
    return model


def averaged(rows: DataFrame, model: Model, epochs: int, seed: int) -> Model:
    """The mean of what each part of ``rows`` (part, at, label, text) makes of ``model``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        order = np.argsort(batch.column(1).to_numpy(), kind="stable")
        labels = batch.column(2).to_numpy()[order].astype(np.float32)
        texts = batch.column(3).to_pylist()
        padded, rows_of, _ = look_up_all([texts[k] for k in order])
        start = shared.value.with_rows(np.empty(0, int), np.empty((0, DIMS)))
        part = batch.column(0)[0].as_py()
        learned = train(padded, rows_of, labels, start, epochs, seed * 1_000_003 + part)
        moved = np.unique(rows_of)
        moved = moved[moved >= 0]
        layers = learned.layers()
        at = np.concatenate([moved, BUCKETS + np.arange(len(layers))])
        values = np.concatenate([learned.table[moved], layers]).astype(np.float64)
        return [at, *np.rint(values * FIXED).astype(np.int64).T]

    names = [f"p{i}" for i in range(DIMS)]
    parts = map_groups(rows, ["part"], work, "row int, " + ", ".join(f"{n} long" for n in names))
    mean = parts.groupBy("row").agg(*[(F.avg(n) / FIXED).alias(n) for n in names])
    found = mean.toArrow()  # ``BUCKETS`` rows and those of the layers at most
    values = np.stack([found.column(n).to_numpy() for n in names], axis=1)
    shared.unpersist()
    return model.with_rows(found.column("row").to_numpy(), values)


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Learn from all ``labels`` (doc_id, toxic) for which ``usable`` holds."""
    hashed = F.xxhash64("doc_id")
    rows = labelled(docs, labels, "toxic", usable).withColumns(
        {"at": hashed, "held": F.pmod(hashed, F.lit(HELD)) == 0, "deal": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))}
    )
    rows = stored(rows.select("doc_id", "at", "held", "deal", "label", "text"), "toxicity-labelled")
    total, toxic = rows.filter("NOT held").agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    model = Model.start()
    if toxic in (0, total):
        return model
    parts = -(-total // PART)
    training = rows.filter("NOT held").select((F.col("deal") % parts).cast("int").alias("part"), "at", "label", "text")
    first = training.agg(F.min("part")).first()[0]
    model = averaged(training.filter(F.col("part") == first), model, EPOCHS, 0)
    for turn in range(ROUNDS if parts > 1 else 0):
        model = averaged(training, model, 1, 1 + turn)
    found = logits(rows.filter("held").select("label", "text"), model)
    counted = found.groupBy("language", F.rint(F.col("logit") * STEPS).alias("step")).agg(
        F.sum("label").alias("toxic"), F.count("*").alias("rows")
    )
    # steps between the least and the greatest logit, for each of five languages
    counted = counted.orderBy("language", "step").toArrow()
    if counted.num_rows:
        names = np.array(counted.column("language").to_pylist())
        model.cut = cuts(names, *(counted.column(c).to_numpy().astype(float) for c in ("step", "toxic", "rows")))
    return model


def logits(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but for the last, ``text``; the language as told from it and its logit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        words = Words()
        vectors = np.empty((1024, DIMS), dtype=np.float32)
        end = np.zeros((WIDTHS[-1], DIMS), dtype=np.float32)

        def work(text):
            nonlocal words, vectors
            if len(words.ids) > REMEMBERED:
                words, old = words.frequent()
                vectors = np.pad(vectors[old], ((0, max(1024 - len(old), 0)), (0, 0)))
            before = len(words.ids)
            ids = words.look_up(text)
            now = len(words.ids)
            while len(vectors) < now:
                vectors = np.concatenate([vectors, np.empty_like(vectors)])
            if now > before:
                vectors[before:now] = model.table[words.rows[before:now]].sum(axis=1)
            x = np.concatenate([vectors[ids], end[: WIDTHS[-1] - 1 + (len(ids) == 0)]])
            language, logit = language_of(words.votes[ids]), model.logit(x)
            return language, logit, model.score(logit, language)

        return work

    return map_texts(docs, make, "language string, logit double, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``language`` (as told from the text) and ``score`` of each row."""
    return logits(docs.select("doc_id", "text"), model).drop("logit")

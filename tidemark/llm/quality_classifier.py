"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted regression trees are grown on the statistics of a bounded sample of labelled
documents.  Every path from a root to a node becomes a rule, a conjunction of
comparisons.  A logistic regression with an L1 penalty over all rules keeps few of them,
and those are compiled into one Spark column expression.

Learned from at most ``SAMPLE`` labelled documents; statistics read whole texts.

Defined results: NULL and empty texts have all statistics 0 and are scored by them;
without labelled rows, or with one label only, every score is the share of label 1 (0.5
if unknown); repeated rows are scored each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import labelled_sample, map_texts

SAMPLE = 12_000
TREES = 40
DEPTH = 3
BINS = 48
LEAST_LEAF = 20
PENALTY = 2e-4
ROUNDS = 300

STATISTICS = (
    "n_words",
    "mean_word",
    "distinct_share",
    "longest_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "pipe_share",
    "exclaim_share",
    "punctuation_share",
    "wide_share",
    "line_words",
    "dup_line_share",
    "same_next_share",
    "repeat_pair_share",
)
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&<>~^_=+@{}[]\\/"
PUNCTUATION = b".,;:?"
WIDE = bytes(range(128, 192))  # one in each character beyond ASCII


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of one text; shares lie between 0 and 1."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, size = len(words), len(data)

    def share(characters: bytes) -> float:
        return (size - len(data.translate(None, characters))) / size

    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    distinct = len(set(words))
    pairs = list(zip(words, words[1:]))
    lengths = list(map(len, words))
    return (
        float(n),
        sum(lengths) / n,
        distinct / n,
        float(max(lengths)),
        # capitals of any script, told by lower-casing
        sum(map(str.isupper, text)) / len(text),
        share(DIGITS),
        share(SYMBOLS),
        data.count(b"|") / n,
        data.count(b"!") / n,
        share(PUNCTUATION),
        share(WIDE),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(a == b for a, b in pairs) / n,
        1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
    )


Condition = tuple[int, bool, float]  # statistic, whether above, cut
Rule = tuple[Condition, ...]


@dataclass
class Model:
    """Rules with their weights, and the intercept."""

    rules: list[Rule]
    weights: list[float]
    bias: float

    def score(self) -> Column:
        """The probability of label 1, as an expression over the statistics' columns."""
        steps = []
        for rule, weight in zip(self.rules, self.weights):
            holds = F.lit(True)
            for statistic, above, cut in rule:
                column = F.col(STATISTICS[statistic])
                holds = holds & (column > cut if above else column <= cut)
            steps.append(F.when(holds, F.lit(weight)).otherwise(F.lit(0.0)))
        # added up in their order by one fold: a chain of some hundred sums overflows the driver's stack
        logit = F.aggregate(F.array(*steps).cast("array<double>"), F.lit(self.bias), lambda total, step: total + step)
        return 1 / (1 + F.exp(-logit))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for statistic, above, cut in rule:
        out &= x[:, statistic] > cut if above else x[:, statistic] <= cut
    return out


def cuts_of(x: np.ndarray) -> list[np.ndarray]:
    """Candidate cuts of each statistic: midpoints between its distinct quantiles."""
    out = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1), method="nearest"))
        out.append((values[:-1] + values[1:]) / 2)
    return out


def grow(x: np.ndarray, bins: np.ndarray, cuts: list, gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray):
    """Rules and their steps (gradient over weight) for the nodes of one tree.

    ``bins`` holds, for each statistic, how many of its cuts a row's value exceeds.
    """
    rules, leaves = [], []
    todo = [((), rows)]
    for _ in range(DEPTH):
        level = []
        for rule, own in todo:
            best, where = 0.0, None
            g, h = gradient[own], weight[own]
            for s, cut in enumerate(cuts):
                if not len(cut):
                    continue
                b = bins[own, s]
                gs = np.bincount(b, g, len(cut) + 1).cumsum()[:-1]
                hs = np.bincount(b, h, len(cut) + 1).cumsum()[:-1]
                ns = np.bincount(b, minlength=len(cut) + 1).cumsum()[:-1]
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                gain[(ns < LEAST_LEAF) | (len(own) - ns < LEAST_LEAF)] = 0
                if gain.max() > best + 1e-9:
                    best, where = gain.max(), (s, int(gain.argmax()))
            if where is None:
                leaves.append((rule, own))
                continue
            s, k = where
            low = bins[own, s] <= k
            for above, part in ((False, own[low]), (True, own[~low])):
                longer = (*rule, (s, above, float(cuts[s][k])))
                rules.append(longer)
                level.append((longer, part))
        todo = level
    return rules, leaves + todo


def boosted_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The distinct rules of trees that are boosted on the logistic loss."""
    rng = np.random.default_rng(5)
    cuts = cuts_of(x)
    bins = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    logit = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        rows = np.flatnonzero(rng.random(len(y)) < 0.6)
        found, leaves = grow(x, bins, cuts, y - p, p * (1 - p), rows)
        rules.update(dict.fromkeys(found))
        for rule, own in leaves:
            there = holds(rule, x)
            step = (y - p)[own].sum() / ((p * (1 - p))[own].sum() + 1)
            logit[there] += 0.3 * np.clip(step, -4, 4)
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty on standardised columns, by accelerated
    proximal gradient steps; the intercept is not penalised."""
    mean, spread = z.mean(axis=0), z.std(axis=0)
    spread[spread < 1e-3] = np.inf  # a rule that holds nearly always or never
    z = ((z - mean) / spread).astype(np.float32)
    v = np.ones(z.shape[1], dtype=np.float32)
    for _ in range(12):  # the largest eigenvalue bounds the step
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) + 1e-9
    rate = 4 * len(y) / (float(v @ (z.T @ (z @ v))) + len(y))
    w, b = np.zeros(z.shape[1], dtype=np.float32), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_b, t = w, b, 1.0
    for _ in range(ROUNDS):
        slope = 1 / (1 + np.exp(-(z @ ahead + ahead_b))) - y
        new = ahead - rate * (z.T @ slope).astype(np.float32) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        new_b = ahead_b - rate * slope.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    raw = w / spread
    return raw, float(b - raw @ mean)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Rules and weights for statistics ``x`` and labels ``y``."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Model([], [], float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rules = boosted_rules(x, y)
    if not rules:
        return Model([], [], float(np.log(y.mean() / (1 - y.mean()))))
    weights, bias = lasso(np.stack([holds(r, x) for r in rules], axis=1).astype(np.float64), y)
    used = np.flatnonzero(np.abs(weights) > 1e-4)
    return Model([rules[i] for i in used], [float(weights[i]) for i in used], bias)


FIELDS = ", ".join(f"{name} double" for name in STATISTICS)


def with_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return map_texts(docs.select(*keep, "text"), lambda: statistics, FIELDS)


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Learn from ``labels`` (doc_id, quality) for which ``usable`` holds."""
    sample = labelled_sample(docs, labels, "quality", usable, SAMPLE)
    rows = sorted(with_statistics(sample, ("doc_id", "label")).collect(), key=lambda r: str(r.doc_id))
    x = np.array([r[2:] for r in rows], dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r.label for r in rows], dtype=np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the statistics and ``score`` of each row of ``docs`` (doc_id, text)."""
    return with_statistics(docs).withColumn("score", model.score())

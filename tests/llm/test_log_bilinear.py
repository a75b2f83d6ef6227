"""Language-model scores against plain sums and against probabilities over all words."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_SMALL
from tidemark.llm import log_bilinear as lm
from tidemark.llm.common import fold
from tidemark.llm.queries import QUERIES

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def plain_base(rows):
    counts = Counter()
    for r in rows:
        if learned(r.doc_id):
            counts.update([*words(r.text), None])
    total, size = sum(counts.values()), len(counts)
    found = []
    for r in rows:
        tokens = [*words(r.text), None]
        base = sum(math.log10((counts[t] + 1) / (total + size + 1)) for t in tokens)
        found.append((r.doc_id, len(tokens), sum(t in counts for t in tokens), total, round(base, 6)))
    return sorted(found, key=repr), counts


BASE = ["doc_id", "n_tokens", "n_known", "train_tokens"]


def base_of(rows):
    return sorted(((*(r[c] for c in BASE), round(r.base_score, 6)) for r in rows), key=repr)


def test_query_over_the_small_table(spark, documents):
    rows = QUERIES["op13_lm_scoring"](spark, SF_SMALL).collect()
    want, _ = plain_base(documents.collect())
    assert base_of(rows) == want
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (not learned(r.doc_id)) for r in rows)
    # more likely than by counts alone, in texts it has not seen
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.01 * sum(r.n_tokens for r in held)


def usable():
    return fold("doc_id", 7) != 2


@pytest.mark.parametrize("head", [40, 3000])
def test_scores_are_probabilities(spark, documents, monkeypatch, head):
    """Every token's probability by a sum over all symbols, with words inside and outside the head."""
    monkeypatch.setattr(lm, "HEAD", head)
    docs = documents.filter("doc_id < 60")
    known = lm.vocabulary(docs.filter(usable()))
    encoded = lm.encode(docs.select("doc_id", "text"), known)
    parameters = lm.train(encoded.filter(usable()), known, 1)
    got = {r.doc_id: r for r in lm.score(encoded, known, parameters).collect()}

    own = {w: i + 1 + lm.CLASSES for i, w in enumerate(known.head[: known.own])}
    rows = docs.collect()
    counts = Counter(w for r in rows if learned(r.doc_id) for w in words(r.text))

    def symbol(w):
        return own.get(w.encode(), 1 + lm._CLASS[w.encode()[-1]])

    inside, kinds = Counter(), Counter()
    for w, n in counts.items():
        if symbol(w) <= lm.CLASSES:
            inside[symbol(w)] += n
            kinds[symbol(w)] += 1
    for kind in inside:  # the words of a class, with one part for all that were never seen
        assert inside[kind] == known.class_tokens[kind - 1] and kinds[kind] == known.class_words[kind - 1]

    def probabilities(one, two):
        p = parameters
        guess = p.context[one] * p.position[0] + p.context[two] * p.position[1]
        scores = (p.target @ guess + p.bias).astype(np.float64)
        return np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()

    seen = {}
    for r in rows[:25]:
        before, total = (0, 0), 0.0
        for w in [*words(r.text), None]:
            at = symbol(w) if w else 0
            if before not in seen:
                seen[before] = probabilities(*before)
                assert math.isclose(seen[before].sum(), 1, rel_tol=1e-9)
            p = seen[before][at]
            if 0 < at <= lm.CLASSES:
                p *= (counts[w] + 1) / (inside[at] + kinds[at] + 1)
            total += math.log10(p)
            before = (at, before[0])
        assert math.isclose(got[r.doc_id].score, total, rel_tol=2e-4, abs_tol=1e-3), r.doc_id


def test_training_is_the_gradient_of_its_loss():
    """A step moves each parameter along the numerical slope of the noise-contrastive loss."""
    rng = np.random.default_rng(1)
    counts = np.array([5, 9, 1, 7, 3, 2])
    word, one, two = (rng.integers(0, 6, 40) for _ in range(3))
    start = lm.Parameters.start(counts)
    start.target += rng.normal(0, 0.2, start.target.shape).astype(np.float32)
    drawn = lm.Learner(lm.Parameters.of_rows(start.rows()), counts, 4)
    noise = np.searchsorted(drawn.cumulated, np.random.default_rng(4).random(lm.NOISE))

    def loss(p):
        guess = p.context[one] * p.position[0] + p.context[two] * p.position[1]
        data = (guess * p.target[word]).sum(1) + p.bias[word] - drawn.log_noise[word]
        other = guess @ p.target[noise].T + p.bias[noise] - drawn.log_noise[noise]
        return np.logaddexp(0, -data).mean() + np.logaddexp(0, other).sum(1).mean()

    seen = []
    drawn._step = lambda name, at, gradient: seen.append((name, at, gradient))
    drawn.batch(word, one, two)
    for name in ("context", "target", "bias", "position"):
        total = np.zeros_like(getattr(start, name), dtype=float)
        for other, at, gradient in seen:
            if other == name:
                total[at] += gradient
        for at in [tuple(rng.integers(0, n) for n in total.shape) for _ in range(12)]:
            high, low = (lm.Parameters.of_rows(start.rows()) for _ in range(2))
            for p, step in ((high, 1e-2), (low, -1e-2)):
                setattr(p, name, getattr(p, name).astype(float))
                getattr(p, name)[at] += step
            assert abs((loss(high) - loss(low)) / 2e-2 - total[at]) < 2e-3, (name, at)


def test_odd_rows(odd):
    """NULLs in every column, empty and very long texts, repeated rows, clashing names."""
    rows = odd.collect()
    got = lm.log_probabilities(odd, usable()).collect()
    want, _ = plain_base(rows)
    assert base_of(got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    same = [r for r in got if r.doc_id == 4]
    assert len(same) == 3 and len({r.score for r in same}) == 1


def test_empty_tables(spark, documents):
    assert lm.log_probabilities(documents.limit(0), usable()).collect() == []
    unlearned = documents.filter("doc_id < 20").withColumn("doc_id", F.lit(None).cast("long"))
    for r in lm.log_probabilities(unlearned, usable()).collect():
        assert r.train_tokens == r.n_known == 0 and abs(r.base_score) < 1e-9 and math.isfinite(r.score)


def test_words_are_split_at_ascii_space_only():
    text = "A b c\x1cD\x0bÉ\tx\u0085y"
    assert [w.decode() for w in lm.words(text)] == words(text)

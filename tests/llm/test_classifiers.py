"""Classifiers: held-out accuracy, learning parts by themselves, and odd tables."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, quality_classifier, toxicity
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def joined(spark, name, label):
    rows = QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left")
    rows = rows.withColumnRenamed(label, "label").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    return rows


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def accuracy(rows):
    own = [r for r in rows if r.held_out and r.label is not None]
    return np.mean([r.predicted == r.label for r in own])


def test_quality_classifier(spark):
    rows = joined(spark, "op2_quality_classifier", "quality")
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert accuracy(rows) >= 0.97


def test_toxicity(spark):
    rows = joined(spark, "op5_toxicity", "toxic")
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    assert accuracy(rows) >= 0.9


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language"](spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) >= 0.97


def test_no_label_of_a_held_out_row_is_learned(spark):
    """Turning the held-out labels around changes no score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    turned = labels.withColumn("quality", F.when(usable, F.col("quality")).otherwise(1 - F.col("quality")))
    models = [quality_classifier.learn(docs, t, usable) for t in (labels, turned)]
    assert models[0] == models[1]


def test_codewords():
    for n in (2, 3, 4, 6, 9, 40):
        codes = language.codewords(n)
        assert len({tuple(r) for r in codes}) == n
        assert (np.abs(codes.sum(axis=0)) < n).all()  # no classifier without a task
    assert language.codewords(4).shape == (4, 7)


def test_wrong_bits_are_corrected():
    codes = language.codewords(4)
    model = language.Model(
        list("abcd"), codes, np.zeros((language.BUCKETS, 7)), np.zeros(7), np.ones((4, 7))
    )
    for k in range(4):
        for bit in range(7):
            margins = codes[k] * 3.0
            margins[bit] *= -1
            model.bias = margins
            assert model.decode(np.append(np.zeros(7), 1.0))[0] == "abcd"[k]
    model.bias = np.zeros(7)
    assert model.decode(np.append(np.zeros(7), 1.0))[2]  # all alike: ambiguous


@pytest.mark.parametrize("names", [[], ["en"], ["en", "de"]])
def test_few_languages(spark, odd, names):
    texts = {"en": "the of and", "de": "der die und"}
    counts = np.array([language.bucket_counts(texts[n]) for n in names], dtype=np.float32)
    model = language.fit(names, counts)
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in range(4))
    assert all(r.lang_pred in [*names, "und"] for r in rows)
    assert language.predict(odd.limit(0), model).count() == 0


def test_rules_find_a_conjunction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality_classifier.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.4)).astype(float)
    model = quality_classifier.fit(x, y)
    logit = model.bias + sum(
        w * quality_classifier.holds(r, x) for r, w in zip(model.rules, model.weights)
    )
    assert np.mean((logit > 0) == y) > 0.98
    assert 0 < len(model.rules) < 300


def test_compiled_rules_equal_the_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_classifier.learn(docs, labels, F.lit(True))
    rows = quality_classifier.score(docs.limit(50), model).collect()
    x = np.array([[r[s] for s in quality_classifier.STATISTICS] for r in rows])
    logit = model.bias + sum(
        w * quality_classifier.holds(r, x) for r, w in zip(model.rules, model.weights)
    )
    assert np.allclose([r.score for r in rows], 1 / (1 + np.exp(-logit)))


def test_as_many_rules_as_trees_can_give(spark):
    """A model of all rules that the trees may have is planned, and scores like its rules."""
    rng = np.random.default_rng(4)
    size = quality_classifier.TREES * (2 ** (quality_classifier.DEPTH + 1) - 2)
    own = rng.integers(0, len(quality_classifier.STATISTICS), (size, quality_classifier.DEPTH))
    rules = [tuple((int(s), bool(rng.integers(2)), float(rng.random() * 3)) for s in part) for part in own]
    model = quality_classifier.Model(rules, rng.normal(0, 0.1, size).tolist(), 0.3)
    docs = spark.createDataFrame(
        [(i, " ".join(rng.choice(["a", "Bc", "d,e", "12 x", "|", "é!"], 20 + i))) for i in range(20)],
        "doc_id long, text string",
    )
    rows = quality_classifier.score(docs, model).collect()
    x = np.array([[r[s] for s in quality_classifier.STATISTICS] for r in rows])
    logit = model.bias + sum(w * quality_classifier.holds(r, x) for r, w in zip(model.rules, model.weights))
    assert len(rows) == 20 and np.allclose([r.score for r in rows], 1 / (1 + np.exp(-logit)))


def test_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(5, 1, 1), (None, 0, None), (77, None, 0)], labels.schema)
    for table in (labels, one):
        quality = quality_classifier.score(odd, quality_classifier.learn(odd, table, F.lit(True)))
        toxic = toxicity.score(odd, toxicity.learn(odd, table, F.lit(True)))
        for rows in (quality.collect(), toxic.collect()):
            assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)


def test_toxic_word_moves_the_score(spark, odd):
    rng = np.random.default_rng(1)
    vocabulary = [f"word{i}" for i in range(300)]
    sample = []
    for i in range(400):
        words = list(rng.choice(vocabulary, 40))
        if i % 4 == 0:
            words[7] = words[20] = "horrid"
        sample.append((" ".join(words), int(i % 4 == 0)))
    model = toxicity.fit(sample)
    docs = spark.createDataFrame(
        [(1, "word1 word2 horrid word3 horrid"), (2, "word1 word2 word4 word3")], "doc_id long, text string"
    )
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert scores[1] > 0.7 > scores[2]
    assert len(toxicity.score(odd, model).collect()) == odd.count()
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_language_by_a_plain_computation(spark):
    """Scores from the n-gram counts of each whole text, without remembered words."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(docs, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    for r in docs.collect():
        counts = language.bucket_counts(r.text).astype(float)
        if not counts.sum():
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        margins = counts @ model.weights * language.SCALE / counts.sum() + model.bias
        losses = [sum(t * np.log1p(np.exp(-c * m)) for t, c, m in zip(trust, code, margins))
                  for trust, code in zip(model.trust, model.codes)]
        chances = np.exp(-np.array(losses)) / np.exp(-np.array(losses)).sum()
        assert got[r.doc_id].lang_pred == model.languages[int(chances.argmax())]
        assert abs(got[r.doc_id].score - chances.max()) < 1e-6


def test_repeated_ids_learn_alike_in_any_partitions(spark):
    """An id with several texts and languages counts once per language, wherever its rows lie."""
    rows = [(i % 5, f"the text number {i} is in English", "en") for i in range(40)]
    rows += [(i % 7, f"der Text Nummer {i} ist deutsch", "de") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = language.learn(df.coalesce(1), F.lit(True))
    for other in (df.repartition(7), df.orderBy("text", ascending=False)):
        again = language.learn(other, F.lit(True))
        assert np.array_equal(one.weights, again.weights) and one.languages == again.languages


def test_toxicity_by_a_plain_computation(spark):
    """Embeddings, filters, maxima and the logistic layer, word by word, for each whole text."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.learn(docs, labels, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for r in docs.limit(60).collect():
        words = toxicity.WORD.findall(r.text.lower()) or [None]
        vectors = [
            sum((model.table[b] for b in toxicity.buckets_of(w) if b >= 0), np.zeros(toxicity.DIMS)) if w
            else np.zeros(toxicity.DIMS) for w in words
        ]
        vectors += [np.zeros(toxicity.DIMS)] * (max(toxicity.WIDTHS) - 1)
        logit = model.bias
        for n, w in enumerate(toxicity.WIDTHS):
            places = range(len(vectors) - max(toxicity.WIDTHS) + 1)
            for f in range(toxicity.FILTERS):
                best = max(
                    sum(vectors[p + j] @ model.filters[w][j][:, f] for j in range(w)) + model.offsets[w][f]
                    for p in places
                )
                logit += max(best, 0.0) * model.out[n * toxicity.FILTERS + f]
        assert abs(got[r.doc_id].score - model.score(logit, got[r.doc_id].language)) < 1e-3


def test_cuts_move_from_the_common_one_with_evidence():
    """No language jumps from one threshold to another: each document moves it a little."""
    model = toxicity.fit([(f"{w} word{i % 7}", i % 2) for i in range(400) for w in ("the",)])
    assert set(model.cut) == {"all", "en"}
    sample = [("the nice day", 0), ("the vile day", 1)] * 100 + [("der nette Tag", 0)] * 50
    for extra in (0, 5, 40):
        model = toxicity.fit(sample + [("der vile Tag und das", 1)] * extra)
        held = sum(1 for i in range(len(sample), len(sample) + extra) if i % 5 == 0)
        assert ("de" in model.cut) == bool(held)


def test_the_sample_does_not_depend_on_partitions(spark):
    """Of an id with several texts the one of the least hash is learned from."""
    from tidemark.llm.common import labelled_sample

    docs = spark.createDataFrame([(i % 10, f"text {i}") for i in range(60)] + [(3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(4, 0)], "doc_id long, toxic int")
    first = None
    for other in (docs.coalesce(1), docs.repartition(9), docs.orderBy("text", ascending=False)):
        rows = sorted(map(tuple, labelled_sample(other, labels, "toxic", F.lit(True), 8).collect()))
        first = first or rows
        assert rows == first and len(rows) == 8


def test_toxicity_learns_from_every_label(spark, monkeypatch):
    """A toxic word that only one of very many documents has is learned, in more parts than one."""
    monkeypatch.setattr(toxicity, "PART", 100)
    rows = [(i, f"word{i % 40} " * 6 + ("horrid" if i % 4 == 0 else f"word{i % 31}"), int(i % 4 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = []
    real = toxicity.averaged
    monkeypatch.setattr(toxicity, "averaged", lambda r, *a: seen.append(r.count()) or real(r, *a))
    one = toxicity.learn(df, df.select("doc_id", "toxic"), F.lit(True))
    assert len(seen) == 1 + toxicity.ROUNDS and seen[0] < seen[1] == seen[2]
    kept = sum(1 for r in df.select(F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.HELD)).alias("k")).collect() if r.k == 0)
    assert seen[1] == 600 - kept
    again = toxicity.learn(df.repartition(5), df.select("doc_id", "toxic"), F.lit(True))
    assert np.array_equal(one.table, again.table) and one.cut == again.cut
    got = {r.doc_id: r.score for r in toxicity.score(df, one).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == bool(t) for i, _, t in rows)


def test_words_that_come_again_are_remembered(monkeypatch):
    words = toxicity.Words()
    texts = ["The cat, the DOG", "dog \u00c4hre x1", "cat \u00e4hre _y"]
    ids = [words.look_up(text) for text in texts]
    assert [i.tolist() for i in ids] == [[0, 1, 0, 2], [2, 3, 4], [1, 3, 5]]
    kept, old = words.frequent()
    assert list(kept.ids) == ["cat", "dog", "\u00e4hre"] and old.tolist() == [1, 2, 3]
    assert kept.look_up("new dog").tolist() == [3, 1]
    for word, k in kept.ids.items():
        assert tuple(kept.rows[k]) == toxicity.buckets_of(word)
    assert list(kept.frequent()[0].ids) == ["dog"]
    monkeypatch.setattr(toxicity, "REMEMBERED", 4)
    assert not words.frequent()[0].ids

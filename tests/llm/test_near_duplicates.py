"""The n-gram Jaccard join against all pairs, hot groups over many blocks, and odd tables."""

import re
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import near_duplicates as nd
from tidemark.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall(text or "")
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def plain(rows):
    """{row number: (class id, number of links, copy id)} from all pairs."""
    sets = [shingles(t) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    links = defaultdict(set)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in where[x]:
                common[j] += 1
        for j, n in common.items():
            if i != j and 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i].add(j)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        copies = [rows[j][0] for j in {i} | links[i] if sets[j] == sets[i] and rows[j][0] is not None]
        if not sets[i]:
            ids = copies = [x for x in [rows[i][0]] if x is not None]
        out[i] = (min(ids, default=None), len(links[i]), min(copies, default=None))
    return out


def check(got, rows):
    want = [(rows[i][0], *v) for i, v in plain(rows).items()]
    got = [(r.doc_id, r.class_id, r.n_links, r.copy_id) for r in got]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(QUERIES["op6_ngram_join"](spark, sf).collect(), rows)


def changed(words, rng, n):
    out = list(words)
    for at in rng.integers(0, len(out), n):
        out[at] = f"x{rng.integers(1_000_000)}"
    return " ".join(out)


@pytest.mark.parametrize("block", [1024, 7])
def test_groups(spark, block, monkeypatch):
    """Copies, near copies of near copies, a group over many blocks, and ids that repeat."""
    monkeypatch.setattr(nd, "BLOCK_NODES", block)
    rng = np.random.default_rng(3)
    base = [[f"w{rng.integers(3000)}" for _ in range(n)] for n in (150, 80, 12, 5, 3)]
    rows = [(i, changed(base[0], rng, rng.integers(0, 3))) for i in range(60)]
    rows += [(100 + i, changed(base[1], rng, i % 3)) for i in range(12)]
    rows += [(200 + i, " ".join(base[k])) for k in (1, 2, 3, 4) for i in range(k + 1)]
    rows += [(300, None), (301, ""), (302, ""), (None, " ".join(base[2])), (None, None)]
    rows += [(400, " ".join(base[2] + ["end"])), (400, " ".join(base[0])), (400, " ".join(base[0]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(nd.join(docs).collect(), rows)


def test_one_of_each(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(100)]
    rows = [(9, " ".join(base)), (3, changed(base, rng, 1)), (5, " ".join(base)), (7, "other text"), (8, "")]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, source string")
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]


def test_odd_tables(spark, odd):
    assert len(nd.join(odd).collect()) == odd.count()
    assert nd.join(odd.limit(0)).count() == 0
    assert nd.one_of_each(odd).columns == odd.columns


def test_depth_meets_the_target_recall():
    depth = nd.prefix_depth()
    assert 1 - (1 - 0.8**depth) ** nd.TREES >= nd.TARGET_RECALL
    assert 1 - (1 - 0.8 ** (depth + 1)) ** nd.TREES < nd.TARGET_RECALL or depth == nd.DEEPEST
    assert nd.prefix_depth(0.99) > depth


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    forest = nd.Forest(1, 400)
    a = np.unique(nd.mix(rng.integers(0, 1 << 62, 500).astype(np.uint64)))
    b = np.unique(np.concatenate([a[:400], nd.mix(rng.integers(0, 1 << 62, 100).astype(np.uint64))]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(np.mean(forest.keys(a) == forest.keys(b)) - true) < 0.08

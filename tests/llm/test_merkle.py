"""The manifest against a plain one that holds all leaves in lists."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_SMALL
from tidemark.llm import merkle
from tidemark.llm.queries import QUERIES


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def sized(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, n_chars):
    return H(*map(sized, (r.doc_id, r.source, r.lang, n_chars, r.text)))


def levels(nodes):
    found = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        found.append(nodes)
    return found


def climb(tree, at, value):
    siblings = []
    for nodes in tree[:-1]:
        run = nodes[at - at % 2 : at - at % 2 + 2]
        siblings += run[: at % 2] + run[at % 2 + 1 :]
        value = H(*run[: at % 2], value, *run[at % 2 + 1 :])
        at //= 2
    return value, siblings


def plain(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.n_chars), r))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang, held in by_lang.items():
        held.sort(key=lambda x: x[:3])
        trees[lang] = levels([x[2] for x in held])
    top = levels([trees[lang][-1][0] for lang in order])
    found = []
    for lang, held in by_lang.items():
        for at, (_, _, own, r) in enumerate(held):
            changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            given = leaf(r, r.n_chars + 1) if changed and r.n_chars is not None else own
            subroot, below = climb(trees[lang], at, given)
            root, above = climb(top, order.index(lang), subroot)
            found.append((r.doc_id, own, trees[lang][-1][0], top[-1][0], H(*below, *above), root, root == top[-1][0]))
    return sorted(found, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(docs):
    return sorted(map(tuple, merkle.manifest(docs).select(COLUMNS).collect()), key=repr)


def test_query_over_the_small_table(spark, documents):
    got = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, SF_SMALL).select(COLUMNS).collect()), key=repr)
    assert got == plain(documents.collect())
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(odd):
    """NULLs in every column, repeated rows, ties in doc_id, very long texts, clashing names."""
    tie = odd.filter("doc_id = 3").withColumn("text", F.lit("another text of the same id"))
    docs = odd.unionByName(tie)
    assert found(docs) == plain(docs.collect())


def test_empty_and_lone(spark, documents):
    assert merkle.manifest(documents.limit(0)).collect() == []
    lone = documents.filter("doc_id = 1")
    assert found(lone) == plain(lone.collect())
    (row,) = merkle.manifest(lone, F.lit(False)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == H() and row.verified


@pytest.mark.parametrize("height", [1, 2, 3])
def test_many_levels_of_blocks(documents, height):
    """Blocks of 2, 4 and 8 leaves: up to seven levels of blocks over 200 documents."""
    got = merkle.manifest(documents, height=height).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain(documents.collect())


def test_versions_share_what_they_do_not_change():
    leaves = [H(str(i)) for i in range(11)]
    tree = merkle.Tree(leaves, None)
    before = list(tree.digests)
    assert tree.digests[tree.root] == levels(leaves)[-1][0]
    for at in range(11):
        changed = [*leaves[:at], H("x"), *leaves[at + 1 :]]
        new = tree.with_leaf(at, H("x"))
        assert len(new) == tree.height + 1
        assert [tree.digests[n] for n in new] == [x[at >> k] for k, x in enumerate(levels(changed))]
    assert tree.digests[: len(before)] == before


def test_a_version_lists_the_copied_nodes(documents):
    rows = merkle.manifest(documents).collect()
    for r in rows:
        assert bool(r.version) == r.tampered
        assert not r.version or r.version[-1] == r.folded_root

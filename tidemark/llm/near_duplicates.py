"""N-gram Jaccard join with MinHash banding and exact verification.

A document is the set of its ``SHINGLE``-word shingles (all words, if it has fewer).
Documents with equal sets form a class of copies that goes on as one node.  A node has a
key in each of ``TREES`` bands; nodes with a common key are candidates.  All keys are made
of the same number of values, the most (up to ``DEEPEST``) with which a pair at the
threshold shares one with at least the target probability.  This is not a forest with
sorted prefixes: one stopped at that depth for all would give the same candidates.

The nodes under one prefix are compared in blocks of bounded size, so a group of any size
is spread over many tasks, and its pairs are never rows: a block emits a row per node,
with its number of links and the least node it hangs together with.  A pair is looked at
only in the first tree in which it shares a prefix, and nodes without such a pair in a
block do not go on to it.  Links are verified on the whole sets (64-bit hashes).

Defined results: texts without words link with nothing, each is a class of its own; very
long texts are read whole; ties are broken by the least id;
repeated rows and equal texts are copies of one class; rows with a NULL id are compared
too, a class is named by its least id; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, map_documents, map_groups, same_row, stored

SHINGLE = 5
#: The similarity from which two documents are linked, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
TREES = 16
DEEPEST = 8
TARGET_RECALL = 0.999
#: Nodes, and shingles of all nodes, in one side of a block.
BLOCK_NODES = 1024
BLOCK_SHINGLES = 1_500_000
#: Words a task remembers before it forgets them all; no result depends on it.
REMEMBERED = 300_000

U = np.uint64


def prefix_depth(
    similarity: float = NUMERATOR / DENOMINATOR, trees: int = TREES, target: float = TARGET_RECALL
) -> int:
    """The longest prefix with which a pair of that similarity is found often enough."""
    depth = DEEPEST
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < target:
        depth -= 1
    return depth


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(29))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Shingler:
    """Shingle sets of texts; remembers the hashes of words."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.hashes: dict[bytes, int] = {}

    def words(self, text: str | None) -> np.ndarray:
        words = text.encode().split() if text else []  # on ASCII white space only
        known = self.hashes
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), dtype=U, count=len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """The distinct shingle hashes, sorted."""
        words = self.words(text)
        size = min(self.size, len(words))
        if not size:
            return words
        places = len(words) - size + 1
        sums = np.full(places, size, dtype=U)
        for j in range(size):
            sums = mix(sums + words[j : j + places])
        return np.unique(sums)


class Forest:
    """Prefix keys of shingle sets: one for each tree."""

    def __init__(self, depth: int, trees: int = TREES):
        self.depth, self.trees = depth, trees
        self.factors = mix(np.arange(1, depth * trees + 1, dtype=U)) | U(1)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), ~U(0))
        for at in range(0, len(shingles), 2048):
            part = shingles[at : at + 2048, None] * self.factors
            least = np.minimum(least, part.min(axis=0))
        prefix = least.reshape(self.trees, self.depth)
        out = np.arange(self.trees, dtype=U)
        for level in range(self.depth):
            out = mix(out + prefix[:, level])
        return out.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``node``, ``n_shingles`` and ``keys`` of each row.

    ``node`` names the shingle set by 16 bytes; it is NULL for a text without words.
    """
    depth = prefix_depth()

    def make():
        shingler, forest = Shingler(), Forest(depth)

        def work(texts: pa.Array):
            nodes, sizes, keys = [], [], []
            for text in texts.to_pylist():
                own = shingler.shingles(text)
                nodes.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                sizes.append(len(own))
                keys.append(forest.keys(own).tobytes() if len(own) else None)
            return nodes, sizes, keys

        return work

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return map_documents(rows, make, "node binary, n_shingles int, keys binary")


def tree_key(keys: Column, tree: Column) -> Column:
    """One of the eight-byte keys, as hexadecimal text."""
    return F.hex(F.substring(keys, 8 * tree + 1, F.lit(8)))


def blocks(nodes: DataFrame) -> DataFrame:
    """The nodes under each shared prefix, dealt into blocks.

    ``tree``, ``bucket``, ``a``, ``b`` name a block: part ``a`` against part ``b`` of the
    nodes under a prefix; ``part`` is the row's own.
    """
    entries = nodes.select(
        "node",
        "n_shingles",
        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"),
        "keys",
    ).select("node", "n_shingles", "tree", F.xxhash64(tree_key(F.col("keys"), F.col("tree"))).alias("bucket"))
    entries = stored(entries, "entries")
    shared = (
        entries.groupBy("tree", "bucket")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
        .filter("n > 1")
    )
    n_parts = F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("size") / BLOCK_SHINGLES)).cast("int")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = (
        entries.join(shared.select("tree", "bucket", n_parts.alias("parts")), ["tree", "bucket"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    return dealt.select(
        "node", "tree", "bucket", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part"
    )


BLOCK = ["tree", "bucket", "a", "b"]


def first_pairs(batch: pa.RecordBatch) -> np.ndarray:
    """Which pairs of a block's rows share no prefix in an earlier tree; rows by rows."""
    tree = batch.column("tree")[0].as_py()
    keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), dtype=np.int64).reshape(-1, TREES)
    part = batch.column("part").to_numpy(zero_copy_only=False)
    pairs = np.triu(np.ones((len(part), len(part)), dtype=bool), 1)
    if batch.column("a")[0] != batch.column("b")[0]:
        pairs &= part[:, None] != part[None, :]
    for before in range(tree):
        pairs &= keys[:, None, before] != keys[None, :, before]
    return pairs


def needed(batch: pa.RecordBatch):
    """The rows of a block that have a pair to look at in it."""
    pairs = first_pairs(batch)
    rows = np.flatnonzero(pairs.any(axis=0) | pairs.any(axis=1))
    kept = batch.take(pa.array(rows))
    return [kept.column(c) for c in ("node", *BLOCK, "part", "keys", "copies")]


def common_counts(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """How many shingles the sets share, for the pairs asked for."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.int64)
    asked = np.argwhere(pairs)
    if len(asked) <= 4:
        for i, j in asked:
            out[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = often[column] > 1  # the others are in one set only
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, 4_000_000 // n)
    names = np.unique(column)
    for at in range(0, len(names), width):
        low, high = names[at], names[min(at + width, len(names)) - 1]
        own = slice(*np.searchsorted(column, (low, high + 1)))
        part = np.zeros((n, min(width, len(names) - at)), dtype=np.float32)
        part[row[own], np.searchsorted(names, column[own]) - at] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def verified(batch: pa.RecordBatch):
    """For each row of a block: links, documents linked, and its least linked node."""
    pairs = first_pairs(batch)
    sets = [np.frombuffer(s, dtype=U) for s in batch.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    both = common_counts(sets, pairs)
    linked = pairs & (DENOMINATOR * both >= NUMERATOR * (sizes[:, None] + sizes[None, :] - both))
    linked |= linked.T
    nodes = batch.column("node").to_pylist()
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    rank = np.empty(len(nodes), dtype=np.int64)
    rank[order] = np.arange(len(nodes))
    root = rank.copy()
    while True:  # the least rank that hangs together with each row
        least = np.where(linked, root[None, :], len(nodes)).min(axis=1, initial=len(nodes))
        new = np.minimum(root, least)
        new = np.minimum(new, new[np.array(order)[new]])
        if (new == root).all():
            break
        root = new
    copies = batch.column("copies").to_numpy(zero_copy_only=False)
    there = np.flatnonzero(linked.any(axis=1))
    return (
        [nodes[i] for i in there],
        linked[there].sum(axis=1),
        (linked[there] * copies[None, :]).sum(axis=1),
        [nodes[order[root[i]]] for i in there],
    )


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``shingles`` for rows ``(doc_id, text_key, node)``."""

    def make():
        shingler = Shingler()
        return lambda texts: [[shingler.shingles(t).tobytes() for t in texts.to_pylist()]]

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = (
        keyed.alias("d")
        .join(wanted.alias("w"), same_row("d", "w"))
        .select("w.node", "d.text")
        .dropDuplicates(["node"])
    )
    return map_documents(found, make, "shingles binary", slice_rows=64)


def join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``copy_id``, ``class_id``, ``class_node``, ``n_links`` of each row.

    ``copy_id`` is the least id with the same shingle set, ``class_id`` the least id that
    links lead to, ``n_links`` the number of other documents at or above the threshold.
    ``class_node`` names the class; it is NULL for a text without words.
    """
    rows = stored(signatures(docs), "signatures")
    nodes = stored(
        rows.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("copy_id"),
            F.count("*").alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("keys").alias("keys"),
            # NULL ids come last, so a node is found again by an id if it has one
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"),
        ),
        "nodes",
    )
    members = blocks(nodes).join(nodes.select("node", "keys", "copies"), "node")
    fields = "node binary, tree int, bucket long, a int, b int, part int, keys binary, copies long"
    asked = stored(map_groups(members, BLOCK, needed, fields), "asked")
    wanted = (
        asked.select("node").distinct().join(nodes, "node").select("row.doc_id", "row.text_key", "node")
    )
    sets = stored(shingle_sets(docs, wanted), "shingles")
    found = stored(
        map_groups(
            asked.join(sets, "node"), BLOCK, verified, "node binary, links long, documents long, least binary"
        ),
        "links",
    )
    roots = components(found.select(F.col("node").alias("u"), F.col("least").alias("v")), "near")
    counts = found.groupBy("node").agg(F.sum("documents").alias("documents"))
    named = nodes.join(roots, "node", "left").select(
        "node",
        "copy_id",
        "copies",
        F.coalesce("root", "node").alias("root")
    )
    least = named.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    classes = stored(
        named.join(least, "root")
        .join(counts, "node", "left")
        .select(
            "node",
            "root",
            "copy_id",
            "class_id",
            (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
        ),
        "classes",
    )
    return (
        rows.select("doc_id", "text_key", "node")
        .join(classes, "node", "left")
        .select(
            "doc_id",
            "text_key",
            F.col("root").alias("class_node"),
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        )
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns of ``docs``: that of the least id.

    Rows without words are classes of their own and stay.
    """
    found = stored(join(docs), "classes")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row")
    chosen = found.filter("class_node IS NOT NULL").groupBy("class_node").agg(least)
    kept = chosen.select("row.doc_id", "row.text_key").unionByName(
        found.filter("class_node IS NULL").select("doc_id", "text_key").distinct()
    )
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    rows = keyed.alias("d").join(kept.alias("k"), same_row("d", "k"), "left_semi")
    repeated = found.filter("class_node IS NOT NULL").groupBy("doc_id", "text_key").count().filter("count > 1")
    if repeated.limit(1).count():  # equal rows are one document; texts move only if there are any
        without = F.col("row.text").rlike("^[\\x20\\x09-\\x0D]*$") | F.col("row.text").isNull()
        rows = rows.filter(~without).dropDuplicates(["doc_id", "text_key"]).unionByName(rows.filter(without))
    return rows.select("row.*")

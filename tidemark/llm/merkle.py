"""Merkle manifest of a table: one leaf per row, one tree per language, one root above.

A leaf is the digest of its row.  Within a language, leaves are ordered by ``doc_id``
(NULL first, then by leaf); while more than one node remains, every ``FAN`` consecutive nodes become
their digest, the last run too if it is shorter.  The roots of the languages, ordered by
language (NULL first), are joined in the same way.

Trees are cut into aligned blocks of ``FAN ** HEIGHT`` leaves, each built by one task.  The tops of
the blocks are the leaves of the next level, which is cut again, until one node is left.

Changed leaves make *versions* of the tree.  Inside its block a version copies the ancestors
of its leaf and shares every other node with the tree it came from (path copying); from the
block's top it goes on along the siblings above, which no version changes.  A block holds at
most one version per leaf of it, however many leaves change.

Defined results: a NULL field is ``-`` in its leaf, an empty text is ``0:``; very long texts
are digested whole, by the JVM; repeated rows are leaves of their own and ties in ``doc_id``
are ordered by their leaves; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_groups, positions, stored

#: Nodes that become one, and levels of a block: 1,024 leaves.
FAN = 2
HEIGHT = 10
#: The columns of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sized(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(**changed: Column) -> Column:
    """Digest of a row; ``changed`` gives other values for some of its columns."""
    return F.sha2(F.concat(*(_sized(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def tampered_by(share: int = 7) -> Column:
    """Whether a document is one of those that are tampered with; a NULL id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % share == 0, F.lit(False))


def digest(parts) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Tree:
    """A persistent tree over some leaves: nodes are only added, a version is a root.

    ``height`` levels are built even if fewer would do (a block inside a larger tree);
    without it, as many as it takes to come to one node.
    """

    def __init__(self, leaves: list[str], height: int | None):
        self.digests: list[str] = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        level = list(range(len(leaves)))
        self.height = 0
        while len(level) > 1 if height is None else self.height < height:
            level = [self.node(tuple(level[i : i + FAN])) for i in range(0, len(level), FAN)]
            self.height += 1
        self.root = level[0]

    def node(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest(self.digests[c] for c in children))
        self.children.append(children)
        return len(self.digests) - 1

    def path(self, at: int) -> list[tuple[int, int]]:
        """(node, which child) from the root down to leaf ``at``."""
        steps, here = [], self.root
        for level in range(self.height - 1, -1, -1):
            turn = at // FAN**level % FAN
            steps.append((here, turn))
            here = self.children[here][turn]
        return steps

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Digests before and after the node on the way, from the leaf upwards."""
        runs = ((self.children[node], turn) for node, turn in reversed(self.path(at)))
        return [
            ("".join(self.digests[c] for c in run[:turn]), "".join(self.digests[c] for c in run[turn + 1 :]))
            for run, turn in runs
        ]

    def with_leaf(self, at: int, value: str) -> list[int]:
        """A version with another leaf: its new nodes, leaf first and root last."""
        self.digests.append(value)
        self.children.append(())
        new = [len(self.digests) - 1]
        for node, turn in reversed(self.path(at)):
            run = self.children[node]
            new.append(self.node((*run[:turn], new[-1], *run[turn + 1 :])))
        return new


def _block_height(size: int, height: int) -> int | None:
    """Levels of a block of a tree of ``size``; a tree of one block ends where one node is left."""
    return height if size > FAN**height else None


def _in_order(group: pa.RecordBatch) -> pa.RecordBatch:
    return group.take(pa.compute.sort_indices(group.column("position")))


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"position div {FAN**height}"))


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The node on top of each block, as a node of the next level."""

    def top(group: pa.RecordBatch):
        group = _in_order(group)
        tree, block, size = (group.column(c)[0].as_py() for c in ("tree", "block", "size"))
        built = Tree(group.column("digest").to_pylist(), _block_height(size, height))
        return [tree], [block], [-(-size // FAN**height)], [built.digests[built.root]]

    rows = _blocks(nodes, height).select("tree", "block", "position", "size", "digest")
    return map_groups(rows, ["tree", "block"], top, "tree string, position long, size long, digest string")


PATH = "array<struct<before:string,after:string>>"


def paths(nodes: DataFrame, largest: int, name: str, height: int) -> DataFrame:
    """``tree``, ``position``, ``path`` (siblings up to the root) and ``root`` of each node.

    ``largest`` is the size of the largest tree; each level has a row per block of the one below.
    """
    if largest <= 1:
        return nodes.select(
            "tree", "position", F.array().cast(PATH).alias("path"), F.col("digest").alias("root")
        )
    tops = stored(_tops(nodes, height), name)
    above = paths(tops, -(-largest // FAN**height), name, height)

    def extend(group: pa.RecordBatch):
        head, group, _ = _with_head(group)
        tree, size = group.column("tree")[0].as_py(), group.column("size")[0].as_py()
        built = Tree(group.column("digest").to_pylist(), _block_height(size, height))
        at = range(group.num_rows)
        found = [[*map(_step, built.siblings(i)), *head["path"]] for i in at]
        return [tree] * len(at), group.column("position"), found, [head["root"]] * len(at)

    rows = _under(nodes.select("tree", "position", "size", "digest"), above, height)
    return map_groups(rows, ["tree", "block"], extend, f"tree string, position long, path {PATH}, root string")


def _step(pair: tuple[str, str]) -> dict:
    return {"before": pair[0], "after": pair[1]}


def _under(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Nodes by block, each block with a head row that holds what is above its top."""
    head = above.select(
        "tree", F.col("position").alias("block"), F.lit(-1).cast("long").alias("position"), "path",
        *(c for c in above.columns if c not in ("tree", "position", "path")),
    )
    return _blocks(nodes, height).unionByName(head, allowMissingColumns=True)


def _with_head(group: pa.RecordBatch) -> tuple[dict, pa.RecordBatch, int]:
    group = _in_order(group)
    return group.slice(0, 1).to_pylist()[0], group.slice(1), group.num_rows - 1


def _climb(value: str, path: list[dict]) -> list[str]:
    """The digests from ``value`` up to the root."""
    found = []
    for step in path:
        value = digest((step["before"], value, step["after"]))
        found.append(value)
    return found


ROWS = (
    "doc_id long, lang string, position long, leaf string, subroot string, root string, "
    "proof_sha256 string, tampered boolean, folded_root string, verified boolean, version array<string>"
)


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per document with its leaf, its roots and the digest of its proof.

    ``tampered`` chooses the documents whose ``n_chars`` is one more; each makes a version.
    ``folded_root`` is the root of that version, or of the untouched tree; ``version`` lists
    the nodes that the version does not share, from its leaf's parent to its root.
    """
    tampered = tampered_by() if tampered is None else tampered
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
        "doc_id",
        leaf().alias("digest"),
        F.when(tampered, leaf(n_chars=more)).alias("changed"),
    )
    leaves = stored(leaves, "merkle-rows")  # sorting reads twice, but not the texts
    nodes = positions(leaves, ["doc_id", "digest"], "merkle-leaves")
    largest = nodes.agg(F.max("size")).first()[0] or 0
    if not largest:
        return docs.sparkSession.createDataFrame([], ROWS)
    tops = stored(_tops(nodes, height), "merkle-tops")
    above = stored(paths(tops, -(-largest // FAN**height), "merkle-tops", height), "merkle-paths")

    # the tree over the languages
    roots = above.filter("position = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("root").alias("digest")
    )
    roots = positions(roots, ["lang"], "merkle-roots")
    trees = roots.agg(F.max("size")).first()[0]
    highest = paths(roots.select("tree", "position", "size", "digest"), trees, "merkle-upper", height)
    highest = roots.select("position", F.col("lang").alias("tree")).join(
        highest.select("position", F.col("path").alias("upper"), F.col("root").alias("top")), "position"
    )
    above = above.join(highest.drop("position"), "tree")

    def rows(group: pa.RecordBatch):
        head, group, n = _with_head(group)
        path, upper = head["path"], head["upper"]
        subroot, root = head["root"], head["top"]
        values, changes = group.column("digest").to_pylist(), group.column("changed").to_pylist()
        built = Tree(values, _block_height(group.column("size")[0].as_py(), height))
        higher = [*path, *upper]
        rest = "".join(step["before"] + step["after"] for step in higher)
        proofs, folded, versions = [], [], []
        for at, change in enumerate(changes):
            proofs.append(digest([*(b + a for b, a in built.siblings(at)), rest]))
            if change is None:
                versions.append([])
                folded.append(root)  # no node differs from the tree's own
                continue
            new = built.with_leaf(at, change)
            version = [built.digests[node] for node in new]
            version += _climb(version[-1], higher)
            versions.append(version[1:])
            folded.append(version[-1])
        name = group.column("tree")[0].as_py()
        lang = None if name == "-" else name[1:]
        return (
            group.column("doc_id"), [lang] * n, group.column("position"), values, [subroot] * n, [root] * n,
            proofs, [c is not None for c in changes], folded, [f == root for f in folded], versions,
        )

    return map_groups(_under(nodes, above, height), ["tree", "block"], rows, ROWS)

"""Prefix trie of conversations: which share how many of their first turns.

Conversations are sorted by their turns.  Those that begin with the same ``d`` turns then lie
next to each other, and a node of the trie is such an interval.  With the *longest common
prefix* (LCP) of each neighbouring pair, the interval of a prefix goes as far to the left and
to the right as the least LCP on the way is ``d`` or more.  Each candidate prefix finds both
ends by itself, by binary search over a sparse table of range minima; what a node counts
comes from prefix sums over its interval.

The order is cut into blocks, of which one task handles many, one after the other.  A prefix
whose interval ends inside its block is finished there.  One that reaches the block's first
or last conversation may go on beyond it and stays *open*: the first and last conversations
of all blocks, with the LCPs between them, are again a sequence in which open prefixes look
for their ends, again in blocks, until one block is left.  Open prefixes are at most the
turns of two conversations a block.

Turns are compared by 128 bits of their SHA-256.  One conversation fits into a task, as one
text does; nothing else is held whole, neither a subtree nor the copies of a conversation.

Defined results: a NULL role or text is empty; turns of equal number are ordered by their
digests; rows without ``conv_id`` belong to no conversation; very long texts are digested
whole by the JVM; repeated rows are turns of their own; an empty table gives no row; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import arrow_schema, map_groups, positions, ship, stored

#: Bytes of a turn's digest.
WIDTH = 16
#: Conversations and turns after which a block ends; blocks that meet in one of the next level.
CONVERSATIONS, TURNS, BLOCKS = 4096, 1 << 17, 1024
#: Conversations whose beginning others take over, and the most turns they take.
FAMILY, MOST_SHARED = 5, 8

EMPTY = sha256(b"").hexdigest()


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` with its turns in order: their digests and UTF-8 sizes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    token = F.substring(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text), 256), 1, 2 * WIDTH)
    rows = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", token.alias("token"), F.octet_length(text).cast("long").alias("size")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.col("t.token").alias("tokens"), F.col("t.size").alias("sizes")
    )


def share_beginnings(convs: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first one of their family.

    ``conv_id`` c takes ``crc32(c) mod 9`` first turns of ``c - c mod 5`` (none if that does
    not exist) in place of as many of its own.
    """
    first = convs.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_first"),
        *(F.slice(c, 1, MOST_SHARED).alias(f"_{c}") for c in ("tokens", "sizes")),
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    joined = convs.withColumn("_h", shared).join(
        first, F.col("_first") == F.col("conv_id") - F.col("conv_id") % FAMILY, "left"
    )

    def taken(name: str) -> Column:
        head = F.coalesce(f"_{name}", F.array().cast(dict(convs.dtypes)[name]))
        own = F.slice(name, F.col("_h") + 1, F.greatest(F.size(name), F.lit(0)))
        return F.concat(F.slice(head, F.lit(1), F.col("_h")), own).alias(name)

    return joined.select("conv_id", taken("tokens"), taken("sizes"))


class RangeMinima:
    """Sparse table of the least value of every run of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The least value from ``left`` to ``right``, both included."""
        k = np.frexp(right - left + 1)[1] - 1
        found = np.empty(len(left), self.rows[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.rows[level]
            found[at] = np.minimum(row[left[at]], row[right[at] - (1 << int(level)) + 1])
        return found

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far left of ``at`` one can go while every value passed is ``least`` or more."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            start = at - (1 << k) + 1
            ok = start >= 0
            ok[ok] = self.rows[k][start[ok]] >= least[ok]
            at[ok] -= 1 << k
        return at

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        at = at.copy()
        size = len(self.rows[0])
        for k in range(len(self.rows) - 1, -1, -1):
            ok = at + (1 << k) < size
            ok[ok] = self.rows[k][at[ok] + 1] >= least[ok]
            at[ok] += 1 << k
        return at


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def _between(sums: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sum of the values at ``left`` to ``right``, both included."""
    return sums[right + 1] - sums[left]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with alike."""
    n = min(len(a), len(b)) // WIDTH
    x = np.frombuffer(a, np.uint64, 2 * n).reshape(-1, 2)
    y = np.frombuffer(b, np.uint64, 2 * n).reshape(-1, 2)
    unlike = np.flatnonzero((x != y).any(axis=1))
    return int(unlike[0]) if len(unlike) else n


def _keys(sequence: bytes) -> list[bytes]:
    """A name for each prefix, the empty one first."""
    found = [sha256(b"").digest()[:WIDTH]]
    for at in range(0, len(sequence), WIDTH):
        found.append(sha256(found[-1] + sequence[at : at + WIDTH]).digest()[:WIDTH])
    return found


#: What is known of an open prefix inside a run of conversations.
OPEN = (
    "struct<side:int,depth:long,key:binary,conv_id:long,n_convs:long,n_ends:long,total:long,new:long,"
    "leaf_pairs:long,child_pairs:long,more:boolean,first_total:long,before:long>"
)
RUN = f"struct<part:int,block:long,first:binary,sums:array<bigint>,last:binary,lcp:long,open:array<{OPEN}>>"
NODE = (
    "conv_id long, depth long, parent_conv_id long, parent_key binary, key binary, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, n_ends long, ends_sha256 string"
)
ROWS = f"{NODE}, run {RUN}, ids struct<key:binary,part:int,block:long,text:string>"
_NODE_FIELDS = [field.split()[0] for field in NODE.split(", ")]


def _counts(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What a node shows, from sums over its interval.

    Over the subtree, members times bytes are the members' bytes from the node's own turn on;
    each turn's bytes once are those of the leftmost member and the new ones of the others.
    """
    once = c["new"] + c["first_total"] - c["before"]
    return {
        "n_children": c["child_pairs"] + c["more"],
        "n_leaves": c["leaf_pairs"] + 1,
        "saved_tokens": c["total"] - c["n_convs"] * c["before"] - once,
    }


def _block(ids: np.ndarray, seqs: list[bytes], sizes: np.ndarray) -> tuple[dict, dict, list[tuple[bytes, str]]]:
    """Finished nodes, the open rest, and the ids that end in open prefixes."""
    m = len(seqs)
    lens = np.array([len(s) for s in seqs], np.int64) // WIDTH
    starts = _sums(lens)[:-1]
    flat = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    bytes_before = _sums(sizes)

    def up_to(i, depth):  # bytes of the first ``depth`` turns
        return bytes_before[starts[i] + depth] - bytes_before[starts[i]]

    lcp = np.zeros(m, np.int64)
    lcp[0] = -1
    limit = np.minimum(lens[:-1], lens[1:])
    active, k = np.flatnonzero(limit > 0), 0
    while len(active):
        same = (flat[starts[active] + k] == flat[starts[active + 1] + k]).all(axis=1)
        active, k = active[same], k + 1
        lcp[active + 1] += 1
        active = active[limit[active] > k]

    # a candidate for each prefix that its left neighbour does not have
    counts = lens - lcp
    offsets = _sums(counts)[:-1]
    at = np.repeat(np.arange(m), counts)
    depth = np.arange(len(at)) - offsets[at] + lcp[at] + 1

    def index(left, depth):
        return offsets[left] + depth - lcp[left] - 1

    table = RangeMinima(lcp)
    left, right = table.left(at, depth), table.right(at, depth)
    total = up_to(np.arange(m), lens)
    new = total - up_to(np.arange(m), np.maximum(lcp, 0))
    leaf_pair = np.concatenate([[False], lcp[1:] < lens[:-1]])
    starts_child = np.flatnonzero((lens > lcp) & (np.arange(m) > 0))
    child = index(table.left(starts_child, lcp[starts_child]), lcp[starts_child])
    copies = np.concatenate([[True], (lcp[1:] != lens[:-1]) | (lcp[1:] != lens[1:])])
    group = np.cumsum(copies) - 1
    ends = np.where(lens[left] == depth, np.bincount(group)[group[left]], 0)
    c = {
        "depth": depth,
        "conv_id": RangeMinima(ids).least(left, right),
        "n_convs": right - left + 1,
        "n_ends": ends,
        "total": _between(_sums(total), left, right),
        "new": _between(_sums(new), left + 1, right),
        "leaf_pairs": _between(_sums(leaf_pair), left + 1, right),
        "child_pairs": np.bincount(child, minlength=len(at)),
        "more": lens[left] > depth,
        "first_total": total[left],
        "before": up_to(left, np.maximum(depth - 1, 0)),
    }
    is_open = (left == 0) | (right == m - 1)
    above = np.maximum(depth - 1, 0)
    parent = index(table.left(left, above), above)
    keys = _keys(seqs[0]), _keys(seqs[-1])
    side = (left > 0).astype(int)
    nodes = _nodes(c, ~is_open, is_open, parent, lambda i: keys[side[i]][depth[i]])
    nodes["key"] = [None] * len(nodes["depth"])
    nodes["ends_sha256"] = [
        sha256(",".join(map(str, ids[i : i + n])).encode()).hexdigest() if n else EMPTY
        for i, n in zip(left[~is_open].tolist(), ends[~is_open].tolist())
    ]
    c["side"] = side
    c["key"] = np.array([keys[side[i]][depth[i]] if is_open[i] else None for i in range(len(at))], object)
    held = [
        (c["key"][i], ",".join(map(str, ids[left[i] : left[i] + ends[i]])))
        for i in np.flatnonzero(is_open & (ends > 0))
    ]
    run = {
        "first": seqs[0],
        "sums": up_to(0, np.arange(lens[0] + 1)).tolist(),
        "last": seqs[-1],
        "lcp": int(lcp[1:].min()) if m > 1 else int(lens[0]),
        "open": _open(c, is_open),
    }
    return nodes, run, held


def _nodes(c, done, is_open, parent, key) -> dict:
    """Columns of the nodes ``done``; a parent that is still open is given by its key."""
    at = np.flatnonzero(done)
    known, top = ~is_open[parent[at]], c["depth"][at] == 0
    ids = c["conv_id"][parent[at]].tolist()
    counts = _counts(c)
    return {
        **{name: c[name][at] for name in ("conv_id", "depth", "n_convs", "n_ends")},
        **{name: counts[name][at] for name in counts},
        "parent_conv_id": [i if k and not t else None for i, k, t in zip(ids, known, top)],
        "parent_key": [
            None if k or t else key(p) for p, k, t in zip(parent[at].tolist(), known, top)
        ],
    }


def _open(c: dict[str, np.ndarray], is_open: np.ndarray) -> list[dict]:
    at = np.flatnonzero(is_open)
    names = list(c)
    return [dict(zip(names, row)) for row in zip(*(c[n][at].tolist() for n in names))]


def _merge(runs: list[dict], last: bool) -> tuple[dict, dict | None]:
    """Finished nodes and the open rest of runs that follow each other."""
    q = len(runs)
    lcp = np.full(2 * q, -1, np.int64)
    lcp[1::2] = [r["lcp"] for r in runs]
    lcp[2::2] = [_common(a["last"], b["first"]) for a, b in zip(runs, runs[1:])]
    table = RangeMinima(lcp)

    # what a pair of neighbouring runs adds to every node that holds both
    new, leaf_pair = np.zeros(2 * q, np.int64), np.zeros(2 * q, np.int64)
    begins = []
    for j in range(1, q):
        shared, sums = int(lcp[2 * j]), runs[j]["sums"]
        new[2 * j] = sums[-1] - sums[shared]
        leaf_pair[2 * j] = shared < len(runs[j - 1]["last"]) // WIDTH
        if len(sums) - 1 > shared:
            begins.append(2 * j)
    begins = np.array(begins, np.int64)

    parts = [(2 * j + o["side"], o) for j, r in enumerate(runs) for o in r["open"]]
    at = np.array([p[0] for p in parts], np.int64)
    depth = np.array([p[1]["depth"] for p in parts], np.int64)
    left, right = table.left(at, depth), table.right(at, depth)
    wide = int(depth.max()) + 1
    order = np.lexsort((at, depth, left))
    codes, first, group = np.unique((left * wide + depth)[order], return_index=True, return_inverse=True)
    leads = order[first]  # the leftmost part of each node
    left, right = left[leads], right[leads]

    def column(name):
        return np.array([p[1][name] for p in parts])

    def added(name):
        total = np.zeros(len(codes), np.int64)
        np.add.at(total, group, column(name)[order])
        return total

    c = {name: added(name) for name in ("n_convs", "n_ends", "total", "new", "leaf_pairs", "child_pairs")}
    c["new"] += _between(_sums(new), left + 1, right)
    c["leaf_pairs"] += _between(_sums(leaf_pair), left + 1, right)
    if len(begins):
        at_border = lcp[begins]
        np.add.at(c["child_pairs"], np.searchsorted(codes, table.left(begins, at_border) * wide + at_border), 1)
    c["conv_id"] = np.full(len(codes), np.iinfo(np.int64).max)
    np.minimum.at(c["conv_id"], group, column("conv_id")[order])
    for name in ("depth", "more", "first_total", "before"):
        c[name] = column(name)[leads]
    c["key"] = np.array([parts[i][1]["key"] for i in leads], object)
    c["side"] = (left > 0).astype(int)

    is_open = np.zeros(len(codes), bool) if last else (left == 0) | (right == 2 * q - 1)
    above = np.maximum(c["depth"] - 1, 0)
    parent = np.searchsorted(codes, table.left(left, above) * wide + above)
    nodes = _nodes(c, ~is_open, is_open, parent, lambda i: c["key"][i])
    nodes["key"] = c["key"][~is_open].tolist()
    nodes["ends_sha256"] = [None if n else EMPTY for n in nodes["n_ends"].tolist()]
    run = None if last else {
        "first": runs[0]["first"], "sums": runs[0]["sums"], "last": runs[-1]["last"],
        "lcp": int(lcp[1:].min()), "open": _open(c, is_open),
    }
    return nodes, run


def _rows(nodes: dict, run: dict | None, held: list[dict]) -> list:
    """Columns of ``ROWS``: the nodes, then the run, then the ids that end in open prefixes."""
    n, tail = len(nodes["depth"]), [run] if run else []
    more = [None] * (len(tail) + len(held))
    columns = [list(nodes[name]) + more for name in _NODE_FIELDS]
    return [*columns, [None] * n + tail + [None] * len(held), [None] * (n + len(tail)) + held]


def _blocks(sorted_rows: DataFrame) -> DataFrame:
    ship(sorted_rows.sparkSession)
    schema = arrow_schema(StructType.fromDDL(ROWS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, rows, turns = TaskContext.get().partitionId(), 0, [], 0, 0

        def result():
            whole = pa.Table.from_batches(held).combine_chunks()
            sizes = whole.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            nodes, run, ends = _block(
                whole.column("conv_id").to_numpy(), whole.column("seq").to_pylist(), sizes.astype(np.int64)
            )
            run |= {"part": part, "block": block}
            ids = [{"key": k, "part": part, "block": block, "text": t} for k, t in ends]
            columns = _rows(nodes, run, ids)
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            lens = pa.compute.list_value_length(batch.column("sizes")).to_pylist()
            begin = 0
            for i, n in enumerate(lens):
                rows, turns = rows + 1, turns + n
                if rows >= CONVERSATIONS or turns >= TURNS:
                    held.append(batch.slice(begin, i + 1 - begin))
                    yield result()
                    begin, block, held, rows, turns = i + 1, block + 1, [], 0, 0
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield result()

    return sorted_rows.mapInArrow(work, ROWS)


def _joined_ids(ids: DataFrame) -> DataFrame:
    """``key`` and the digest of its ids, which come as texts in order of ``part`` and ``block``.

    A task reads its texts one after the other and holds one digest.
    """
    schema = StructType.fromDDL("key binary, joined string")
    arrow = arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = k, sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in done], schema=arrow)
        if state:
            yield pa.RecordBatch.from_pylist([{"key": key, "joined": state.hexdigest()}], schema=arrow)

    return ids.repartition("key").sortWithinPartitions("key", "part", "block").mapInArrow(work, schema)


def trie(convs: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """One row per distinct prefix of the conversations of ``conversations()``.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes that sharing saves in the subtree),
    ``n_ends`` and ``ends_sha256`` (of the ids of the members that end here, ascending).
    """
    rows = convs.select("conv_id", F.unhex(F.array_join("tokens", "")).alias("seq"), "sizes")
    ordered = (
        stored(rows, "trie-rows")  # sorting reads twice, but not the turns
        .repartitionByRange("seq", "conv_id")
        .sortWithinPartitions("seq", "conv_id")
    )
    lowest = stored(_blocks(ordered), "trie-blocks")
    runs = lowest.filter("run IS NOT NULL").select("run.*")
    n = runs.count()
    higher = lowest.filter("false").select(*_NODE_FIELDS)
    while n:
        last = n <= blocks

        def merged(group: pa.RecordBatch, last=last):
            group = group.take(pa.compute.sort_indices(group.column("position")))
            nodes, run = _merge(group.to_pylist(), last)
            if run:
                run |= {"part": 0, "block": group.column("chunk")[0].as_py()}
            return _rows(nodes, run, [])

        placed = positions(runs.withColumn("tree", F.lit("")), ["part", "block"], "trie-runs")
        chunks = placed.withColumn("chunk", F.expr(f"position div {blocks}")).drop("tree", "size")
        level = stored(map_groups(chunks, ["chunk"], merged, ROWS), "trie-level")
        higher = higher.unionByName(level.filter("depth IS NOT NULL").select(*_NODE_FIELDS))
        runs, n = level.filter("run IS NOT NULL").select("run.*"), 0 if last else -(-n // blocks)

    ids = _joined_ids(lowest.filter("ids IS NOT NULL").select("ids.*"))
    higher = stored(
        higher.join(ids, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", "joined"))
        .drop("joined"),
        "trie-higher",
    )
    nodes = lowest.filter("depth IS NOT NULL").select(*_NODE_FIELDS).unionByName(higher)
    # a parent that was open is one of the few higher nodes; many nodes may share it
    parents = higher.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    found = nodes.filter("parent_key IS NOT NULL").join(parents, "parent_key")
    found = found.withColumn("parent_conv_id", F.col("_parent")).drop("_parent")
    whole = nodes.filter("parent_key IS NULL").unionByName(found)
    return whole.drop("key", "parent_key")

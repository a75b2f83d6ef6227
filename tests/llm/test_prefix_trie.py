"""The trie against a plain one that holds every prefix in a dictionary."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF_SMALL
from tidemark.llm import prefix_trie
from tidemark.llm.queries import QUERIES

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def rebuilt(rows):
    """Conversations of rows, whose turns are ordered like the operator orders ties."""
    own = {}
    for r in rows:
        if r.conv_id is not None:
            turn = (r.role or "", r.text or "")
            token = sha256(f"{len(turn[0].encode())}:{turn[0]}:{turn[1]}".encode()).hexdigest()[:32]
            own.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, token, turn))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    found = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        found[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return found


def plain(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    found = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) or 1
        saved[p] = sum(saved[x] for x in below) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        found.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves[p],
            saved[p], sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def got(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


def found(turns, **more):
    return got(prefix_trie.trie(prefix_trie.share_beginnings(prefix_trie.conversations(turns)), **more))


def test_query_over_the_small_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    assert got(QUERIES["op12_prefix_trie"](spark, SF_SMALL)) == plain(rebuilt(rows))


SCHEMA = "conv_id long, turn long, role string, text string, key int, seq string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def test_odd_rows(spark):
    """NULLs everywhere, equal turns, repeated rows, very long texts and conversations."""
    rows = [
        (0, 0, "user", "hello"), (0, 1, None, "again"), (0, None, "system", None), (0, 1, "user", "tie"),
        (1, 0, "user", "own"), (None, 0, "user", "nobody's"), (2, None, None, None), (3, 5, "user", "x" * 300_000),
        (3, 5, "user", "x" * 300_000), (7, 0, "user", ""), (-5, 0, "user", "negative"),
        *[(c, t, "user", f"t{t % 7}é") for c in (10, 11, 12, 14) for t in range(700)],
        *[(c, t, "user", f"same {t}") for c in range(100, 400, 3) for t in range(10)],
    ]
    turns = frame(spark, rows)
    want = plain(rebuilt(turns.collect()))
    assert found(turns) == want


def test_empty_and_lone(spark):
    assert found(frame(spark, [])) == []
    lone = frame(spark, [(8, 0, "user", "a"), (8, 1, "user", "b")])
    assert found(lone) == plain(rebuilt(lone.collect()))


@pytest.mark.parametrize("blocks", [2, 3])
def test_many_levels_of_blocks(spark, blocks):
    """Copies and prefixes over many small runs, merged two or three at a time."""
    rows = []
    for c in range(240):
        shape = [0] * 9 if c % 3 == 0 else [(c // 3) % 2, (c // 7) % 3, c % 4, 0, 0, (c // 50)][: c % 7]
        rows += [(5 * c + 1, t, "user", f"{x} {t}") for t, x in enumerate(shape)]
    turns = frame(spark, rows)
    convs = prefix_trie.conversations(turns).repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        want = plain({c: own for c, own in originals(rows).items()})
        assert got(prefix_trie.trie(convs, blocks=blocks)) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def originals(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        own.setdefault(c, []).append((turn, (role, text)))
    return {c: [x[1] for x in sorted(t)] for c, t in own.items()}


def in_blocks(convs, size, fan):
    """The trie without Spark: blocks of ``size`` conversations, ``fan`` of which are merged."""
    def tokens(turns):
        return b"".join(sha256(repr(t).encode()).digest()[: prefix_trie.WIDTH] for t in turns)

    order = sorted((tokens(t), c) for c, t in convs.items())
    runs, nodes, texts = [], [], {}

    def note(columns):
        names = list(columns)
        nodes.extend(dict(zip(names, row)) for row in zip(*(list(columns[n]) for n in names)))

    for at in range(0, len(order), size):
        part = order[at : at + size]
        sizes = [len(t[1].encode()) for _, c in part for t in convs[c]]
        columns, run, held = prefix_trie._block(
            np.array([c for _, c in part]), [s for s, _ in part], np.array(sizes, np.int64))
        note(columns)
        runs.append(run)
        for key, text in held:
            texts.setdefault(key, []).append(text)
    while runs:
        last = len(runs) <= fan
        merged = [prefix_trie._merge(runs[i : i + fan], last) for i in range(0, len(runs), fan)]
        for columns, _ in merged:
            note(columns)
        runs = [] if last else [r for _, r in merged]
    parents = {n["key"]: n["conv_id"] for n in nodes if n["key"]}
    for n in nodes:
        if n["parent_key"] is not None:
            n["parent_conv_id"] = parents[n["parent_key"]]
        if n["ends_sha256"] is None:
            n["ends_sha256"] = sha256(",".join(texts[n["key"]]).encode()).hexdigest()
    return sorted((tuple(n[c] for c in COLUMNS) for n in nodes), key=repr)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abc"), max_size=5), min_size=1, max_size=30),
    st.integers(1, 6),
    st.integers(2, 4),
)
def test_any_split_into_blocks(shapes, size, fan):
    convs = {7 * i % 101: [("user", x) for x in shape] for i, shape in enumerate(shapes)}
    assert in_blocks(convs, size, fan) == plain(convs)


@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.data())
def test_range_minima(values, data):
    table = prefix_trie.RangeMinima(np.array(values))
    at = np.arange(len(values))
    least = np.array([data.draw(st.integers(0, 6)) for _ in values])
    for i, l, r in zip(at, table.left(at, least), table.right(at, least)):
        assert min(values[l + 1 : i + 1], default=9) >= least[i] and (l < 0 or values[l] < least[i])
        assert min(values[i + 1 : r + 1], default=9) >= least[i]
        assert r == len(values) - 1 or values[r + 1] < least[i]

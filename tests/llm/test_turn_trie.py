"""The prefix trie of rebuilt conversations against a trie of whole texts."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import types as T
from tidemark.llm import turn_trie
from tidemark.llm.turn_trie import FingerprintClash, prefix_products, prefix_trie

TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("depth", T.StringType())]
)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.fixture(scope="module")
def frame(spark):
    """Rows (conv_id, turn, role, text), with one more column whose name clashes with an output's."""
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], TURNS)


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) if kids[path] else 1
        saved[path] = sum(saved[k] for k in kids[path]) + ((len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in own if len(paths[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        out.append((own[0], len(path), parent, len(own), len(kids[path]), leaves[path], saved[path], sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie(frame).collect()), key=lambda r: (r[0], r[1]))


def test_trie_of_odd_conversations(frame):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "é"), (1, None, "user", "a"), (1, 3, None, "b"), (2, 0, "user", None), (2, 0, "user", None), (3, 0, None, None)]
    rows += [(None, 0, "user", "lost"), (13, 0, "user", "x"), (13, 0, "assistant", "x"), (21, 0, "user", "no base"), (10**15 + 1, 5, "user", "far")]
    assert found(frame(rows)) == plain(rows)
    assert found(frame([])) == []


def test_random_conversations(frame):
    pick = random.Random(7)
    rows = [(c, t, pick.choice(["user", "assistant"]), pick.choice(["", "a", "b" * t])) for c in range(0, 300) if c % 7 for t in range(pick.randrange(14))]
    pick.shuffle(rows)
    assert found(frame(rows)) == plain(rows)


def test_one_conversation_over_many_tasks(spark, frame):
    rows = [(5, t, "user", f"t{t % 3}") for t in range(3000)] + [(c, t, "user", "t0") for c in (4, 6, 7) for t in range(12)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        products = prefix_products(turn_trie.keyed_turns(frame(rows), 0)).collect()
        assert found(frame(rows)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    own = sorted((r for r in products if r.conv_id == 5), key=lambda r: r.pos)
    assert [r.pos for r in own] == list(range(1, 3001)) and own[-1].cum == 6000
    assert all(r.power0 == pow(turn_trie.BASES[0], r.pos, turn_trie.PRIMES[0]) for r in own)


def test_clashes_are_found(frame, monkeypatch):
    rows = [(c, t, "user", f"{c}{t}") for c in (1, 2, 3) for t in range(12)]
    for name in ("BASES", "PRIMES"):
        assert len(set(getattr(turn_trie, name))) == 4
    keyed = turn_trie.keyed_turns
    tries = []

    def weak(frame, seed):
        tries.append(seed)
        made = keyed(frame, seed)
        return made.selectExpr("* EXCEPT (key0, key1)", "key0 % 2 AS key0", "0L AS key1") if seed < 1 else made

    monkeypatch.setattr(turn_trie, "keyed_turns", weak)
    assert found(frame(rows)) == plain(rows) and tries == [0, 1]
    monkeypatch.setattr(turn_trie, "SEEDS", 1)
    with pytest.raises(FingerprintClash):
        prefix_trie(frame(rows))


def test_trie_of_the_given_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert found(table) == plain(rows)

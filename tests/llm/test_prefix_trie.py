"""The prefix trie against one built in plain Python, and its parts one by one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weirflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def turns_of(rows):
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in kept.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = [] if c is None else convs.get(c - c % 100, [])
        out[c] = base[:h] + own[h:]
    return out


def by_hand(convs):
    rank = lambda c: (c is not None, c or 0)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    least = lambda path: min((c for c in members[path] if c is not None), default=None)
    out = []
    below = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        leaves = sum(below[k][0] for k in children[path]) or 1
        saved = own + sum(below[k][1] for k in children[path])
        below[path] = leaves, saved
        ids = ",".join("" if c is None else str(c) for c in sorted(ends[path], key=rank))
        out.append((
            least(path), len(path), least(path[:-1]) if path else None, len(members[path]), len(children[path]),
            leaves, saved, hashlib.sha256(ids.encode()).hexdigest(),
        ))
    return sorted(map(repr, out))


def built(rows, paths=prefix_trie.shared_start_paths):
    return sorted(repr(tuple(r)) for r in prefix_trie.trie(*paths(rows)).collect())


def conversations(rng, n, texts=4, most=7):
    return [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "é😀", "one", "two words"][:texts]))
        for c in rng.sample(range(-150, 500), n)
        for t in range(rng.randrange(1, most))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = conversations(random.Random(seed), 120)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert built(frame) == by_hand(rebuilt(turns_of(rows)))
    assert built(frame, prefix_trie.whole_paths) == by_hand(turns_of(rows))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (None, 0, "user", "x"), (None, None, None, None), (3, None, "user", "b"), (3, None, "user", "a"),
        (3, 1, "user", "same"), (3, 1, "user", "same"), (200, 0, "a", "t"), (201, 0, "a", "t"), (7, 5, "a", "only"),
    ]
    names = ["cid", "depth", "length", "range", "place", "next", "h1", "k1"]
    frame = spark.createDataFrame([(*r, *names) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    assert built(frame) == by_hand(rebuilt(turns_of(rows)))


def test_empty_table(spark):
    assert prefix_trie.trie(*prefix_trie.shared_start_paths(spark.createDataFrame([], SCHEMA))).count() == 0


def test_one_conversation_of_many_turns_and_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEPTH_BLOCK", 16)
    rows = [(1, t, "user", f"t{t % 3}") for t in range(100)] + [(2, t, "user", f"t{t % 3}") for t in range(70)]
    rows += [(3, t, "user", f"t{t % 3}" if t != 40 else "long " * 200_000) for t in range(60)]
    got = built(spark.createDataFrame(rows, SCHEMA), prefix_trie.whole_paths)
    assert got == by_hand(turns_of(rows))


def test_many_equal_conversations_and_many_children(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_PIECE", 8)
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(c, 0, "user", "hi") for c in range(1000, 1300)]
    rows += [(c, 1, "user", f"{c}") for c in range(1000, 1300)]
    got = built(spark.createDataFrame(rows, SCHEMA), prefix_trie.whole_paths)
    assert got == by_hand(turns_of(rows))


@pytest.mark.parametrize("near", ["order", "mixed"])
def test_list_rank(spark, near):
    """Neighbours in order shorten range by range; mixed ones go on by pointer doubling."""
    n, rng = 500, random.Random(4)
    ids = rng.sample(range(10_000), n)
    places = list(range(n)) if near == "order" else rng.sample(range(n), n)
    rows = [(ids[i], ids[i + 1] if i + 1 < n else None, places[i]) for i in range(n)]
    frame = spark.createDataFrame(rows, "id long, next long, place long").repartition(3)
    got = {r.id: r.position for r in prefix_trie.list_rank(frame, ["place"], least=20, most=40).collect()}
    assert got == {v: i for i, v in enumerate(ids)}


def test_running_sums_over_several_levels_of_blocks(spark):
    frame = spark.range(200).select(F.col("id").alias("at"), (F.col("id") % 7).alias("v"))
    got = {r.at: r.v for r in prefix_trie.running_sums(frame, "at", ["v"], block=4).collect()}
    assert got == {i: sum(j % 7 for j in range(i + 1)) for i in range(200)}

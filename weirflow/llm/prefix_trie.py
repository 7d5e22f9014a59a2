"""Conversation prefix trie by the Euler-tour technique.

Every different sequence of first turns is a node; conversations that start with it are
its members. What members share is computed or stored once, so a node saves its last
text for all members but one, and a subtree saves the sum.

Steps, each a Spark job over all turns:

1. *Order.* Turns are sorted by range of conversation and turn, so a conversation may
   hold any share of the rows; places are counted per range and carried on.
2. *Prefix keys.* A turn has a 128-bit hash of its depth, role and text. A prefix's key
   is the exclusive-or of its turns' hashes, a running aggregate in blocks of depth. No
   text is shuffled after the sort, and equal prefixes meet by a partial aggregate.
3. *Arcs.* One sort by range puts every node before its children, in order of their
   smallest member: the row before gives the parent, the row after the first child or
   the next sibling. So each node gets an arc that enters and one that leaves it, and
   each arc its successor, with no join on a parent that may have very many children.
4. *List ranking.* The tour is cut into ranges of neighbouring conversations. Each task
   shortens its parts of the list to one entry per part, and the shorter list is cut
   anew, until it fits one small range. Where a cut shortens too little, pointer
   doubling finishes. Places are then handed down again.
5. *Prefix sums* over the places, in blocks: a subtree is what lies between entering a
   node and leaving it.

Nulls: a null conversation id is one conversation whose id sorts first and is written as
empty text; a null turn sorts first; a null role or text is empty. Ties in the turn go by
role, then text; repeated rows are turns of their own. Very long texts are hashed and
measured where they are read. Empty tables give empty results. Only the named columns
are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.session import materialize

DEPTH_BLOCK = 65_536
# Entries of the list in one task: few enough for its memory, enough for a task's cost.
RANGE_LEAST = 16_384
RANGE_MOST = 1_000_000
SUM_BLOCK = 65_536
IDS_PER_PIECE = 4_096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def ordered_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)``.

    ``turns``: ``conv, range, place`` (ascending in a range) and ``h1, h2, chars`` of role
    and text. ``conversations``: ``conv, range, first`` (place in that range) and
    ``before`` (turns in earlier ranges).
    """
    order = ["conv", "turn", "role", "text", "tie"]
    body = [F.col("role"), F.char_length("role"), F.col("text")]
    turns = materialize(
        rows.select(
            F.col(conv).cast("bigint").alias("conv"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv",
            F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().alias("place"),
            F.xxhash64(F.lit(1), *body).alias("h1"),
            F.xxhash64(F.lit(2), *body).alias("h2"),
            F.char_length("text").cast("bigint").alias("chars"),
        ),
        "turns",
    )
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    conversations = (
        turns.groupBy("conv", "range")
        .agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    return turns, materialize(conversations, "conversations")


def placed(turns: DataFrame, conversations: DataFrame, *more: str) -> DataFrame:
    """``turns`` with ``at``, their number in the conversation from 0, and more columns."""
    named = conversations.select(
        F.col("conv").alias("_conv"), F.col("range").alias("_range"), "first", "before", *more
    )
    return turns.join(
        named, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("range") == F.col("_range"))
    ).select("conv", (F.col("place") - F.col("first") + F.col("before")).alias("at"), "h1", "h2", "chars", *more)


def whole_paths(rows: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """``(steps, conversations)`` for ``trie``: every conversation as it stands."""
    turns, ranges = ordered_turns(rows, **columns)
    conversations = materialize(
        ranges.groupBy("conv").agg(F.sum("n").alias("length"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "paths",
    )
    numbered = ranges.join(
        conversations.select(F.col("conv").alias("c"), "cid", "length"), F.col("conv").eqNullSafe(F.col("c"))
    )
    steps = placed(turns, numbered, "cid", "length").withColumn("depth", F.col("at") + 1)
    return steps.select("cid", "conv", "length", "depth", "h1", "h2", "chars"), conversations


def shared_start_paths(
    rows: DataFrame, group: int = 100, choices: int = 6, **columns: str
) -> tuple[DataFrame, DataFrame]:
    """``(steps, conversations)`` for ``trie``: starts replaced by a common one.

    Conversation *c* begins with the first *h* turns of conversation ``c - c mod group``,
    as many as there are, and goes on with its own after its first *h*; *h* is the crc32
    of its decimal id modulo ``choices``. A null id has no start to take over.
    """
    turns, ranges = ordered_turns(rows, **columns)
    h = F.coalesce(F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(choices)), F.lit(0))
    counted = ranges.groupBy("conv").agg(F.sum("n").alias("n"))
    starts = counted.where(F.pmod("conv", F.lit(group)) == 0).select(F.col("conv").alias("b"), F.col("n").alias("of_base"))
    taken = F.least("h", F.coalesce("of_base", F.lit(0)))
    conversations = materialize(
        counted.withColumn("h", h)
        .withColumn("base", F.col("conv") - F.pmod("conv", F.lit(group)))
        .join(starts, F.col("base") == F.col("b"), "left")
        .withColumn("taken", taken)
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv", "base", "h", "taken", "length", F.monotonically_increasing_id().alias("cid")),
        "paths",
    )
    shape = conversations.withColumnRenamed("conv", "c")
    numbered = ranges.join(shape, F.col("conv").eqNullSafe(F.col("c")))
    own = materialize(placed(turns, numbered, "cid", "length", "h", "taken"), "numbered-turns")
    columns_out = ["cid", "conv", "length", "depth", "h1", "h2", "chars"]
    rest = own.where(F.col("at") >= F.col("h")).withColumn("depth", F.col("taken") + F.col("at") - F.col("h") + 1)
    first = own.where((F.pmod("conv", F.lit(group)) == 0) & (F.col("at") < choices - 1)).select(
        F.col("conv").alias("b"), "at", "h1", "h2", "chars"
    )
    start = (
        conversations.where("taken > 0")
        .join(first, (F.col("base") == F.col("b")) & (F.col("at") < F.col("taken")))
        .withColumn("depth", F.col("at") + 1)
    )
    return rest.select(*columns_out).unionByName(start.select(*columns_out)), conversations


def prefix_keys(steps: DataFrame) -> DataFrame:
    """``steps`` with the key ``k1, k2`` of the prefix that ends there, and its parent's."""
    hashed = steps.withColumn("h1", F.xxhash64("h1", "depth")).withColumn("h2", F.xxhash64("h2", "depth"))
    blocked = materialize(
        hashed.withColumn("block", F.floor((F.col("depth") - 1) / DEPTH_BLOCK)), "steps"
    )
    earlier = Window.partitionBy("cid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.where(F.col("length") > DEPTH_BLOCK)
        .groupBy("cid", "block")
        .agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
        .select("cid", "block", F.bit_xor("x1").over(earlier).alias("c1"), F.bit_xor("x2").over(earlier).alias("c2"))
        .where("block > 0")
    )
    inside = Window.partitionBy("cid", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = blocked.withColumn("x1", F.bit_xor("h1").over(inside)).withColumn("x2", F.bit_xor("h2").over(inside))
    key = lambda i: F.col(f"x{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0)))
    return (
        own.join(carried, ["cid", "block"], "left")
        .withColumn("k1", key(1))
        .withColumn("k2", key(2))
        .withColumn("p1", F.col("k1").bitwiseXOR(F.col("h1")))
        .withColumn("p2", F.col("k2").bitwiseXOR(F.col("h2")))
        .select("conv", "length", "depth", "chars", "k1", "k2", "p1", "p2")
    )


def _nodes(paths: DataFrame, conversations: DataFrame) -> DataFrame:
    found = paths.groupBy("depth", "k1", "k2").agg(
        F.count("*").alias("n_convs"),
        F.min("conv").alias("conv"),
        F.first("chars").alias("chars"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
    )
    zero = F.lit(0).cast("bigint")
    root = (
        conversations.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"))
        .where("n_convs > 0")
        .select(
            zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "n_convs", "conv", zero.alias("chars"),
            F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
        )
    )
    return materialize(found.unionByName(root).withColumn("nid", F.monotonically_increasing_id()), "trie-nodes")


def _families(nodes: DataFrame) -> DataFrame:
    """``nid, child`` (0: the node itself, 1: as its parent's child), ``conv, depth``, its
    ``parent`` (``nid`` and ``conv``), and the row after it: ``next`` (``child``, ``nid``).
    """
    zero, one = F.lit(0), F.lit(1)
    rows = nodes.select(
        F.col("depth").alias("d"), "k1", "k2", zero.alias("child"), "conv", "nid", "depth"
    ).unionByName(
        nodes.where("depth > 0").select(
            (F.col("depth") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
            one.alias("child"), "conv", "nid", "depth",
        )
    )
    order = ["d", "k1", "k2", "child", "conv", "nid"]
    ranged = materialize(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("place"),
            "child", "nid", "conv", "depth",
        ),
        "families",
    )
    me, family = F.struct("child", "nid"), F.struct("nid", "conv")
    # As many rows as ranges: the last parent before a range and the first row after it.
    ends = ranged.groupBy("range").agg(
        F.min_by(me, "place").alias("first"),
        F.max_by(family, F.when(F.col("child") == 0, F.col("place"))).alias("last"),
    )
    in_order = Window.orderBy("range")
    borders = ends.select(
        F.col("range").alias("r"),
        F.lead("first").over(in_order).alias("after"),
        F.last("last", True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
    )
    inside = Window.partitionBy("range").orderBy("place")
    return materialize(
        ranged.withColumn("next", F.lead(me).over(inside))
        .withColumn("parent", F.last(F.when(F.col("child") == 0, family), True).over(inside))
        .join(F.broadcast(borders), F.col("range") == F.col("r"))
        .select(
            "nid", "child", "conv", "depth",
            F.coalesce("parent", "before").alias("parent"),
            F.coalesce("next", "after").alias("next"),
        ),
        "arcs",
    )


def tour(families: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, next, conv, depth`` of every arc: ``2 nid`` enters a node, ``2 nid + 1`` leaves it."""
    on = F.col("next.child") == 1
    into = F.col("next.nid") * 2
    leave = F.when(F.col("child") == 0, F.col("nid") * 2 + 1).otherwise(F.col("parent.nid") * 2 + 1)
    arcs = families.select(
        (F.col("nid") * 2 + F.col("child")).alias("id"), F.when(on, into).otherwise(leave).alias("next"), "conv", "depth"
    )
    end = nodes.where("depth = 0").select(
        (F.col("nid") * 2 + 1).alias("id"), F.lit(None).cast("bigint").alias("next"), "conv", "depth"
    )
    return arcs.unionByName(end)


def _shorten(names: Sequence[str]):
    """Rank the parts of the list that lie in one task's rows; one entry stands for each."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if rows is None:
            return
        rows = rows.sort_by("id")
        ids = rows.column("id").to_numpy()
        after = rows.column("next").fill_null(-1).to_numpy()
        weight = rows.column("weight").to_numpy()
        n = len(ids)
        at = np.minimum(np.searchsorted(ids, after), n - 1)
        here = ids[at] == after
        head, offset = np.arange(n), np.zeros(n, np.int64)
        head[at[here]] = np.flatnonzero(here)
        offset[at[here]] = weight[here]
        while True:  # pointer doubling towards the part's first entry
            further = head[head]
            if (further == head).all():
                break
            offset, head = offset + offset[head], further
        last = np.flatnonzero(~here)
        follows, total = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        follows[head[last]] = after[last]
        total[head[last]] = offset[last] + weight[last]
        found = {
            "id": pa.array(ids),
            "head": pa.array(ids[head]),
            "offset": pa.array(offset),
            "next": pa.array(follows, mask=follows < 0),
            "weight": pa.array(total),
        }
        yield from pa.table({**found, **{c: rows.column(c) for c in names}}).combine_chunks().to_batches(65_536)

    return shorten


def _doubled(entries: DataFrame) -> DataFrame:
    """``id, rest``: all weight from an entry to the end, by pointer doubling."""
    entries = entries.select("id", "next", F.col("weight").alias("rest"))
    while not entries.where("next IS NOT NULL").isEmpty():
        to = entries.select(F.col("id").alias("i"), F.col("next").alias("n"), F.col("rest").alias("r"))
        moved = (
            entries.where("next IS NOT NULL").join(to, F.col("next") == F.col("i"))
            .select("id", F.col("n").alias("next"), (F.col("rest") + F.col("r")).alias("rest"))
        )
        entries = materialize(moved.union(entries.where("next IS NULL")), "doubled")
    return entries.select("id", "rest")


def list_rank(
    entries: DataFrame, near: Sequence[str], least: int = RANGE_LEAST, most: int = RANGE_MOST
) -> DataFrame:
    """``(id, position)`` of a linked list ``(id, next)``, from 0; the last has no next.

    ``near`` are columns by which entries that follow each other tend to be close; the
    result doesn't depend on them.
    """
    spark = entries.sparkSession
    current = materialize(
        entries.select("id", "next", F.lit(1).cast("bigint").alias("weight"), *near), "list"
    )
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in current.schema if f.name in near)
    whole = n = current.count()
    levels: list[DataFrame] = []
    rest = None
    while rest is None:
        ranges = max(math.ceil(n / most), min(math.ceil(n / least), 4 * spark.sparkContext.defaultParallelism))
        dealt = current.coalesce(1) if n <= least else current.repartitionByRange(ranges, *near, "id")
        done = materialize(
            dealt.mapInArrow(
                _shorten(near), "id bigint, head bigint, offset bigint, next bigint, weight bigint" + kinds
            ),
            "ranked",
        )
        levels.append(done)
        heads = done.where("id = head").select("id", "next", "weight", *near)
        left = heads.count()
        if n <= least:
            rest = heads.select("id", F.col("weight").alias("rest"))
        elif left > 0.75 * n:
            rest = _doubled(heads)
        current, n = heads, left
    for done in reversed(levels):
        to = rest.select(F.col("id").alias("h"), F.col("rest").alias("r"))
        rest = materialize(
            done.join(to, F.col("head") == F.col("h")).select("id", (F.col("r") - F.col("offset")).alias("rest")),
            "rest",
        )
    return rest.select("id", (F.lit(whole) - F.col("rest")).alias("position"))


def running_sums(rows: DataFrame, position: str, values: Sequence[str], block: int = SUM_BLOCK) -> DataFrame:
    """``rows`` with each of ``values`` summed up to its ``position``, inclusive.

    Positions count from 0 without gaps, so blocks of them are of one size. Their totals
    are summed in the same way, until one block holds all.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(position) / block).cast("bigint"))
    totals = materialize(blocked.groupBy("_block").agg(*(F.sum(v).alias(v) for v in values)), "block-sums")
    if totals.count() <= block:
        in_order = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
        summed = totals.select("_block", *(F.sum(v).over(in_order).alias(v) for v in values))
    else:
        summed = running_sums(totals.withColumnRenamed("_block", "_at"), "_at", values, block).withColumnRenamed(
            "_at", "_block"
        )
    # The carry of a block is the sum up to the one before.
    carry = summed.select((F.col("_block") + 1).alias("_block"), *(F.col(v).alias(f"_{v}") for v in values))
    inside = Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    kept = [c for c in rows.columns if c not in values]
    return (
        blocked.select("_block", *kept, *(F.sum(v).over(inside).alias(v) for v in values))
        .join(carry, "_block", "left")
        .select(*kept, *((F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values))
    )


def _id_digests(ends: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key, ends_sha256`` of ids in ascending order, comma-joined.

    Ids go into pieces of neighbouring numbers in parallel; a digest is by its nature one
    stream per group, which reads those pieces in order and holds one at a time.
    """
    pieces = (
        ends.groupBy(*key, F.floor(F.col("conv") / IDS_PER_PIECE).alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("conv"))).alias("ids"))
        .select(
            *key,
            "piece",
            F.array_join(F.transform("ids", lambda i: F.coalesce(i["conv"].cast("string"), F.lit(""))), ",").alias("text"),
        )
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group: tuple, found) -> pa.RecordBatch:
            columns = [pa.array([k], pa.int64()) for k in group] + [pa.array([found.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=[*key, "ends_sha256"])

        group, found, ready = None, None, []
        for batch in batches:
            for *mine, text in zip(*(batch.column(i).to_pylist() for i in (*range(len(key)), len(key) + 1))):
                if mine != group:
                    if group is not None:
                        ready.append(out(group, found))
                    group, found = mine, hashlib.sha256(text.encode())
                else:
                    found.update(b"," + text.encode())
            if ready:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready = []
        if group is not None:
            yield out(group, found)

    return (
        pieces.repartition(*key)
        .sortWithinPartitions(*key, "piece")
        .mapInArrow(digest, ", ".join(f"{k} bigint" for k in key) + ", ends_sha256 string")
    )


def trie(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member) and ``depth`` name it, then
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``steps``: ``cid, conv, length, depth`` (from 1) and ``h1, h2, chars`` of each turn.
    ``conversations``: ``cid, conv, length`` of each, those without turns included.
    """
    key = ["depth", "k1", "k2"]
    paths = materialize(prefix_keys(steps), "prefixes")
    nodes = _nodes(paths, conversations)
    families = _families(nodes)
    children = families.where("child = 1")
    facts = materialize(
        nodes.drop("p1", "p2")
        .join(children.select("nid", F.col("parent.conv").alias("parent_conv")), "nid", "left")
        .join(children.groupBy(F.col("parent.nid").alias("nid")).agg(F.count("*").alias("n_children")), "nid", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")),
        "node-facts",
    )
    positions = list_rank(tour(families, nodes), ["conv", "depth"])
    enters = F.pmod("id", F.lit(2)) == 0
    zero = F.lit(0).cast("bigint")
    weighed = (
        positions.select("position", enters.alias("enters"), F.expr("id div 2").alias("nid"))
        .join(facts.select("nid", "leaf", "saved"), "nid")
        .select(
            "nid", "position", "enters",
            *(F.when(F.col("enters"), F.col(v)).otherwise(zero).alias(v) for v in ("leaf", "saved")),
        )
    )
    at_arcs = running_sums(weighed, "position", ["leaf", "saved"])

    def between(value: str) -> Column:
        left = F.sum(F.when(~F.col("enters"), F.col(value)))
        return left - F.sum(F.when(F.col("enters"), F.col(value)))

    # The sum at the entering arc holds the node itself, which belongs to its subtree.
    below = at_arcs.groupBy("nid").agg(between("leaf").alias("leaves"), between("saved").alias("below"))
    ends = paths.where("depth = length").select(*key, "conv")
    turnless = conversations.where("length = 0").select(*(F.lit(0).cast("bigint").alias(k) for k in key), "conv")
    digests = _id_digests(ends.unionByName(turnless), key)
    return (
        facts.join(below, "nid")
        .join(digests, key, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent_conv").alias("parent_conv_id"),
            "n_convs",
            F.col("n_children").cast("bigint").alias("n_children"),
            (F.col("leaves") + F.col("leaf")).alias("n_leaves"),
            (F.col("below") + F.col("saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )

"""Sharding: a keyed Feistel permutation of global row numbers.

Rows are numbered in the order of a hash bucket, then key columns. A Feistel network
on two mixed-radix halves permutes ``[0, a*b)``, the smallest such grid that holds
all rows; a value outside is sent through again (cycle walking) until it is a row
number. Position ``p`` goes to shard ``p mod shards``, slot ``p div shards``: shard
sizes are at most one apart, and ``row_number_at`` computes which row a shard and
slot holds.

The result depends on the rows, the number of shards and the seed only, not on
partitions or order. Nulls in key columns are values like any other. Rows equal in
all key columns are counted first and numbered in one piece, so a row repeated any
number of times costs no more than one before the numbers are dealt. An empty table
gives an empty result. Columns other than the named ones are not read, so their
names can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ROUNDS = 8
# Rows fall into this many buckets; their counts are the only table in one task.
BUCKETS = 4096
# More walks than the grid has cells outside [0, n) for n <= 4096; above, a walk goes
# on with a chance below 1/64, so 64 are never used up. It raises if they are.
WALKS = 64


def _sides(n: Column) -> tuple[Column, Column]:
    """Sides a, b of the grid: a*b >= n and a*b - n < a."""
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1))
    return a, F.greatest(((n + a - 1) - F.pmod(n + a - 1, a)) / a, F.lit(1)).cast("long")


def _network(value: Column, a: Column, b: Column, seed: int, backward: bool) -> Column:
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if backward else F.sequence(F.lit(1), F.lit(ROUNDS))
    sign = F.lit(-1 if backward else 1)

    def turn(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        moved_left = F.pmod(left + sign * F.pmod(F.xxhash64(right, i, F.lit(seed)), a), a)
        moved_right = F.pmod(right + sign * F.pmod(F.xxhash64(left, i, F.lit(seed)), b), b)
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, moved_left).otherwise(left).alias("l"),
            F.when(odd, right).otherwise(moved_right).alias("r"),
        )

    left = F.pmod(value, a)
    start = F.struct(left.alias("l"), F.floor((value - left) / a).cast("long").alias("r"))
    return F.aggregate(rounds, start, turn, lambda s: s["r"] * a + s["l"])


def _walk(value: Column, n: Column, seed: int, backward: bool) -> Column:
    a, b = _sides(n)
    once = _network(value, a, b, seed, backward)
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        once,
        lambda y, _: F.when(y < n, y).otherwise(_network(y, a, b, seed, backward)),
    )
    return found


def permuted(number: Column, n: Column, seed: int = 0) -> Column:
    """The place of row ``number`` among ``n``."""
    return _walk(number, n, seed, False)


def row_number_at(shard: Column, slot: Column, shards: int, n: Column, seed: int = 0) -> Column:
    """The row number that a shard and slot hold: the inverse of the permutation."""
    return _walk(slot * shards + shard, n, seed, True)


def numbered(
    rows: DataFrame, group: Sequence[str], keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """``group``, ``keys``, ``row_number`` from 0 within the group, and ``n``, its size.

    Two shuffles of these columns alone. Rows are counted in hash buckets and numbered
    inside them from carried offsets, so a group may hold any share of the rows.
    """
    counted = (
        rows.select(*group, *keys)
        .withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        .groupBy("bucket", *group, *keys)
        .agg(F.count("*").alias("copies"))
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        counted.groupBy("bucket", *group)
        .agg(F.sum("copies").alias("size"))
        .select(
            F.col("bucket").alias("_bucket"),
            *(F.col(g).alias(f"_{g}") for g in group),
            F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"),
            F.sum("size").over(whole).alias("n"),
        )
    )
    if not group:
        sizes = F.broadcast(sizes)  # ``buckets`` rows of three numbers at most
    same = F.col("bucket") == F.col("_bucket")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = (
        Window.partitionBy("bucket", *group)
        .orderBy(*(F.asc_nulls_first(k) for k in keys))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("first") + F.col("at")
    return (
        counted.withColumn("at", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(sizes, same)
        .select(
            *group,
            *keys,
            F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("row_number"),
            "n",
        )
    )


def shard_rows(rows: DataFrame, keys: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """``keys``, ``row_number``, ``shard`` and ``slot`` for every row of ``rows``.

    ``keys`` should tell rows apart; rows equal in all of them are interchangeable.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    place = F.col("place")
    return (
        numbered(rows, [], keys)
        .withColumn("place", permuted(F.col("row_number"), F.col("n"), seed))
        .withColumn(
            "place",
            F.when(place < F.col("n"), place).otherwise(
                F.raise_error(F.lit("cycle walk did not end")).cast("long")
            ),
        )
        .select(
            *keys,
            "row_number",
            F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
            ((place - F.pmod(place, F.lit(shards))) / shards).cast("long").alias("slot"),
        )
    )

"""Exact top-k search over binary codes: incremental multi-index hashing.

A vector's code has one bit per coordinate: whether it is above zero. Codes are cut into
``m`` segments of equal width. A code at distance below ``m * (r + 1)`` of a query differs
by at most ``r`` bits in some segment, so once all segment values within radius ``r`` have
been looked up, every code at distance ``m * (r + 1) - 1`` or less has been seen. The
radius grows until each query's k-th best verified distance is covered. A code whose first
nearest segment is number ``s``, at ``r``, is at ``m * r + s`` at least, so a query looks a
radius up in the first ``bound - m * r + 1`` segments only.

What is looked up is many times the queries, by a number that Spark doesn't see when it
estimates a size: values and codes meet in a sort-merge join, which may spill, and neither
is sent to the driver. AQE splits a value that many codes share.

Equal codes are one class that keeps its k smallest ids, so copies cost one row. Of
queries with equal codes one is searched. A pair is found in exactly one segment (the
first of those that are nearest), and only if it can still be among the k best: the
bound starts from a fixed small set of codes and falls with what is found. Distances are
checked inside the join, so only such pairs leave it.

Ties in distance go to the smaller id. A vector that is null or has another number of
coordinates than ``bits`` has no code: it is never found, and as a query finds nothing.
A null coordinate or one that is not a number is not above zero. Rows that repeat an id
and code are one. Null ids are never found. Empty tables give empty results. Only the id
and vector columns are read.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.session import materialize

# Codes that give a first bound on the k-th distance: any would do, more give a lower one.
PROBES = 256

# Values that one task looks up at most.
LOOKED_UP = 1_000_000


def _words(bits: int) -> list[str]:
    return [f"c{i}" for i in range(-(-bits // 64))]


def binary_codes(vectors: DataFrame, id_column: str, vector: str, bits: int) -> DataFrame:
    """``id, c0, c1, ...``: the code in 64-bit words, for vectors of ``bits`` coordinates."""
    value = F.col(vector)

    def word(start: int) -> Column:
        part = F.slice(value, start + 1, min(64, bits - start))
        bit = lambda x: F.when((x > 0) & ~F.isnan(x), F.lit(1)).otherwise(F.lit(0)).cast("long")
        return F.aggregate(part, F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(bit(x)))

    return (
        vectors.select(F.col(id_column).cast("bigint").alias("id"), value.alias(vector))
        .where(F.size(vector) == bits)
        .select("id", *(word(64 * i).alias(name) for i, name in enumerate(_words(bits))))
    )


def segment_width(codes: int) -> int:
    """Bits per segment: wider for more codes, so that a segment value stays selective."""
    size = math.log2(max(codes, 1))
    return 16 if size >= 19 else 8 if size >= 8 else 4


def _segment(prefix: str, s: int, width: int) -> Column:
    per_word = 64 // width
    word = F.col(f"{prefix}c{s // per_word}")
    return F.shiftrightunsigned(word, width * (s % per_word)).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _distance(words: list[str], left: str, right: str) -> Column:
    total = F.lit(0)
    for w in words:
        total = total + F.bit_count(F.col(left + w).bitwiseXOR(F.col(right + w)))
    return total


def _first_bound(queries: DataFrame, codes: DataFrame, words: list[str], k: int, bits: int) -> DataFrame:
    """Queries with ``bound``: the k-th distance among ``PROBES`` codes, or ``bits``."""
    some = codes.select(*words).orderBy(F.xxhash64(*words), *words).limit(PROBES).collect()
    if len(some) < k:
        return queries.withColumn("bound", F.lit(bits))
    array = F.array(*(F.struct(*(F.lit(r[w]).cast("long").alias(w) for w in words)) for r in some))

    def distance(code: Column) -> Column:
        total = F.lit(0)
        for w in words:
            total = total + F.bit_count(F.col(w).bitwiseXOR(code[w]))
        return total

    return queries.withColumn("bound", F.element_at(F.array_sort(F.transform(array, distance)), k))


def nearest(vectors: DataFrame, queries: DataFrame, id_column: str, vector: str, bits: int, k: int) -> DataFrame:
    """The ``k`` nearest of ``vectors`` to each of ``queries`` by Hamming distance.

    Returns ``query_id, rank`` (from 1), ``neighbor_id, distance``.
    """
    if bits % 4 or bits < 4 or k < 1:
        raise ValueError("bits must be a multiple of 4, k at least 1")
    words = _words(bits)
    smallest = Window.partitionBy(*words).orderBy("id")
    codes = materialize(
        binary_codes(vectors, id_column, vector, bits)
        .where(F.col("id").isNotNull()).distinct()
        .withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k)
        .groupBy(*words).agg(F.array_sort(F.collect_list("id")).alias("ids")),
        "codes",
    )
    asked = materialize(binary_codes(queries, id_column, vector, bits), "query-codes")
    width = segment_width(codes.count())
    while bits % width or 64 % width:
        width //= 2
    segments = bits // width
    parts = F.posexplode(F.array(*(_segment("", s, width) for s in range(segments)))).alias("seg", "val")
    place = F.shiftleft(F.col("seg").cast("long"), width).bitwiseOR(F.col("val")).alias("place")
    index = codes.select(*(F.col(w).alias(f"x{w}") for w in words), "ids", parts).select(
        *(f"x{w}" for w in words), "ids", place
    )
    open_ = _first_bound(asked.select(*words).distinct(), codes, words, k, bits)
    open_ = materialize(open_, "bounds")
    first, best, left = open_, None, open_.count()
    for r in range(width + 1):
        masks = [sum(1 << b for b in some) for some in combinations(range(width), r)]
        probes = (
            open_.repartition(1 + left * segments * len(masks) // LOOKED_UP)
            .select(*(F.col(w).alias(f"q{w}") for w in words), "bound", parts)
            .where(F.col("seg") <= F.col("bound") - segments * r)
            .select(
                *(f"q{w}" for w in words), "bound", "seg", place.alias("own"),
                F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("mask"),
            )
            .withColumn("place", F.col("own").bitwiseXOR(F.col("mask")))
            .drop("own", "mask")
        )
        once = F.lit(True)
        for s in range(segments):
            apart = F.bit_count(_segment("q", s, width).bitwiseXOR(_segment("x", s, width)))
            once = once & F.when(F.col("seg") > s, apart > r).otherwise(apart >= r)
        distance = _distance(words, "q", "x")
        found = (
            probes.alias("p")
            .join(
                index.hint("merge").alias("i"),
                (F.col("p.place") == F.col("i.place")) & (distance <= F.col("bound")) & once,
            )
            .select(
                *(F.col(f"q{w}").alias(w) for w in words),
                distance.alias("distance"),
                F.explode("ids").alias("neighbor_id"),
            )
        )
        order = Window.partitionBy(*words).orderBy("distance", "neighbor_id")
        best = materialize(
            (found if best is None else best.drop("rank").unionByName(found))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k),
            "best",
        )
        kth = best.where(F.col("rank") == k).select(*words, F.col("distance").alias("kth"))
        covered = segments * (r + 1) - 1
        open_ = materialize(
            first.join(kth, words, "left")
            .withColumn("bound", F.least("bound", F.coalesce("kth", "bound")))
            .drop("kth").where(F.col("bound") > covered),
            "bounds",
        )
        left = open_.count()
        if not left:
            break
    return asked.withColumnRenamed("id", "query_id").join(best, words).select(
        "query_id", "rank", "neighbor_id", "distance"
    )

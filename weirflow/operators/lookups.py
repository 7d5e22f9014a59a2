"""A lookup join that hot keys don't slow down."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.operators.rows import unique_lookup
from weirflow.session import materialize

# A key that holds this share of the rows or more is hot, so at most 1 / SHARE keys are.
SHARE = 0.01
# Lookup rows of hot keys are copied to all tasks only if they are at most this large.
HOT_BYTES = 8 * 1024 * 1024


def hot_hashes(df: DataFrame, key: str, share: float = SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, by a sketch of one pass.

    The sketch may name further keys, never more than ``1 / share`` in all, and misses none.
    Only hashes reach the driver, however long the keys are.
    """
    hashed = df.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    return sorted(hashed.stat.freqItems(["h"], share).first()[0] or [])


def hot_rows(key: str, hashes: list[int]) -> Column:
    """Whether the row's key is hot. A null key is: it matches nothing and needs no shuffle."""
    return F.col(key).isNull() | F.xxhash64(key).isin(hashes)


def with_hot_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    default: str = "Not Found",
    share: float = SHARE,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Left join to a lookup of any size, with a default for absent keys; hot keys stay in place.

    Rows of hot and null keys aren't shuffled: they meet the at most ``1 / share`` lookup rows
    of those keys, which are copied to every task once their measured size is at most
    ``hot_bytes``. All other rows join by shuffle, or by Spark's own broadcast if the lookup
    is small. Above ``hot_bytes`` hot keys join by shuffle as well and AQE splits them.

    The rows are read twice, for the sketch and for the join: persist a micro-batch first. A
    repeated lookup key fails the job; a null one is no key. A value that is null counts as
    absent. An empty side is fine. ``df`` must not have a column ``value`` names.
    """
    # Hashes of a key agree only within one type.
    typed = lookup.withColumn(key, F.col(key).cast(df.schema[key].dataType))
    known = typed.filter(F.col(key).isNotNull())
    hashes = hot_hashes(df, key, share)
    hot = hot_rows(key, hashes)
    few = materialize(unique_lookup(known.filter(hot), key, value), "hot-lookup")
    length = F.octet_length(F.col(key).cast("string")) + F.coalesce(
        F.octet_length(F.col(value).cast("string")), F.lit(0)
    )
    size = few.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    if size > hot_bytes:
        joined = df.join(unique_lookup(known, key, value), key, "left")
    else:
        in_place = df.filter(hot).join(F.broadcast(few), key, "left")
        others = unique_lookup(known.filter(~hot), key, value)
        joined = in_place.unionByName(df.filter(~hot).join(others, key, "left"))
    return joined.withColumn(value, F.coalesce(value, F.lit(default))).select(*_quoted(df), value)


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def with_timed_lookup(
    load: Callable[[], DataFrame],
    apply: Callable[[DataFrame, DataFrame, int], None],
    seconds: float,
    clock: Callable[[], float] = time.monotonic,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body whose lookup is read again once it is ``seconds`` old.

    It is written when read, so micro-batches in between see one state of it and never
    ask its source. A load that fails leaves the time as it was: the next batch tries again.
    """
    held: list[tuple[float, DataFrame]] = []

    def body(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        if not held or now - held[0][0] >= seconds:
            fresh = materialize(load(), "lookup")
            held[:] = [(now, fresh)]
        apply(batch, held[0][1], batch_id)

    return body

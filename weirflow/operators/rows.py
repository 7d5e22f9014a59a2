"""Row operators shared by all pipelines: latest per key, numbering, batches, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def compute_once(df: DataFrame, keep: Sequence[Column | str], **columns: Column) -> DataFrame:
    """``keep`` plus new columns, each computed once per row.

    A filter on a plain projection is pushed below it together with a copy of the
    expressions, so a parse would run again for every mention. The generator
    between the two holds the filter back.
    """
    struct = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(struct)))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row per key.

    Spark limits each map task to one row per key before the shuffle
    (``WindowGroupLimit ... Partial``), so a hot key sends one row per task.
    ``order`` must be total for a repeatable result.
    """
    newest = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    )
    return ranked.filter("_rank = 1").drop("_rank")


def latest_view(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Register the deduplicated reading of an append-only table as a view."""
    view = latest_by(df, keys, order)
    view.createOrReplaceTempView(name)
    return view


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    block_rows: int = 1_000_000,
    name: str = "row_num",
) -> DataFrame:
    """``row_number()`` per key over an increasing integer column, without one task per key.

    Rows are numbered inside blocks of the order column; the start of each block
    is a running sum over block counts. A hot key is thereby spread over its
    blocks, and only counts are ordered per key. ``order`` is a position such as
    an offset, so a block holds about ``block_rows`` rows.
    """
    # Key and block are one struct: structs are equal null by null, so the window and the
    # join share one shuffle of the rows.
    block = F.call_function("div", F.col(order), F.lit(block_rows)).alias("_block")
    blocked = df.withColumn("_g", F.struct(*keys, block))
    earlier = (
        Window.partitionBy(*[f"_g.{k}" for k in keys])
        .orderBy("_g._block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        blocked.groupBy("_g")
        .agg(F.count("*").alias("_n"))
        .select("_g", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    local = blocked.withColumn("_local", F.row_number().over(Window.partitionBy("_g").orderBy(order)))
    joined = local.join(starts, "_g")
    return joined.withColumn(name, F.col("_start") + F.col("_local")).select(*df.columns, name)


def batches_of(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    size: int = 100,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Adds ``batch_id``: consecutive groups of at most ``size`` rows per key.

    In a stream the trigger interval bounds the waiting time and this split
    bounds the size, inside each micro-batch.
    """
    rows = numbered(df, keys, order, block_rows, "_row")
    batch = F.call_function("div", F.col("_row") - 1, F.lit(size))
    return rows.withColumn("batch_id", batch).drop("_row")


def sharded(df: DataFrame, shards: int, *columns: str) -> DataFrame:
    """Spread rows so each value of ``columns`` goes to ``shards`` tasks, and so files.

    0 leaves it to AQE, which merges small parts and splits large ones by size. A
    number deals rows out evenly, or per value by their hash, so a hot value is
    cut like any other.
    """
    if shards <= 0:
        return df.hint("rebalance", *columns)
    if not columns:
        return df.repartition(shards)
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    shard = F.pmod(F.xxhash64(*hashed), F.lit(shards))
    return df.repartition(*columns, shard)


def unique_lookup(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """The lookup with its key checked: a repeated key fails the job that reads it."""
    checked = lookup.groupBy(key).agg(F.count("*").alias("_n"), F.max(value).alias("_v"))
    message = F.concat(F.lit("lookup key is not unique: "), F.col(key))
    return checked.select(
        key, F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_v")).alias(value)
    )


def with_lookup(
    df: DataFrame, lookup: DataFrame, key: str, value: str, default: str = "Not Found"
) -> DataFrame:
    """Left join to a lookup table, with a default for absent keys.

    No broadcast hint: Spark broadcasts the lookup only while its measured size is
    below ``spark.sql.autoBroadcastJoinThreshold``; above it the join shuffles and
    AQE splits a hot key on the row side.
    """
    joined = df.join(unique_lookup(lookup, key, value), key, "left")
    return joined.withColumn(value, F.coalesce(value, F.lit(default)))

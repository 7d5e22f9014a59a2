"""A table that is upserted: copy-on-write by bucket of the key, behind a view.

Rows lie in ``<table>_files``, partitioned by ``bucket``, a hash of the key, and ``version``.
An upsert reads the buckets its rows fall into, keeps the last row per key, writes those
buckets as a new version, and only then replaces the view ``<table>``, which names the
version of each bucket. That replacement is one statement of the catalog: a reader sees
all of a micro-batch or nothing, with a plain ``SELECT``, and reads one row per key
however many micro-batches there were. Buckets that a batch does not touch are not read.

A run that fails before the replacement leaves a version nobody reads, which the next run
drops. A run repeated after it finds its own rows and writes the same. Versions
that the view no longer names are dropped after ``keep_versions`` further upserts, so
readers have that long to finish.

Deletes are rows too (``deleted``): they stay as tombstones, out of the view, so an older
change that comes later finds them, and are purged once ``purge`` says so.

One writer at a time: two streams that upsert one table would replace each other's view.
A bucket should hold some 100 MB: ``buckets`` is chosen for the table's size.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.operators.rows import latest_by
from weirflow.sinks.tables import quoted_column, table_exists
from weirflow.sources.schemas import quoted

BUCKET, VERSION = "bucket", "version"
SEQUENCE = "upsert_sequence"
_STATE = "weirflow.versions"


@dataclass(frozen=True)
class UpsertTable:
    """``order`` decides which row of a key is the last; ``deleted`` names a boolean column.

    With ``sequenced`` a later upsert wins over an earlier one, and ``order`` decides inside one.
    """

    name: str
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 16
    deleted: str | None = None
    keep_versions: int = 2
    sequenced: bool = False

    @property
    def files(self) -> str:
        return f"{self.name}_files"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


def create(spark: SparkSession, table: UpsertTable, schema: T.StructType) -> None:
    """The empty table, if it is missing."""
    if table_exists(spark, table.name):
        return
    columns = ", ".join(f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table.files)} ({columns}, {BUCKET} INT, {VERSION} BIGINT) "
        f"USING parquet PARTITIONED BY ({BUCKET}, {VERSION})"
    )
    _switch(spark, table, {"last": 0, "of": [None] * table.buckets})


def drop(spark: SparkSession, table: UpsertTable) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {quoted(table.name)}")
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table.files)}")


def versions(spark: SparkSession, table: UpsertTable) -> dict:
    """``last``, the newest version, and ``of``, the version of each bucket, null if it is empty."""
    text = spark.sql(f"SHOW TBLPROPERTIES {quoted(table.name)} ('{_STATE}')").first()["value"]
    return json.loads(text)


def _switch(spark: SparkSession, table: UpsertTable, state: dict) -> None:
    """The one step that makes a new state visible."""
    fields = [f.name for f in spark.table(quoted(table.files)).schema if f.name not in (BUCKET, VERSION)]
    shown = ", ".join(quoted_column(n) for n in fields if n not in (table.deleted, SEQUENCE))
    named = ", ".join("CAST(NULL AS BIGINT)" if v is None else f"{v}L" for v in state["of"])
    live = f" AND NOT coalesce({quoted_column(table.deleted)}, false)" if table.deleted else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(table.name)} TBLPROPERTIES ('{_STATE}' = '{json.dumps(state)}') AS "
        f"SELECT {shown} FROM {quoted(table.files)} "
        f"WHERE {VERSION} = element_at(array({named}), {BUCKET} + 1){live}"
    )


def stored(spark: SparkSession, table: UpsertTable, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets as they are now, tombstones included."""
    state = versions(spark, table)["of"]
    wanted = F.lit(False)
    for b in buckets:
        if state[b] is not None:
            wanted = wanted | ((F.col(BUCKET) == b) & (F.col(VERSION) == state[b]))
    return spark.table(quoted(table.files)).filter(wanted).drop(VERSION)


def upsert(batch: DataFrame, table: UpsertTable, purge: Column | None = None) -> list[int]:
    """Merge the rows into the table; returns the buckets that were rewritten.

    The table is created with the batch's columns if it is missing; columns the batch
    lacks are NULL. ``purge`` is a condition on a tombstone that lets it go.
    """
    spark = batch.sparkSession
    order = [SEQUENCE, *table.order] if table.sequenced else table.order
    sequence = [T.StructField(SEQUENCE, T.LongType())] if table.sequenced else []
    create(spark, table, T.StructType([*batch.schema.fields, *sequence]))
    last = latest_by(batch, table.keys, table.order).withColumn(BUCKET, table.bucket()).persist()
    try:
        touched = sorted(r[0] for r in last.select(BUCKET).distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        state = versions(spark, table)
        new = state["last"] + 1
        _drop(spark, table, lambda _, v: v >= new)  # what a failed run left
        mine = last.withColumn(SEQUENCE, F.lit(new).cast("bigint")) if table.sequenced else last
        both = stored(spark, table, touched).unionByName(mine, allowMissingColumns=True)
        merged = latest_by(both, table.keys, order)
        if table.deleted and purge is not None:
            gone = F.coalesce(F.col(table.deleted), F.lit(False)) & F.coalesce(purge, F.lit(False))
            merged = merged.filter(~gone)
        columns = [c for c in spark.table(quoted(table.files)).columns if c not in (BUCKET, VERSION)]
        rows = merged.select(*columns, BUCKET, F.lit(new).cast("bigint").alias(VERSION))
        rows.repartition(BUCKET).write.mode("append").insertInto(quoted(table.files))
        for b in touched:
            state["of"][b] = new
        state["last"] = new
        _switch(spark, table, state)
        oldest = new - table.keep_versions
        _drop(spark, table, lambda b, v: state["of"][b] != v and v <= oldest)
        return touched
    finally:
        last.unpersist()


def _drop(spark: SparkSession, table: UpsertTable, unused: Callable[[int, int], bool]) -> None:
    """Drop the folders of (bucket, version) that are no longer, or were never, in use."""
    old = []
    for row in spark.sql(f"SHOW PARTITIONS {quoted(table.files)}").collect():
        b, v = (int(part.split("=")[1]) for part in row[0].split("/"))
        if unused(b, v):
            old.append(f"PARTITION ({BUCKET} = {b}, {VERSION} = {v})")
    if old:
        spark.sql(f"ALTER TABLE {quoted(table.files)} DROP IF EXISTS {', '.join(old)}")

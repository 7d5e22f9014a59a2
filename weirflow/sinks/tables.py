"""Catalog tables as sinks: append, widen, route, upsert.

Every table written by a stream is partitioned by ``ingest_batch`` and ``ingest_writer``,
and a micro-batch overwrites its own partition, so a batch that runs twice lands once.
The writer is the stream's own id, which its checkpoint keeps, so streams that share a
table, and one started anew with a new checkpoint, leave each other's rows alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from weirflow.operators.drift import lower_names, new_fields, shaped, widened
from weirflow.operators.rows import latest_by, sharded
from weirflow.sources.schemas import live_schema, quoted

# Partition columns of every table a stream writes; no message field may have these names.
BATCH = "ingest_batch"
WRITER = "ingest_writer"
RESERVED = (BATCH, WRITER)

# Table property with the batches that ``sinks.compact`` has merged, per writer.
COMPACTED = "weirflow.compacted"

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"

# Names of table formats whose provider executes MERGE.
MERGE_FORMATS = ("delta", "iceberg", "hudi")


def quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the catalog has the table; a name it can't read is no table."""
    try:
        return spark.catalog.tableExists(quoted(table))
    except AnalysisException:
        return False


def stream_id(spark: SparkSession) -> str:
    """The id of the stream whose micro-batch is running, or ``batch`` outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()
    return {r["key"]: r["value"] for r in rows}.get(name)


def landed_ranges(spark: SparkSession, table: str, writer: str) -> list[tuple[int, int, int]]:
    """``(first, last, tier)`` of the writer's batches that were merged: all of them have landed."""
    marks = json.loads(table_property(spark, table, COMPACTED) or "{}")
    return [tuple(m) for m in marks.get(writer, [])]


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str | None = None,
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
) -> None:
    """Create the table if it is missing, partitioned by ``partitions`` and the batch.

    Partition columns are columns of the schema, such as a day; a reader of one day
    lists that day's folders only.
    """
    columns = [f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
    layout = ", ".join([*map(quoted_column, partitions), BATCH, WRITER])
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} "
        f"({', '.join(columns)}, {BATCH} BIGINT, {WRITER} STRING) "
        f"USING {fmt} PARTITIONED BY ({layout}){where}"
    )


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def table_columns(spark: SparkSession, table: str) -> T.StructType:
    """Data columns of the table as it is now."""
    fields = live_schema(spark, table).fields
    return T.StructType([f for f in fields if f.name not in RESERVED])


def ordered_dump(spark: SparkSession, table: str, by: str = "ID") -> DataFrame:
    """All data columns of the table in the order of one of them, for checking by eye."""
    return spark.table(quoted(table)).drop(*RESERVED).orderBy(by)


def append_batch(
    batch: DataFrame, table: str, batch_id: int, create: bool = False, shards: int | None = None
) -> None:
    """Append a micro-batch by column name; running it again replaces the same rows.

    A batch that ``sinks.compact`` has merged with others has landed, and is skipped.
    Columns the table lacks are ignored, columns the batch lacks are NULL. The
    table must exist unless ``create`` is set. Files follow the batch's own
    partitions, without a shuffle, unless ``shards`` sets their number (0: AQE).
    """
    spark = batch.sparkSession
    if not table_exists(spark, table):
        if not create:
            raise ValueError(f"table {table} does not exist")
        create_table(spark, table, batch.schema)
    if any(first <= batch_id <= last for first, last, _ in landed_ranges(spark, table, stream_id(spark))):
        return
    have = {f.name.lower(): f for f in batch.schema.fields}
    columns = []
    for f in table_columns(spark, table).fields:
        source = have.get(f.name.lower())
        value = (
            shaped(F.col(quoted_column(source.name)), source.dataType, f)
            if source
            else F.lit(None).cast(f.dataType)
        )
        columns.append(value.alias(f.name))
    layout = [c.name for c in spark.catalog.listColumns(quoted(table)) if c.isPartition]
    own = {BATCH: F.lit(int(batch_id)).cast("bigint"), WRITER: F.lit(stream_id(spark))}
    data = [c for c, f in zip(columns, table_columns(spark, table).fields) if f.name not in layout]
    parts = [c for c, f in zip(columns, table_columns(spark, table).fields) if f.name in layout]
    rows = batch.select(*data, *parts)
    if shards is not None:
        rows = sharded(rows, shards)
    if parts:
        # Only the folders of this batch and writer are replaced, below each day it has.
        # The session's setting decides that; a writer's option is not heeded here.
        before = spark.conf.get(_OVERWRITE)
        spark.conf.set(_OVERWRITE, "dynamic")
        try:
            rows.withColumns(own).write.mode("overwrite").insertInto(quoted(table))
        finally:
            spark.conf.set(_OVERWRITE, before)
        return
    view = f"batch_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION "
            f"({BATCH} = {int(batch_id)}, {WRITER} = '{stream_id(spark)}') SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def add_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> list[str]:
    """Add the columns the table lacks (any case counts as present); returns those added.

    The names of the partition columns count as present: they can't be added.
    """
    present = {*lower_names(live_schema(spark, table).fieldNames()), *RESERVED}
    missing = {n: t for n, t in columns.items() if n.lower() not in present}
    if missing:
        listed = ", ".join(f"{quoted_column(name)} {kind}" for name, kind in missing.items())
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({listed})")
        spark.catalog.refreshTable(quoted(table))
    return list(missing)


def add_fields(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give the table every field of the schema it lacks, inside structs too.

    ``ALTER TABLE`` cannot add a field inside a struct of a parquet table. An
    external table is then defined anew over the same files, which read NULL for it.
    """
    have = table_columns(spark, table)
    want = widened(have, schema)
    if want == have:
        return
    top = {f.name: f.dataType.simpleString() for f in want.fields[len(have) :]}
    if want.fields[: len(have)] == have.fields:
        add_columns(spark, table, top)
        return
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {quoted(table)}").collect()}
    if details["Type"] != "EXTERNAL":
        raise ValueError(f"{table} must be external to gain a field inside a struct")
    parts = [c.name for c in spark.catalog.listColumns(quoted(table)) if c.isPartition and c.name not in RESERVED]
    drop_table(spark, table)
    create_table(spark, table, want, details["Location"], details["Provider"], parts)
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")


def evolve(rows: DataFrame, table: str) -> list[str]:
    """Add every field of the rows that the table lacks, as nullable text, spelled as sent.

    Only field names reach the driver.
    """
    spark = rows.sparkSession
    fields = new_fields(rows, table_columns(spark, table).fieldNames())
    names = sorted(r["spelling"] for r in fields.collect())
    return add_columns(spark, table, {name: "STRING" for name in names})


def known_tables(
    spark: SparkSession, names: Iterable[str | None], table_of: Callable[[str], str] = str
) -> dict[str, list[str]]:
    """The tables there are for the given destinations: table to its destinations.

    Names that differ only in case are one table. Destinations without a table are
    left out. Destinations are names of tables, so they, not rows, reach the driver.
    """
    found: dict[str, list[str]] = {}
    for name in sorted(n for n in names if n is not None):
        table = table_of(name).lower()
        if table in found or table_exists(spark, table):
            found.setdefault(table, []).append(name)
    return found


def route_to_tables(
    rows: DataFrame,
    batch_id: int,
    column: str = "destination",
    dead_table: str = "unrouted_rows",
) -> list[str]:
    """Append each row to the table its ``column`` names.

    A row whose destination is missing, or is no table, goes to ``dead_table`` as JSON
    text with the reason ``no table``, so one such row can't stop a stream.
    """
    spark = rows.sparkSession
    kept = rows.persist()
    try:
        found = known_tables(spark, (r[0] for r in kept.select(column).distinct().collect()))
        for table, names in found.items():
            append_batch(kept.filter(F.col(column).isin(names)).drop(column), table, batch_id)
        known = [n for names in found.values() for n in names]
        lost = kept.filter(F.col(column).isNull() | ~F.col(column).isin(known))
        letters = lost.select(
            column, F.to_json(F.struct(*rows.columns)).alias("value"), F.lit("no table").alias("reason")
        )
        append_batch(letters, dead_table, batch_id, create=True)
        return sorted(found)
    finally:
        kept.unpersist()


def merge_statement(
    target: str,
    source: str,
    keys: Sequence[str],
    change_column: str | None = None,
    columns: Sequence[str] | None = None,
) -> str:
    """MERGE for table formats that have it; a DELETE marker in ``change_column`` deletes."""
    on = " AND ".join(f"t.{k} <=> s.{k}" for k in keys)
    live = f" AND s.{change_column} <> 'DELETE'" if change_column else ""
    delete = (
        f" WHEN MATCHED AND s.{change_column} = 'DELETE' THEN DELETE" if change_column else ""
    )
    if columns:
        updates = ", ".join(f"t.{c} = s.{c}" for c in columns)
        inserts = f"({', '.join(columns)}) VALUES ({', '.join('s.' + c for c in columns)})"
        update, insert = f"UPDATE SET {updates}", f"INSERT {inserts}"
    else:
        update, insert = "UPDATE SET *", "INSERT *"
    return (
        f"MERGE INTO {target} t USING {source} s ON {on}{delete}"
        f" WHEN MATCHED THEN {update} WHEN NOT MATCHED{live} THEN {insert}"
    )


def upsert_batch(
    batch: DataFrame,
    table: str,
    batch_id: int,
    keys: Sequence[str],
    arrival: Sequence[str],
    fmt: str = "parquet",
) -> None:
    """Upsert a micro-batch, last arrival per key winning.

    A format with MERGE gets one; elsewhere the batch's last row per key is
    appended and ``current_rows`` reads the last one over all batches.
    """
    last = latest_by(batch, keys, arrival)
    if fmt not in MERGE_FORMATS:
        append_batch(last, table, batch_id, create=True)
        return
    view = f"batch_{uuid.uuid4().hex}"
    last.createOrReplaceTempView(view)
    batch.sparkSession.sql(merge_statement(table, view, keys, columns=batch.columns))


class Fold(NamedTuple):
    """A folder with the last row per key over all batches up to ``upto`` of each writer."""

    path: str
    upto: dict[str, int]

    def covers(self) -> Column:
        """Whether a row of the table is in the fold."""
        last = F.create_map(*[F.lit(x) for pair in self.upto.items() for x in pair])
        return F.coalesce(F.col(BATCH) <= F.try_element_at(last, F.col(WRITER)), F.lit(False))


def fold_batches(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    upto: int,
    folder: str,
    previous: Fold | None = None,
) -> Fold:
    """Write a new fold from the previous one and the batches since.

    Keeps reading cheap while batches add up: work grows with the new batches and
    the keys, not with the history. The old fold stays valid until the caller
    turns to the new one, so a failed run changes nothing. Delete markers are rows
    like others and stay, so an older change that comes later finds them. Of each
    writer the fold takes the batches that are there now, up to number ``upto``.
    """
    path = f"{folder}/upto={int(upto)}-{uuid.uuid4().hex}"
    there = spark.table(quoted(table)).filter(F.col(BATCH) <= upto)
    last = there.groupBy(WRITER).agg(F.max(BATCH).alias("last")).collect()  # a row per writer
    covered = dict(previous.upto) if previous else {}
    for r in last:
        covered[r[WRITER]] = max(r["last"], covered.get(r[WRITER], r["last"]))
    fold = Fold(path, covered)
    rows = unfolded(spark, table, previous)
    if covered:
        rows = rows.filter(fold.covers())
    latest_by(rows, keys, order).write.mode("overwrite").parquet(path)
    return fold


def unfolded(spark: SparkSession, table: str, fold: Fold | None = None) -> DataFrame:
    """All rows of the table, or the fold's rows and those it does not cover."""
    rows = spark.table(quoted(table))
    if fold is None or not fold.upto:
        return rows
    later = rows.filter(~fold.covers())
    return later.unionByName(spark.read.parquet(fold.path), allowMissingColumns=True)


def current_rows(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    arrival: Sequence[str] = (),
    fold: Fold | None = None,
) -> DataFrame:
    """The table with only the last row per key, newest micro-batch first."""
    return latest_by(unfolded(spark, table, fold), keys, [BATCH, *arrival]).drop(*RESERVED)


def write_each_batch(
    df: DataFrame,
    body: Callable[[DataFrame, int], None],
    checkpoint: str,
    seconds: int | None = 15,
    mode: str = "append",
) -> DataStreamWriter:
    """A stream writer that runs ``body`` per micro-batch, every ``seconds``.

    ``None`` drains what is there and stops. Source offsets are committed in the
    checkpoint only after the body has returned.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True)
        if seconds is None
        else writer.trigger(processingTime=f"{seconds} seconds")
    )
    return writer.foreachBatch(body)

"""File sinks: window folders, day partitions, staged JSON and its load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.times import window_path
from weirflow.operators import lattice
from weirflow.operators.rows import compute_once, sharded
from weirflow.sinks.tables import (
    RESERVED,
    WRITER,
    add_columns,
    append_batch,
    create_table,
    stream_id,
    table_columns,
    table_exists,
)
from weirflow.sources.messages import read_staged

# Folder levels of a window's end.
PARTS = ("yyyy", "mm", "dd", "hh")


def window_folders(df: DataFrame, window_end: Column) -> DataFrame:
    """Adds the folder columns ``yyyy, mm, dd, hh`` of the window's end."""
    parts = F.split(window_path(window_end), "/")
    return df.withColumns({n: F.get(parts, i) for i, n in enumerate(PARTS)})


def batch_folder(spark: SparkSession, folder: str, batch_id: int | None) -> tuple[str, str]:
    """Path and write mode: a micro-batch of a writer owns a folder, which a second run replaces.

    The writer is the stream's own id, so jobs that share a folder, and a stream started
    anew with a new checkpoint, leave each other's files alone.
    """
    if batch_id is None:
        return folder, "append"
    return f"{folder}/{WRITER}={stream_id(spark)}/batch_id={int(batch_id)}", "overwrite"


def write_window_text(
    lines: DataFrame,
    window_end: Column,
    folder: str,
    shards: int = 0,
    batch_id: int | None = None,
) -> None:
    """One ``value`` line per row below ``yyyy=/mm=/dd=/hh=`` folders."""
    path, mode = batch_folder(lines.sparkSession, folder, batch_id)
    rows = window_folders(lines, window_end).select("value", *PARTS)
    sharded(rows, shards, *PARTS).write.mode(mode).partitionBy(*PARTS).text(path)


def write_window_records(
    rows: DataFrame,
    window_end: Column,
    folder: str,
    shards: int = 0,
    batch_id: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Typed records in window folders, snappy-compressed; ``avro`` where it is deployed."""
    path, mode = batch_folder(rows.sparkSession, folder, batch_id)
    out = sharded(window_folders(rows, window_end), shards, *PARTS)
    writer = out.write.mode(mode).partitionBy(*PARTS).option("compression", "snappy")
    writer.format(fmt).save(path)


def write_by_day(df: DataFrame, event_seconds: str, path: str, batch_id: int | None = None) -> None:
    """Table files partitioned by the UTC day of an epoch-second column.

    A micro-batch that runs again replaces its own files; without a number rows are added.
    """
    day = F.to_date(F.timestamp_seconds(event_seconds))
    path, mode = batch_folder(df.sparkSession, path, batch_id)
    rows = df.withColumn("event_day", day)
    sharded(rows, 0, "event_day").write.mode(mode).partitionBy("event_day").parquet(path)


def staged_folder(folder: str, batch_id: int, writer: str) -> str:
    return f"{folder.rstrip('/')}/window={int(batch_id)}/{WRITER}={writer}"


def stage_rows(rows: DataFrame, folder: str, batch_id: int, shards: int = 0) -> str:
    """The rows of one micro-batch as newline JSON; returns their folder, the writer's own."""
    path = staged_folder(folder, batch_id, stream_id(rows.sparkSession))
    sharded(rows, shards).select(F.to_json(F.struct("*")).alias("value")).write.mode(
        "overwrite"
    ).text(path)
    return path


def stage_text(rows: DataFrame, folder: str, batch_id: int, column: str = "value") -> str:
    """Message text of one micro-batch, a line each; returns its folder, the writer's own.

    A line break in JSON text is white space between tokens, so it becomes a blank.
    """
    path = staged_folder(folder, batch_id, stream_id(rows.sparkSession))
    line = F.translate(F.col(column), "\r\n", "  ").alias("value")
    rows.select(line).write.mode("overwrite").text(path)
    return path


def staged_paths(rows: DataFrame, table: str, batch: str, folder: str) -> DataFrame:
    """Folder, rows and window per table of what is staged: one load each.

    Below a window's folder each writer has its own.
    """
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.col(table), F.lit("/window="), F.col(batch))
    return (
        rows.groupBy(table, batch)
        .agg(F.count("*").alias("staged_rows"))
        .withColumn("path", path)
    )


def load_staged(
    spark: SparkSession, paths: Sequence[str] | str, table: str, schema: T.StructType, batch_id: int
) -> None:
    """Append all staged files of one window to the table in one job, under its schema."""
    append_batch(read_staged(spark, paths, schema), table, batch_id)


def load_inferred(
    spark: SparkSession,
    paths: Sequence[str] | str,
    table: str,
    batch_id: int,
    location: str | None = None,
    dead_table: str | None = None,
) -> list[str]:
    """The same with column types inferred from the files; returns the columns added.

    Types are joined by ``operators.lattice``: a value that an existing column can't
    hold exactly goes to the field's next column, so no value is lost or rewritten
    and none fails the load. Text that is no object, a field given in two
    spellings and a field with a reserved name go to the dead letters.
    """
    lines = spark.read.text(paths)
    parsed = compute_once(lines, ["value"], fields=lattice.value_kinds(F.col("value"))).persist()
    try:
        names = F.transform("fields", lambda f: f["name"])
        reserved = F.array(*[F.lit(n) for n in RESERVED])
        checked = parsed.withColumn(
            "reason",
            F.when(F.col("fields").isNull(), "malformed")
            .when(F.size(F.array_distinct(names)) < F.size(names), "repeated field")
            .when(F.arrays_overlap(names, reserved), "unknown field"),
        )
        good = checked.filter(F.col("reason").isNull())
        there = table_exists(spark, table)
        have = table_columns(spark, table) if there else T.StructType([])
        wanted = lattice.columns_for(lattice.misfits(good, have).collect(), have)
        letters = checked.filter(F.col("reason").isNotNull()).select("value", "reason")
        added = list(wanted)
        if there:
            added = add_columns(spark, table, {n: t.simpleString() for n, t in wanted.items()})
        elif wanted:
            create_table(spark, table, T.StructType([T.StructField(n, t) for n, t in wanted.items()]), location)
        if there or wanted:
            rows = lattice.placed(good, table_columns(spark, table), ["value"])
            append_batch(rows.filter("NOT misplaced"), table, batch_id)
            lost = rows.filter("misplaced").select("value", F.lit("bad field").alias("reason"))
        else:  # no message has a value, so there is nothing to make a table of
            lost = good.select("value", F.lit("no field").alias("reason"))
        append_batch(letters.unionByName(lost), dead_table or f"{table}_dead", batch_id, create=True)
        return added
    finally:
        parsed.unpersist()

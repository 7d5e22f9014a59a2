"""Whole streaming jobs: source DataFrame in, stream writer out, ready to start.

Most pipelines are one ``write_each_batch(messages, body, checkpoint)`` with a body
from ``bodies``. The jobs here need more than one step before the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from weirflow.functions.json_text import json_field, json_map
from weirflow.functions.times import from_millis
from weirflow.operators import drift, events, logs, windows
from weirflow.operators.rows import compute_once
from weirflow.sinks import tables
from weirflow.streaming import bodies
from weirflow.streaming.dedup import dedup_stream, without_key
from weirflow.streaming.panes import pane_stream


def stamp_ingest(messages: DataFrame, name: str = "ingested") -> DataFrame:
    """Adds the processing time of the micro-batch, for windows over failures."""
    return messages.withColumn(name, F.current_timestamp())


def pane_job(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    size_seconds: int = 300,
    lateness_seconds: int = 300,
    period_seconds: int | None = 60,
    late_count: int = 1,
) -> DataStreamWriter:
    """CSV events to a table of window panes, fired early every ``period_seconds``."""
    typed = logs.good_rows(events.type_lines(lines))
    timed = typed.withColumn("ts", from_millis(F.col("event_ts")))
    panes = pane_stream(timed, "ts", size_seconds, lateness_seconds, late_count)
    # Processing time of the firing, for newest-first keys.
    fired = panes.withColumn("process_ts", F.unix_millis(F.current_timestamp()))
    return tables.write_each_batch(fired, bodies.append_body(table), checkpoint, period_seconds)


def tall_table(spark: SparkSession, table: str) -> DataFrame:
    """Accumulating reading of the pane table: one row per firing, newest first by key."""
    return windows.tall_rows(spark.table(table), process_ts=F.col("process_ts"))


def wide_table(spark: SparkSession, table: str) -> DataFrame:
    """Discarding reading of the pane table: one row per window, a cell per pane."""
    return windows.wide_rows(windows.non_empty(spark.table(table)))


def bundle_rows(
    messages: DataFrame,
    tables_by_bundle: dict[str, str],
    bundle_key: str = "bundle_id",
    uuid_key: str = "uuid",
    arrival: str = "seq",
) -> DataFrame:
    """Messages with their table and dedup key; unknown bundles and bad text get a reason."""
    entries: list[Column] = []
    for bundle, table in tables_by_bundle.items():
        entries += [F.lit(bundle), F.lit(table)]
    parsed = compute_once(messages, [arrival, "value"], row=json_map(F.col("value")))
    known = F.try_element_at(F.create_map(*entries), F.try_element_at("row", F.lit(bundle_key)))
    uuid = F.nullif(F.try_element_at("row", F.lit(uuid_key)), F.lit(""))
    reason = F.when(F.col("row").isNull(), "malformed").when(known.isNull(), "unknown bundle")
    return parsed.select(
        arrival,
        "value",
        known.alias("destination"),
        F.concat_ws("#", known, F.when(uuid.isNotNull(), uuid)).alias("_key"),
        uuid.isNotNull().alias("_keyed"),
        reason.alias("reason"),
    ).select(
        arrival,
        "value",
        "destination",
        F.when(F.col("_keyed"), F.col("_key")).alias("dedup_key"),
        "reason",
    )


def bundle_job(
    messages: DataFrame,
    tables_by_bundle: dict[str, str],
    checkpoint: str,
    ttl_seconds: int = 300,
    seconds: int | None = 120,
    **keys: str,
) -> DataStreamWriter:
    """Each bundle's rows to its table, repeats of a uuid dropped for ``ttl_seconds``.

    Rows without a uuid all pass. Fields a table lacks are ignored. Dead letters
    and the field registry come from ``bundle_side_job`` over the same source.
    """
    rows = bundle_rows(messages, tables_by_bundle, **keys).filter("reason IS NULL")
    arrival = keys.get("arrival", "seq")
    kept = dedup_stream(rows, "dedup_key", arrival, ttl_seconds)
    passed = kept.unionByName(without_key(rows, "dedup_key"))

    def body(batch: DataFrame, batch_id: int) -> None:
        with bodies.kept(batch) as stored:
            for table in sorted(set(tables_by_bundle.values())):
                target = tables.table_columns(batch.sparkSession, table)
                own = drift.dynamic_rows(stored.filter(F.col("destination") == table))
                checked = drift.strict_split(own, target, ignore_unknown=True)
                good = checked.filter(F.col("reason").isNull())
                tables.append_batch(drift.as_columns(good, target), table, batch_id)
                dead = logs.dead_letters(checked)
                tables.append_batch(dead, bodies.dead_of(table, None), batch_id, create=True)

    return tables.write_each_batch(passed, body, checkpoint, seconds)


def bundle_side_job(
    messages: DataFrame,
    tables_by_bundle: dict[str, str],
    dead_table: str,
    registry_table: str,
    checkpoint: str,
    seconds: int | None = 120,
    **keys: str,
) -> DataStreamWriter:
    """Dead letters and the registry of fields seen per table."""
    arrival = keys.get("arrival", "seq")
    rows = stamp_ingest(bundle_rows(messages, tables_by_bundle, **keys))

    def body(batch: DataFrame, batch_id: int) -> None:
        with bodies.kept(batch) as stored:
            letters = logs.dead_letters(stored, [arrival])
            tables.append_batch(letters, dead_table, batch_id, create=True)
            good = drift.dynamic_rows(stored.filter("reason IS NULL"), ["destination", "ingested"])
            seen = drift.field_registry(good, "destination", "ingested")
            tables.append_batch(seen, registry_table, batch_id, create=True)

    return tables.write_each_batch(rows, body, checkpoint, seconds)


def json_value_view(df: DataFrame, name: str, column: str = "METADATA", *paths: str) -> DataFrame:
    """Register a reading of a JSON column with the given fields taken out."""
    view = df.select("*", *[json_field(column, p).alias(p.replace(".", "_")) for p in paths])
    view.createOrReplaceTempView(name)
    return view

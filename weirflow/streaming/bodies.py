"""``foreachBatch`` bodies: what a micro-batch does, in program order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.json_text import split_metadata
from weirflow.functions.times import from_millis
from weirflow.operators import cdc, drift, events, logs, windows
from weirflow.operators.rows import compute_once, latest_by, sharded, with_lookup
from weirflow.session import materialize, staged
from weirflow.sinks import bulk, bulk_source, files, tables, upserted
from weirflow.sinks.upserted import UpsertTable

Body = Callable[[DataFrame, int], None]


# Whether the parts of a kept result may follow AQE; otherwise they are as many as a shuffle's.
_KEPT_PARTS = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


@contextmanager
def kept(df: DataFrame, several: bool = True, by_size: bool = False) -> Iterator[DataFrame]:
    """A micro-batch that feeds several writes is read and parsed once.

    With ``by_size`` AQE merges small parts and splits large ones before they are kept.
    """
    if not several:
        yield df
        return
    conf = df.sparkSession.conf
    before = conf.get(_KEPT_PARTS)
    conf.set(_KEPT_PARTS, "true" if by_size else before)
    try:
        stored = df.persist()
    finally:
        conf.set(_KEPT_PARTS, before)
    try:
        yield stored
    finally:
        stored.unpersist()


def dealt(batch: DataFrame) -> DataFrame:
    """A micro-batch in parts of bounded size, for a parse that makes its rows many times wider.

    A source may give it in a few large parts; what a task keeps of each would grow with them.
    """
    return sharded(batch, 0)


def log_body(
    table: str,
    dead_table: str | None = None,
    keep: Sequence[str] = (),
    shards: int | None = None,
) -> Body:
    """Parse log messages, append good rows and dead letters to their tables."""

    def body(batch: DataFrame, batch_id: int) -> None:
        with kept(logs.parse_logs(batch, keep), bool(dead_table)) as parsed:
            good = logs.good_rows(parsed)
            tables.append_batch(good, table, batch_id, create=True, shards=shards)
            if dead_table:
                dead = logs.dead_letters(parsed, keep)
                tables.append_batch(dead, dead_table, batch_id, create=True)

    return body


def dead_of(table: str, dead_table: str | None) -> str:
    """The dead-letter table: the one named, or one beside the table."""
    return dead_table or f"{table}_dead"


def upsert_body(
    table: str,
    keys: Sequence[str],
    arrival: str,
    parse: Callable,
    fmt: str = "parquet",
    buckets: int = 16,
    dead_table: str | None = None,
) -> Body:
    """Parse and upsert by primary key, with MERGE where the table format has it.

    Elsewhere the table is one of ``sinks.upserted``, read with a plain ``SELECT``. A later
    micro-batch wins; inside one, the later arrival. ``parse`` gives the good rows, or
    those and the dead letters.
    """
    target = UpsertTable(table, list(keys), [arrival], buckets, sequenced=True)

    def body(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            parsed = parse(rows)
            good, letters = parsed if isinstance(parsed, tuple) else (parsed, None)
            if fmt in tables.MERGE_FORMATS:
                tables.upsert_batch(good, table, batch_id, keys, [arrival], fmt)
            else:
                upserted.upsert(good, target)
            if letters is not None:
                tables.append_batch(letters, dead_of(table, dead_table), batch_id, create=True)

    return body


def change_table(table: str, buckets: int = 16) -> UpsertTable:
    """The table of ``applied_change_body``: a row per record of each destination."""
    return UpsertTable(table, ["destination", "record_key"], cdc.CHANGE_ORDER, buckets, deleted="deleted")


def applied_change_body(
    target: UpsertTable, arrival: str, dead_table: str | None = None, keep_deletes_ms: int | None = None
) -> Body:
    """Apply each batch's changes to a table that is read as it is, with a plain ``SELECT``.

    Deletes stay in it unseen, so an older change that comes later finds them; with
    ``keep_deletes_ms`` those go whose time is that far behind the newest of the batch.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        with kept(cdc.parse_changes(dealt(batch), [arrival]), by_size=True) as parsed:
            changes = cdc.changed_records(parsed, arrival).withColumn(
                "record_key", cdc.record_key(F.col("pk_names"), F.col("record"))
            )
            marked = changes.withColumn("deleted", F.coalesce(F.col("change_type") == "DELETE", F.lit(False)))
            purge = None
            if keep_deletes_ms is not None:
                newest = parsed.agg(F.max("ts")).first()[0]
                purge = F.col("ts") < (newest or 0) - keep_deletes_ms
            upserted.upsert(marked, target, purge)
            letters = logs.dead_letters(parsed, [arrival])
            tables.append_batch(letters, dead_of(target.name, dead_table), batch_id, create=True)

    return body


def change_body(table: str, arrival: str, dead_table: str | None = None) -> Body:
    """Append each batch's last change per record; ``current_records`` applies them."""

    def body(batch: DataFrame, batch_id: int) -> None:
        with kept(cdc.parse_changes(batch, [arrival]), bool(dead_table)) as parsed:
            changes = cdc.changed_records(parsed, arrival)
            keyed = changes.withColumn(
                "record_key", cdc.record_key(F.col("pk_names"), F.col("record"))
            )
            last = latest_by(keyed, ["destination", "record_key"], cdc.CHANGE_ORDER)
            tables.append_batch(last, table, batch_id, create=True)
            if dead_table:
                dead = logs.dead_letters(parsed, [arrival])
                tables.append_batch(dead, dead_table, batch_id, create=True)

    return body


def current_records(changes: DataFrame) -> DataFrame:
    """Live records of a change table: deletes stay in it as markers, out of the reading."""
    last = latest_by(changes, ["destination", "record_key"], cdc.CHANGE_ORDER)
    return last.filter(F.coalesce(F.col("change_type"), F.lit("UPSERT")) != "DELETE")


def routed_change_body(
    arrival: str, dead_table: str = "unrouted_changes", table_of: Callable[[str], str] = str
) -> Body:
    """Append changes to the table each one names, in that table's own columns.

    ``table_of`` gives the table of a destination, by default of the same name. Names
    that differ only in case are one table. Record fields a table lacks are ignored.
    Rows carry their change columns, so ``current_table`` can apply them. A change
    whose destination is no table, or with a value that does not parse, goes to the
    dead letters with its reason. Envelopes are parsed and exploded once, to files: they
    are as large as the batch and read once per table. Of a message only a dead letter
    keeps its text.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        text = F.when(F.col("reason").isNotNull(), F.col("value"))
        with staged(cdc.parse_changes(dealt(batch), [arrival]).withColumn("value", text), "parsed") as parsed:
            changes = cdc.changed_records(parsed, arrival).withColumn(
                "record_key", cdc.record_key(F.col("pk_names"), F.col("record"))
            )
            with staged(changes, "changes") as changes:
                names = changes.select("destination").distinct().collect()
                found = tables.known_tables(spark, (r[0] for r in names), table_of)
                letters = logs.dead_letters(parsed, [arrival])
                known = [n for own in found.values() for n in own]
                lost = changes.filter(~F.col("destination").isin(known))
                letters = letters.unionByName(_dead_changes(lost, arrival, "no table"))
                for table, own_names in found.items():
                    target = data_columns(spark, table, cdc.CHANGE_COLUMNS)
                    own = changes.filter(F.col("destination").isin(own_names))
                    bad = cdc.bad_record(F.col("record"), target)
                    letters = letters.unionByName(_dead_changes(own.filter(bad), arrival, "bad field"))
                    rows = cdc.record_columns(own.filter(~bad), target, cdc.CHANGE_COLUMNS)
                    last = latest_by(rows, ["record_key"], cdc.CHANGE_ORDER)
                    tables.append_batch(last, table, batch_id)
                tables.append_batch(letters, dead_table, batch_id, create=True)

    return body


def _dead_changes(changes: DataFrame, arrival: str, reason: str) -> DataFrame:
    return changes.select(
        F.col("arrival").alias(arrival), F.to_json("record").alias("value"), F.lit(reason).alias("reason")
    )


def create_change_table(
    spark: SparkSession, table: str, schema: T.StructType, location: str | None = None
) -> None:
    """A destination table: its record columns plus the change columns."""
    tables.create_table(
        spark, table, T.StructType([*schema.fields, *cdc.CHANGE_FIELDS.fields]), location
    )


def current_table(changes: DataFrame) -> DataFrame:
    """Live rows of one destination table, without the change columns."""
    last = latest_by(changes, ["record_key"], cdc.CHANGE_ORDER)
    live = last.filter(F.coalesce(F.col("change_type"), F.lit("UPSERT")) != "DELETE")
    return live.drop(*cdc.CHANGE_COLUMNS, *tables.RESERVED)


def append_body(table: str) -> Body:
    """Append the rows of each batch as they are."""

    def body(batch: DataFrame, batch_id: int) -> None:
        tables.append_batch(batch, table, batch_id, create=True)

    return body


def sql_body(
    table: str, statement: str, keep: Sequence[str] = (), dead_table: str | None = None
) -> Body:
    """Parse log messages, run a SQL statement over the good rows, append its result."""

    def body(batch: DataFrame, batch_id: int) -> None:
        with kept(logs.parse_logs(batch, keep, millis=True), bool(dead_table)) as parsed:
            result = logs.sql_over(logs.good_rows(parsed), statement)
            tables.append_batch(result, table, batch_id, create=True)
            if dead_table:
                dead = logs.dead_letters(parsed, keep)
                tables.append_batch(dead, dead_table, batch_id, create=True)

    return body


def event_body(
    load_lookup: Callable[[], DataFrame],
    size: str,
    table: str | None = None,
    text_folder: str | None = None,
    record_folder: str | None = None,
    error_folder: str | None = None,
    post: Callable[[str], int] | None = None,
    shards: int = 0,
    delimiter: str = ",",
    receipts: str | None = None,
) -> Body:
    """CSV events to every raw sink: table rows by day, text and record files, documents, errors.

    The lookup is read again for each micro-batch. Lines come with their ingest
    time in ``ingested``, which windows the errors. With a folder for ``receipts`` a
    micro-batch whose documents were posted posts none when it runs again.
    """
    sink = f"bulk_{uuid.uuid4().hex}"

    def body(batch: DataFrame, batch_id: int) -> None:
        # Written first, so Spark knows its size: a small lookup is broadcast, and all
        # sinks see the same one.
        lookup = materialize(load_lookup(), "lookup")
        parsed = events.type_lines(batch, delimiter=delimiter, keep=["ingested"])
        timed = events.with_process_time(parsed).withColumn("ts", from_millis(F.col("event_ts")))
        with kept(with_lookup(timed, lookup, "dim1", "dim1_val")) as stamped:
            enriched = logs.good_rows(stamped)
            windowed = windows.with_plain_pane(windows.with_window(enriched, "ts", size), "event_ts")
            end = F.col("window.end")
            if table:
                rows = events.table_rows(windowed)
                day = F.to_date(F.timestamp_seconds("event_ts"))
                append = rows.withColumn("event_day", day)
                if not tables.table_exists(batch.sparkSession, table):
                    tables.create_table(
                        batch.sparkSession, table, append.schema, partitions=["event_day"]
                    )
                tables.append_batch(append, table, batch_id)
            if text_folder:
                line = F.concat_ws(delimiter, *events.EVENT_SCHEMA.fieldNames(), "process_ts", "dim1_val")
                lines = windowed.select(line.alias("value"), "window")
                files.write_window_text(lines, end, text_folder, shards, batch_id)
            if record_folder:
                records = windowed.select(*events.EVENT_SCHEMA.fieldNames(), "process_ts", "dim1_val", "window")
                files.write_window_records(records, end, record_folder, shards, batch_id)
            if post:
                docs = events.search_documents(enriched)
                if receipts:
                    bulk_source.register_bulk(batch.sparkSession, sink, post)
                    bulk_source.bulk_commit_body(sink, receipts)(docs, batch_id)
                else:
                    bulk.bulk_totals(bulk.send_bulk(docs, post)).collect()
            if error_folder:
                dead = windows.with_window(logs.dead_letters(stamped, ["ingested"]), "ingested", size)
                files.write_window_text(dead, end, error_folder, shards, batch_id)

    return body


# Rows without a tick come before all others.
NO_TICK = -(2**62)

MARKS = "tick bigint, min_ts timestamp, max_ts timestamp, watermark timestamp"


def _tick_marks(ticks: DataFrame, marks_table: str, batch_id: int) -> DataFrame:
    """``tick, watermark`` of a micro-batch's ticks, by all ticks before; kept in the table."""
    spark = ticks.sparkSession
    tables.create_table(spark, marks_table, T.StructType.fromDDL(MARKS))
    own = F.col(tables.WRITER) == tables.stream_id(spark)
    kept_marks = spark.table(marks_table)
    before = kept_marks.filter(own & (F.col(tables.BATCH) < batch_id)).agg(F.max("max_ts")).first()[0]
    tables.append_batch(windows.tick_watermarks(ticks, before), marks_table, batch_id)
    mine = spark.table(marks_table).filter(own & (F.col(tables.BATCH) == batch_id))
    return mine.select("tick", "watermark")


def late_body(
    table: str, marks_table: str, ts: str, size: str, lateness: str, tick: Column | None = None
) -> Body:
    """Rows with their ``window`` and ``timing``; the watermark survives a restart.

    The watermark is the highest event time of all earlier micro-batches of this
    stream, kept as one row per micro-batch; only that one time reaches the driver.
    With ``tick``, the number of a row's trigger interval, a micro-batch holds several
    intervals and the watermark moves with each of them.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(batch) as rows:
            if tick is not None:
                ticked = rows.withColumn("tick", F.coalesce(tick.cast("bigint"), F.lit(NO_TICK)))
                at = F.col(ts).cast("timestamp")
                ticks = ticked.groupBy("tick").agg(F.min(at).alias("min_ts"), F.max(at).alias("max_ts"))
                joined = ticked.join(F.broadcast(_tick_marks(ticks, marks_table, batch_id)), "tick")
                marked = windows.mark_late(joined, ts, size, lateness, F.col("watermark"))
                tables.append_batch(marked.drop("tick", "watermark"), table, batch_id, create=True)
                return
            newest = rows.agg(F.max(F.col(ts).cast("timestamp")).alias("newest"))
            tables.append_batch(newest, marks_table, batch_id, create=True)
            own = F.col(tables.WRITER) == tables.stream_id(spark)
            before = spark.table(marks_table).filter(own & (F.col(tables.BATCH) < batch_id))
            watermark = before.agg(F.max("newest")).first()[0]
            marked = windows.mark_late(rows, ts, size, lateness, watermark)
            tables.append_batch(marked, table, batch_id, create=True)

    return body


def pane_parts_body(table: str, marks_table: str, ts: str, size: str, lateness: str, tick: Column) -> Body:
    """What each trigger interval adds to its windows, timed by the watermark at it.

    A micro-batch may hold many intervals; ``windows.tick_panes`` reads the panes from
    both tables. The marks of earlier micro-batches carry the watermark on.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        ticked = batch.withColumn("tick", F.coalesce(tick.cast("bigint"), F.lit(NO_TICK)))
        with kept(windows.pane_parts(ticked, ts, size)) as parts:
            ticks = parts.groupBy("tick").agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))
            marks = _tick_marks(ticks, marks_table, batch_id)
            tables.append_batch(windows.timed_parts(parts, marks, lateness), table, batch_id, create=True)

    return body


def basic_event_body(table: str, schema: T.StructType, dead_table: str | None = None) -> Body:
    """JSON events to a declared table partitioned by the day of ``event_ts``."""

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = T.StructType([f for f in schema.fields if f.name != "event_ts"])
        checked = drift.strict_split(events.basic_events(batch), target, ignore_unknown=True)
        with kept(checked) as parsed:
            rows = drift.as_columns(logs.good_rows(parsed), target, ["event_ts"])
            dated = rows.withColumn("event_day", F.to_date(F.timestamp_seconds("event_ts")))
            tables.create_table(spark, table, dated.schema, partitions=["event_day"])
            tables.append_batch(dated, table, batch_id)
            tables.append_batch(logs.dead_letters(parsed), dead_of(table, dead_table), batch_id, create=True)

    return body


def json_column_body(table: str, dead_table: str | None = None) -> Body:
    """Two flat columns and one JSON column; text that is no object is a dead letter."""

    def body(batch: DataFrame, batch_id: int) -> None:
        parsed = compute_once(dealt(batch), ["value"], r=split_metadata(F.col("value")))
        with kept(parsed, by_size=True) as split:
            good = split.filter("r.parsed").select("r.ID", "r.SENDER_NAME", "r.METADATA")
            tables.append_batch(good, table, batch_id, create=True)
            dead = split.filter("NOT r.parsed")
            dead = dead.select("value", F.lit("malformed").alias("reason"))
            tables.append_batch(dead, dead_of(table, dead_table), batch_id, create=True)

    return body


def declared_body(
    table: str, schema: T.StructType, location: str | None = None, dead_table: str | None = None
) -> Body:
    """Rows under a declared schema version; the table gains the version's new fields first.

    Text that is no object, a missing required field and a value that does not parse
    send the row to the dead letters. A row with a field the version lacks is written
    without it, and its text is also kept there, as ``unknown field``.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checked = drift.strict_split(drift.dynamic_rows(batch), schema, ignore_unknown=True)
        with kept(checked) as rows:
            tables.create_table(spark, table, schema, location)
            tables.add_fields(spark, table, schema)
            good = rows.filter(F.col("reason").isNull())
            tables.append_batch(drift.as_columns(good, schema), table, batch_id)
            more = good.filter(F.size(drift.new_keys(F.col("row"), schema.names)) > 0)
            letters = logs.dead_letters(rows).unionByName(
                more.select("value", F.lit("unknown field").alias("reason"))
            )
            tables.append_batch(letters, dead_of(table, dead_table), batch_id, create=True)

    return body


def staged_load_body(
    table: str, stage_folder: str, location: str | None = None, dead_table: str | None = None
) -> Body:
    """Stage each window's messages as files, then load them with inferred new columns.

    All text is staged as it came. What the load can't place goes to the dead letters.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        path = files.stage_text(batch.filter(F.col("value").isNotNull()), stage_folder, batch_id)
        files.load_inferred(batch.sparkSession, path, table, batch_id, location, dead_of(table, dead_table))

    return body


def healing_body(
    table: str,
    keep: Sequence[str] = (),
    dead_table: str | None = None,
    registry_table: str | None = None,
    ts: str | None = None,
    location: str | None = None,
    route_table: str | None = None,
) -> Body:
    """Route by schema, widen the table, then write: no row and no value is lost.

    Each row is judged by the table as it is when its micro-batch starts: NORMAL, or
    DRIFTED with the fields to be added. ``route_table`` gets that for every message
    that is an object, ahead of the write.

    The schema is read once per micro-batch; columns are added before any drifted
    row is written, so the barrier between the two is the order of statements.
    Normal and drifted rows then go out in one append. Only rows that will be written
    widen the table: a value that does not parse as its column's type, or a field with
    a reserved name (a partition column's or one of ``keep``, which come from the
    source) sends its row to the dead letters.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(drift.dynamic_rows(batch, keep)) as rows:
            if not tables.table_exists(spark, table):
                first = [T.StructField("ID", T.StringType()), *[batch.schema[c] for c in keep]]
                tables.create_table(spark, table, T.StructType(first), location)
            if route_table:
                live = data_columns(spark, table, keep).names
                routed = drift.route_rows(rows.filter(F.col("reason").isNull()), live)
                tables.append_batch(routed.select(*keep, "route", "missing"), route_table, batch_id, create=True)
            before = drift.strict_split(
                rows, data_columns(spark, table, keep), ignore_unknown=True, refused=[*keep, *tables.RESERVED]
            )
            tables.evolve(before.filter(F.col("reason").isNull()), table)
            target = data_columns(spark, table, keep)
            checked = drift.strict_split(before, target)
            dead = logs.dead_letters(checked, keep)
            tables.append_batch(dead, dead_of(table, dead_table), batch_id, create=True)
            good = checked.filter(F.col("reason").isNull())
            tables.append_batch(drift.as_columns(good, target, keep), table, batch_id)
            if registry_table and ts:
                seen = drift.field_registry(good.withColumn("table", F.lit(table)), "table", ts)
                tables.append_batch(seen, registry_table, batch_id, create=True)

    return body


def failed_rows_body(
    table: str, keep: Sequence[str] = (), dead_table: str | None = None
) -> Body:
    """Strict write: rows that failed on unknown fields are healed, the others are dead letters.

    The fields of the failed rows are added in one step, then all rows are
    checked again against the wider table.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(drift.dynamic_rows(batch, keep)) as rows:
            # A row that would fail for another reason too does not widen the table.
            sound = drift.strict_split(
                rows, data_columns(spark, table, keep), ignore_unknown=True, refused=[*keep, *tables.RESERVED]
            ).filter(F.col("reason").isNull())
            tables.evolve(sound, table)
            target = data_columns(spark, table, keep)
            checked = drift.strict_split(rows, target)
            good = checked.filter(F.col("reason").isNull())
            tables.append_batch(drift.as_columns(good, target, keep), table, batch_id)
            dead = checked.filter(F.col("reason").isNotNull())
            tables.append_batch(
                dead.select(*keep, "value", "reason"), dead_of(table, dead_table), batch_id, create=True
            )

    return body


def data_columns(spark: SparkSession, table: str, keep: Sequence[str]) -> T.StructType:
    """Columns of the table that come from the message itself."""
    fields = tables.table_columns(spark, table).fields
    return T.StructType([f for f in fields if f.name not in keep])

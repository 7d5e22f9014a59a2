"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.json_text import (
    flatten_json,
    json_field,
    json_map,
    json_texts,
    split_metadata,
)
from weirflow.functions import times
from weirflow.functions.times import epoch_millis, from_millis
from weirflow.operators import cdc, compare, drift, events, logs, lookups, rows, windows
from weirflow.plans import adapters
from weirflow.session import materialize, prepare_session, scratch_dir
from weirflow.sinks import bulk, bulk_source, compact, files, routed, tables
from weirflow.sources.messages import envelope_rows, stream_table, with_fresh_lookup
from weirflow.sources.schemas import record_schema, table_schema
from weirflow.streaming import bodies, jobs, retry
from weirflow.streaming.batches import batch_stream
from weirflow.streaming.dedup import dedup_stream, without_key
from weirflow.streaming.panes import pane_stream

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = "1 hour"
WINDOW_SECONDS = 3600
LATENESS = "12 hours"
LATENESS_SECONDS = 12 * 3600
PERIOD = 1800
DEDUP_TTL = 86_400
DEDUP_PERIOD = 60
PROCESS_DELAY_MS = 1500
PANE_TICK_MS = 5 * 86_400_000
LATE_COUNT = 2
TICK_FILES = 4
ROUTES = 12

DRIFT_START = ("ID", "SENDER_NAME")

# Three declared versions of one table: a nested and a top-level field are added,
# then a field whose type changed comes back under a new name.
_RECORD_V1 = [{"name": n, "type": "STRING"} for n in ("SENDER_NAME", "SENDER_COMPANY")]
_RECORD_V2 = [*_RECORD_V1, {"name": "SENDER_MOBILE_PHONE", "type": "STRING"}]


def _version(record: list[dict], *more: dict) -> T.StructType:
    return table_schema(
        [
            {"name": "ID", "type": "STRING", "mode": "REQUIRED"},
            {"name": "SENDER_JSON", "type": "JSON"},
            {"name": "SENDER_RECORD", "type": "RECORD", "fields": record},
            *more,
        ]
    )


_TOP = {"name": "NEW_TOP_LEVEL_FIELD", "type": "STRING"}
_TOP_V2 = {"name": "NEW_TOP_LEVEL_FIELD_V2", "type": "INTEGER"}
VERSIONS = (
    _version(_RECORD_V1),
    _version(_RECORD_V2, _TOP),
    _version(_RECORD_V2, _TOP, _TOP_V2),
)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{folder}/{name}.parquet")


def _fresh_table(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


# Log ingest


def _logs(spark: SparkSession, folder: str) -> DataFrame:
    return logs.parse_logs(adapters.log_messages(read(spark, folder, "events")), ["seq"])


def log_parse(spark: SparkSession, folder: str) -> DataFrame:
    return logs.good_rows(_logs(spark, folder))


def log_millis(spark: SparkSession, folder: str) -> DataFrame:
    """Good log rows whose time keeps its milliseconds."""
    parsed = logs.parse_logs(
        adapters.log_messages(read(spark, folder, "events")), ["seq"], millis=True
    )
    return logs.good_rows(parsed).select(
        "seq", epoch_millis(F.col("timestamp")).alias("at_ms"), "severity"
    )


def time_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Times as text and back: milliseconds or a fixed now, change sequence, window stamp and key."""
    at = epoch_millis(F.col("ts"))
    sent = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.concat(F.lit(" "), at.cast("string")))
    end = F.window("ts", WINDOW)["end"]
    return read(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        epoch_millis(times.millis_or_now(sent, F.timestamp_millis(F.lit(0)))).alias("at_ms"),
        times.change_sequence(at).alias("sequence"),
        times.window_stamp(end).alias("stamp"),
        times.newest_first_key(F.col("event_type"), at).alias("key"),
        times.micros_to_seconds(F.unix_micros(F.col("ts").cast("timestamp"))).alias("seconds"),
    )


def log_filter_sql(spark: SparkSession, folder: str) -> DataFrame:
    statement = "SELECT * FROM PCOLLECTION WHERE severity != 'DEBUG'"
    return logs.sql_over(log_parse(spark, folder), statement)


def log_dlq(spark: SparkSession, folder: str) -> DataFrame:
    dead = logs.dead_letters(_logs(spark, folder))
    return dead.groupBy("reason").agg(F.count("*").alias("messages"))


def log_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return logs.upsert_rows(log_parse(spark, folder), ["trace_id"], ["seq"])


# Exact JSON


def bigint_flatten(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.big_number_messages(read(spark, folder, "lineitem"))
    names = ("ID", "wide", "wrapper", "code", "qty", "old", "flag")
    m = rows.compute_once(messages, [], m=json_texts(F.col("value"), names)).select("m.*")
    return m.select(
        F.col("ID").alias("id_text"),
        (F.col("ID").try_cast("decimal(38,0)") + 1).cast("string").alias("id_plus_one"),
        F.col("wide").alias("wide_text"),
        "wrapper",
        json_field("wrapper", "ID").alias("wrapper_id"),
        "code",
        F.col("qty").try_cast("bigint").alias("qty"),
        F.coalesce("old", F.lit("none")).alias("old_value"),
        "flag",
    )


def _envelopes(spark: SparkSession, folder: str, as_string: bool) -> DataFrame:
    messages = adapters.nested_messages(read(spark, folder, "orders"))
    flat = rows.compute_once(messages, ["seq"], envelope=flatten_json(F.col("value"), as_string))
    return flat.filter(F.col("envelope").isNotNull())


def bigint_envelope(spark: SparkSession, folder: str) -> DataFrame:
    return _envelopes(spark, folder, False)


def bigint_envelope_text(spark: SparkSession, folder: str) -> DataFrame:
    return _envelopes(spark, folder, True)


def json_metadata_split(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.sender_messages(read(spark, folder, "customer"))
    split = rows.compute_once(messages, [], r=split_metadata(F.col("value"))).filter("r.parsed")
    return split.select(
        "r.ID",
        "r.SENDER_NAME",
        "r.METADATA",
        json_field("r.METADATA", "account").alias("account"),
        json_field("r.METADATA", "profile.segment").alias("segment"),
    )


# CSV events


def _typed_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapters.csv_lines(read(spark, folder, "events"))
    return events.type_lines(lines, keep=["arrival"])


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return logs.good_rows(_typed_lines(spark, folder))


def _timed_events(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).withColumn("ts", from_millis(F.col("event_ts")))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    processed = events.with_process_time(
        _events(spark, folder), F.col("event_ts") + PROCESS_DELAY_MS
    )
    lookup = adapters.lookup_table(read(spark, folder, "events"))
    return rows.with_lookup(processed, lookup, "dim1", "dim1_val")


def csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).drop("arrival")


def csv_failures(spark: SparkSession, folder: str) -> DataFrame:
    return logs.dead_letters(_typed_lines(spark, folder))


def dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select("seq", "dim1", "dim1_val", "process_ts")


def search_docs(spark: SparkSession, folder: str) -> DataFrame:
    return events.search_documents(_enriched(spark, folder), ["seq"])


def table_rows(spark: SparkSession, folder: str) -> DataFrame:
    timed = _enriched(spark, folder).withColumn("ts", from_millis(F.col("event_ts")))
    windowed = windows.with_plain_pane(windows.with_window(timed, "ts", WINDOW), "event_ts")
    return events.table_rows(windowed)


def basic_event_rows(spark: SparkSession, folder: str) -> DataFrame:
    parsed = events.basic_events(adapters.basic_messages(read(spark, folder, "events")), ["seq"])
    return logs.good_rows(parsed).select(
        "seq",
        "event_ts",
        F.try_element_at("row", F.lit("kind")).alias("kind"),
        F.try_element_at("row", F.lit("user")).try_cast("bigint").alias("user"),
        F.size("row").cast("bigint").alias("fields"),
    )


RECORD = """{"type": "record", "name": "reading", "fields": [
    {"name": "kind", "type": "string"}, {"name": "even", "type": ["null", "boolean"]},
    {"name": "user", "type": "int"}, {"name": "at_ms", "type": "long"},
    {"name": "about", "type": "float"}, {"name": "exactly", "type": "double"}]}"""


def typed_record(spark: SparkSession, folder: str) -> DataFrame:
    """Text lines to the types of a record description, each kind once."""
    line = F.concat_ws(
        ",",
        "event_type",
        F.when(F.col("user_id") % 2 == 0, "True").otherwise("no"),
        F.col("user_id").cast("string"),
        epoch_millis(F.col("ts")).cast("string"),
        F.col("value").cast("string"),
        F.col("value").cast("string"),
    )
    lines = read(spark, folder, "events").select(F.col("event_id").alias("seq"), line.alias("value"))
    typed = events.type_lines(lines, record_schema(RECORD), keep=["seq"])
    return logs.good_rows(typed)


# Windows


def _stats_in_millis(stats: DataFrame) -> DataFrame:
    return stats.withColumns(
        {
            "window_start": epoch_millis(F.col("window_start")),
            "window_end": epoch_millis(F.col("window_end")),
        }
    )


def window_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _stats_in_millis(windows.window_stats(_timed_events(spark, folder), "ts", WINDOW))


def _by_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream that takes a micro-batch per five days of arrival."""
    lines = adapters.csv_lines(read(spark, folder, "events"))
    timed = logs.good_rows(events.type_lines(lines, keep=["arrival"])).withColumn("ts", from_millis(F.col("event_ts")))
    return ticks(timed, F.call_function("div", epoch_millis(F.col("arrival")), F.lit(PANE_TICK_MS)), "arrivals")


def _panes(spark: SparkSession, folder: str) -> DataFrame:
    """Panes of a stream, and the ``tick`` that made each fire.

    A passing watermark fires with the next micro-batch.
    """
    panes = pane_stream(_by_arrival(spark, folder), "ts", WINDOW_SECONDS, LATENESS_SECONDS, LATE_COUNT)
    table = _sink_table(spark, "panes", panes.schema)
    _drain(panes, bodies.append_body(table), spark, "panes")
    passing = ((F.col("timing") == "ON_TIME") | F.col("is_last")).cast("bigint")
    fired = spark.table(table).withColumn("tick", F.col(tables.BATCH) - passing)
    return fired.drop(*tables.RESERVED)


def _whole_panes(panes: DataFrame) -> DataFrame:
    """Window bounds in milliseconds, and 0 for the bounds of an empty pane."""
    filled = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("sum", "min", "max")}
    return _stats_in_millis(panes).withColumns(filled)


def pane_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Early, on-time, late and closing panes of a stream over several micro-batches."""
    return _whole_panes(_panes(spark, folder))


def _period_tick() -> Column:
    """The early-firing period, counted from 1970, in which a row arrives."""
    return F.call_function("div", epoch_millis(F.col("arrival")), F.lit(PERIOD * 1000))


def _period_panes(spark: SparkSession, folder: str) -> DataFrame:
    """Panes that fire every period; a micro-batch of the stream holds the periods of five days."""
    table, marks = _fresh_table("pane_parts"), _fresh_table("pane_marks")
    body = bodies.pane_parts_body(table, marks, "ts", WINDOW, LATENESS, _period_tick())
    _drain(_by_arrival(spark, folder), body, spark, "period-panes")
    return windows.tick_panes(spark.table(table), spark.table(marks), WINDOW)


def window_tall(spark: SparkSession, folder: str) -> DataFrame:
    fired_at = (F.col("tick") + 1) * (PERIOD * 1000)
    return windows.tall_rows(_period_panes(spark, folder), process_ts=fired_at)


def window_wide(spark: SparkSession, folder: str) -> DataFrame:
    wide = windows.wide_rows(windows.non_empty(_period_panes(spark, folder)))
    return wide.select("row_key", F.explode("cells").alias("column", "value"))


def late_drop(spark: SparkSession, folder: str) -> DataFrame:
    """Each row in time, late or dropped, by the watermark of a stream that moves every period."""
    table, marks = _fresh_table("timed"), _fresh_table("marks")
    body = bodies.late_body(table, marks, "ts", WINDOW, LATENESS, _period_tick())
    _drain(_by_arrival(spark, folder), body, spark, "late-drop")
    return spark.table(table).select("seq", "dim1", "event_ts", "timing")


def error_windows(spark: SparkSession, folder: str) -> DataFrame:
    dead = logs.dead_letters(_typed_lines(spark, folder), ["arrival"])
    windowed = windows.with_window(dead, "arrival", WINDOW)
    return windowed.groupBy("window", "reason").agg(F.count("*").alias("messages")).select(
        epoch_millis(F.col("window.end")).alias("window_end"), "reason", "messages"
    )


def day_partition(spark: SparkSession, folder: str) -> DataFrame:
    windowed = windows.with_window(_timed_events(spark, folder), "ts", WINDOW)
    placed = files.window_folders(windowed, F.col("window.end"))
    return (
        placed.groupBy(
            F.date_format("ts", "yyyy-MM-dd").alias("event_day"),
            F.concat_ws("/", "yyyy", "mm", "dd", "hh").alias("folder"),
        )
        .agg(F.count("*").alias("num_records"))
    )


def window_files(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the events to window folders and reads the written files back."""
    windowed = windows.with_window(_timed_events(spark, folder), "ts", WINDOW)
    out = scratch_dir(spark, "window-files")
    line = F.concat_ws(",", "event_ts", "seq", "dim1", "metrics1")
    lines = windowed.select(line.alias("value"), "window")
    files.write_window_text(lines, F.col("window.end"), out)
    schema = "value string, yyyy string, mm string, dd string, hh string"
    back = spark.read.schema(schema).text(out)
    return back.select("value", F.concat_ws("/", "yyyy", "mm", "dd", "hh").alias("folder"))


def dedup_ttl(spark: SparkSession, folder: str) -> DataFrame:
    """First rows per key over several micro-batches; a key is free again after a day."""
    arrivals = tick_stream(spark, folder, "events", "event_id")
    minute = F.timestamp_seconds(F.unix_seconds("arrival") - F.pmod(F.unix_seconds("arrival"), F.lit(DEDUP_PERIOD)))
    keyed = _keyed_events(arrivals).withColumn("arrival", minute)
    return _deduped(spark, keyed, "dedup-ttl", ttl_seconds=DEDUP_TTL, at="arrival")


def _deduped(spark: SparkSession, keyed: DataFrame, label: str, **options) -> DataFrame:
    table = _sink_table(spark, label.replace("-", "_"), "seq bigint, uuid string, unkeyed boolean")
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        deduped = dedup_stream(keyed, "uuid", "seq", **options).withColumn("unkeyed", F.lit(False))
        unkeyed = without_key(keyed, "uuid").withColumn("unkeyed", F.lit(True))
        _drain(deduped.unionByName(unkeyed), bodies.append_body(table), spark, label)
    finally:
        spark.conf.set(setting, before)
    return spark.table(table).drop(*tables.RESERVED)


def _keyed_events(source: DataFrame) -> DataFrame:
    uuid_text = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return source.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 17 != 0, uuid_text).alias("uuid"),
        F.col("ts").cast("timestamp").alias("arrival"),
    )


def window_records(spark: SparkSession, folder: str) -> DataFrame:
    """Writes typed records to window folders and reads the written files back."""
    windowed = windows.with_window(_timed_events(spark, folder), "ts", WINDOW)
    out = scratch_dir(spark, "window-records")
    records = windowed.select("event_ts", "seq", "dim1", "metrics1", "window")
    files.write_window_records(records, F.col("window.end"), out)
    back = spark.read.schema(
        "event_ts bigint, seq bigint, dim1 string, metrics1 bigint, yyyy string, mm string, "
        "dd string, hh string"
    ).parquet(out)
    placed = F.concat_ws("/", "yyyy", "mm", "dd", "hh").alias("folder")
    return back.select("event_ts", "seq", "dim1", "metrics1", placed)


def day_table(spark: SparkSession, folder: str) -> DataFrame:
    """JSON events of several micro-batches in a table partitioned by day, compacted and read back."""
    table = _fresh_table("day_table")
    schema = T.StructType.fromDDL("event_ts bigint, kind string, user bigint, event_day date")
    tables.create_table(
        prepare_session(spark), table, schema, scratch_dir(spark, "day-table"), partitions=["event_day"]
    )
    body = bodies.basic_event_body(table, T.StructType(schema.fields[:3]))
    arrivals = tick_stream(spark, folder, "events", "event_id", 6)
    _drain(adapters.basic_messages(arrivals), body, spark, "day-table")
    compact.compact(spark, table, fanout=3)
    stored = spark.table(table)
    return stored.groupBy(F.col("event_day").cast("string").alias("event_day"), "kind").agg(
        F.count("*").alias("num_records"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.countDistinct("user").alias("users"),
    )


def payload_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Message envelopes with byte payloads, their time in an attribute."""
    source = adapters.csv_lines(read(spark, folder, "events"))
    envelope = source.select(
        F.encode("value", "UTF-8").alias("payload"),
        F.create_map(
            F.lit("timestamp"), F.date_format("arrival", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        ).alias("attributes"),
        F.col("seq").cast("string").alias("message_id"),
        F.lit(None).cast("timestamp").alias("publish_ts"),
    )
    found = envelope_rows(envelope, "timestamp")
    return found.select("message_id", "value", epoch_millis(F.col("ts")).alias("arrival"))


# Batches


def batches_100(spark: SparkSession, folder: str) -> DataFrame:
    source = read(spark, folder, "events").select("event_id", "event_type")
    batched = rows.batches_of(source, ["event_type"], "event_id", 100)
    return batched.groupBy("event_type", "batch_id").agg(F.count("*").alias("size"))


def stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Full batches of a hundred per key, filled over several micro-batches."""
    source = tick_stream(spark, folder, "events", "event_id").select("event_id", "event_type")
    batched = batch_stream(source, "event_type", "event_id", 100, 86_400)
    table = _sink_table(spark, "batches", batched.schema)
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        _drain(batched, bodies.append_body(table), spark, "batches")
    finally:
        spark.conf.set(setting, before)
    ids = F.transform("rows", lambda r: r["event_id"])
    return spark.table(table).select(
        F.col("key").alias("event_type"), F.col("batch").alias("batch_id"), F.size("rows").cast("bigint").alias("size"),
        F.array_min(ids).alias("first_id"), F.array_max(ids).alias("last_id"),
    )


def _accept(body: str) -> int:
    return 200


def _bulk_parts(docs: DataFrame) -> DataFrame:
    parted = docs.withColumn("part", F.call_function("div", F.col("seq"), F.lit(5000)))
    return parted.repartition("part").sortWithinPartitions("part", "seq")


def _bulk_results(spark: SparkSession, folder: str) -> DataFrame:
    docs = events.search_documents(_enriched(spark, folder), ["seq"])
    return bulk.send_bulk(_bulk_parts(docs), _accept, part="part")


def bulk_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _bulk_results(spark, folder)


def bulk_counters(spark: SparkSession, folder: str) -> DataFrame:
    return bulk.bulk_totals(_bulk_results(spark, folder))


def bulk_commit(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of several micro-batches posted once each; the receipts of their requests."""
    lookup = materialize(adapters.lookup_table(read(spark, folder, "events")), "lookup")

    def documents(batch: DataFrame) -> DataFrame:
        typed = logs.good_rows(events.type_lines(batch))
        timed = events.with_process_time(typed, F.col("event_ts") + PROCESS_DELAY_MS)
        found = rows.with_lookup(timed, lookup, "dim1", "dim1_val")
        return _bulk_parts(events.search_documents(found, ["seq"]))

    lines = adapters.csv_lines(tick_stream(spark, folder, "events", "event_id"))
    name = bulk_source.register_bulk(spark, "accepted_bulk", _accept)
    receipts = scratch_dir(spark, "bulk-receipts")
    _drain(lines, bulk_source.bulk_commit_body(name, receipts, "part", documents), spark, "bulk-commit")
    return bulk_source.read_receipts(spark, receipts).drop("writer", "task")


def staged_paths(spark: SparkSession, folder: str) -> DataFrame:
    source = adapters.drift_messages(read(spark, folder, "events"))
    named = source.withColumn("table_name", F.lit("orders"))
    return files.staged_paths(named, "table_name", "batch", "stage")


# Change capture


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.parse_changes(
        adapters.change_messages(read(spark, folder, "orders")), ["arrival"]
    )


def _records(changes: DataFrame) -> DataFrame:
    def text(key: str) -> Column:
        return F.try_element_at("record", F.lit(key))

    return changes.select(
        "destination",
        text("ID").alias("id"),
        text("STATUS").alias("status"),
        text("CENTS").try_cast("bigint").alias("cents"),
        text("ORDER_ID").try_cast("bigint").alias("order_id"),
        F.coalesce("change_type", F.lit("NONE")).alias("change_type"),
    )


def cdc_explode(spark: SparkSession, folder: str) -> DataFrame:
    return _records(cdc.changed_records(_changes(spark, folder), "arrival"))


def cdc_apply(spark: SparkSession, folder: str) -> DataFrame:
    changes = cdc.changed_records(_changes(spark, folder), "arrival")
    return _records(cdc.apply_changes(changes))


def cdc_route(spark: SparkSession, folder: str) -> DataFrame:
    changes = cdc.changed_records(_changes(spark, folder), "arrival")
    return changes.groupBy("destination").agg(F.count("*").alias("changes"))


def cdc_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Changes appended to the table each names, every table then read as it is now."""
    parsed = _changes(spark, folder)
    changes = cdc.changed_records(parsed, "arrival")
    names = [r[0] for r in changes.select("destination").distinct().orderBy("destination").collect()]
    label = _fresh_table("cdc")
    schema = T.StructType.fromDDL("ID bigint, STATUS string, CENTS bigint, ORDER_ID bigint")
    own_tables = {name: f"{label}_{name.replace('.', '_').lower()}" for name in names}
    for table in own_tables.values():
        bodies.create_change_table(spark, table, schema, scratch_dir(spark, table))
    body = bodies.routed_change_body("arrival", f"{label}_dead", table_of=lambda name: own_tables.get(name, name))
    body(adapters.change_messages(read(spark, folder, "orders")), 0)
    parts = [
        bodies.current_table(spark.table(table)).withColumn("destination", F.lit(name))
        for name, table in own_tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def route_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of several micro-batches to a table per key, written once per micro-batch and read back."""
    label = _fresh_table("routed")
    schema = T.StructType.fromDDL("order_id bigint, status string")
    names = [f"{label}_{number}" for number in range(ROUTES)]
    for table in names[:-1]:  # the last one's orders are dead letters
        tables.create_table(spark, table, schema, scratch_dir(spark, table))
    place = scratch_dir(spark, "routed-rows")

    def body(batch: DataFrame, batch_id: int) -> None:
        number = F.col("o_custkey") % ROUTES
        orders = batch.select(
            F.concat(F.lit(f"{label}_"), number.cast("string")).alias("destination"),
            F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        )
        routed.route_once(orders, batch_id, place, dead_table=f"{label}_dead")

    _drain(tick_stream(spark, folder, "orders", "o_orderkey"), body, spark, "route-tables")
    letters = spark.table(f"{label}_dead")
    parts = [spark.table(t).withColumn("route", F.lit(i).cast("bigint")) for i, t in enumerate(names[:-1])]
    lost = letters.select(
        json_field("value", "order_id").cast("bigint").alias("order_id"),
        json_field("value", "status").alias("status"),
        F.lit(-1).cast("bigint").alias("route"),
    )
    union = lost
    for part in parts:
        union = union.unionByName(part.drop(*tables.RESERVED))
    return union


def cdc_dlq(spark: SparkSession, folder: str) -> DataFrame:
    dead = logs.dead_letters(_changes(spark, folder))
    return dead.groupBy("reason").agg(F.count("*").alias("messages"))


def latest_view(spark: SparkSession, folder: str) -> DataFrame:
    source = read(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    rows.latest_view(source, "latest_events", ["user_id"], ["ts", "event_id"])
    return spark.sql(
        "SELECT user_id, event_id, event_type, unix_millis(CAST(ts AS TIMESTAMP)) AS event_ms "
        "FROM latest_events"
    )


# Schema drift


def _drift(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.drift_messages(read(spark, folder, "events"))
    return drift.dynamic_rows(messages, ["seq", "ts", "batch"])


def _drift_good(spark: SparkSession, folder: str) -> DataFrame:
    return _drift(spark, folder).filter(F.col("reason").isNull())


def drift_detect(spark: SparkSession, folder: str) -> DataFrame:
    return drift.new_fields(_drift_good(spark, folder), DRIFT_START, by=["batch"]).drop("spelling")


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    """The route of every message of a stream whose table gains the fields of each micro-batch."""
    table, routes = _drift_table(spark, "routed"), _fresh_table("routes")
    messages = ticks(adapters.drift_messages(read(spark, folder, "events")), F.col("batch"), "drift")
    body = bodies.healing_body(table, ["seq", "batch"], route_table=routes)
    _drain(messages, body, spark, "drift-route")
    return spark.table(routes)


def drift_route(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder).groupBy("batch", "route").agg(F.count("*").alias("messages"))


def drift_route_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The route of every message."""
    return _routed(spark, folder).select("seq", "batch", "route")


def drift_route_startup(spark: SparkSession, folder: str) -> DataFrame:
    good = _drift_good(spark, folder)
    routed = drift.route_rows(good, DRIFT_START)
    return routed.groupBy("batch", "route").agg(F.count("*").alias("messages"))


def strict_split(spark: SparkSession, folder: str) -> DataFrame:
    schema = table_schema(
        [
            {"name": "ID", "type": "STRING", "mode": "REQUIRED"},
            {"name": "SENDER_NAME", "type": "STRING"},
            {"name": "CHANNEL", "type": "STRING"},
        ]
    )
    checked = drift.strict_split(_drift(spark, folder), schema)
    reason = F.coalesce("reason", F.lit("valid"))
    return checked.groupBy("batch", reason.alias("outcome")).agg(F.count("*").alias("messages"))


def _drift_table(spark: SparkSession, label: str) -> str:
    table = _fresh_table(label)
    fields = [T.StructField("seq", T.LongType())]
    fields += [T.StructField(name, T.StringType()) for name in DRIFT_START]
    tables.create_table(spark, table, T.StructType(fields), scratch_dir(spark, label))
    return table


def _healed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(
        "seq", "ID", "SENDER_NAME", "CHANNEL", "VISIT"
    )


def drift_heal(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.drift_messages(read(spark, folder, "events"))
    table = _drift_table(spark, "healed")
    body = bodies.healing_body(table, ["seq"])
    for batch in (1, 2, 3):
        body(messages.filter(F.col("batch") == batch), batch)
    return _healed(spark, table)


def ordered_dump(spark: SparkSession, folder: str) -> DataFrame:
    """A table made from its first rows, listed by ID."""
    messages = adapters.drift_messages(read(spark, folder, "events"))
    table = _fresh_table("created")
    bodies.healing_body(table, ["seq"], location=scratch_dir(spark, "created"))(messages, 1)
    return tables.ordered_dump(spark, table).select(
        "seq", "ID", "SENDER_NAME", "CHANNEL", "VISIT"
    )


def failed_rows_heal(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.drift_messages(read(spark, folder, "events"))
    table = _drift_table(spark, "failed_rows")
    body = bodies.failed_rows_body(table, ["seq"])
    for batch in (1, 2, 3):
        body(messages.filter(F.col("batch") == batch), batch)
    return _healed(spark, table)


def autodetect_load(spark: SparkSession, folder: str) -> DataFrame:
    good = _drift_good(spark, folder)
    table, stage = _fresh_table("inferred"), scratch_dir(spark, "stage")
    location = scratch_dir(spark, "inferred")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in DRIFT_START])
    tables.create_table(spark, table, schema, location)
    for batch in (1, 2, 3):
        path = files.stage_text(good.filter(F.col("batch") == batch), stage, batch)
        files.load_inferred(spark, path, table, batch)
    return spark.table(table).select(
        "ID",
        "SENDER_NAME",
        "CHANNEL",
        F.coalesce(F.col("VISIT") + 1, F.lit(-1)).alias("batch_2_plus_one"),
    )


def _version_text() -> Column:
    """JSON text with the fields of all versions."""
    sender = F.struct(
        F.col("c_name").alias("SENDER_NAME"),
        F.col("c_mktsegment").alias("SENDER_COMPANY"),
        F.concat(F.lit("+49-"), F.col("c_custkey").cast("string")).alias("SENDER_MOBILE_PHONE"),
    )
    return F.to_json(
        F.struct(
            F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("ID"),
            F.to_json(F.struct(F.col("c_nationkey").alias("nation"))).alias("SENDER_JSON"),
            sender.alias("SENDER_RECORD"),
            F.col("c_mktsegment").alias("NEW_TOP_LEVEL_FIELD"),
            F.col("c_custkey").alias("NEW_TOP_LEVEL_FIELD_V2"),
        )
    )


def _declared(customer: DataFrame, number: int) -> DataFrame:
    """Rows of one declared version, parsed from JSON under that version's schema."""
    rows_ = customer.filter(_version_of() == number)
    record = F.from_json(_version_text(), VERSIONS[number - 1])
    return rows.compute_once(rows_, [], r=record).select("r.*")


def _version_of() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment.isin("AUTOMOBILE", "BUILDING"), 1)
        .when(segment.isin("FURNITURE", "HOUSEHOLD"), 2)
        .otherwise(3)
    )


def schema_versions(spark: SparkSession, folder: str) -> DataFrame:
    customer = read(spark, folder, "customer")
    parts = [drift.to_version(_declared(customer, n), VERSIONS[-1]) for n in (1, 2, 3)]
    return _flat_versions(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _flat_versions(union: DataFrame) -> DataFrame:
    return union.select(
        "ID",
        "SENDER_JSON",
        F.col("SENDER_RECORD.SENDER_NAME").alias("SENDER_NAME"),
        F.col("SENDER_RECORD.SENDER_COMPANY").alias("SENDER_COMPANY"),
        F.col("SENDER_RECORD.SENDER_MOBILE_PHONE").alias("SENDER_MOBILE_PHONE"),
        "NEW_TOP_LEVEL_FIELD",
        F.coalesce("NEW_TOP_LEVEL_FIELD_V2", F.lit(-1)).alias("NEW_TOP_LEVEL_FIELD_V2"),
    )


def schema_registry(spark: SparkSession, folder: str) -> DataFrame:
    good = _drift_good(spark, folder).withColumn("table_name", F.lit("orders"))
    seen = drift.field_registry(good, "table_name", "ts")
    return seen.select(
        "table_name",
        "field",
        epoch_millis(F.col("first_seen")).alias("first_seen"),
        epoch_millis(F.col("last_seen")).alias("last_seen"),
        "seen",
    )


def declared_load(spark: SparkSession, folder: str) -> DataFrame:
    """The declared versions written to one table in turn, which gains their fields."""
    customer = read(spark, folder, "customer")
    table, location = _fresh_table("declared"), scratch_dir(spark, "declared")
    for number, schema in enumerate(VERSIONS, 1):
        texts = customer.filter(_version_of() == number).select(_version_text().alias("value"))
        bodies.declared_body(table, schema, location)(texts, number)
    return _flat_versions(spark.table(table))


def json_column_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two flat columns and a JSON column in a table, fields taken out on reading."""
    table = _sink_table(
        prepare_session(spark), "json_column", "ID string, SENDER_NAME string, METADATA string"
    )
    body = bodies.json_column_body(table)
    body(adapters.sender_messages(read(spark, folder, "customer")), 0)
    return spark.table(table).select(
        "ID", "SENDER_NAME", json_field("METADATA", "profile.nation").alias("nation")
    )


def staged_load(spark: SparkSession, folder: str) -> DataFrame:
    """Drifted rows staged as JSON files, then loaded under the widened schema."""
    good = _drift_good(spark, folder)
    table, stage = _drift_table(spark, "staged"), scratch_dir(spark, "staged-json")
    tables.evolve(good, table)
    target = tables.table_columns(spark, table)
    data = T.StructType([f for f in target.fields if f.name != "seq"])
    path = files.stage_rows(drift.as_columns(good, data, ["seq"]), stage, 1)
    files.load_staged(spark, path, table, target, 1)
    return _healed(spark, table)


# Comparison


def _order_records(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("key"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


def _changed_copy(records: DataFrame) -> DataFrame:
    """The records after a trip through JSON text, with known differences."""
    key = F.col("key")
    text = F.to_json(
        F.struct(
            "customer",
            F.when(key % 50 == 0, F.lit("X")).otherwise(F.col("status")).alias("status"),
            F.when(key % 61 != 0, F.col("priority")).alias("priority"),
            F.when(key % 67 == 0, F.lit("new")).alias("note"),
            "cents",
        )
    )
    return records.select("key", json_map(text).alias("record"))


def table_compare(spark: SparkSession, folder: str) -> DataFrame:
    records = _order_records(spark, folder)
    left = compare.as_records(records, ["key"])
    return compare.compare_records(left, _changed_copy(records), ["key"]).drop("copies")


def field_counts(spark: SparkSession, folder: str) -> DataFrame:
    records = _order_records(spark, folder)
    source = compare.field_counts(compare.as_records(records, ["key"]))
    table = compare.field_counts(_changed_copy(records))
    return source.withColumn("side", F.lit("source")).unionByName(
        table.withColumn("side", F.lit("table"))
    )


# Streams: each drains its input and returns the final table.


def _drain(df: DataFrame, body, spark: SparkSession, label: str, mode: str = "append") -> None:
    checkpoint = scratch_dir(spark, f"{label}-progress")
    tables.write_each_batch(df, body, checkpoint, None, mode).start().awaitTermination()


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return stream_table(prepare_session(spark), folder, name)


def ticks(rows_: DataFrame, tick: Column, label: str) -> DataFrame:
    """The rows as a stream that takes a micro-batch per value of ``tick``, in its order.

    Rows without a tick come first. The rows are read once and dealt to a folder per
    tick; each then becomes the same number of files, and a file source takes files
    in the order of writing.
    """
    spark = rows_.sparkSession
    staged, path = scratch_dir(spark, f"{label}-staged"), scratch_dir(spark, f"{label}-ticks")
    first = F.lit(-(2**62)).cast("bigint")
    dealt = rows_.withColumn("_tick", F.coalesce(tick.cast("bigint"), first))
    dealt.write.partitionBy("_tick").parquet(staged)
    numbers = spark.read.schema("_tick bigint").parquet(staged).distinct().collect()  # a row per tick
    files_sent = 0
    empty = spark.createDataFrame([], rows_.schema)
    for number in sorted(r[0] for r in numbers):
        part = spark.read.schema(rows_.schema).parquet(f"{staged}/_tick={number}")
        part.repartition(TICK_FILES).write.mode("append").parquet(path)
        files_sent += TICK_FILES
        # A partition that got no row leaves no file.
        while len(spark.read.schema(rows_.schema).parquet(path).inputFiles()) < files_sent:
            empty.coalesce(1).write.mode("append").parquet(path)
    if not numbers:
        empty.coalesce(1).write.parquet(path)
    return spark.readStream.schema(rows_.schema).option("maxFilesPerTrigger", TICK_FILES).parquet(path)


def tick_stream(spark: SparkSession, folder: str, name: str, order: str, count: int = 5) -> DataFrame:
    """A stream over a given table that takes about ``count`` micro-batches, in the order of an id.

    Rows whose id is null or negative come first.
    """
    whole = read(spark, folder, name)
    last = whole.agg(F.max(order)).first()[0] or 0
    width = max(1, -(-(last + 1) // count))
    return ticks(whole, F.greatest(F.call_function("div", F.col(order), F.lit(width)), F.lit(0)), name)


def _sink_table(spark: SparkSession, label: str, schema: T.StructType | str) -> str:
    table = _fresh_table(label)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    tables.create_table(spark, table, schema, scratch_dir(spark, label))
    return table


LOG_DDL = (
    "seq bigint, timestamp string, severity string, service string, message string, "
    "trace_id string, request_details string, latency_ms bigint"
)


def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.log_messages(_stream(spark, folder, "events"))
    table = _sink_table(spark, "stream_log", LOG_DDL)
    dead = _sink_table(spark, "stream_log_dead", "seq bigint, value string, reason string")
    _drain(messages, bodies.log_body(table, dead, ["seq"]), spark, "stream-log")
    return spark.table(table).drop(*tables.RESERVED)


def stream_shared_dead(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams, each with its half of the messages, share one dead-letter table."""
    dead = _sink_table(spark, "shared_dead", "seq bigint, value string, reason string")
    for half in (0, 1):
        part = _stream(spark, folder, "events").filter(F.pmod("event_id", F.lit(2)) == half)
        table = _sink_table(spark, f"shared_{half}", LOG_DDL)
        body = bodies.log_body(table, dead, ["seq"])
        _drain(adapters.log_messages(part), body, spark, f"shared-dead-{half}")
    return spark.table(dead).groupBy("reason").agg(F.count("*").alias("messages"))


def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Upserts over several micro-batches into a table read as it is."""
    messages = adapters.log_messages(tick_stream(spark, folder, "events", "event_id"))
    table = _fresh_table("stream_upsert")

    def parse(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        parsed = logs.parse_logs(batch, ["seq"])
        return logs.good_rows(parsed), logs.dead_letters(parsed, ["seq"])

    _drain(messages, bodies.upsert_body(table, ["trace_id"], "seq", parse), spark, "stream-upsert")
    return spark.sql(f"SELECT * FROM {table}")


def poison_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that make a strict body fail, found by halving; the others land."""
    source = read(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 49_999 == 5, F.lit("many")).otherwise(F.col("user_id").cast("string")).alias("amount"),
    )
    table, poison = _fresh_table("strict"), _fresh_table("poison")

    def typed(batch: DataFrame) -> DataFrame:
        return batch.select("seq", F.col("amount").cast("bigint").alias("amount"))

    def strict(batch: DataFrame, batch_id: int) -> None:
        tables.append_batch(typed(batch), table, batch_id, create=True)

    def trial(batch: DataFrame, batch_id: int) -> None:
        typed(batch).write.format("noop").mode("overwrite").save()

    stream = ticks(source, F.lit(0), "poison")
    _drain(stream, retry.isolating(strict, poison, max_runs=10_000, trial=trial), spark, "poison")
    good = spark.table(table).select("seq", F.col("amount").cast("string").alias("amount"), F.lit("").alias("reason"))
    text = F.from_json("value", "seq bigint, amount string")
    bad = spark.table(poison).select(text.alias("r"), "reason").select("r.seq", "r.amount", "reason")
    return good.unionByName(bad)


def conflict_load(spark: SparkSession, folder: str) -> DataFrame:
    """A field whose kind changes from micro-batch to micro-batch, loaded without loss."""
    day = F.dayofmonth("ts")
    batch = F.least(F.floor((day - 1) / 10), F.lit(2)).cast("bigint")
    number = F.col("event_id").cast("string")
    value = (
        F.when(batch == 0, number)
        .when(batch == 1, F.concat(number, F.lit(".50")))
        .otherwise(F.concat(F.lit('"v'), number, F.lit('"')))
    )
    nested = F.concat(F.lit('{"a":'), number, F.when(batch > 0, F.lit(',"b":[1,"x"]')).otherwise(""), F.lit("}"))
    twice = F.when(F.col("event_id") % 101 == 0, F.lit(',"N":0')).otherwise("")
    text = F.concat(F.lit('{"ID":'), number, F.lit(',"n":'), value, F.lit(',"o":'), nested, twice, F.lit("}"))
    stream = ticks(read(spark, folder, "events").select(text.alias("value"), batch.alias("batch")), F.col("batch"), "conflict")
    table = _fresh_table("conflict")
    body = bodies.staged_load_body(table, scratch_dir(spark, "conflict-stage"), scratch_dir(spark, "conflict"))
    _drain(stream, body, spark, "conflict-load")
    rows_ = spark.table(table).select(
        "ID", "n", F.col("n_V2").cast("decimal(38,2)").cast("string").alias("n_V2"), "n_V3", F.to_json("o").alias("o"),
        F.lit("").alias("reason"),
    )
    lost = spark.table(table + "_dead").select(
        json_field("value", "ID").cast("bigint").alias("ID"), F.lit(None).cast("bigint").alias("n"),
        *[F.lit(None).cast("string").alias(c) for c in ("n_V2", "n_V3", "o")], "reason",
    )
    return rows_.unionByName(lost)


def stream_cdc(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.change_messages(_stream(spark, folder, "orders"))
    table = _sink_table(
        spark,
        "stream_cdc",
        "destination string, change_type string, ts bigint, es bigint, arrival bigint, "
        "pk_names array<string>, pos int, record map<string,string>, record_key string",
    )
    _drain(messages, bodies.change_body(table, "arrival"), spark, "stream-cdc")
    return _records(bodies.current_records(spark.table(table)))


def stream_cdc_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Changes over several micro-batches, applied to a table read as it is."""
    messages = adapters.change_messages(tick_stream(spark, folder, "orders", "o_orderkey"))
    target = bodies.change_table(_fresh_table("stream_cdc_batches"))
    _drain(messages, bodies.applied_change_body(target, "arrival"), spark, "stream-cdc-batches")
    return _records(spark.sql(f"SELECT * FROM {target.name}"))


def stream_drift_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A table that gains fields over several micro-batches."""
    messages = adapters.drift_messages(tick_stream(spark, folder, "events", "event_id"))
    table = _drift_table(spark, "stream_drift_batches")
    _drain(messages, bodies.healing_body(table, ["seq"]), spark, "stream-drift-batches")
    return _healed(spark, table)


def stream_window(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapters.csv_lines(_stream(spark, folder, "events"))
    typed = logs.good_rows(events.type_lines(lines))
    timed = typed.withColumn("ts", from_millis(F.col("event_ts"))).withWatermark("ts", "30 days")
    stats = windows.window_stats(timed, "ts", WINDOW)
    table = _sink_table(
        spark,
        "stream_window",
        "window_start timestamp, window_end timestamp, dim1 string, num_records bigint, "
        "sum bigint, min bigint, max bigint, avg double",
    )
    _drain(stats, bodies.append_body(table), spark, "stream-window", mode="update")
    current = tables.current_rows(spark, table, ["window_start", "window_end", "dim1"])
    return _stats_in_millis(current)


def stream_panes(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapters.csv_lines(_stream(spark, folder, "events"))
    typed = logs.good_rows(events.type_lines(lines))
    timed = typed.withColumn("ts", from_millis(F.col("event_ts")))
    panes = pane_stream(timed, "ts", WINDOW_SECONDS, LATENESS_SECONDS)
    table = _sink_table(spark, "stream_panes", panes.schema)
    _drain(panes, bodies.append_body(table), spark, "stream-panes")
    return _whole_panes(spark.table(table).drop(*tables.RESERVED))


def stream_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched events from a stream whose lookup is read again per micro-batch."""
    lines = adapters.csv_lines(tick_stream(spark, folder, "events", "event_id"))
    table = _sink_table(spark, "stream_lookup", "seq bigint, dim1 string, dim1_val string")

    def apply(batch: DataFrame, lookup: DataFrame, batch_id: int) -> None:
        typed = logs.good_rows(events.type_lines(batch))
        tables.append_batch(rows.with_lookup(typed, lookup, "dim1", "dim1_val"), table, batch_id)

    body = with_fresh_lookup(lambda: adapters.lookup_table(read(spark, folder, "events")), apply)
    _drain(lines, body, spark, "stream-lookup")
    return spark.table(table).drop(*tables.RESERVED)


def lookup_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of several micro-batches with their customer's name; one key has over half of them.

    The lookup is read once for the run, as it is younger than its hour.
    """
    table = _sink_table(spark, "lookup_hot", "order_id bigint, customer string, name string")
    customer = read(spark, folder, "customer")

    def names() -> DataFrame:
        return customer.select(F.col("c_custkey").alias("customer"), F.col("c_name").alias("name"))

    def apply(batch: DataFrame, lookup: DataFrame, batch_id: int) -> None:
        with bodies.kept(adapters.hot_orders(batch)) as orders:
            named = lookups.with_hot_lookup(orders, lookup, "customer", "name")
            tables.append_batch(named, table, batch_id)

    stream = tick_stream(spark, folder, "orders", "o_orderkey")
    _drain(stream, lookups.with_timed_lookup(names, apply, 3600), spark, "lookup-hot")
    return spark.table(table).drop(*tables.RESERVED)


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    keyed = _keyed_events(_stream(spark, folder, "events")).drop("arrival")
    return _deduped(spark, keyed, "stream-dedup")


# Bundles and their tables; other event types are unknown bundles.
BUNDLES = {"purchase": "orders", "click": "visits", "view": "visits"}


def _bundle_tables(spark: SparkSession) -> tuple[dict[str, str], dict[str, str]]:
    made = {
        name: _sink_table(spark, f"bundle_{name}", "uuid string, v string")
        for name in sorted(set(BUNDLES.values()))
    }
    return {bundle: made[name] for bundle, name in BUNDLES.items()}, made


def bundle_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Bundled messages to their tables over several micro-batches, repeats of a uuid dropped."""
    messages = adapters.bundle_messages(tick_stream(spark, folder, "events", "event_id"))
    by_bundle, made = _bundle_tables(spark)
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        progress = scratch_dir(spark, "bundle-progress")
        jobs.bundle_job(messages, by_bundle, progress, DEDUP_TTL, None).start().awaitTermination()
    finally:
        spark.conf.set(setting, before)
    parts = [
        spark.table(table).select(F.lit(name).alias("name"), F.coalesce("uuid", F.lit("")).alias("uuid"), "v")
        for name, table in made.items()
    ]
    return parts[0].unionByName(parts[1])


def bundle_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Dead letters by reason and the fields seen per table, over several micro-batches."""
    messages = adapters.bundle_messages(tick_stream(spark, folder, "events", "event_id"))
    by_bundle, made = _bundle_tables(spark)
    dead, registry = _fresh_table("bundle_dead"), _fresh_table("bundle_registry")
    progress = scratch_dir(spark, "bundle-side-progress")
    jobs.bundle_side_job(messages, by_bundle, dead, registry, progress, None).start().awaitTermination()
    name = F.create_map(*[F.lit(x) for pair in made.items() for x in reversed(pair)])[F.col("destination")]
    letters = spark.table(dead).groupBy(F.lit("dead").alias("kind"), F.col("reason").alias("what")).agg(
        F.count("*").alias("n")
    )
    fields = spark.table(registry).groupBy(
        F.lit("field").alias("kind"), F.concat_ws(".", name, "field").alias("what")
    ).agg(F.sum("seen").alias("n"))
    return letters.unionByName(fields)


def stream_drift(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.drift_messages(_stream(spark, folder, "events"))
    table = _drift_table(spark, "stream_drift")
    _drain(messages, bodies.healing_body(table, ["seq"]), spark, "stream-drift")
    return _healed(spark, table)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        log_parse,
        log_filter_sql,
        log_millis,
        time_forms,
        typed_record,
        log_dlq,
        log_upsert,
        bigint_flatten,
        bigint_envelope,
        bigint_envelope_text,
        json_metadata_split,
        csv_typed,
        csv_failures,
        dim_lookup,
        search_docs,
        table_rows,
        basic_event_rows,
        window_stats,
        pane_replay,
        window_tall,
        window_wide,
        late_drop,
        error_windows,
        day_partition,
        window_files,
        window_records,
        day_table,
        payload_rows,
        dedup_ttl,
        batches_100,
        stream_batches,
        bulk_batches,
        bulk_counters,
        bulk_commit,
        staged_paths,
        cdc_explode,
        cdc_apply,
        cdc_route,
        cdc_tables,
        route_tables,
        cdc_dlq,
        latest_view,
        drift_detect,
        drift_route,
        drift_route_rows,
        drift_route_startup,
        strict_split,
        drift_heal,
        failed_rows_heal,
        ordered_dump,
        autodetect_load,
        schema_versions,
        declared_load,
        json_column_load,
        staged_load,
        schema_registry,
        table_compare,
        field_counts,
        stream_log,
        stream_upsert,
        poison_rows,
        conflict_load,
        stream_shared_dead,
        bundle_tables,
        bundle_registry,
        stream_cdc_batches,
        stream_drift_batches,
        stream_cdc,
        stream_window,
        stream_panes,
        stream_lookup,
        lookup_hot,
        stream_dedup,
        stream_drift,
    )
}

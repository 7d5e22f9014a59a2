"""CSV and JSON events: typing, enrichment, documents and table rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.casts import field, split_line, typed
from weirflow.functions.json_text import json_map
from weirflow.functions.times import micros_to_seconds, millis_to_seconds, now_millis
from weirflow.operators.rows import compute_once

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_ts", T.LongType()),
        T.StructField("thread_id", T.StringType()),
        T.StructField("thread_name", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("dim1", T.StringType()),
        T.StructField("metrics1", T.LongType()),
    ]
)


def type_lines(
    lines: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    delimiter: str = ",",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``value`` text to columns of the schema plus ``value`` and ``reason``.

    A row is good (``reason`` NULL) when it has every field and each one parses.
    """
    split = compute_once(lines, [*keep, "value"], _f=split_line(F.col("value"), delimiter))
    texts = [field(F.col("_f"), i) for i in range(len(schema))]
    columns = [typed(t, f.dataType).alias(f.name) for t, f in zip(texts, schema.fields)]
    short = F.size("_f") < len(schema)
    unparsed = [
        typed(t, f.dataType).isNull()
        for t, f in zip(texts, schema.fields)
        if not isinstance(f.dataType, (T.StringType, T.BooleanType))
    ]
    bad = F.lit(False)
    for condition in unparsed:
        bad = bad | condition
    reason = (
        F.when(F.col("value").isNull(), "empty")
        .when(short, "missing field")
        .when(bad, "bad field")
    )
    return split.select(*keep, *columns, "value", reason.alias("reason"))


def with_process_time(events: DataFrame, process_ts: Column | None = None) -> DataFrame:
    """Adds ``process_ts`` in epoch milliseconds: now, unless given."""
    return events.withColumn("process_ts", process_ts if process_ts is not None else now_millis())


def search_documents(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON document per enriched event; times are epoch milliseconds."""
    doc = F.to_json(
        F.struct(
            F.col("event_ts").alias("@timestamp"),
            "thread_id",
            "thread_name",
            F.col("seq").cast("bigint").alias("seq"),
            "dim1",
            F.col("metrics1").cast("bigint").alias("metrics1"),
            "process_ts",
            "dim1_val",
        )
    )
    return events.select(*keep, doc.alias("doc"))


def table_rows(events: DataFrame) -> DataFrame:
    """The 16-column table row: event times in seconds, window and pane as their own columns.

    Needs the enriched event columns, ``window`` (start, end) and ``pane`` (info,
    idx, nonspeculative_idx, is_first, is_last, timing, event_ts).
    """
    return events.select(
        millis_to_seconds(F.col("event_ts")).alias("event_ts"),
        "thread_id",
        "thread_name",
        F.col("seq").cast("bigint").alias("seq"),
        "dim1",
        F.col("metrics1").cast("bigint").alias("metrics1"),
        millis_to_seconds(F.col("process_ts")).alias("process_ts"),
        "dim1_val",
        window_text(F.col("window")).alias("window"),
        F.col("pane.info").alias("pane_info"),
        F.col("pane.idx").cast("bigint").alias("pane_idx"),
        F.col("pane.nonspeculative_idx").cast("bigint").alias("pane_nonspeculative_idx"),
        F.col("pane.is_first").alias("is_first"),
        F.col("pane.is_last").alias("is_last"),
        F.col("pane.timing").alias("pane_timing"),
        millis_to_seconds(F.col("pane.event_ts")).alias("pane_event_ts"),
    )


def window_text(window: Column) -> Column:
    """``[start..end)`` with millisecond ISO times."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    return F.concat(
        F.lit("["),
        F.date_format(window["start"], iso),
        F.lit(".."),
        F.date_format(window["end"], iso),
        F.lit(")"),
    )


def basic_events(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JSON events to a key map without ``perf_ts``, with ``event_ts`` in seconds.

    ``reason`` is ``malformed`` when the text is no object and ``no event time``
    when ``event_timestamp`` (microseconds) is absent or no integer.
    """
    parsed = compute_once(messages, [*keep, "value"], row=json_map(F.col("value")))
    micros = F.try_element_at("row", F.lit("event_timestamp")).try_cast("bigint")
    reason = F.when(F.col("row").isNull(), "malformed").when(micros.isNull(), "no event time")
    return parsed.select(
        *keep,
        micros_to_seconds(micros).alias("event_ts"),
        F.map_filter("row", lambda k, v: k != "perf_ts").alias("row"),
        "value",
        reason.alias("reason"),
    )

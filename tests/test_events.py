from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from weirflow.functions import casts, times
from weirflow.operators import events, logs, rows, windows

LINE = "1704067207179,8,worker-0,12,error,6"


def test_typed_line(texts):
    row = logs.good_rows(events.type_lines(texts(LINE))).first()
    assert tuple(row) == (1704067207179, "8", "worker-0", 12, "error", 6)


def test_line_failures(texts):
    lines = texts(LINE, "1,2,3", "x,8,w,12,error,6", None, LINE + ",more", "1,2,3,4,5,")
    parsed = events.type_lines(lines, keep=["seq"]).orderBy("seq").collect()
    assert [r["reason"] for r in parsed] == [
        None, "missing field", "bad field", "empty", None, "bad field",
    ]


def test_record_types_and_delimiter(texts):
    schema = T.StructType(
        [T.StructField(n, casts.RECORD_TYPES[n]) for n in ("string", "boolean", "int", "float", "double")]
    )
    row = logs.good_rows(events.type_lines(texts("a|TRUE|7|1.5|2.5"), schema, "|")).first()
    assert tuple(row) == ("a", True, 7, 1.5, 2.5)
    row = logs.good_rows(events.type_lines(texts("a|yes|7|1.5|2.5"), schema, "|")).first()
    assert row["boolean"] is False


def enriched(texts, spark):
    typed = logs.good_rows(events.type_lines(texts(LINE, LINE.replace("error", "view"))))
    lookup = spark.createDataFrame([("error", "E!")], "dim1 string, dim1_val string")
    processed = events.with_process_time(typed, F.lit(1704067208000))
    return rows.with_lookup(processed, lookup, "dim1", "dim1_val")


def test_lookup_default(texts, spark):
    found = {r["dim1"]: r["dim1_val"] for r in enriched(texts, spark).collect()}
    assert found == {"error": "E!", "view": "Not Found"}


def test_lookup_key_must_be_unique(texts, spark):
    lookup = spark.createDataFrame([("error", "a"), ("error", "b")], "dim1 string, dim1_val string")
    typed = logs.good_rows(events.type_lines(texts(LINE)))
    with pytest.raises(Exception, match="not unique"):
        rows.with_lookup(typed, lookup, "dim1", "dim1_val").collect()


def test_process_time_is_now_by_default(texts):
    typed = logs.good_rows(events.type_lines(texts(LINE)))
    stamp = events.with_process_time(typed).first()["process_ts"]
    assert abs(stamp / 1000 - datetime.now().timestamp()) < 600


def test_search_document(texts, spark):
    doc = events.search_documents(enriched(texts, spark).filter("dim1 = 'error'")).first()["doc"]
    assert doc == (
        '{"@timestamp":1704067207179,"thread_id":"8","thread_name":"worker-0","seq":12,'
        '"dim1":"error","metrics1":6,"process_ts":1704067208000,"dim1_val":"E!"}'
    )


def test_table_row(texts, spark):
    timed = enriched(texts, spark).withColumn("ts", times.from_millis(F.col("event_ts")))
    windowed = windows.with_plain_pane(windows.with_window(timed, "ts", "5 minutes"), "event_ts")
    row = events.table_rows(windowed.filter("dim1 = 'view'")).first()
    assert len(row) == 16
    assert row["event_ts"] == 1704067207 and row["process_ts"] == 1704067208
    assert row["window"] == "[2024-01-01T00:00:00.000Z..2024-01-01T00:05:00.000Z)"
    assert row["pane_timing"] == "UNKNOWN" and row["is_first"] and row["pane_event_ts"] == 1704067207


def test_basic_events(texts):
    parsed = events.basic_events(
        texts('{"event_timestamp":1704067207179575,"perf_ts":9,"k":"v"}', "nope", '{"k":"v"}'),
        ["seq"],
    )
    found = parsed.orderBy("seq").collect()
    assert found[0]["event_ts"] == 1704067207 and set(found[0]["row"]) == {"event_timestamp", "k"}
    assert [r["reason"] for r in found] == [None, "malformed", "no event time"]


def test_time_functions(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00' AS e, 'a' AS d, '1704067207179 ' AS t, 'x' AS bad")
    row = df.select(
        times.window_path(F.col("e")),
        times.window_stamp(F.col("e")),
        times.newest_first_key(F.col("d"), F.lit(1000)),
        times.epoch_millis(times.millis_or_now(F.col("t"))),
        times.millis_or_now(F.col("bad")) == F.current_timestamp(),
        times.change_sequence() == F.lower(F.hex(times.now_millis())),
        times.millis_to_seconds(F.lit(1999)),
        times.micros_to_seconds(F.lit(1_999_999)),
        times.parse_instant(F.lit("soon")),
    ).first()
    assert tuple(row) == (
        "2024/01/01/10", "2024-01-01T09-59-59.999Z", "a#9223372036854774807", 1704067207179,
        True, True, 1, 1, None,
    )

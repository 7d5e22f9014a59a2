"""JSON log messages to typed rows, with dead letters for what does not parse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from weirflow.functions.json_text import parsed_json, struct_text
from weirflow.functions.times import datetime_text, parse_instant
from weirflow.operators.rows import compute_once, latest_by

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("ip_address", T.StringType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("request_details", REQUEST_SCHEMA),
        T.StructField("latency_ms", T.LongType()),
    ]
)

LOG_COLUMNS = LOG_SCHEMA.fieldNames()


def parse_logs(
    messages: DataFrame, keep: Sequence[str] = (), millis: bool = False
) -> DataFrame:
    """``value`` text to the seven log columns plus ``value`` and ``reason``.

    ``reason`` is NULL for a good row, else ``empty``, ``malformed``,
    ``no timestamp`` or ``bad timestamp``. The time is ``yyyy-MM-dd HH:mm:ss``
    text, or an instant with its milliseconds when ``millis`` is set.
    """
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    log = parsed_json("value", schema, columnNameOfCorruptRecord="_bad")
    parsed = compute_once(messages, [*keep, "value"], log=log).select(
        *keep, "value", "log.*", parse_instant(F.col("log.timestamp")).alias("_at")
    )
    blank = F.col("value").isNull() | F.trim("value").isin("", "null")
    reason = (
        F.when(blank, "empty")
        .when(F.col("_bad").isNotNull(), "malformed")
        .when(F.col("timestamp").isNull(), "no timestamp")
        .when(F.col("_at").isNull(), "bad timestamp")
    )
    return parsed.select(
        *keep,
        (F.col("_at") if millis else datetime_text(F.col("_at"))).alias("timestamp"),
        "severity",
        "service",
        "message",
        "trace_id",
        struct_text(F.col("request_details")).alias("request_details"),
        "latency_ms",
        "value",
        reason.alias("reason"),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    """Rows without a reason against them."""
    return parsed.filter(F.col("reason").isNull()).drop("reason", "value")


def dead_letters(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text and reason of rejected messages; empty ones carry nothing and are left out."""
    rejected = F.col("reason").isNotNull() & (F.col("reason") != "empty")
    return parsed.filter(rejected).select(*keep, "value", "reason")


def sql_over(df: DataFrame, statement: str, view: str = "PCOLLECTION") -> DataFrame:
    """Run a SQL statement over the rows, known to it by the view name."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(statement)


def upsert_rows(
    batch: DataFrame, keys: Sequence[str], arrival: Sequence[str], target: DataFrame | None = None
) -> DataFrame:
    """Target after an upsert by primary key: the last arrival wins."""
    rows = batch if target is None else target.unionByName(batch, allowMissingColumns=True)
    return latest_by(rows, keys, arrival)

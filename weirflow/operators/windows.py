"""Event-time windows: statistics, forms of panes, late rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.functions.times import epoch_millis, newest_first_key, now_millis

# Fixed value: text of a pane that no trigger has fired.
NO_FIRING = "PaneInfo.NO_FIRING"

# Ticks per block when the watermark is carried over ticks.
TICK_BLOCK = 1440


def with_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Adds the tumbling ``window`` (start, end) of the event time."""
    return df.withColumn("window", F.window(ts, size))


def with_plain_pane(df: DataFrame, event_ts: str) -> DataFrame:
    """Pane of a row that no trigger has grouped yet: the only one, of unknown timing."""
    return df.withColumn(
        "pane",
        F.struct(
            F.lit(NO_FIRING).alias("info"),
            F.lit(0).alias("idx"),
            F.lit(0).alias("nonspeculative_idx"),
            F.lit(True).alias("is_first"),
            F.lit(True).alias("is_last"),
            F.lit("UNKNOWN").alias("timing"),
            F.col(event_ts).alias("event_ts"),
        ),
    )


def stats_columns(metric: str) -> list[Column]:
    """The five statistics; sums are 64-bit and the average is a double."""
    return [
        F.count(metric).alias("num_records"),
        F.sum(metric).alias("sum"),
        F.min(metric).alias("min"),
        F.max(metric).alias("max"),
        F.avg(metric).alias("avg"),
    ]


def window_stats(
    df: DataFrame, ts: str, size: str, dims: Sequence[str] = ("dim1",), metric: str = "metrics1"
) -> DataFrame:
    """Statistics per window and dimension, combined per task before the shuffle."""
    return (
        df.groupBy(F.window(ts, size).alias("window"), *dims)
        .agg(*stats_columns(metric))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *dims,
            "num_records",
            "sum",
            "min",
            "max",
            "avg",
        )
    )


def tall_rows(panes: DataFrame, dim: str = "dim1", process_ts: Column | None = None) -> DataFrame:
    """One row per firing, keyed newest first, with the window and pane columns."""
    processed = process_ts if process_ts is not None else now_millis()
    return panes.select(
        newest_first_key(F.col(dim), processed).alias("row_key"),
        F.col("acc_num_records").alias("num_records"),
        F.col("acc_sum").alias("sum"),
        F.col("acc_max").alias("max"),
        F.col("acc_min").alias("min"),
        (F.col("acc_sum") / F.col("acc_num_records")).alias("avg"),
        "pane_idx",
        "nonspeculative_idx",
        "is_first",
        "is_last",
        "timing",
        epoch_millis(F.col("window_start")).alias("win_start_ts"),
        epoch_millis(F.col("window_end")).alias("win_end_ts"),
    )


def wide_row_key(dim: str = "dim1") -> Column:
    """``dim#start#end`` with epoch milliseconds."""
    return F.concat_ws(
        "#",
        F.col(dim),
        epoch_millis(F.col("window_start")).cast("string"),
        epoch_millis(F.col("window_end")).cast("string"),
    )


def wide_rows(panes: DataFrame, dim: str = "dim1") -> DataFrame:
    """One row per window and dimension: a cell map ``stat#pane_idx`` -> value.

    The number of panes of a window is open, so cells are a map and no pivot
    needs a list of pane numbers. Takes panes in discarding mode; panes are few
    per window (one per tick), so collecting them per key is bounded.
    """
    stats = {
        "num_records": F.col("num_records").cast("string"),
        "sum": F.col("sum").cast("string"),
        "max": F.col("max").cast("string"),
        "min": F.col("min").cast("string"),
        "avg": (F.col("sum") / F.col("num_records")).cast("string"),
    }
    cells = F.array(
        *[
            F.struct(
                F.concat(F.lit(name + "#"), F.col("pane_idx").cast("string")).alias("column"),
                value.alias("value"),
            )
            for name, value in stats.items()
        ]
    )
    return panes.groupBy(wide_row_key(dim).alias("row_key")).agg(
        F.map_from_entries(F.flatten(F.collect_list(cells))).alias("cells")
    )


def wide_pivot(panes: DataFrame, pane_indexes: Sequence[int], dim: str = "dim1") -> DataFrame:
    """The wide form with a column per statistic and listed pane number."""
    return (
        panes.groupBy(wide_row_key(dim).alias("row_key"))
        .pivot("pane_idx", list(pane_indexes))
        .agg(
            F.max("num_records").alias("num_records"),
            F.max("sum").alias("sum"),
            F.max("min").alias("min"),
            F.max("max").alias("max"),
        )
    )


def mark_late(
    rows: DataFrame, ts: str, size: str, lateness: str, watermark: Column | datetime | None
) -> DataFrame:
    """Adds ``window`` and ``timing``: ``IN_TIME``, ``LATE`` or ``DROPPED``.

    A row is late once the watermark has reached its window's end, and dropped once
    that is ``lateness`` ago. Without a watermark all rows are in time.
    """
    timing = _timing(F.col("window.end"), lateness, watermark)
    return with_window(rows, ts, size).withColumn("timing", timing)


def _timing(end: Column, lateness: str, watermark: Column | datetime | None) -> Column:
    mark = (watermark if isinstance(watermark, Column) else F.lit(watermark)).cast("timestamp")
    return (
        F.when(mark >= end + F.expr(f"INTERVAL {lateness}"), "DROPPED")
        .when(mark >= end, "LATE")
        .otherwise("IN_TIME")
    )


def tick_watermarks(ticks: DataFrame, before: datetime | None = None) -> DataFrame:
    """``tick, min_ts, max_ts`` plus ``watermark``: the highest time of all earlier ticks.

    ``before`` is the highest time of what came before all of them. Ticks are carried in
    blocks, so no task sees more than one block of ticks or one row per block.
    """
    blocks = ticks.withColumn("_block", F.call_function("div", F.col("tick"), F.lit(TICK_BLOCK)))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.groupBy("_block")
        .agg(F.max("max_ts").alias("_max"))
        .select("_block", F.max("_max").over(earlier).alias("_before"))
    )
    inside = F.max("max_ts").over(
        Window.partitionBy("_block").orderBy("tick").rowsBetween(Window.unboundedPreceding, -1)
    )
    mark = F.greatest("_inside", "_before", F.lit(before).cast("timestamp"))
    return (
        blocks.withColumn("_inside", inside)
        .join(carried, "_block")
        .select("tick", "min_ts", "max_ts", mark.alias("watermark"))
    )


def pane_parts(
    rows: DataFrame, ts: str, size: str, dim: str = "dim1", metric: str = "metrics1"
) -> DataFrame:
    """One row per window, dimension and ``tick``: what the rows of a trigger interval add to a pane."""
    return rows.groupBy(F.window(ts, size).alias("window"), F.col(dim).alias("dim1"), "tick").agg(
        F.count(metric).alias("num_records"),
        F.sum(metric).alias("sum"),
        F.min(metric).alias("min"),
        F.max(metric).alias("max"),
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
    )


def timed_parts(parts: DataFrame, marks: DataFrame, lateness: str) -> DataFrame:
    """The parts that fire, with ``timing`` EARLY or LATE by the watermark of their tick."""
    timing = _timing(F.col("window.end"), lateness, F.col("watermark"))
    timed = parts.drop("min_ts", "max_ts").join(marks, "tick").withColumn("timing", timing)
    early = F.when(F.col("timing") == "IN_TIME", "EARLY").otherwise("LATE")
    return timed.filter("timing <> 'DROPPED'").select(
        "dim1",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "tick",
        early.alias("timing"),
        *("num_records", "sum", "min", "max"),
    )


def _passing_ticks(marks: DataFrame, size: str) -> DataFrame:
    """``window_end, passed_at``: the tick whose rows move the watermark to a window's end."""
    first = F.window(F.coalesce("watermark", "min_ts"), size)["end"]
    steps = F.sequence("_from", "max_ts", F.expr(f"INTERVAL {size}"))
    return marks.withColumn("_from", first).select(
        F.explode(F.when(F.col("_from") <= F.col("max_ts"), steps)).alias("window_end"),
        F.col("tick").alias("passed_at"),
    )


def tick_panes(parts: DataFrame, marks: DataFrame, size: str) -> DataFrame:
    """Every firing of every window, from ``timed_parts`` and the marks of all ticks.

    Each tick with rows fires one pane, EARLY before the watermark passes the window's
    end and LATE after; the tick that passes it fires one ON_TIME pane after its rows,
    with nothing pending. ``num_records, sum, min, max`` are the pane's own values
    (discarding), the ``acc_`` columns run over all panes so far (accumulating).
    """
    key = ["dim1", "window_start", "window_end"]
    values = ["num_records", "sum", "min", "max"]
    waiting = parts.filter("timing = 'EARLY'").select(*key).distinct()
    on_time = waiting.join(_passing_ticks(marks, size), "window_end").select(
        *key,
        F.col("passed_at").alias("tick"),
        F.lit("ON_TIME").alias("timing"),
        F.lit(0).cast("bigint").alias("num_records"),
        *[F.lit(None).cast("bigint").alias(v) for v in values[1:]],
    )
    by_key = Window.partitionBy(*key).orderBy("tick", F.col("timing") != "EARLY")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    final = F.sum(F.when(F.col("timing") == "EARLY", 0).otherwise(1)).over(so_far)
    index = F.row_number().over(by_key) - 1
    return parts.select(*key, "tick", "timing", *values).unionByName(on_time).select(
        *key,
        "tick",
        "timing",
        index.cast("bigint").alias("pane_idx"),
        F.when(F.col("timing") == "EARLY", -1).otherwise(final - 1).cast("bigint").alias("nonspeculative_idx"),
        (index == 0).alias("is_first"),
        F.lit(False).alias("is_last"),
        *values,
        F.sum("num_records").over(so_far).alias("acc_num_records"),
        F.sum("sum").over(so_far).alias("acc_sum"),
        F.min("min").over(so_far).alias("acc_min"),
        F.max("max").over(so_far).alias("acc_max"),
    )


def non_empty(panes: DataFrame) -> DataFrame:
    """Panes that hold rows of their own."""
    return panes.filter("num_records > 0")

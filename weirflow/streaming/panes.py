"""Window panes in a stream: early, on-time and late firings with their numbering."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

PARTIAL = T.StructType(
    [
        T.StructField("dim1", T.StringType()),
        T.StructField("start_ms", T.LongType()),
        T.StructField("max_ts", T.TimestampType()),
        T.StructField("num_records", T.LongType()),
        T.StructField("sum", T.LongType()),
        T.StructField("min", T.LongType()),
        T.StructField("max", T.LongType()),
    ]
)

PANES = (
    "dim1 string, window_start timestamp, window_end timestamp, timing string, pane_idx long, "
    "nonspeculative_idx long, is_first boolean, is_last boolean, num_records long, sum long, "
    "min long, max long, acc_num_records long, acc_sum long, acc_min long, acc_max long"
)

_PaneRow = Row(*[part.split()[0] for part in PANES.split(", ")])

# All panes so far, rows waiting for a late firing, and the firing counters.
STATE = (
    "n long, total long, low long, high long, "
    "wait_n long, wait_total long, wait_low long, wait_high long, "
    "fired long, final_fired long, passed boolean"
)

EMPTY = (0, 0, None, None)


def _merge(a: tuple, b: tuple) -> tuple:
    lows = [v for v in (a[2], b[2]) if v is not None]
    highs = [v for v in (a[3], b[3]) if v is not None]
    return a[0] + b[0], a[1] + b[1], min(lows, default=None), max(highs, default=None)


class PaneProcessor(StatefulProcessor):
    """Firings of one (dimension, window); its rows come as partial sums."""

    def __init__(self, size_ms: int, lateness_ms: int, late_count: int):
        self.size_ms = size_ms
        self.lateness_ms = lateness_ms
        self.late_count = late_count
        # Spark's own late filter must not drop rows that are still allowed.
        self.delay_ms = size_ms + lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", STATE)

    def _watermark(self, timers: TimerValues) -> int | None:
        current = timers.getCurrentWatermarkInMs()
        return current + self.delay_ms if current > 0 else None

    def _load(self) -> dict | None:
        stored = self.state.get()
        if stored is None:
            return None
        return {
            "all": tuple(stored[0:4]),
            "wait": tuple(stored[4:8]),
            "fired": stored[8],
            "final": stored[9],
            "passed": stored[10],
        }

    def _store(self, s: dict) -> None:
        self.state.update((*s["all"], *s["wait"], s["fired"], s["final"], s["passed"]))

    def _fire(self, key, s: dict, timing: str, own: tuple, last: bool = False) -> Row:
        dim, start = key
        index = s["fired"]
        s["fired"] += 1
        if timing == "EARLY":
            nonspeculative = -1
        else:
            nonspeculative = s["final"]
            s["final"] += 1
        bounds = (_moment(start), _moment(start + self.size_ms))
        flags = (timing, index, nonspeculative, index == 0, last)
        return _PaneRow(dim, *bounds, *flags, *own, *s["all"])

    def _pass(self, key, s: dict, out: list[Row]) -> None:
        """The watermark is over the window's end: fire once, wait for the lateness to end."""
        s["passed"] = True
        if s["all"][0] > 0:
            out.append(self._fire(key, s, "ON_TIME", EMPTY))
        closes = key[1] + self.size_ms + self.lateness_ms
        self.handle.registerTimer(closes - self.delay_ms - 1)

    def handleInputRows(
        self, key, rows: Iterator[Row], timerValues: TimerValues
    ) -> Iterator[Row]:
        end = key[1] + self.size_ms
        watermark = self._watermark(timerValues)
        new = EMPTY
        for row in rows:
            new = _merge(new, (row["num_records"], row["sum"], row["min"], row["max"]))
        if watermark is not None and watermark >= end + self.lateness_ms:
            return
        s = self._load()
        out: list[Row] = []
        late = watermark is not None and watermark >= end
        if s is None:
            s = {"all": EMPTY, "wait": EMPTY, "fired": 0, "final": 0, "passed": False}
            if not late:
                self.handle.registerTimer(end - self.delay_ms - 1)
        if late and not s["passed"]:
            self._pass(key, s, out)
        s["all"] = _merge(s["all"], new)
        if not late:
            out.append(self._fire(key, s, "EARLY", new))
        else:
            s["wait"] = _merge(s["wait"], new)
            if s["wait"][0] >= self.late_count:
                out.append(self._fire(key, s, "LATE", s["wait"]))
                s["wait"] = EMPTY
        self._store(s)
        yield from out

    def handleExpiredTimer(
        self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        s = self._load()
        if s is None:
            return
        end = key[1] + self.size_ms
        watermark = self._watermark(timerValues) or 0
        out: list[Row] = []
        if watermark >= end and not s["passed"]:
            self._pass(key, s, out)
        if watermark >= end + self.lateness_ms:
            # The closing pane fires only when rows are pending.
            if s["wait"][0] > 0:
                out.append(self._fire(key, s, "LATE", s["wait"], last=True))
            self.state.clear()
        else:
            self._store(s)
        yield from out

    def close(self) -> None:
        pass


def _moment(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, UTC)


def partial_sums(events: DataFrame, ts: str, size_ms: int, dim: str, metric: str) -> DataFrame:
    """One row per dimension, window and Arrow batch: what a hot key sends to the shuffle."""
    millis = F.unix_millis(F.col(ts).cast("timestamp"))
    rows = events.select(
        F.col(dim).alias("dim1"),
        (millis - F.pmod(millis, F.lit(size_ms))).alias("start_ms"),
        F.timestamp_millis(millis).alias("max_ts"),
        F.col(metric).cast("bigint").alias("metric"),
    )

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.groupby(["dim1", "start_ms"], as_index=False, dropna=False).agg(
                    max_ts=("max_ts", "max"),
                    num_records=("metric", "count"),
                    sum=("metric", "sum"),
                    min=("metric", "min"),
                    max=("metric", "max"),
                )

    return rows.filter(F.col("metric").isNotNull()).mapInPandas(combine, PARTIAL)


def pane_stream(
    events: DataFrame,
    ts: str,
    size_seconds: int,
    lateness_seconds: int,
    late_count: int = 1,
    dim: str = "dim1",
    metric: str = "metrics1",
) -> DataFrame:
    """Panes of a streaming DataFrame, in discarding and accumulating values.

    Each micro-batch with rows for an open window fires EARLY (the trigger
    interval is the early-firing period), the watermark passing its end fires
    ON_TIME, and ``late_count`` late rows fire LATE until the lateness is over.
    Panes of no rows of their own are the ON_TIME ones. What still waits when the
    lateness is over fires as the last pane, LATE.
    """
    size_ms, lateness_ms = size_seconds * 1000, lateness_seconds * 1000
    partials = partial_sums(events, ts, size_ms, dim, metric)
    return (
        partials.withWatermark("max_ts", f"{size_seconds + lateness_seconds} seconds")
        .groupBy("dim1", "start_ms")
        .transformWithState(
            PaneProcessor(size_ms, lateness_ms, late_count),
            outputStructType=PANES,
            outputMode="Append",
            timeMode="EventTime",
        )
    )

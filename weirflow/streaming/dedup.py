"""Deduplication in a stream, with keys forgotten after a fixed time."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)


class FirstSeen(StatefulProcessor):
    """Lets the first row of a key pass and remembers the key for ``ttl_ms``.

    With a column ``at`` the rows' own times decide when a key is free again, and the
    state holds that time.
    """

    def __init__(self, ttl_ms: int, order: str, at: str | None):
        self.ttl_ms, self.order, self.at = ttl_ms, order, at

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.at is None:
            self.seen = handle.getValueState("seen", "seen boolean", ttlDurationMs=self.ttl_ms)
        else:
            self.seen = handle.getValueState("seen", "free_at timestamp")

    def handleInputRows(
        self, key, rows: Iterator[Row], timerValues: TimerValues
    ) -> Iterator[Row]:
        if self.at is None:
            first = min(rows, key=lambda row: row[self.order], default=None)
            if first is not None and not self.seen.exists():
                self.seen.update((True,))
                yield first
            return
        free_at = self.seen.get()[0] if self.seen.exists() else None
        for row in sorted(rows, key=lambda row: (row[self.at], row[self.order])):
            if free_at is None or row[self.at].timestamp() >= free_at.timestamp():
                free_at = row[self.at] + timedelta(milliseconds=self.ttl_ms)
                self.seen.update((free_at,))
                yield row

    def close(self) -> None:
        pass


def dedup_stream(
    rows: DataFrame, key: str, order: str, ttl_seconds: int = 300, at: str | None = None
) -> DataFrame:
    """First row per key; the key is forgotten ``ttl_seconds`` of processing time later.

    With a timestamp column ``at``, such as the ingest time, the key is free again
    ``ttl_seconds`` after the time of the row that passed, so a backlog gives the same rows
    as a live stream; a key's one value then stays in the state. ``order`` decides among
    rows of equal time. Rows without a key share nothing: keep them out of this stream
    (``has_key``); ``at`` must not be null. Each Arrow batch sends only its first row per
    key (and time) to the shuffle, so a hot key stays small there. The query
    needs ``spark.sql.streaming.noDataMicroBatches.enabled=false`` to end under
    an available-now trigger.
    """
    same = [key] if at is None else [key, at]

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # Arrow keeps every value as it is, nulls beside integers too
            ranked = batch.take(pc.sort_indices(batch, [(order, "ascending")]))
            codes = [ranked.column(c).dictionary_encode().indices.to_numpy() for c in same]
            code = np.unique(np.stack(codes, axis=1), axis=0, return_index=True)[1]
            yield ranked.take(pa.array(np.sort(code)))

    schema = T.StructType(rows.schema.fields)
    return (
        has_key(rows, key)
        .mapInArrow(firsts, schema)
        .groupBy(key)
        .transformWithState(
            FirstSeen(ttl_seconds * 1000, order, at),
            outputStructType=schema,
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )


def has_key(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull())


def without_key(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNull())


def dedup_event_time(rows: DataFrame, key: str, ts: str, ttl: str = "300 seconds") -> DataFrame:
    """The event-time form: duplicates within ``ttl`` of event time are dropped."""
    return rows.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])

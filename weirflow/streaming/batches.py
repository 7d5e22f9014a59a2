"""Batches of at most *n* rows or *t* seconds per key, across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

Batch = Row("key", "shard", "batch", "closed", "rows")


class Batcher(StatefulProcessor):
    """Keeps the rows of a key that wait for their batch: fewer than ``size`` of them.

    A batch is full with ``size`` rows, or over ``wait_ms`` after its first row came.
    """

    def __init__(self, size: int, wait_ms: int, schema: str, names: list[str], order: str):
        self.size, self.wait_ms, self.order = size, wait_ms, order
        self.schema, self.names = schema, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.facts = handle.getValueState("facts", "closed long, since long")

    def _out(self, key: tuple, number: int, closed: str, rows: list) -> Row:
        return Batch(key[0], key[1], number, closed, [dict(zip(self.names, r)) for r in rows])

    def handleInputRows(
        self, key, rows: Iterator[Row], timerValues: TimerValues
    ) -> Iterator[Row]:
        closed, since = self.facts.get() if self.facts.exists() else (0, None)
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        new = sorted((r["row"] for r in rows), key=lambda r: r[self.order])
        for row in new:
            held.append(tuple(row[n] for n in self.names))
            if len(held) == self.size:
                yield self._out(key, closed, "full", held)
                held, closed, since = [], closed + 1, None
        if held and since is None:
            since = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(since + self.wait_ms)
        self._keep(held, closed, since)

    def handleExpiredTimer(
        self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        closed, since = self.facts.get() if self.facts.exists() else (0, None)
        # A timer of a batch that was filled meanwhile finds a younger one, or none.
        if since is None or expiredTimerInfo.getExpiryTimeInMs() < since + self.wait_ms:
            return
        held = [tuple(r) for r in self.waiting.get()]
        yield self._out(key, closed, "time", held)
        self._keep([], closed + 1, None)

    def _keep(self, held: list, closed: int, since: int | None) -> None:
        if held:
            self.waiting.put(held)
        else:
            self.waiting.clear()
        self.facts.update((closed, since))

    def close(self) -> None:
        pass


def batch_stream(
    rows: DataFrame, key: str, order: str, size: int = 100, wait_seconds: int = 15, shards: int = 1
) -> DataFrame:
    """``key, shard, batch, closed, rows``: the rows of a key in batches, oldest first.

    ``batch`` counts up per key and shard. ``closed`` is ``full`` or ``time``. Rows of a
    micro-batch are taken in the order of ``order``, and rows wait for later micro-batches
    in the state, so a batch may span several. A hot key is dealt to ``shards`` tasks by a
    hash of the order column, each with batches of its own.
    """
    schema = rows.schema
    shard: Column = F.pmod(F.xxhash64(order), F.lit(shards)).cast("int")
    keyed = rows.select(F.col(key).alias("key"), shard.alias("shard"), F.struct(*rows.columns).alias("row"))
    out = T.StructType(
        [
            T.StructField("key", schema[key].dataType),
            T.StructField("shard", T.IntegerType()),
            T.StructField("batch", T.LongType()),
            T.StructField("closed", T.StringType()),
            T.StructField("rows", T.ArrayType(schema)),
        ]
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return keyed.groupBy("key", "shard").transformWithState(
        Batcher(size, wait_seconds * 1000, fields, schema.names, order),
        outputStructType=out,
        outputMode="Append",
        timeMode="ProcessingTime",
    )

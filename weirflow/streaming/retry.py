"""What to do when a micro-batch fails: try again, or find the rows that make it fail.

A failure of the surroundings (a lost connection, a full disk) passes; the micro-batch is
run again after a pause. A failure of the data does not pass: run again, it stops the
stream for ever. Then the rows at fault are searched by halving, they go to a table of
their own with the error's name, and the micro-batch is run without them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from weirflow.session import scratch_dir
from weirflow.sinks import tables
from weirflow.streaming.bodies import Body

# Rows of a block: a searched micro-batch lies in files by block, and a small part of it is read from one.
BLOCK_ROWS = 16_384
# Parts of a micro-batch that are tried side by side.
SIDE_BY_SIDE = 16
# Ranges of rows at fault that are copied to every task; more are joined as Spark sees fit.
BROADCAST_RANGES = 100_000

# SQLSTATE class of data exceptions: casts, overflow, division by zero, malformed text.
DATA_STATE = "22"


def is_data_error(error: BaseException) -> bool:
    """Whether the data is at fault: by the error's SQLSTATE, or a ValueError of the body."""
    if isinstance(error, PySparkException):
        state = error.getSqlState()
        if state:
            return state.startswith(DATA_STATE)
        # A failed task's own error stands in the text of the job's.
        return f"SQLSTATE: {DATA_STATE}" in str(error) or "ValueError:" in str(error)
    return isinstance(error, (ValueError, ArithmeticError))


def error_name(error: BaseException) -> str:
    if isinstance(error, PySparkException) and error.getCondition():
        return error.getCondition()
    return type(error).__name__


class Part(NamedTuple):
    """Rows ``low`` to ``high`` of a block, or all rows of the blocks ``first`` to ``last``."""

    first: int
    last: int
    low: int
    high: int

    def halves(self, sizes: dict[int, int]) -> tuple[Part, Part] | None:
        """Two parts of about the same size, or None for a single row."""
        if self.first < self.last:
            middle = (self.first + self.last) // 2
            cuts = ((self.first, middle), (middle + 1, self.last))
            return tuple(Part(a, b, 0, sizes.get(a, 0) if a == b else 0) for a, b in cuts)
        if self.high - self.low < 2:
            return None
        middle = (self.low + self.high) // 2
        return self._replace(high=middle), self._replace(low=middle)

    def of(self, rows: DataFrame) -> DataFrame:
        if self.first < self.last:
            return rows.filter(F.col("block").between(self.first, self.last))
        inside = (F.col("n") >= self.low) & (F.col("n") < self.high)
        return rows.filter((F.col("block") == self.first) & inside)


def isolating(
    body: Body,
    poison_table: str,
    attempts: int = 3,
    pause: float = 1.0,
    max_runs: int = 200,
    data_error: Callable[[BaseException], bool] = is_data_error,
    trial: Body | None = None,
) -> Body:
    """``body`` with bounded retries, that writes all rows but those that make it fail.

    One bad row among *n* is found in about log2 *n* runs of the body on parts of the
    micro-batch. Such a run replaces what an earlier one wrote, as runs of one micro-batch
    do; the last run, on all good rows, is what stands. Rows at fault go to ``poison_table``
    as JSON text ``value`` with the error's name as ``reason``. After ``max_runs`` for each
    ``BLOCK_ROWS`` rows the parts still searched go there whole, so a batch of nothing but
    bad rows ends too. A transient error is raised after ``attempts``, and the stream's own
    restart takes over.

    A micro-batch with many bad rows takes many runs, and runs of a body that writes must
    follow each other. ``trial`` does the body's work on the rows but writes nowhere
    (``noop``), so trials go side by side and find the parts at fault; what fails only in
    the body itself is then searched with the body.
    """

    def run(work: Body, batch: DataFrame, batch_id: int) -> BaseException | None:
        """The error that is the data's fault, or None; others are tried again, then raised."""
        for attempt in range(attempts):
            try:
                work(batch, batch_id)
                return None
            except Exception as error:  # noqa: BLE001
                if data_error(error):
                    return error
                if attempt + 1 == attempts:
                    raise
                time.sleep(pause * 2**attempt)
        return None

    def wrapped(batch: DataFrame, batch_id: int) -> None:
        error = run(body, batch, batch_id)
        if error is None:
            return
        rows, sizes = _blocks(batch)
        left = max_runs * len(sizes)

        def search(work: Body, cause: BaseException, side_by_side: int) -> list[tuple[Part, str]]:
            """Halve the parts that are known to fail, larger ones first."""
            nonlocal left
            poison = []

            def halve(known: tuple[Part, BaseException]) -> tuple[int, list[tuple[Part, BaseException]]]:
                one, other = known[0].halves(sizes)
                first = run(work, one.of(rows).select("row.*"), batch_id)
                if first is None:  # then the other half is at fault
                    return 1, [(other, known[1])]
                second = run(work, other.of(rows).select("row.*"), batch_id)
                return 2, [(one, first), *([] if second is None else [(other, second)])]

            top = max(sizes)
            failing = [(Part(0, top, 0, 0 if top else sizes[0]), cause)]
            with ThreadPoolExecutor(side_by_side) as pool:
                while failing:
                    now, failing = failing[:side_by_side], failing[side_by_side:]
                    whole = [k for k in now if left <= 0 or not k[0].halves(sizes)]
                    poison += [(part, error_name(e)) for part, e in whole]
                    now = [k for k in now if k not in whole]
                    # A body runs in the stream's own thread, which knows the stream's id.
                    beside = inheritable_thread_target(rows.sparkSession)(halve)
                    for used, found in pool.map(beside, now) if side_by_side > 1 else map(halve, now):
                        left -= used
                        failing += found
            return poison

        searches = [] if trial is None else [(trial, SIDE_BY_SIDE)]
        letters = []
        for work, side_by_side in [*searches, (body, 1)]:
            if work is not body:
                error = run(work, rows.select("row.*"), batch_id)
            if error is not None:
                bad = _ranges(rows.sparkSession, search(work, error, side_by_side), sizes)
                letters.append(rows.join(bad, _inside(rows, bad)).select(F.to_json("row").alias("value"), "reason"))
                rows = rows.join(bad, _inside(rows, bad), "left_anti")
            error = run(body, rows.select("row.*"), batch_id)
            if error is None:
                break
        if error is not None:  # no row alone is at fault, but rows together are
            raise error
        tables.append_batch(reduce(DataFrame.unionAll, letters), poison_table, batch_id, create=True)

    return wrapped


def _blocks(batch: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The micro-batch in files, ``row, n, block`` with rows numbered by block, and the blocks' sizes.

    Its parts are read often, its source is not. A size per block reaches the driver.
    """
    spark, path = batch.sparkSession, scratch_dir(batch.sparkSession, "searched-batch")
    blocks = max(1, -(-batch.count() // BLOCK_ROWS))
    whole = batch.select(F.struct(*batch.columns).alias("row"), F.monotonically_increasing_id().alias("id"))
    dealt = whole.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    n = F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1
    dealt.select("row", n.alias("n"), "block").write.partitionBy("block").parquet(path)
    schema = T.StructType([whole.schema["row"], T.StructField("n", T.IntegerType()), T.StructField("block", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    return rows, {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}


def _ranges(spark: SparkSession, poison: list[tuple[Part, str]], sizes: dict[int, int]) -> DataFrame:
    """The parts at fault as ``in_block, low, high, reason``."""
    found = []
    for part, reason in poison:
        for block in range(part.first, part.last + 1):
            low, high = (part.low, part.high) if part.first == part.last else (0, sizes.get(block, 0))
            found.append((block, low, high, reason))
    ranges = spark.createDataFrame(found, "in_block int, low int, high int, reason string")
    return F.broadcast(ranges) if len(found) <= BROADCAST_RANGES else ranges


def _inside(rows: DataFrame, ranges: DataFrame) -> Column:
    same = rows["block"] == ranges["in_block"]
    return same & (rows["n"] >= ranges["low"]) & (rows["n"] < ranges["high"])

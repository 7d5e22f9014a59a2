"""The bulk sink as a data source: a write posts each document once and keeps receipts.

A task posts its documents and writes a receipt per request to a file of its own. Only
when all tasks are through does the driver write the manifest of the epoch, one line per
task, so receipts of a lost or repeated task attempt are never read. A micro-batch whose
manifest is there has been sent: run again after a restart, it posts nothing. Documents
of an epoch that failed half-way are posted again with it, as the service has no
transactions; give documents their own ids where that matters.

An empty micro-batch has a manifest without lines. Documents that are null are not sent.
``part`` may be null and is then a part of its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs, parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from weirflow.sinks.bulk import Limits, Post, RESULT, bulk_columns, sent_requests
from weirflow.sinks.tables import stream_id

RECEIPT = f"epoch long, writer string, task string, {RESULT}"
MANIFEST = "epoch long, writer string, task string, requests long, documents long"
RECEIPT_ARROW = pa.schema(
    [("epoch", pa.int64()), ("writer", pa.string()), ("task", pa.string()), ("part", pa.string())]
    + [(name, pa.int64()) for name in ("batch", "docs", "bytes")]
    + [(name, pa.int32()) for name in ("attempts", "status")]
)
ROWS_HELD = 1000  # receipts a task holds before it writes them


@dataclass
class TaskSent(WriterCommitMessage):
    """What one task tells the driver: counters, whatever the number of its requests."""

    task: str
    requests: int
    documents: int


@dataclass(frozen=True)
class Epoch:
    """One micro-batch of one stream, and the folder of its receipts."""

    folder: str
    writer: str
    number: int

    def manifest(self) -> tuple[pafs.FileSystem, str]:
        store, root = pafs.FileSystem.from_uri(self.folder)
        return store, f"{root}/manifests/{self.writer}-{self.number}.json"

    def landed(self) -> bool:
        store, path = self.manifest()
        return store.get_file_info(path).type != pafs.FileType.NotFound

    def receipts(self, task: str) -> tuple[pafs.FileSystem, str]:
        store, root = pafs.FileSystem.from_uri(self.folder)
        store.create_dir(f"{root}/receipts", recursive=True)
        return store, f"{root}/receipts/{self.writer}-{self.number}-{task}.parquet"


class BulkWriter(DataSourceArrowWriter):
    """Posts in the tasks, then names the tasks that are through in the epoch's manifest."""

    def __init__(self, epoch: Epoch, post: Post, limits: Limits) -> None:
        self.epoch, self.post, self.limits = epoch, post, limits
        self.landed = epoch.landed()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskSent:
        task = uuid.uuid4().hex
        if self.landed:
            return TaskSent(task, 0, 0)
        own = (self.epoch.number, self.epoch.writer, task)
        requests = documents = 0
        held: list[tuple] = []
        writer = None
        try:
            for result in sent_requests(_frames(iterator), self.post, self.limits):
                held.append((*own, *result))
                requests, documents = requests + 1, documents + result[2]
                if len(held) >= ROWS_HELD:
                    writer = self._write(writer, held, task)
                    held = []
            if held:
                writer = self._write(writer, held, task)
        finally:
            if writer is not None:
                writer.close()
        return TaskSent(task, requests, documents)

    def _write(self, writer: pq.ParquetWriter | None, held: list[tuple], task: str) -> pq.ParquetWriter:
        if writer is None:
            store, path = self.epoch.receipts(task)
            writer = pq.ParquetWriter(path, RECEIPT_ARROW, filesystem=store)
        columns = [pa.array(values, f.type) for values, f in zip(zip(*held), RECEIPT_ARROW)]
        writer.write_table(pa.table(columns, schema=RECEIPT_ARROW))
        return writer

    def commit(self, messages: list[TaskSent | None]) -> None:
        if self.landed:
            return
        own = {"epoch": self.epoch.number, "writer": self.epoch.writer}
        lines = [json.dumps({**own, **vars(m)}) for m in messages if m is not None and m.requests]
        store, path = self.epoch.manifest()
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        # Written beside its name first: a reader sees a whole manifest or none.
        folder, name = path.rsplit("/", 1)
        with store.open_output_stream(f"{folder}/_{name}") as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        store.move(f"{folder}/_{name}", path)

    def abort(self, messages: list[TaskSent | None]) -> None:
        """No manifest names the receipts of this run, so they are not read."""


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        frame = batch.to_pandas()
        yield frame[frame["doc"].notna()]


def register_bulk(spark: SparkSession, name: str, post: Post, limits: Limits = Limits()) -> str:
    """Make ``post`` a format to write to: options ``receipts``, ``writer`` and ``epoch``."""

    class BulkSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: T.StructType, overwrite: bool) -> BulkWriter:
            if overwrite:
                raise ValueError("documents that were sent can't be taken back: use mode append")
            epoch = Epoch(self.options["receipts"], self.options["writer"], int(self.options["epoch"]))
            return BulkWriter(epoch, post, limits)

    spark.dataSource.register(BulkSource)
    return name


def bulk_commit_body(
    name: str,
    receipts: str,
    part: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that posts the ``doc`` column once per micro-batch.

    ``receipts`` is a folder that the driver and all executors share. With ``part`` rows must
    come ordered by that column. ``prepare`` makes the documents of a micro-batch.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        docs = bulk_columns(prepare(batch), part)
        writer = docs.write.format(name).option("receipts", receipts)
        writer = writer.option("writer", stream_id(batch.sparkSession)).option("epoch", str(batch_id))
        writer.mode("append").save()

    return body


def read_receipts(spark: SparkSession, receipts: str) -> DataFrame:
    """One row per request that counts: those of tasks that a manifest names."""
    store, root = pafs.FileSystem.from_uri(receipts)
    if store.get_file_info(f"{root}/receipts").type == pafs.FileType.NotFound:
        return spark.createDataFrame([], RECEIPT)
    counted = spark.read.schema(MANIFEST).json(f"{receipts}/manifests")
    sent = spark.read.schema(RECEIPT).parquet(f"{receipts}/receipts")
    return sent.join(counted.select("epoch", "writer", "task"), ["epoch", "writer", "task"], "left_semi")


def receipt_totals(spark: SparkSession, receipts: str) -> DataFrame:
    """Counters of every micro-batch that sent something, from the manifests alone."""
    return (
        spark.read.schema(MANIFEST)
        .json(f"{receipts}/manifests")
        .groupBy("epoch", "writer")
        .agg(F.sum("documents").alias("documents"), F.sum("requests").alias("requests"))
    )

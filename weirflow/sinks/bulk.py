"""Bulk document sink: bounded batches per task, posted with retries."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

# Limits of one request and the retry rule of the index service.
MAX_DOCS = 1000
MAX_BYTES = 5 * 1024 * 1024
MAX_SECONDS = 30.0
BYTES_PER_CHAR = 3
BUSY = 429
MAX_ATTEMPTS = 6
RETRY_SECONDS = 60.0
FIRST_PAUSE = 5.0
ACTION = '{"index":{}}\n'

# Sends a request body; gives an HTTP status or the JSON text of the bulk answer.
Post = Callable[[str], int | str]

RESULT = "part string, batch long, docs long, bytes long, attempts int, status int"
RESULT_NAMES = ["part", "batch", "docs", "bytes", "attempts", "status"]


def bulk_body(docs: list[str]) -> str:
    """Newline-JSON request body: an action line before each document."""
    return "".join(f"{ACTION}{doc}\n" for doc in docs)


def answer_status(answer: int | str) -> tuple[int, str]:
    """Status and message of an answer: an HTTP status, or the JSON text of a bulk answer.

    A bulk answer fails as a whole when any document failed. It counts as busy if
    one of them was refused as such.
    """
    if isinstance(answer, int):
        return answer, ""
    parsed = json.loads(answer)
    if not parsed.get("errors"):
        return 200, ""
    results = [result for item in parsed.get("items", []) for result in item.values()]
    failed = [r for r in results if "error" in r or r.get("status", 200) >= 300]
    statuses = [r.get("status", 500) for r in failed]
    status = BUSY if BUSY in statuses else next(iter(statuses), 500)
    return status, "; ".join(f"{r.get('_id')}: {r.get('error')}" for r in failed)


def post_with_retry(
    post: Post,
    body: str,
    sleep: Callable[[float], None] = time.sleep,
    jitter: Callable[[], float] = lambda: random.uniform(0.5, 1.5),
) -> tuple[int, int]:
    """Attempts and final status. Only a busy answer is retried, with growing pauses."""
    pause, waited, attempt = FIRST_PAUSE, 0.0, 0
    while True:
        attempt += 1
        status, message = answer_status(post(body))
        if status < 300:
            return attempt, status
        if status != BUSY or attempt >= MAX_ATTEMPTS or waited >= RETRY_SECONDS:
            raise OSError(
                f"bulk request failed with status {status} after {attempt} attempts {message}"
            )
        nap = min(pause * jitter(), RETRY_SECONDS - waited)
        sleep(nap)
        waited += nap
        pause *= 1.5


class Limits(NamedTuple):
    """Where a request ends: documents, bytes (three per character) or seconds."""

    docs: int = MAX_DOCS
    bytes: int = MAX_BYTES
    seconds: float = MAX_SECONDS


def sent_requests(frames: Iterator[pd.DataFrame], post: Post, limits: Limits) -> Iterator[tuple]:
    """Post the ``doc`` column of the frames in bounded requests; a tuple of ``RESULT`` each.

    One request's documents are held at a time. With a ``part`` column a request also ends
    where it changes; else the part is the Spark partition.
    """
    context = TaskContext.get()
    default_part = str(context.partitionId() if context else 0)
    batch: list[str] = []
    size, number, current, started = 0, 0, None, time.monotonic()

    def flush() -> tuple:
        attempts, status = post_with_retry(post, bulk_body(batch))
        return current, number, len(batch), size, attempts, status

    for frame in frames:
        parts = frame["part"].tolist() if "part" in frame else [default_part] * len(frame)
        for name, doc in zip(parts, frame["doc"].tolist()):
            if name != current:
                if batch:
                    yield flush()
                batch, size, number, current, started = [], 0, 0, name, time.monotonic()
            batch.append(doc)
            size += BYTES_PER_CHAR * len(doc)
            overdue = time.monotonic() - started >= limits.seconds
            if len(batch) >= limits.docs or size >= limits.bytes or overdue:
                yield flush()
                batch, size, number, started = [], 0, number + 1, time.monotonic()
    if batch:
        yield flush()


def bulk_columns(docs: DataFrame, part: str | None) -> DataFrame:
    columns = ["doc", F.col(part).cast("string").alias("part")] if part else ["doc"]
    return docs.select(*columns)


def send_bulk(
    docs: DataFrame,
    post: Post,
    part: str | None = None,
    max_docs: int = MAX_DOCS,
    max_bytes: int = MAX_BYTES,
    max_seconds: float = MAX_SECONDS,
) -> DataFrame:
    """Send the ``doc`` column in bulk requests; one result row per request.

    Documents stream through the task, which holds one batch at a time. A batch
    ends at ``max_docs``, at ``max_bytes`` (three per character) or after
    ``max_seconds``. With ``part``, rows must come ordered by that column and a
    batch also ends where it changes; else the part is the Spark partition. A
    failed request fails the task. Delivery is at least once, and every action on
    the result posts again: ``sinks.bulk_source`` posts once and keeps receipts.
    """
    limits = Limits(max_docs, max_bytes, max_seconds)

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in sent_requests(frames, post, limits):
            yield pd.DataFrame([row], columns=RESULT_NAMES)

    return bulk_columns(docs, part).mapInPandas(send, RESULT)


def bulk_totals(results: DataFrame) -> DataFrame:
    """Counters over all requests."""
    return results.agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("documents"),
        F.count("*").alias("batches"),
        F.coalesce(F.sum(F.col("attempts") - 1), F.lit(0)).alias("errors"),
    )

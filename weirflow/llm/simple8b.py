"""Token-id files: Simple-8b words, read and written by Spark tasks.

A 64-bit word has a 4-bit selector on top and 60 bits of data: so many ids of so many
bits each. An id that needs more than 60 bits is an escape: the word holds its place
in a list of whole values. Ids are packed in blocks of ``BLOCK``; a table has the first
word of each block, so any block decodes alone and all decode at once in numpy.

A file is a run of segments; each is self-contained:

    magic, then 6 unsigned 64-bit numbers: documents, ids, blocks, words, escapes, block size
    document ids (signed 64-bit), 1 byte per document: 1 if its id is null
    ids per document, first word of each block, words, escapes (unsigned 64-bit each)

All numbers are little-endian. A document is whole within its segment.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from weirflow.llm.tokens import encoder
from weirflow.llm.words import text_groups
from weirflow.session import materialize, scratch_dir

# The fixed values of the format: ids per word and bits per id, by selector from 1.
# Selector 0 is an escape.
LAYOUTS = (
    (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
MAGIC = b"IDS8B001"
BLOCK = 512
SEGMENT_IDS = 1 << 20

_COUNTS = np.array([1] + [n for n, _ in LAYOUTS], dtype=np.int64)
_LIMITS = np.array([1 << bits for _, bits in LAYOUTS], dtype=np.uint64)
_PAD = 120


def pack_words(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, first word of each block, escapes)`` of unsigned 64-bit ``ids``.

    Each word takes the most ids that fit from its place on. Which layout fits where is
    worked out for all places at once; then all blocks step from word to word together.
    """
    n = len(ids)
    blocks = -(-n // block)
    if not n:
        none = np.zeros(0, dtype=np.uint64)
        return none, none, none
    grid = np.zeros((blocks, block + _PAD), dtype=np.uint64)
    flat_ids = np.zeros(blocks * block, dtype=np.uint64)
    flat_ids[:n] = ids
    grid[:, :block] = flat_ids.reshape(blocks, block)
    kind = np.searchsorted(_LIMITS, grid, side="right").astype(np.int8)  # 15: an escape
    choice = np.zeros((blocks, block), dtype=np.int8)  # selector; 0 where nothing fits
    for at in range(len(LAYOUTS) - 1, -1, -1):  # the layout of most ids is set last
        count = LAYOUTS[at][0]
        if not (kind[:, :block] <= at).any():
            break
        over = np.zeros((blocks, block + _PAD + 1), dtype=np.int32)
        np.cumsum(kind > at, axis=1, out=over[:, 1:])
        choice[over[:, count : count + block] == over[:, :block]] = at + 1
    lengths = np.full(blocks, block, dtype=np.int64)
    lengths[-1] = n - (blocks - 1) * block
    starts = np.zeros((blocks, block), dtype=bool)
    live, place = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    while len(live):
        starts[live, place] = True
        place = place + _COUNTS[choice[live, place]]
        going = place < lengths[live]
        live, place = live[going], place[going]
    row, column = np.nonzero(starts)
    selector = choice[row, column].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    flat, at = grid.ravel(), row * (block + _PAD) + column
    for k, (count, bits) in enumerate(LAYOUTS, 1):
        which = np.flatnonzero(selector == k)
        if bits and len(which):
            for j in range(count):
                words[which] |= flat[at[which] + j] << np.uint64(j * bits)
    which = np.flatnonzero(selector == 0)
    escapes = flat[at[which]]
    words[which] |= np.arange(len(which), dtype=np.uint64)
    firsts = np.searchsorted(row, np.arange(blocks)).astype(np.uint64)
    return words, firsts, escapes


def unpack_words(
    words: np.ndarray, firsts: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK
) -> np.ndarray:
    """The ``n`` ids of whole blocks, as unsigned 64-bit numbers."""
    blocks = len(firsts)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selector]
    before = np.cumsum(counts) - counts
    first = firsts.astype(np.int64)
    row = np.repeat(np.arange(blocks), np.diff(np.append(first, len(words))))
    at = before - before[first][row] + row * (block + _PAD)
    out = np.zeros(blocks * (block + _PAD), dtype=np.uint64)
    for k, (count, bits) in enumerate(LAYOUTS, 1):
        which = np.flatnonzero(selector == k)
        mask = np.uint64((1 << bits) - 1)
        if bits and len(which):
            for j in range(count):
                out[at[which] + j] = words[which] >> np.uint64(j * bits) & mask
    which = np.flatnonzero(selector == 0)
    data = words[which] & np.uint64((1 << 60) - 1)
    out[at[which]] = escapes[data.astype(np.int64)]
    return out.reshape(blocks, block + _PAD)[:, :block].ravel()[:n]


def segment_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    words, firsts, escapes = pack_words(ids.astype(np.uint64))
    head = np.array([len(doc_ids), len(ids), len(firsts), len(words), len(escapes), BLOCK], "<u8")
    return b"".join(
        [
            MAGIC,
            head.tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            firsts.astype("<u8").tobytes(),
            words.astype("<u8").tobytes(),
            escapes.astype("<u8").tobytes(),
        ]
    )


def read_segments(stream) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """``(doc_ids, ids per document, ids)`` of each segment of an open file."""
    while magic := stream.read(len(MAGIC)):
        if magic != MAGIC:
            raise ValueError("not a token-id segment")
        docs, n, blocks, n_words, n_escapes, block = np.frombuffer(stream.read(48), "<u8").tolist()
        array = lambda kind, count: np.frombuffer(stream.read(count * np.dtype(kind).itemsize), kind)
        doc_ids, nulls, lengths = array("<i8", docs), array("u1", docs), array("<u8", docs)
        firsts, words, escapes = array("<u8", blocks), array("<u8", n_words), array("<u8", n_escapes)
        yield (
            [None if null else d for d, null in zip(doc_ids.tolist(), nulls.tolist())],
            lengths.astype(np.int64),
            unpack_words(words, firsts, escapes, n, block),
        )


def _segments(rows: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[tuple[list, list, np.ndarray]]:
    doc_ids, parts, n = [], [], 0
    for doc_id, ids in rows:
        doc_ids.append(doc_id)
        parts.append(ids)
        n += len(ids)
        if n >= SEGMENT_IDS:
            yield doc_ids, [len(p) for p in parts], np.concatenate(parts)
            doc_ids, parts, n = [], [], 0
    if doc_ids:
        yield doc_ids, [len(p) for p in parts], np.concatenate(parts)


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode ``doc_id, text`` and write files in ascending ``doc_id`` order below ``folder``.

    Returns the manifest ``(part, path, n_docs, n_ids)``, one row per file, ``part`` in
    order. A task that runs again writes a file of its own; a manifest row exists only
    for the attempt Spark counted, so others are never read. ``folder`` must be one that
    all executors share, in any store that pyarrow can write.

    Null ids come first. Equal ids are ordered by a hash of the text, which also lets an
    id that very many rows share be dealt to several tasks. A null text has the end id only.
    """
    key = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .withColumn("_tie", key)
        .repartitionByRange(F.asc_nulls_first("doc_id"), "_tie")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "_tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).batch
        end = np.array([end_id], dtype="<u4")
        part = TaskContext.get().partitionId()
        store, root = pafs.FileSystem.from_uri(folder)
        path = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.ids"
        rows = (
            (doc_id, np.concatenate([ids, end]))
            for batch in batches
            for group, texts in text_groups(batch, 1)
            for doc_id, ids in zip(group.column(0).to_pylist(), encode(texts))
        )
        n_docs = n_ids = 0
        stream = None
        for doc_ids, lengths, ids in _segments(rows):
            if stream is None:
                store.create_dir(root, recursive=True)
                stream = store.open_output_stream(path)
            stream.write(segment_bytes(doc_ids, lengths, ids))
            n_docs, n_ids = n_docs + len(doc_ids), n_ids + len(ids)
        if stream is not None:
            stream.close()
            name = path.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "path": [f"{folder}/{name}"], "n_docs": [n_docs], "n_ids": [n_ids]}
            )

    return ordered.mapInArrow(write, "part bigint, path string, n_docs bigint, n_ids bigint")


def read_ids(manifest: DataFrame, files: int) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` is the number of ids of all documents before. ``files`` is the number of
    files: each is read by a task of its own. The window sums one number per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.select(
        "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first")
    ).repartition(max(files, 1))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = pafs.FileSystem.from_uri(path)
                with store.open_input_stream(place) as stream:
                    for doc_ids, lengths, ids in read_segments(stream):
                        raw = ids.astype("<u4")
                        ends = np.cumsum(lengths)
                        bounds = [0, *ends.tolist()]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "doc_id": pa.array(doc_ids, pa.int64()),
                                "start": pa.array(first + ends - lengths, pa.int64()),
                                "n_tokens": pa.array(lengths, pa.int64()),
                                "ids_crc32": pa.array(
                                    [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])],
                                    pa.int64(),
                                ),
                            }
                        )
                        first += int(lengths.sum())

    return listed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write the ids of all documents and read them back."""
    folder = scratch_dir(docs.sparkSession, "token-ids")
    manifest = materialize(write_ids(docs, folder, vocabulary, end_id), "token-id-manifest")
    return read_ids(manifest, manifest.count())

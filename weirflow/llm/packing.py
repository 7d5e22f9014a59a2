"""Best-fit packing of token sequences by minimum bin slack.

Documents longer than the capacity are cut; the pieces are packed into sequences of at
most ``capacity`` tokens. The largest piece left opens a sequence; a bitset subset-sum
over the lengths still available finds the fullest combination that fits beside it,
and the combination is removed.

Only the *histogram* of lengths goes to the driver: at most ``capacity`` counters,
however large the corpus. A combination is taken as often as the counters allow at
once, so the number of rounds depends on the number of different lengths, not on the
number of pieces. Spark numbers the pieces of each length and looks up what place the
n-th piece of a length has. A length that a third of all pieces have is numbered in
hash buckets with carried offsets.

Nulls: a null text has no ids but the end id; a null document id is kept. Repeated rows
are packed each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weirflow.llm.shards import numbered
from weirflow.llm.tokens import encoder
from weirflow.llm.words import text_groups
from weirflow.session import materialize

CAPACITY = 2048
END_ID = 0

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Each document's ids and the end id, cut at ``capacity``: ``doc_id, piece, start,
    length, ids_crc32``, and the ids themselves with ``keep_ids``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).batch
        end = np.array([end_id], dtype="<u4")
        for part, texts in (g for batch in batches for g in text_groups(batch, 1)):
            rows = defaultdict(list)
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(texts)):
                ids = np.concatenate([ids, end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(len(own))
                    rows["ids_crc32"].append(zlib.crc32(own.tobytes()))
                    if keep_ids:
                        rows["ids"].append(own.astype("int32"))
            fields = [("doc_id", pa.int64()), ("piece", pa.int32())]
            fields += [(name, pa.int64()) for name in ("start", "length", "ids_crc32")]
            fields += [("ids", pa.list_(pa.int32()))] * keep_ids
            yield pa.RecordBatch.from_pydict(dict(rows) or {n: [] for n, _ in fields}, pa.schema(fields))

    schema = PIECES + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, schema)


def fullest(available: Mapping[int, int], room: int) -> list[int]:
    """Lengths from ``available`` (length to count) whose sum is the largest up to ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in available if n <= room), reverse=True):
        for _ in range(min(available[length], room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> left & 1:
            chosen.append(length)
            left -= length
    return chosen


def combinations(counts: Mapping[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """All sequences of the packing: ``([(length, uses), ...], repeats)``."""
    counts = {n: c for n, c in counts.items() if c}
    found = []
    while counts:
        largest = max(counts)
        rest = {n: c - (n == largest) for n, c in counts.items() if c > (n == largest)}
        uses = defaultdict(int, {largest: 1})
        for length in fullest(rest, capacity - largest):
            uses[length] += 1
        repeats = min(counts[n] // u for n, u in uses.items())
        found.append((sorted(uses.items(), reverse=True), repeats))
        for n, u in uses.items():
            counts[n] -= u * repeats
            if not counts[n]:
                del counts[n]
    return found


def places(found: Sequence[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """For each length, in order of its pieces' numbers: runs of pieces and where they go.

    ``first`` is ``length << 44`` plus the number of the run's first piece.
    """
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for uses, repeats in found:
        offset = 0
        for length, n in uses:
            rows.append(((length << 44) + taken[length], n, sequence, offset))
            taken[length] += n * repeats
            offset += n * length
        sequence += repeats
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return dict(zip(("first", "uses", "sequence", "offset"), table.T.copy()))


def pack(pieces: DataFrame, keys: Sequence[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``.

    ``keys`` should tell pieces apart. ``pieces`` is read twice: pass a written table.
    """
    histogram = {
        r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()
    }
    if any(n is None or n < 1 or n > capacity for n in histogram):
        raise ValueError(f"lengths must be 1 to {capacity}")
    where = places(combinations(histogram, capacity))
    names = [k for k in keys if k != "length"]
    rows = numbered(pieces, ["length"], names, buckets=256)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("row_number").to_numpy()
            run = np.searchsorted(where["first"], (length << 44) + number, side="right") - 1
            k = number - (where["first"][run] & ((1 << 44) - 1))
            uses = where["uses"][run]
            new = {
                "sequence_id": where["sequence"][run] + k // uses,
                "offset": where["offset"][run] + k % uses * length,
            }
            out = batch.drop_columns(["row_number"])
            for name, values in new.items():
                out = out.append_column(name, pa.array(values, pa.int64()))
            yield out

    kept = rows.select("length", *names, "row_number")
    schema = kept.drop("row_number").schema.add("sequence_id", T.LongType()).add("offset", T.LongType())
    return kept.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Cut and pack: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = materialize(token_pieces(docs, vocabulary, capacity, end_id), "pieces")
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return pack(pieces, keys, capacity).select(*keys, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the pieces' ``ids`` of each sequence put together."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))

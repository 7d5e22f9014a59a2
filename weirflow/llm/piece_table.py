"""Fill-in-middle transformation by piece table.

A document becomes one descriptor ``(buffer, start, length)`` over its immutable UTF-8
text; three more descriptors lie over a buffer of sentinels. Cutting splits a descriptor
and copies nothing. An arrangement is a permutation of descriptors: ``psm`` writes
``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` writes ``<S>`` suffix ``<P>`` prefix
``<M>`` middle. The inverse permutation over the written text's own descriptors gives the
document back. Hashes take in one descriptor after the other; no joined copy is made for
them.

Where a document is cut, and its form, follow from a hash of its id, so a task that
runs again writes the same. Positions are code points, matched to bytes once per text.

Nulls and empty texts: empty and ``plain``. A null id is hashed as empty text. A text
that holds a sentinel stays plain, else its form could not be told. Very long texts are
a few descriptors like any other; rows reach Python in batches bounded by bytes.
Repeated rows and ties get the same result each. Empty tables give empty results. Only
the id and text columns are read, so further columns never clash; the id column may not
be named as one of the result's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

Piece = tuple[int, int, int]  # buffer, first byte, bytes

# The sentinels, and where each stands in the buffer of sentinels.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
MARKS: tuple[Piece, ...] = ((1, 0, 3), (1, 3, 3), (1, 6, 3))
# Descriptors 0 to 2 are prefix, middle, suffix, 3 to 5 the sentinels in the order above.
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
WRITTEN = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

RESULT = {
    "n": "bigint",
    "form": "string",
    "prefix_chars": "bigint",
    "middle_chars": "bigint",
    "pieces": "array<struct<buffer: int, start: bigint, length: bigint>>",
    "output": "string",
    "output_sha256": "string",
}


@dataclass(frozen=True)
class PieceTable:
    """Descriptors over immutable buffers; every change gives a new table."""

    buffers: tuple[bytes, ...]
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: bytes, *more: bytes) -> PieceTable:
        return cls((text, *more), ((0, 0, len(text)),))

    def cut(self, at: int) -> PieceTable:
        """The same content with a border ``at`` bytes from its start.

        The last descriptor that starts there or before is split, so every cut adds
        one descriptor, an empty one if need be.
        """
        before, owner, inside = 0, 0, 0
        for i, (_, _, length) in enumerate(self.pieces):
            if before > at:
                break
            owner, inside = i, at - before
            before += length
        buffer, start, length = self.pieces[owner]
        if not 0 <= inside <= length:
            raise ValueError(f"no byte {at} to cut at")
        halves = ((buffer, start, inside), (buffer, start + inside, length - inside))
        return PieceTable(self.buffers, self.pieces[:owner] + halves + self.pieces[owner + 1 :])

    def arranged(self, order: Sequence[int]) -> PieceTable:
        """The descriptors in the given order."""
        return PieceTable(self.buffers, tuple(self.pieces[i] for i in order))

    def restored(self, order: Sequence[int]) -> PieceTable:
        """What ``arranged(order)`` was made of."""
        back = [0] * len(order)
        for place, i in enumerate(order):
            back[i] = place
        return self.arranged(back)

    def slices(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        for buffer, start, length in self.pieces:
            yield views[buffer][start : start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.slices():
            digest.update(part)
        return digest.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.slices())


@dataclass(frozen=True)
class Rates:
    """Per cent of documents left plain, and of the rest those in ``spm`` form."""

    plain: int = 10
    spm: int = 20
    seed: str = "1"

    def draws(self, doc_id: int | None) -> tuple[int, ...]:
        """Four numbers below 2**32 that follow from the id."""
        text = f"{self.seed}:{'' if doc_id is None else doc_id}"
        return tuple(np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], ">u4").tolist())


def arrange(text: bytes, doc_id: int | None, rates: Rates) -> tuple[int, str, int | None, int | None, PieceTable]:
    """``(n, form, prefix_chars, middle_chars, table)`` of one document."""
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    n = len(starts)
    h1, h2, h3, h4 = rates.draws(doc_id)
    if n == 0 or h3 % 100 >= 100 - rates.plain or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, PieceTable.of(text, SENTINELS)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    byte = lambda k: int(starts[k]) if k < n else len(text)
    table = PieceTable.of(text, SENTINELS).cut(byte(first)).cut(byte(second))
    form = "spm" if h4 % 100 < rates.spm else "psm"
    marked = PieceTable(table.buffers, table.pieces + MARKS)
    return n, form, first, second - first, marked.arranged(ORDERS[form])


def restore(output: bytes, form: str) -> PieceTable:
    """The document's descriptors over its written text."""
    table = PieceTable.of(output)
    if form == "plain":
        return table
    at = 0
    for mark in WRITTEN[form]:
        at = output.index(mark, at)
        # The first mark opens the text: nothing is before it to cut off.
        table = (table.cut(at) if at else table).cut(at + len(mark))
        at += len(mark)
    whole = table.restored(ORDERS[form])
    # Descriptors 0 to 2 are prefix, middle and suffix: the document in its own order.
    return PieceTable(whole.buffers, whole.pieces[:3])


def _texts(values: list[bytes]) -> pa.Array:
    """A string column of bytes that are UTF-8 as far as the input was."""
    return pa.array(values, pa.binary()).view(pa.string())


def transformed(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rates: Rates = Rates()) -> DataFrame:
    """Per row: the id, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars``
    (null if plain), ``pieces`` (of the output, in bytes; buffer 0 is the text, buffer 1
    the sentinels), ``output`` and ``output_sha256``.
    """
    if id_column in RESULT:
        raise ValueError(f"rename the id column {id_column}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.list_(pa.struct({"buffer": pa.int32(), "start": pa.int64(), "length": pa.int64()}))
        for batch in batches:
            found = []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                *facts, table = arrange(body, doc_id, rates)
                found.append((*facts, table.pieces, table.content(), table.sha256()))
            n, form, prefix, middle, pieces, output, digest = zip(*found) if found else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array([[dict(zip(("buffer", "start", "length"), p)) for p in ps] for ps in pieces], piece),
                    _texts(list(output)),
                    pa.array(digest, pa.string()),
                ],
                names=[id_column, *RESULT],
            )

    rows = docs.select(
        F.col(id_column).cast("bigint"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    )
    schema = ", ".join(f"`{name}` {kind}" for name, kind in {id_column: "bigint", **RESULT}.items())
    return rows.mapInArrow(cut, schema)


def restored(rows: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """``rows`` with the document's text, rebuilt from ``output`` and ``form`` alone.

    The column ``into`` takes the place of ``output``; the others pass unchanged.
    """
    kept = [c for c in rows.columns if c not in (output, into)]
    schema = rows.select(*kept).schema

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(batch.num_columns - 1).to_pylist()
            forms = batch.column(batch.num_columns - 2).to_pylist()
            texts = [restore(b, f).content() for b, f in zip(bodies, forms)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], _texts(texts)], names=[*schema.names, into]
            )

    return rows.select(
        *kept, F.col(form).alias("_form"), F.col(output).cast("binary").alias("_output")
    ).mapInArrow(rebuild, T.StructType([*schema.fields, T.StructField(into, T.StringType())]))

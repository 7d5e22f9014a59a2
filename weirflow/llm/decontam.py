"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Of each test item's 3-word n-grams that the training data holds at all, the three quarters
in the fewest documents are its seeds (at least eight, or all). Where a training document holds
two seeds of an item (one, of an item of fewer than ten words) at about the same offset from
it, the two are aligned there, by local alignment of words: a match counts 2, a mismatch or
gap -1. An item's score is the alignment's share of a perfect one; at ``THRESHOLD`` or more
the document contains the item, whole, edited or paraphrased in part. Three words are the
longest run that is left if every fourth word is replaced; against the alignment of all
pairs the search misses less than one in ten edited copies (see the tests).

The training data is scanned twice and never shuffled. Test items are sent to the tasks
in blocks of at most about ``BLOCK_CHARS`` characters. If there are more blocks than one,
what each finds is written before the next is read, so what is sent and what the driver
holds is bounded whatever the benchmark's size; further blocks mean further scans. Document
frequencies are counted over all documents.

Words are lower-case runs of letters, digits and underscores. An item with fewer than
``LEAST_WORDS`` words is not judged: it can't be told from chance. Null or empty texts contain
nothing; items with a null text are left out, a null item id is kept; equal items are
reported each. Repeated rows are judged each. Very long texts are scanned whole. Empty
tables give empty results. Other columns are passed on unchanged or not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirflow.llm.words import hash_table, shingles, text_groups
from weirflow.session import materialize

N = 3
THRESHOLD = 0.5
LEAST_SEEDS = 8
RARE_SHARE = 0.75
LEAST_WORDS = 4
BLOCK_CHARS = 4_000_000
MATCH, MISS = 2, 1


@dataclass(frozen=True)
class Hit:
    row: int
    item: int
    score: float
    start: int  # words of the document, end not included
    end: int


def _grams_at(words: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, n: int):
    """``(row, position in row, index in wanted)`` where a text has one of the n-grams
    ``wanted`` (sorted)."""
    none = np.zeros(0, dtype=np.int64)
    if len(words) < n or not len(wanted):
        return none, none, none
    grams = shingles(words, n)
    at = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
    place = np.flatnonzero(wanted[at] == grams)
    row = np.searchsorted(bounds, place, side="right") - 1
    inside = place + n <= bounds[row + 1]
    place, row = place[inside], row[inside]
    return row, place - bounds[row], at[place]


def align(item: np.ndarray, windows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of ``item`` in each window: its score, and where it ends.

    All windows advance together, one word of the item at a time.
    """
    width = max(map(len, windows))
    grid = np.zeros((len(windows), width), dtype=np.uint64)
    real = np.zeros(grid.shape, dtype=bool)
    for i, w in enumerate(windows):
        grid[i, : len(w)] = w
        real[i, : len(w)] = True
    step = np.arange(width, dtype=np.int32) * MISS
    above = np.zeros((len(windows), width + 1), dtype=np.int32)
    best = np.zeros(len(windows), dtype=np.int32)
    end = np.zeros(len(windows), dtype=np.int64)
    every = np.arange(len(windows))
    for word in item:
        now = above[:, :-1] + np.where((grid == word) & real, MATCH, -MISS).astype(np.int32)
        now = np.maximum(np.maximum(now, above[:, 1:] - MISS), 0)
        now = np.maximum.accumulate(now + step, axis=1) - step  # gaps within the window
        top = now.argmax(axis=1)
        better = now[every, top] > best
        best[better], end[better] = now[every, top][better], top[better] + 1
        above[:, 1:] = now
    return best, end


class Seeds:
    """The seeds of a block of items: finds and aligns their occurrences in texts."""

    def __init__(self, items: list[np.ndarray], frequency: dict[int, int], n: int) -> None:
        self.items, self.n = items, n
        found = []
        for i, words in enumerate(items):
            grams = shingles(words, n)
            held = [p for p, gram in enumerate(grams.tolist()) if frequency.get(gram)]
            order = sorted(held, key=lambda p: (frequency[int(grams[p])], p))
            for p in order[: max(LEAST_SEEDS, math.ceil(len(held) * RARE_SHARE))]:
                found.append((int(grams[p]), i, p))
        found.sort()
        self.all = np.array([g for g, _, _ in found], dtype=np.uint64)
        self.grams, self.first = np.unique(self.all, return_index=True)
        self.last = np.append(self.first[1:], len(found))
        self.item = np.array([i for _, i, _ in found], dtype=np.int64)
        self.place = np.array([p for _, _, p in found], dtype=np.int64)
        self.length = np.array([len(w) for w in items], dtype=np.int64)
        self.needed = np.where(self.length - n + 1 < LEAST_SEEDS, 1, 2)

    def hits(self, words: np.ndarray, bounds: np.ndarray, threshold: float) -> list[Hit]:
        row, at, seed = _grams_at(words, bounds, self.grams, self.n)
        if not len(row):
            return []
        repeats = self.last[seed] - self.first[seed]  # a seed may belong to several items
        which = np.repeat(self.first[seed], repeats) + np.arange(repeats.sum()) - np.repeat(
            np.cumsum(repeats) - repeats, repeats
        )
        row, at = np.repeat(row, repeats), np.repeat(at, repeats)
        item, diagonal = self.item[which], at - self.place[which]
        order = np.lexsort((diagonal, row, item))
        row, item, diagonal = row[order], item[order], diagonal[order]
        # Words put in or left out move what follows to another diagonal, by a few.
        apart = self.length[item] // 4 + 2
        new = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > apart[1:]))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(row)) - 1
        enough = ends - starts + 1 >= self.needed[item[starts]]
        starts, ends = starts[enough], ends[enough]
        best: dict[tuple[int, int], Hit] = {}
        for i in np.unique(item[starts]).tolist():
            m = len(self.items[i])
            slack = m // 2 + 2
            own = np.flatnonzero(item[starts] == i)
            for lo in range(0, len(own), 256):
                self._align(i, own[lo : lo + 256], row, diagonal, starts, ends, m, slack, words, bounds, threshold, best)
        return list(best.values())

    def _align(self, i, own, row, diagonal, starts, ends, m, slack, words, bounds, threshold, best) -> None:
        rows = row[starts[own]]
        low = np.maximum(diagonal[starts[own]] - slack, 0)
        high = np.minimum(diagonal[ends[own]] + m + slack, bounds[rows + 1] - bounds[rows])
        windows = [words[bounds[r] + a : bounds[r] + b] for r, a, b in zip(rows, low, high)]
        score, end = align(self.items[i], windows)
        share = score / (MATCH * m)
        good = np.flatnonzero(share >= threshold)
        if not len(good):
            return
        # The same alignment backwards, from its end, gives its start.
        _, back = align(self.items[i][::-1], [windows[g][: end[g]][::-1] for g in good])
        for g, size in zip(good, back):
            key = (int(rows[g]), i)
            if key not in best or best[key].score < share[g]:
                stop = int(low[g] + end[g])
                best[key] = Hit(*key, float(share[g]), stop - int(size), stop)


def _blocks(
    items: DataFrame, block_chars: int
) -> Iterator[tuple[bool, list[tuple[int | None, np.ndarray]]]]:
    """Whether there are several blocks, and the items with their words, block by block."""
    kept = items.select("item_id", "text").where(F.col("text").isNotNull())
    chars = kept.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    for b in range(blocks):
        some = kept.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        if some:
            words, bounds = hash_table().batch([r["text"] for r in some])
            yield blocks > 1, [(r["item_id"], words[x:y]) for r, x, y in zip(some, bounds[:-1], bounds[1:])]


def _frequencies(docs: DataFrame, grams: np.ndarray, n: int) -> dict[int, int]:
    """How many documents contain each n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = hash_table()
        seen = np.zeros(len(grams), dtype=np.int64)
        for _, texts in (g for batch in batches for g in text_groups(batch, 0)):
            words, bounds = table.batch(texts)
            row, _, gram = _grams_at(words, bounds, grams, n)
            pairs = np.unique(row * len(grams) + gram)
            seen += np.bincount(pairs % len(grams), minlength=len(grams))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"gram": found, "n": seen[found]})

    rows = docs.select("text").mapInArrow(count, "gram bigint, n bigint")
    got = rows.groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {int(grams[r["gram"]]): r["n"] for r in got}


def _prepared(
    docs: DataFrame, items: DataFrame, n: int, block_chars: int
) -> Iterator[tuple[bool, list[int | None], Seeds]]:
    """Per block: whether there are several, the items' ids, and their seeds."""
    for more, block in _blocks(items, block_chars):
        block = [(name, words) for name, words in block if len(words) >= max(n, LEAST_WORDS)]
        if not block:
            continue
        grams = np.unique(np.concatenate([shingles(words, n) for _, words in block]))
        frequency = _frequencies(docs, grams, n)
        yield more, [name for name, _ in block], Seeds([words for _, words in block], frequency, n)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    n: int = N,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: each item found in each document."""
    schema = "doc_id bigint, item_id bigint, score double, start_word bigint, end_word bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    for more, names, seeds in _prepared(docs, items, n, block_chars):

        def find(batches: Iterator[pa.RecordBatch], names=names, seeds=seeds) -> Iterator[pa.RecordBatch]:
            table = hash_table()
            for part, texts in (g for batch in batches for g in text_groups(batch, 1)):
                ids = part.column(0).to_pylist()
                hits = seeds.hits(*table.batch(texts), threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[h.row] for h in hits], pa.int64()),
                        pa.array([names[h.item] for h in hits], pa.int64()),
                        pa.array([h.score for h in hits], pa.float64()),
                        pa.array([h.start for h in hits], pa.int64()),
                        pa.array([h.end for h in hits], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "score", "start_word", "end_word"],
                )

        rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(find, schema)
        found = found.union(materialize(rows, "contaminated") if more else rows)
    return found


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    n: int = N,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    clean = docs
    at = docs.columns.index("text")
    for more, _, seeds in _prepared(docs, items, n, block_chars):

        def keep(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            table = hash_table()
            for part, texts in (g for batch in batches for g in text_groups(batch, at)):
                good = np.ones(len(texts), dtype=bool)
                good[[h.row for h in seeds.hits(*table.batch(texts), threshold)]] = False
                yield part.filter(pa.array(good))

        clean = clean.mapInArrow(keep, docs.schema)
        clean = materialize(clean, "decontaminated") if more else clean
    return clean

"""Values per white-space word, for a batch of texts at once.

A text is a run of words; what an operator wants of each word (its token ids, a hash of
it, the weight of a feature) depends on the word alone. ``WordTable`` finds a batch's
different words with Arrow, asks for those it does not know yet, and gathers the values
in numpy. Whole texts are read; the table of known words is bounded and only saves work.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Characters of a batch handled at once; one longer text is a batch of its own. A worker
# keeps much of what its largest batch took, and an executor has one for each core.
BATCH_CHARS = 1_000_000
_WORD = re.compile(r"\w+")


class WordTable:
    """``resolve(word)`` gives a word's values as the bytes of a ``dtype`` array.

    ``prepare`` maps the Arrow array of texts before it is split, by default to lower
    case. When the table is full, further words are resolved each time they come; if
    that happens for more than a third of a million words, it starts anew.
    """

    def __init__(
        self,
        resolve: Callable[[str], bytes],
        dtype: str,
        prepare: Callable[[pa.Array], pa.Array] = pc.utf8_lower,
        limit: int = 300_000,
    ) -> None:
        self.resolve, self.dtype, self.prepare, self.limit = resolve, np.dtype(dtype), prepare, limit
        self.known: dict[str, bytes] = {}
        self.asked = self.missed = 0

    def _values(self, words: list[str]) -> list[bytes]:
        parts = list(map(self.known.get, words))
        for at in [i for i, part in enumerate(parts) if part is None]:
            word = words[at]
            parts[at] = value = self.resolve(word)
            self.missed += 1
            if len(self.known) < self.limit and len(word) <= 64:
                self.known[word] = value
        self.asked += len(words)
        if self.asked > 1_000_000:
            if len(self.known) >= self.limit and self.missed > self.asked / 3:
                self.known = {}
            self.asked = self.missed = 0
        return parts

    def batch(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(values, bounds)``: text *i* has ``values[bounds[i]:bounds[i + 1]]``."""
        split = pc.utf8_split_whitespace(self.prepare(pa.array([t or "" for t in texts], pa.large_string())))
        coded = split.flatten().dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        parts = self._values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        counts = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(parts), self.dtype)
        starts = np.cumsum(counts) - counts
        per_word = counts[places]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        gather = np.repeat(starts[places] - ends[:-1], per_word) + np.arange(ends[-1])
        return flat[gather], ends[split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()]


def text_groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cut a record batch so that each part has about ``BATCH_CHARS`` characters."""
    texts = batch.column(column).to_pylist()
    start = chars = 0
    for at, text in enumerate(texts):
        chars += len(text or "")
        if chars >= BATCH_CHARS:
            yield batch.slice(start, at + 1 - start), texts[start : at + 1]
            start, chars = at + 1, 0
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def per_worker(name: str, make: Callable[[], object]) -> object:
    """One object per Python process: a worker keeps it from task to task.

    Functions reach workers as copies, with fresh globals for each task, so what must
    last is kept with the interpreter. The object of another name makes room: stages that
    follow each other in the same workers don't add up.
    """
    kept = sys.__dict__.setdefault("_weirflow_llm", {})
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]


def _word_hashes(word: str) -> bytes:
    return b"".join(xxhash.xxh64_digest(w)[::-1] for w in _WORD.findall(word))


def hash_table() -> WordTable:
    """64-bit hashes of lower-case words (runs of letters, digits and underscores)."""
    return per_worker("word hashes", lambda: WordTable(_word_hashes, "<u8"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words; of all words if there are fewer."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(total)]
    return mix(total)

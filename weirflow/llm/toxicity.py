"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score of its words; the
document's score is their noisy-or, ``1 - prod(1 - p)``: one bad sentence is enough.
Only documents are labelled, so the gradient of the document's loss decides how much
each sentence is to blame. Sentences that score high are then located in the text.

A sentence ends with a word that ends in ``. ! ?`` (further marks may follow) or with a
line. A word is a lower-case run of letters, digits and underscores. A sentence without a
learned word, an empty one included, has probability 0 in learning and scoring: length
alone makes no document toxic.

Words are counted by Spark over all labelled whole texts and screened by their association
with the label, so that of the words that pass about ``FALSE_WORDS`` are there by chance
(Benjamini and Hochberg), however large the vocabulary. Each first gets the weight its
counts give it. The gradient steps use a sample of about ``MAX_ROWS`` labelled documents
that hold such a word (the documented bound, of every number of words), in which rare words
have all their documents and others stand for what was left out; a word none of whose
documents is in it keeps its first weight. Only word and sentence numbers of the sample
reach the driver, never texts. Scoring reads every whole text.

A limit of the method as built: words weigh towards toxic only, and a sentence's bias is
fixed, so no word can excuse another.

Nulls and texts without learned words score 0. Very long texts are scored whole, and a
score at the threshold counts as toxic. Extra columns pass as they are. Rows without label are
not learned from; if a document has several labels the highest counts. Repeated rows are
scored alike. An empty table gives an empty result. If nothing can be learned (no label,
one kind of label only), every score is 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.llm.words import WordTable, text_groups
from weirflow.session import materialize

MAX_ROWS = 30_000
FALSE_WORDS = 0.01
TALLY_WORDS = 200_000
THRESHOLD = 0.3
# Fixed: learned from sentences with learned words only, it would rise until each such word
# counts by itself, the accidental ones too. A word has to earn its weight from here.
BIAS = -9.5

_LINE = "\ue000"  # stands for a line's end among the words
_WORD = re.compile(r"\w+")
_STOP = re.compile(r"[.!?]\W*$")
_TOKEN = re.compile(r"\n|\S+")
_END = -1


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float


NOTHING = ToxicityModel({}, -math.inf)


def _prepare(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.utf8_lower(texts), "\n", f" {_LINE} ")


def _bags(values: np.ndarray, bounds: np.ndarray, end: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks between sentences taken out: ``(values, sentence of each, document of each
    sentence)``. Sentences are numbered through; each document has one more than marks."""
    docs = len(bounds) - 1
    of_doc = np.repeat(np.arange(docs), np.diff(bounds))
    marks = values == end
    sentence = np.cumsum(marks) - marks + of_doc  # a document's last sentence needs no mark
    per_doc = np.bincount(of_doc[marks], minlength=docs) + 1
    return values[~marks], sentence[~marks], np.repeat(np.arange(docs), per_doc)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


class _Tally:
    """In how many documents each word is, and how many of those are toxic."""

    def __init__(self) -> None:
        self.docs = self.toxic = 0
        self._clear()

    def _clear(self) -> None:
        self.names: dict[str, int] = {}
        self.seen, self.hits = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.table = WordTable(self._word, "<i4", limit=50_000)

    def _word(self, token: str) -> bytes:
        return np.array([self.names.setdefault(w, len(self.names)) for w in _WORD.findall(token)], "<i4").tobytes()

    def add(self, texts: list[str | None], labels: np.ndarray) -> None:
        values, bounds = self.table.batch(texts)
        words = max(len(self.names), 1)
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        pairs = np.unique(doc * words + values)  # each word once a document
        for name, found in (("seen", pairs), ("hits", pairs[labels[pairs // words] > 0])):
            total = np.bincount(found % words, minlength=words)
            old = getattr(self, name)
            total[: len(old)] += old
            setattr(self, name, total)
        self.docs += len(texts)
        self.toxic += int((labels > 0).sum())

    def taken(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``(words, seen, hits)``; the words are forgotten."""
        n = len(self.names)
        out = list(self.names), self.seen[:n], self.hits[:n]
        self._clear()
        return out


def _offends(seen, hits, docs, toxic):
    """Whether a word goes with toxic documents, by chi-square; for numpy and for columns."""
    off = hits * docs - seen * toxic
    return (seen >= 3) & (off > 0) & (off * off * docs > 27.0 * seen * (docs - seen) * toxic * (docs - toxic))


def _descend(
    cells: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, counts: np.ndarray,
    start: np.ndarray, rounds: int, l2: float,
) -> np.ndarray:
    """A weight per word. ``cells``: sentence of each occurrence, its word, document of each
    sentence. A document stands for ``counts`` like it. Words without a cell keep ``start``."""
    row, feature, owner = cells
    n, words = max(len(labels), 1), len(start)
    held = np.bincount(feature, minlength=words) > 0
    weights, first, second = np.zeros(words), np.zeros(words), np.zeros(words)
    for t in range(1, rounds + 1):  # Adam on the whole sample
        z = BIAS + np.bincount(row, weights=weights[feature], minlength=len(owner))
        total = np.bincount(owner, weights=_softplus(z), minlength=n)
        odds = np.exp(-total) / np.maximum(-np.expm1(-total), 1e-12)
        blame = counts * np.where(labels == 1, -np.minimum(odds, 1e4), 1.0)
        p = 1 / (1 + np.exp(-z))
        step = blame[owner] * p
        gradient = (np.bincount(feature, weights=step[row], minlength=words) + l2 * weights) / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights = weights - 0.15 * first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    return np.where(held, weights, start)


def _first_weights(seen: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """The weight by which a sentence of this word alone is as toxic as its documents are."""
    return np.log((hits + 0.5) / (seen - hits + 0.5)) - BIAS


def surprise(seen: Column, hits: Column, rate: float) -> Column:
    """A bound on minus the log of the chance of so many ``hits`` or more at ``rate`` (Chernoff)."""
    share = hits / seen
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return F.when(share > rate, seen * (share * F.log(share / rate) + rest)).otherwise(0.0)


def _least_surprise(counts: DataFrame, words: int, level: float) -> float:
    """The smallest surprise at which about ``level`` of the words that reach it do by chance.

    A histogram by tenths stands for the order of all words, so a bounded number of rows
    reaches the driver.
    """
    tenths = F.least(F.floor(F.col("surprise") * 10), F.lit(10_000)).alias("tenths")
    rows = counts.where("surprise > 0").groupBy(tenths).agg(F.count("*").alias("n")).collect()
    reached, least = 0, math.inf
    for r in sorted(rows, key=lambda r: -r["tenths"]):
        reached += r["n"]
        if math.exp(-r["tenths"] / 10) * words <= level * reached:
            least = r["tenths"] / 10
    return least


def learn(texts: list[str | None], labels: np.ndarray, rounds: int = 150, l2: float = 0.05) -> ToxicityModel:
    """Fit sentence weights from document labels."""
    labels = np.asarray(labels, dtype=float)
    tally = _Tally()
    tally.add(texts, labels)
    words, seen, hits = tally.taken()
    chosen = [words[i] for i in np.flatnonzero(_offends(seen * 1.0, hits * 1.0, tally.docs, tally.toxic))]
    if not chosen:
        return NOTHING
    cells = Scorer(ToxicityModel(dict.fromkeys(chosen, 0.0), BIAS)).cells(texts)
    start = np.zeros(len(chosen))
    weights = _descend(cells, labels, np.ones(len(labels)), start, rounds, l2)
    return ToxicityModel(dict(zip(chosen, weights.tolist())), BIAS)


def document_labels(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, seen, hits`` of all ``rows(text, toxic)``; the null word is every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()

        def counted(words: list, seen: np.ndarray, hits: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(seen, pa.int64()), pa.array(hits, pa.int64())],
                names=["word", "seen", "hits"],
            )

        for part, texts in (g for batch in batches for g in text_groups(batch, 0)):
            tally.add(texts, part.column(1).to_numpy(zero_copy_only=False))
            if len(tally.names) > TALLY_WORDS:
                yield counted(*tally.taken())
        yield counted(*tally.taken())
        yield counted([None], np.array([tally.docs]), np.array([tally.toxic]))

    return (
        rows.where(F.col("text").isNotNull()).select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(count, "word string, seen bigint, hits bigint")
        .groupBy("word").agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits"))
    )


def learning_rows(docs: DataFrame, words: list[str], seen: np.ndarray, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, share, sentences, words``: the documents that hold some of ``words``, as the
    numbers of those words and of the sentences they are in.

    A sample by a hash of the id, which takes a document with probability ``share``: about
    ``max_rows / len(words)`` labelled documents of each word, or all it has, so about
    ``max_rows`` at most, of any number of words.
    """
    odds = np.minimum(1.0, max_rows / len(words) / np.maximum(seen, 1))
    known = ToxicityModel(dict.fromkeys(words, 0.0), BIAS)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known)
        for part, texts in (g for batch in batches for g in text_groups(batch, 2)):
            row, feature, owner = scorer.cells(texts)
            share = np.zeros(len(texts))
            np.maximum.at(share, owner[row], odds[feature])
            taken = part.column(1).to_numpy() < share * (1 << 20)
            cells = taken[owner[row]]
            bounds = pa.array(np.append(0, np.cumsum(np.bincount(owner[row], minlength=len(texts))[taken])), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).filter(pa.array(taken)),
                    pa.array(share[taken]),
                    pa.ListArray.from_arrays(bounds, pa.array(row[cells], pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(feature[cells], pa.int32())),
                ],
                names=["doc_id", "share", "sentences", "words"],
            )

    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).cast("double")
    return (
        docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select(F.col("doc_id").cast("bigint"), chance, "text")
        .mapInArrow(take, "doc_id bigint, share double, sentences array<int>, words array<int>")
    )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, rounds: int = 150, l2: float = 0.05) -> ToxicityModel:
    """Learn from the labelled documents; ``labels`` holds only rows to learn from."""
    one = document_labels(labels)
    # Labels grow with the corpus, so this is a shuffle join at every size.
    labelled = docs.select("doc_id", "text").join(one.hint("merge"), "doc_id")
    counts = materialize(word_counts(labelled), "word-counts")
    every = counts.where(F.col("word").isNull()).first()
    if every is None or not 0 < every.hits < every.seen:
        return NOTHING
    seen, hits = F.col("seen").cast("double"), F.col("hits").cast("double")
    judged = counts.where(F.col("word").isNotNull()).withColumn(
        "surprise", surprise(seen, hits, every.hits / every.seen)
    )
    least = _least_surprise(judged, judged.count(), FALSE_WORDS)
    offends = _offends(seen, hits, float(every.seen), float(every.hits))
    chosen = (
        judged.where(offends & (F.col("surprise") >= least)).select("word", "seen", "hits").orderBy("word").toArrow()
    )
    words = chosen.column("word").to_pylist()
    if not words:
        return NOTHING
    start = _first_weights(chosen.column("seen").to_numpy(), chosen.column("hits").to_numpy())
    rows = learning_rows(docs, words, chosen.column("seen").to_numpy(), max_rows).join(one, "doc_id").toArrow()
    sizes = rows.column("words").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    sentence = rows.column("sentences").combine_chunks().flatten().to_numpy()
    feature = rows.column("words").combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.append(True, (np.diff(doc) != 0) | (np.diff(sentence) != 0))[: len(doc)]
    cells = np.cumsum(starts) - 1, feature, doc[starts]
    likes = 1 / rows.column("share").to_numpy()
    weights = _descend(cells, rows.column("toxic").to_numpy(), likes, start, rounds, l2)
    return ToxicityModel(dict(zip(words, weights.tolist())), BIAS)


def offending(model: ToxicityModel, text: str, threshold: float) -> list[dict]:
    """Sentences of ``text`` that score at least ``threshold``: start, length, score."""
    found, start, end, z = [], None, 0, model.bias
    seen: set[str] = set()

    def close() -> None:
        if seen and (p := 1 / (1 + math.exp(-z))) >= threshold:
            found.append({"start": start, "length": end - start, "score": p})

    for token in _TOKEN.finditer(text):
        if token[0] != "\n":
            start, end = token.start() if start is None else start, token.end()
        stop = token[0] == "\n" or bool(_STOP.search(token[0]))
        for w in _WORD.findall(token[0].lower()):
            if w in model.weights and w not in seen:
                seen.add(w)
                z += model.weights[w]
        if stop:
            close()
            start, z, seen = None, model.bias, set()
    close()
    return found


class Scorer:
    """Scores texts in batches; made once per task from a model."""

    def __init__(self, model: ToxicityModel) -> None:
        self.bias = model.bias
        self.places = {w: i for i, w in enumerate(model.weights)}
        self.weights = np.array(list(model.weights.values()))
        self.table = WordTable(self._word, "<i4", _prepare)

    def _word(self, token: str) -> bytes:
        if token == _LINE:
            return np.array([_END], "<i4").tobytes()
        found = [self.places[w] for w in _WORD.findall(token) if w in self.places]
        return np.array(found + [_END] * bool(_STOP.search(token)), "<i4").tobytes()

    def cells(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(sentence of each known word, the word, text of each sentence)``: each word once a
        sentence, and sentences without a known word are none."""
        words = max(len(self.weights), 1)
        values, sentence, doc_of = _bags(*self.table.batch(texts), _END)
        found = np.unique(sentence.astype(np.int64) * words + values)
        active, row = np.unique(found // words, return_inverse=True)
        return row, found % words, doc_of[active]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The noisy-or of each text's sentences; 0 for a text without learned words."""
        if not len(self.weights):
            return np.zeros(len(texts))
        row, feature, owner = self.cells(texts)
        z = self.bias + np.bincount(row, weights=self.weights[feature], minlength=len(owner))
        return -np.expm1(-np.bincount(owner, weights=_softplus(z), minlength=len(texts)))


def scored(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, offending`` for each row of ``docs``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part, texts in (g for batch in batches for g in text_groups(batch, 1)):
            scores = scorer.scores(texts)
            bad = scores >= threshold
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(bad.astype(np.int32)),
                    pa.array(
                        [offending(model, t, threshold) if b else [] for t, b in zip(texts, bad)],
                        pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())])),
                    ),
                ],
                names=["doc_id", "score", "predicted", "offending"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        score,
        "doc_id bigint, score double, predicted int, offending array<struct<start: int, length: int, score: double>>",
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part, texts in (g for batch in batches for g in text_groups(batch, at)):
            yield part.filter(pa.array(scorer.scores(texts) < threshold))

    return docs.mapInArrow(keep, docs.schema)

"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, whatever is no letter becomes one space, and runs of one to three
characters are hashed into ``BUCKETS`` features, weighted by ``(1 + log tf) * idf`` and
scaled to unit length. Document frequencies are counted by Spark over *all* documents
learned from; at most ``BUCKETS`` numbers reach the driver. Weights are learned by
follow-the-regularised-leader with an elastic net on a sample of about ``MAX_ROWS``
documents (the documented bound), whatever their length. Languages too rare for it have
about ``LEAST`` documents in it, or all they have. A temperature is then fitted on a part of
the sample kept out of learning. Texts never reach the driver: the tasks count the n-grams
of sampled texts, at most ``BUCKETS`` of them each, and send those counts.

A text that is null or has no letter is ``und`` with score 0; so is every text if there
is nothing to learn from. Repeated rows are predicted alike. Of languages of equal probability the
first in the alphabet is predicted. Very long texts are read
whole. Empty tables give empty results. Only ``doc_id``, ``text`` and, for learning,
``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirflow.llm.words import per_worker

BUCKETS = 1 << 15
MAX_ROWS = 6_000
LEAST = 30
UNKNOWN = "und"


def _letters() -> np.ndarray:
    return per_worker("letters", lambda: np.array([chr(c).isalpha() for c in range(0x110000)]))


def characters(text: str | None) -> np.ndarray:
    """Code points of the lower-case text, each run of non-letters one space; empty if
    there is no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    kept = letter | np.append(True, letter[:-1])
    points = np.where(letter, points, 32)[kept].astype(np.uint64)
    space = np.array([32], dtype=np.uint64)
    return np.concatenate([space[int(points[0] == 32) :], points, space[int(points[-1] == 32) :]])


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``(feature, how often)`` of the text's n-grams of 1, 2 and 3 characters."""
    points = characters(text)
    total = np.zeros(BUCKETS, dtype=np.int64)
    for n in (1, 2, 3):
        if len(points) < n:
            break
        code = np.full(len(points) - n + 1, n, dtype=np.uint64)
        for j in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + points[j : j + len(code)]
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        total += np.bincount((code >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many of ``docs(text)`` contain each feature, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[counts(text)[0]] += 1
                n += 1
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict(
            {"feature": np.append(found, -1), "n": np.append(seen[found], n)}
        )

    rows = docs.select("text").mapInArrow(count, "feature bigint, n bigint")
    got = rows.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(BUCKETS + 1, dtype=np.int64)
    frequency[got["feature"].to_numpy(dtype=np.int64)] = got["n"]  # -1 is the last place
    return frequency[:-1], int(frequency[-1])


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    temperature: float = 1.0

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.weighted(*counts(text))

    def weighted(self, found: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (1 + np.log(n)) * self.idf[found]
        norm = np.sqrt((x * x).sum())
        return found, x / norm if norm else x

    def probabilities(self, found: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights[found] / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def predict(self, text: str | None) -> tuple[str, float]:
        found, x = self.features(text)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        p = self.probabilities(found, x)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, languages: int,
    epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01,
) -> np.ndarray:
    """Weights by FTRL-proximal, one example at a time; l1 keeps unhelpful weights at 0."""
    z, n = np.zeros((BUCKETS, languages)), np.zeros((BUCKETS, languages))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    order = np.random.default_rng(10)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            found, x = rows[i]
            zf, nf = z[found], n[found]
            w = weights(zf, nf)
            score = x @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[classes[i]] -= 1
            g = x[:, None] * p[None, :]
            squares = nf + g * g
            z[found] = zf + g - (np.sqrt(squares) - np.sqrt(nf)) / alpha * w
            n[found] = squares
    return weights(z, n)


def _temperature(scores: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least log loss, searched on a log scale."""
    if not len(scores):
        return 1.0

    def loss(t: float) -> float:
        s = scores / t
        top = s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s - top).sum(axis=1)) + top[:, 0] - s[np.arange(len(s)), classes]).mean())

    grid = np.exp(np.linspace(np.log(0.02), np.log(10), 120))
    return float(min(grid, key=loss))


def shares(sizes: dict[str, int], max_rows: int) -> tuple[float, dict[str, float]]:
    """The share of documents to learn from, and that of the languages too rare for it."""
    n = max(sum(sizes.values()), 1)
    least = max(1, min(LEAST, max_rows // (2 * max(len(sizes), 1))))
    rare = [name for name, size in sizes.items() if size * max_rows < least * n and max_rows < n]
    return (
        min(1.0, max(0, max_rows - least * len(rare)) / n),
        {name: min(1.0, least / sizes[name]) for name in rare},
    )


def sampled_counts(sample: DataFrame) -> DataFrame:
    """``lang, late, features, counts`` of ``sample(lang, late, text)``: four bytes a feature.

    A count beyond 65,535 is sent as that; its logarithm is what is learned from.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f.astype("<u2").tobytes() for f, _ in found], pa.binary()),
                    pa.array([np.minimum(n, 65_535).astype("<u2").tobytes() for _, n in found], pa.binary()),
                ],
                names=["lang", "late", "features", "counts"],
            )

    return sample.mapInArrow(count, "lang string, late boolean, features binary, counts binary")


def fit(docs: DataFrame, max_rows: int = MAX_ROWS) -> LanguageModel:
    """Learn from ``docs(doc_id, text, lang)``; the caller has left out what must be held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequency, n = document_frequencies(known)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    common, rare = shares(sizes, max_rows)
    share = F.lit(int(common * (1 << 20)))
    if rare:
        own = F.create_map(*[F.lit(x) for name, s in rare.items() for x in (name, int(s * (1 << 20)))])
        share = F.coalesce(F.element_at(own, F.col("lang")), share)
    few = [name for name, size in sizes.items() if size < LEAST]  # all of them are learned from
    pick = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("learn")), F.lit(1 << 20))
    late = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(5)) == 0, F.lit(False))
    chosen = known.where(pick < share).select("lang", (late & ~F.col("lang").isin(few)).alias("late"), "text")
    sample = sampled_counts(chosen).toPandas()
    languages = tuple(sorted(sample["lang"].unique()))
    model = LanguageModel(languages, idf, np.zeros((BUCKETS, len(languages))))
    if not languages:
        return model
    rows = [
        model.weighted(np.frombuffer(f, "<u2").astype(np.int64), np.frombuffer(n, "<u2"))
        for f, n in zip(sample["features"], sample["counts"])
    ]
    classes = sample["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    full = np.array([len(found) > 0 for found, _ in rows])
    late = sample["late"].to_numpy(dtype=bool)
    early = np.flatnonzero(full & ~late)
    weights = follow_the_leader([rows[i] for i in early], classes[early], len(languages))
    later = np.flatnonzero(full & late)
    scores = np.array([rows[i][1] @ weights[rows[i][0]] for i in later]).reshape(len(later), len(languages))
    return LanguageModel(languages, idf, weights, _temperature(scores, classes[later]))


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        predict, "doc_id bigint, lang_pred string, score double"
    )

"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet below the folder all executors share and reads it again as the next one's input.
All stages but the last return the columns of ``documents``.

For every stage: a null text has nothing to judge and stays as it is (the last packs it as
empty); a null id is a value like any other; very long texts are read whole; an empty table
gives an empty result; further columns pass unchanged, whatever their names. Repeated rows
are judged alike, and the near-duplicate stage keeps one of them; of documents of one group
it keeps the smallest id, a null id first, and of equal ids the smaller hash of the text.
Scores at a threshold count as above it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.llm import decontam, lines, neardup, packing, toxicity
from weirflow.llm.queries import read
from weirflow.llm.tokens import default_vocabulary
from weirflow.session import materialize, prepare_session

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from all labelled documents that are here; documents predicted toxic go."""
    prepare_session(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; every document stays."""
    prepare_session(spark)
    clean = lines.drop_boilerplate(docs, counts=False)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare_session(spark)
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, cut and packed into sequences of 2048 tokens."""
    prepare_session(spark)
    return packing.pack_documents(docs, default_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Learned scores, n-gram sets and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

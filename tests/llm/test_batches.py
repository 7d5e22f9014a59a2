"""What a Python worker holds at once is bounded, however many or long the rows are."""

import tracemalloc

import pyarrow as pa

from weirflow.llm.words import hash_table, text_groups
from weirflow.session import prepare_session

WORDS = [f"word{i * 7919 % 5_000}" for i in range(5_000)]


def test_hashing_texts_takes_bounded_memory():
    text = " ".join(WORDS)
    batch = pa.record_batch({"text": [text] * 250})  # 11 million characters
    hash_table().batch([text])
    parts, most = [], 0
    tracemalloc.start()
    for part, texts in text_groups(batch, 0):
        parts.append(part)
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        hash_table().batch(texts)
        most = max(most, tracemalloc.get_traced_memory()[1] - before)
    tracemalloc.stop()
    assert most < 10e6
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_rows_reach_python_in_batches_of_four_megabytes(spark):
    rows = prepare_session(spark).range(0, 1_500, 1, 1).selectExpr("id", "repeat(string(id % 10), 10000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    got = rows.mapInArrow(sizes, "n bigint, bytes bigint").collect()
    assert sum(r["n"] for r in got) == 1_500
    assert max(r["bytes"] for r in got) < 5e6

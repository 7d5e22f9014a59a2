import random
import uuid

import pytest
from pyspark.sql import functions as F

from weirflow.sinks import upserted
from weirflow.sinks.upserted import UpsertTable

SCHEMA = "k string, at bigint, v bigint, gone boolean"


@pytest.fixture
def table(spark):
    made = UpsertTable(f"up_{uuid.uuid4().hex}", ["k"], ["at"], buckets=4, deleted="gone")
    yield made
    upserted.drop(spark, made)


def rows(spark, table):
    return {r.k: (r["at"], r.v) for r in spark.sql(f"SELECT * FROM {table.name}").collect()}


def test_equals_a_dictionary_over_many_batches(spark, table):
    draw, want = random.Random(1), {}
    for number in range(8):
        batch = [(draw.choice([f"k{i}" for i in range(12)] + [None]), draw.randrange(60), draw.randrange(99), draw.random() < 0.3) for _ in range(10)]
        batch = list({(k, at): (k, at, v, gone) for k, at, v, gone in batch if (want.get(k, (-1,))[0] != at)}.values())
        upserted.upsert(spark.createDataFrame(batch, SCHEMA).repartition(2), table)
        if number == 4:  # run again
            upserted.upsert(spark.createDataFrame(batch, SCHEMA), table)
        for k, at, v, gone in batch:
            if at > want.get(k, (-1,))[0]:
                want[k] = (at, v, gone)
        assert rows(spark, table) == {k: (at, v) for k, (at, v, gone) in want.items() if not gone}
    kept = spark.sql(f"SHOW PARTITIONS {table.files}").count()
    assert kept <= 4 * (table.keep_versions + 1)  # not one per batch


def test_only_touched_buckets_are_rewritten(spark, table):
    upserted.upsert(spark.createDataFrame([(f"k{i}", 1, i, False) for i in range(40)], SCHEMA), table)
    before = upserted.versions(spark, table)["of"]
    touched = upserted.upsert(spark.createDataFrame([("k3", 2, 99, False)], SCHEMA), table)
    after = upserted.versions(spark, table)["of"]
    assert len(touched) == 1 and sum(a != b for a, b in zip(before, after)) == 1
    assert rows(spark, table)["k3"] == (2, 99) and len(rows(spark, table)) == 40


def test_a_run_that_fails_before_the_switch_changes_nothing(spark, table, monkeypatch):
    upserted.upsert(spark.createDataFrame([("a", 1, 1, False)], SCHEMA), table)
    switch = upserted._switch

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(upserted, "_switch", fails)
    with pytest.raises(RuntimeError):
        upserted.upsert(spark.createDataFrame([("a", 2, 2, False), ("b", 1, 1, False)], SCHEMA), table)
    assert rows(spark, table) == {"a": (1, 1)}
    monkeypatch.setattr(upserted, "_switch", switch)
    upserted.upsert(spark.createDataFrame([("a", 2, 3, False)], SCHEMA), table)
    assert rows(spark, table) == {"a": (2, 3)}


def test_tombstones_hold_back_older_changes_until_purged(spark, table):
    upserted.upsert(spark.createDataFrame([("a", 5, 1, True), ("b", 1, 1, False)], SCHEMA), table)
    upserted.upsert(spark.createDataFrame([("a", 4, 2, False)], SCHEMA), table)
    assert rows(spark, table) == {"b": (1, 1)}
    upserted.upsert(spark.createDataFrame([("a", 3, 2, False)], SCHEMA), table, purge=F.col("at") <= 5)
    upserted.upsert(spark.createDataFrame([("a", 2, 7, False)], SCHEMA), table)
    assert rows(spark, table) == {"b": (1, 1), "a": (2, 7)}


def test_empty_batches_and_missing_columns(spark, table):
    upserted.upsert(spark.createDataFrame([], SCHEMA), table)
    assert rows(spark, table) == {}
    upserted.upsert(spark.createDataFrame([("a", 1)], "k string, at bigint"), table)
    assert rows(spark, table) == {"a": (1, None)}
    assert spark.sql(f"SELECT * FROM {table.name}").columns == ["k", "at", "v"]

import uuid

import pytest
from pyspark.sql import functions as F

from weirflow.sinks import tables
from weirflow.streaming import bodies, retry


@pytest.fixture
def table(spark):
    name = f"retry_{uuid.uuid4().hex}"
    yield name
    for suffix in ("", "_poison"):
        tables.drop_table(spark, name + suffix)


def counting(table, runs, fail=None):
    def body(batch, batch_id):
        runs.append(batch_id)
        if fail:
            fail()
        typed = batch.select("id", F.col("text").cast("bigint").alias("n"))
        tables.append_batch(typed, table, batch_id, create=True)

    return body


@pytest.mark.parametrize("bad", [[5000], [1, 7777], []])
def test_poison_is_found_by_halving(spark, table, bad):
    rows = spark.range(10_000).select("id", F.when(F.col("id").isin(bad), "x").otherwise(F.col("id").cast("string")).alias("text"))
    runs = []
    body = retry.isolating(counting(table, runs), table + "_poison")
    for _ in range(2):  # a micro-batch that runs again lands once
        body(rows.repartition(3), 0)
    assert spark.table(table).count() == 10_000 - len(bad)
    assert len(runs) <= 2 * (2 + 40 * len(bad))
    if bad:
        letters = spark.table(table + "_poison").collect()
        assert {r.reason for r in letters} == {"CAST_INVALID_INPUT"}
        assert sorted(r.value for r in letters) == sorted('{"id":%d,"text":"x"}' % b for b in bad)


def test_many_bad_rows_end(spark, table):
    rows = spark.range(300).select("id", F.lit("x").alias("text"))
    runs = []
    retry.isolating(counting(table, runs), table + "_poison", max_runs=12)(rows, 0)
    assert len(runs) < 40 and spark.table(table + "_poison").count() == 300
    assert spark.table(table).count() == 0


def test_transient_errors_are_tried_again_and_then_raised(spark, table):
    rows = spark.range(3).select("id", F.lit("1").alias("text"))
    left = [2]

    def shaky():
        if left[0]:
            left[0] -= 1
            raise ConnectionError("lost")

    runs = []
    retry.isolating(counting(table, runs, shaky), table + "_poison", pause=0)(rows, 0)
    assert len(runs) == 3 and spark.table(table).count() == 3
    left[0] = 99
    with pytest.raises(ConnectionError):
        retry.isolating(counting(table, runs, shaky), table + "_poison", pause=0)(rows, 1)


def test_errors_of_a_body_written_in_python(spark, table):
    def body(batch, batch_id):
        def check(batches):
            for b in batches:
                if 7 in b.column(0).to_pylist():
                    raise ValueError("seven")
                yield b

        tables.append_batch(batch.mapInArrow(check, batch.schema), table, batch_id, create=True)

    retry.isolating(body, table + "_poison")(spark.range(40), 0)
    assert {r.id for r in spark.table(table).collect()} == set(range(40)) - {7}


def test_empty_batch(spark, table):
    body = retry.isolating(bodies.append_body(table), table + "_poison")
    body(spark.createDataFrame([], "id long, text string"), 0)
    assert spark.table(table).count() == 0


def test_many_bad_rows_are_found_by_trials_side_by_side(spark, table):
    bad = list(range(5, 40_000, 3_001))
    rows = spark.range(40_000).select("id", F.when(F.col("id").isin(bad), "x").otherwise(F.col("id").cast("string")).alias("text"))
    runs, tried = [], []

    def trial(batch, batch_id):
        tried.append(batch_id)
        batch.select(F.col("text").cast("bigint")).write.format("noop").mode("overwrite").save()

    retry.isolating(counting(table, runs), table + "_poison", trial=trial)(rows.repartition(3), 0)
    assert len(runs) == 2  # whole, and without the bad rows
    assert len(tried) <= 1 + 2 * 17 * len(bad)
    assert spark.table(table).count() == 40_000 - len(bad)
    letters = spark.table(table + "_poison").collect()
    assert sorted(r.value for r in letters) == sorted('{"id":%d,"text":"x"}' % b for b in bad)
    assert {r.reason for r in letters} == {"CAST_INVALID_INPUT"}


def test_what_trials_do_not_see_is_searched_with_the_body(spark, table):
    rows = spark.createDataFrame([(i, {3: "x", 5: "99"}.get(i, str(i))) for i in range(12)], "id long, text string")

    def body(batch, batch_id):
        def check(batches):
            for b in batches:
                if 99 in b.column(1).to_pylist():
                    raise ValueError("ninety-nine")
                yield b

        typed = batch.select("id", F.col("text").cast("bigint").alias("n"))
        tables.append_batch(typed.mapInArrow(check, typed.schema), table, batch_id, create=True)

    def trial(batch, batch_id):
        batch.select(F.col("text").cast("bigint")).write.format("noop").mode("overwrite").save()

    retry.isolating(body, table + "_poison", trial=trial)(rows, 0)
    assert {r.id for r in spark.table(table).collect()} == set(range(12)) - {3, 5}
    assert sorted(r.value for r in spark.table(table + "_poison").collect()) == ['{"id":3,"text":"x"}', '{"id":5,"text":"99"}']

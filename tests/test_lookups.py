"""Lookup joins with hot and null keys, and lookups that are read again by the clock."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weirflow.operators.lookups import hot_hashes, hot_rows, with_hot_lookup, with_timed_lookup


def skewed(spark, n=20_000):
    """60 % of the rows have key 0, 10 % none, the others keys of their own."""
    key = F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 10 == 6, None).otherwise(F.col("id"))
    return spark.range(0, n, 1, 4).select("id", key.cast("string").alias("k"))


def wide_lookup(spark, n=20_000):
    return spark.range(0, n, 2, 4).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("v"), "id").alias("v"))


def test_hot_keys_are_found(spark):
    hot = skewed(spark).select(F.xxhash64(F.lit("0"))).first()[0]
    found = hot_hashes(skewed(spark), "k")
    assert hot in found and len(found) <= 100


def test_hot_and_null_keys_are_not_shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the lookup is too large
    try:
        joined = with_hot_lookup(skewed(spark), wide_lookup(spark), "k", "v")
        rows = {r["id"]: r["v"] for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
    assert len(rows) == 20_000
    for i, v in rows.items():
        k = 0 if i % 10 < 6 else None if i % 10 == 6 else i
        assert v == (f"v{k}" if k is not None and k % 2 == 0 else "Not Found")
    # What reaches the shuffle are the 30 % of other keys.
    shuffled = skewed(spark).filter(~hot_rows("k", hot_hashes(skewed(spark), "k")))
    assert shuffled.filter("k = '0' OR k IS NULL").count() == 0


def test_large_hot_values_are_not_copied(spark):
    joined = with_hot_lookup(skewed(spark, 100), wide_lookup(spark, 100), "k", "v", hot_bytes=1)
    assert joined.filter("v = 'v0'").count() == 60 and joined.count() == 100


KEYS = st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, st.dictionaries(st.integers(0, 5), st.one_of(st.none(), st.text("ab", max_size=2))))
def test_equals_a_dictionary(spark, keys, values):
    df = spark.createDataFrame(list(enumerate(keys)), "n int, k int")
    lookup = spark.createDataFrame([*values.items(), (None, "x")], "k long, v string")
    got = sorted(tuple(r) for r in with_hot_lookup(df, lookup, "k", "v", share=0.3).collect())
    absent = [values.get(k) if k is not None else None for k in keys]
    want = [(n, k, "Not Found" if v is None else v) for n, (k, v) in enumerate(zip(keys, absent))]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_repeated_key_fails(spark):
    lookup = spark.createDataFrame([("0", "a"), ("0", "b")], "k string, v string")
    with pytest.raises(PySparkException, match="not unique"):
        with_hot_lookup(skewed(spark, 10), lookup, "k", "v").collect()


def test_a_lookup_is_read_again_by_the_clock(spark):
    loads, seen, now = [], [], [0.0]

    def load():
        loads.append(now[0])
        return spark.createDataFrame([(len(loads),)], "n int")

    def apply(batch, lookup, batch_id):
        seen.append(lookup.first()[0])

    body = with_timed_lookup(load, apply, 10, lambda: now[0])
    for at in (0.0, 5.0, 9.9, 10.0, 15.0, 25.0):
        now[0] = at
        body(None, 0)
    assert loads == [0.0, 10.0, 25.0] and seen == [1, 1, 1, 2, 2, 3]

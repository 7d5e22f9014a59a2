import random

from pyspark.sql import functions as F

from weirflow.operators import rows
from weirflow.session import materialize


def test_numbering_equals_brute_force(spark):
    rng = random.Random(3)
    # One key holds most rows, one key is null.
    keys = [rng.choice(["hot"] * 6 + ["a", "b", None]) for _ in range(500)]
    order = rng.sample(range(-200, 5000), 500)
    df = spark.createDataFrame(list(zip(keys, order)), "k string, o bigint").repartition(5)
    found = {(r["k"], r["o"]): r["row_num"] for r in rows.numbered(df, ["k"], "o", 50).collect()}
    expected = {}
    for key in set(keys):
        own = sorted(o for k, o in zip(keys, order) if k == key)
        expected.update({(key, o): i + 1 for i, o in enumerate(own)})
    assert found == expected


def test_batches_are_full_but_the_last(spark):
    df = spark.range(1050).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    sizes = rows.batches_of(df, ["k"], "o", 100, 64).groupBy("k", "batch_id").count().collect()
    by_key = {}
    for r in sizes:
        by_key.setdefault(r["k"], {})[r["batch_id"]] = r["count"]
    assert by_key == {k: {**{i: 100 for i in range(5)}, 5: 25} for k in (0, 1)}


def test_latest_view(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, ts int, v string")
    rows.latest_view(df, "latest_rows", ["k"], ["ts"])
    found = spark.sql("SELECT v FROM latest_rows ORDER BY k").collect()
    assert [r["v"] for r in found] == ["b", "c"]


def test_numbering_shuffles_the_rows_once(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "repeat('x', 50) AS payload")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = rows.numbered(df, ["k"], "o", 50)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    with_rows = plan.count("payload") and [line for line in moved if "_g" in line]
    assert len(moved) == 4 and len(with_rows) <= 3  # rows once; counts thrice


def test_small_lookup_of_known_size_is_broadcast(spark):
    lookup = spark.createDataFrame([("a", "one"), ("b", "two")], "dim string, v string")
    events = spark.range(100).selectExpr("id", "if(id % 2 = 0, 'a', 'b') AS dim").repartition(4)
    joined = rows.with_lookup(events, materialize(lookup, "lookup"), "dim", "v")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

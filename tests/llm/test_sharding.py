from pyspark.sql import functions as F

from weirflow.llm import shards


def test_permutation_and_its_inverse(spark):
    for n in (1, 2, 3, 7, 64, 65, 1000):
        got = (
            spark.range(n).withColumn("n", F.lit(n).cast("long"))
            .withColumn("place", shards.permuted(F.col("id"), F.col("n"), 3))
            .withColumn("back", shards.row_number_at(F.col("place") % 4, F.floor(F.col("place") / 4), 4, F.col("n"), 3))
            .collect()
        )
        assert sorted(r.place for r in got) == list(range(n))
        assert all(r.back == r.id for r in got)
    assert [r.place for r in got] != sorted(r.place for r in got)


def test_shards_are_even_and_do_not_depend_on_partitions(spark):
    rows = [(i, f"t{i}") for i in range(101)] + [(None, None)] * 3 + [(5, "same")] * 40
    frame = spark.createDataFrame(rows, "k bigint, v string")
    one = sorted(map(str, shards.shard_rows(frame.repartition(7), ["k", "v"], 5).collect()))
    two = shards.shard_rows(frame.coalesce(1).withColumn("bucket", F.lit(1)), ["k", "v"], 5).collect()
    assert one == sorted(map(str, two)) and len(two) == len(rows)
    for s in range(5):
        slots = sorted(r.slot for r in two if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (28, 29)


def test_other_seed_other_order(spark):
    frame = spark.range(50)
    a = shards.shard_rows(frame, ["id"], 4, seed=1).collect()
    b = shards.shard_rows(frame, ["id"], 4, seed=2).collect()
    assert {(r.id, r.shard, r.slot) for r in a} != {(r.id, r.shard, r.slot) for r in b}


def test_numbers_within_groups(spark):
    rows = [(g, i) for g in (None, 1, 2) for i in range(20)] + [(1, 3)] * 5
    got = shards.numbered(spark.createDataFrame(rows, "g bigint, i bigint"), ["g"], ["i"], buckets=4).collect()
    for g, n in ((None, 20), (1, 25), (2, 20)):
        assert sorted(r.row_number for r in got if r.g == g) == list(range(n))
        assert {r.n for r in got if r.g == g} == {n}


def test_empty_table(spark):
    assert shards.shard_rows(spark.range(0), ["id"], 16).count() == 0

"""One write for all destinations of a shape: rows, reruns, dead letters, number of jobs."""

import uuid

from pyspark.sql import functions as F, types as T

from weirflow.sinks import tables
from weirflow.sinks.compact import compact
from weirflow.sinks.routed import route_once


def made(spark, tmp_path, names, ddl="v string", partitions=()):
    label = f"r{uuid.uuid4().hex[:8]}"
    for name in names:
        schema = T.StructType.fromDDL(ddl)
        tables.create_table(spark, f"{label}_{name}", schema, f"{tmp_path}/{label}/{name}", partitions=partitions)
    return label


def values(spark, table):
    return sorted(r["v"] for r in spark.table(table).collect())


def test_routes_reruns_and_dead_letters(spark, tmp_path):
    label = made(spark, tmp_path, ["a", "b", "c"])
    dead = f"{label}_dead"
    rows = spark.createDataFrame(
        [(f"{label}_a", "1", 0), (f"{label}_A".upper(), "2", 0), (f"{label}_b", "3", 0), (None, "4", 0), ("x.no-such", "5", 0)],
        "destination string, v string, extra int",
    )
    for _ in range(2):
        assert route_once(rows, 0, f"{tmp_path}/routed", dead_table=dead) == [f"{label}_a", f"{label}_b"]
    assert values(spark, f"{label}_a") == ["1", "2"] and values(spark, f"{label}_b") == ["3"]
    assert spark.table(f"{label}_c").count() == 0
    letters = spark.table(dead).collect()
    assert {r["destination"] for r in letters} == {None, "x.no-such"} and {r["reason"] for r in letters} == {"no table"}
    fewer = rows.filter("v = '2'")
    route_once(fewer, 0, f"{tmp_path}/routed", dead_table=dead)
    assert values(spark, f"{label}_a") == ["2"]
    route_once(rows.limit(0), 1, f"{tmp_path}/routed", dead_table=dead)
    assert values(spark, f"{label}_a") == ["2"]


def test_shapes_types_and_days(spark, tmp_path):
    plain = made(spark, tmp_path, ["a"])
    typed = made(spark, tmp_path, ["a", "b"], "V int, w string")
    days = made(spark, tmp_path, ["a"], "v string, day string", ["day"])
    rows = spark.createDataFrame(
        [(f"{plain}_a", "7", "d1"), (f"{typed}_a", "8", "d1"), (f"{typed}_b", "9", "d2"), (f"{days}_a", "10", "d2")],
        "destination string, v string, day string",
    )
    route_once(rows, 0, f"{tmp_path}/routed", dead_table=f"{plain}_dead")
    assert values(spark, f"{plain}_a") == ["7"]
    assert [(r["V"], r["w"]) for r in spark.table(f"{typed}_b").collect()] == [(9, None)]
    assert [(r["v"], r["day"]) for r in spark.table(f"{days}_a").collect()] == [("10", "d2")]


def test_compaction_takes_routed_batches(spark, tmp_path):
    label = made(spark, tmp_path, ["a"])
    batch = lambda n: spark.createDataFrame([(f"{label}_a", str(n))], "destination string, v string")
    for n in range(5):
        route_once(batch(n), n, f"{tmp_path}/routed", dead_table=f"{label}_dead")
    assert compact(spark, f"{label}_a", fanout=2) > 0
    assert values(spark, f"{label}_a") == list("01234")
    route_once(batch(1), 1, f"{tmp_path}/routed", dead_table=f"{label}_dead")
    assert values(spark, f"{label}_a") == list("01234")


def jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "count")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_tables(spark, tmp_path):
    counts = []
    for n in (2, 60):
        label = made(spark, tmp_path, range(n))
        rows = spark.range(600).select(
            F.concat(F.lit(f"{label}_"), F.col("id") % n).alias("destination"), F.col("id").cast("string").alias("v")
        )
        counts.append(jobs_of(spark, lambda: route_once(rows, 0, f"{tmp_path}/routed", dead_table=f"{label}_dead")))
        assert spark.table(f"{label}_1").count() == 600 // n
    assert 0 < counts[1] <= counts[0] + 2, counts

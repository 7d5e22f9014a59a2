import json

import pytest
from pyspark.sql import functions as F, types as T
from test_streams import Feed

from weirflow.sinks import tables
from weirflow.streaming import jobs

NAMES = ("j_panes", "j_a", "j_b", "j_dead", "j_registry", "j_a_dead", "j_b_dead")


@pytest.fixture
def feed(spark, tmp_path):
    for name in NAMES:
        tables.drop_table(spark, name)
    yield Feed(spark, tmp_path / "feed", "value string, seq bigint")
    for name in NAMES:
        tables.drop_table(spark, name)


def test_pane_job_feeds_both_readings(spark, feed, tmp_path):
    base = 1_704_067_200_000
    line = "%d,1,w,%d,a,%d"
    feed.send([{"value": line % (base, 1, 4), "seq": 1}, {"value": line % (base + 1, 2, 6), "seq": 2}])
    feed.send([{"value": line % (base + 2, 3, 1), "seq": 3}])
    job = jobs.pane_job(feed.stream(), "j_panes", str(tmp_path / "p"), period_seconds=None)
    job.start().awaitTermination()
    tall = jobs.tall_table(spark, "j_panes").orderBy("pane_idx").collect()
    assert [(r["num_records"], r["sum"], r["timing"]) for r in tall] == [(2, 10, "EARLY"), (3, 11, "EARLY")]
    assert tall[0]["row_key"] > tall[1]["row_key"]
    cells = jobs.wide_table(spark, "j_panes").first()["cells"]
    assert (cells["sum#0"], cells["sum#1"], cells["num_records#1"]) == ("10", "1", "1")


def test_bundle_jobs(spark, feed, tmp_path):
    for name in ("j_a", "j_b"):
        tables.create_table(spark, name, T.StructType.fromDDL("uuid string, v string"))
    bundles = {"one": "j_a", "two": "j_b"}

    def message(seq, **fields):
        return {"value": json.dumps(fields), "seq": seq}

    feed.send(
        [
            message(1, bundle_id="one", uuid="u", v="first", extra="x"),
            message(2, bundle_id="one", uuid="u", v="again"),
            message(3, bundle_id="two", uuid="u", v="other table"),
            message(4, bundle_id="one", v="no uuid"),
            message(5, bundle_id="one", uuid="", v="empty uuid"),
            message(6, bundle_id="three", uuid="w"),
            {"value": "{", "seq": 7},
        ]
    )
    feed.send([message(8, bundle_id="one", uuid="u", v="later")])
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(setting, "false")
    try:
        jobs.bundle_job(feed.stream(), bundles, str(tmp_path / "p1"), seconds=None).start().awaitTermination()
    finally:
        spark.conf.set(setting, "true")
    jobs.bundle_side_job(
        feed.stream(), bundles, "j_dead", "j_registry", str(tmp_path / "p2"), None
    ).start().awaitTermination()
    assert sorted(r["v"] for r in spark.table("j_a").collect()) == ["empty uuid", "first", "no uuid"]
    assert [r["v"] for r in spark.table("j_b").collect()] == ["other table"]
    assert {(r["seq"], r["reason"]) for r in spark.table("j_dead").collect()} == {
        (6, "unknown bundle"), (7, "malformed"),
    }
    seen = spark.table("j_registry").groupBy("destination", "field").agg(F.sum("seen").alias("n"))
    found = {(r["destination"], r["field"]): r["n"] for r in seen.collect()}
    assert found[("j_a", "bundle_id")] == 5 and found[("j_a", "extra")] == 1
    assert found[("j_b", "uuid")] == 1


def test_json_value_view(spark):
    df = spark.sql("""SELECT '1' AS ID, '{"a":{"b":901807788764659968}}' AS METADATA""")
    jobs.json_value_view(df, "with_fields", "METADATA", "a.b")
    assert spark.sql("SELECT a_b FROM with_fields").first()[0] == "901807788764659968"


def test_ingest_stamp(spark):
    assert jobs.stamp_ingest(spark.range(1)).first()["ingested"] is not None

"""The bulk data source: one post per document, receipts of committed tasks only."""

import json
import os
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weirflow.sinks import bulk_source as source
from weirflow.sinks.bulk import Limits
from weirflow.streaming import bodies


def posting(folder, refuse=None):
    """A service that keeps each request as a file and refuses those that hold a text."""

    def post(body):
        if refuse and refuse in body and not os.path.exists(f"{folder}/calm"):
            return 500
        with open(f"{folder}/{uuid.uuid4().hex}.req", "w") as out:
            out.write(body)
        return 200

    return post


def posted(folder):
    lines = [line for f in folder.glob("*.req") for line in f.read_text().splitlines()]
    return sorted(json.loads(line)["n"] for line in lines if '"n"' in line)


def documents(spark, n, tasks=3):
    return spark.range(0, n, 1, tasks).select(F.to_json(F.struct(F.col("id").alias("n"))).alias("doc"), "id")


def test_posts_once_whatever_is_read_later(spark, tmp_path):
    name = source.register_bulk(spark, "bulk_once", posting(str(tmp_path)), Limits(docs=10))
    receipts = str(tmp_path / "out")
    source.bulk_commit_body(name, receipts)(documents(spark, 100), 0)
    read = source.read_receipts(spark, receipts)
    assert read.agg(F.sum("docs")).first()[0] == 100 and read.count() == len(read.collect()) == 12
    assert posted(tmp_path) == list(range(100))


def test_a_batch_that_runs_again_posts_nothing(spark, tmp_path):
    name = source.register_bulk(spark, "bulk_again", posting(str(tmp_path)))
    receipts, body = str(tmp_path / "out"), None
    body = source.bulk_commit_body(name, receipts)
    for batch_id in (0, 0, 1, 0):
        body(documents(spark, 20), batch_id)
    assert posted(tmp_path) == sorted([*range(20), *range(20)])
    totals = {r["epoch"]: r["documents"] for r in source.receipt_totals(spark, receipts).collect()}
    assert totals == {0: 20, 1: 20}


def test_receipts_of_a_failed_run_do_not_count(spark, tmp_path):
    name = source.register_bulk(spark, "bulk_fails", posting(str(tmp_path), '"n":29}'), Limits(docs=4))
    receipts = str(tmp_path / "out")
    body = source.bulk_commit_body(name, receipts)
    with pytest.raises(PySparkException):
        body(documents(spark, 30), 7)
    assert os.listdir(f"{receipts}/receipts") and not os.path.exists(f"{receipts}/manifests")
    (tmp_path / "calm").touch()
    body(documents(spark, 30), 7)
    read = source.read_receipts(spark, receipts)
    assert read.agg(F.sum("docs")).first()[0] == 30
    assert {r["epoch"] for r in read.collect()} == {7}
    assert set(posted(tmp_path)) == set(range(30))


def test_parts_nulls_and_empty_batches(spark, tmp_path):
    name = source.register_bulk(spark, "bulk_parts", posting(str(tmp_path)), Limits(docs=4))
    receipts = str(tmp_path / "out")
    body = source.bulk_commit_body(name, receipts, part="p")
    rows = documents(spark, 12, 1).withColumn("p", F.call_function("div", F.col("id"), F.lit(6)))
    body(rows.withColumn("doc", F.when(F.col("id") != 3, F.col("doc"))), 0)
    body(rows.limit(0), 1)
    read = source.read_receipts(spark, receipts).select("part", "batch", "docs").orderBy("part", "batch")
    assert [tuple(r) for r in read.collect()] == [("0", 0, 4), ("0", 1, 1), ("1", 0, 4), ("1", 1, 2)]
    assert source.Epoch(receipts, "batch", 1).landed()


def test_receipts_before_any_write_and_overwrite(spark, tmp_path):
    assert source.read_receipts(spark, str(tmp_path)).count() == 0
    name = source.register_bulk(spark, "bulk_over", posting(str(tmp_path)))
    with pytest.raises(PySparkException, match="append"):
        options = {"receipts": str(tmp_path), "writer": "w", "epoch": "0"}
        documents(spark, 1).write.format(name).options(**options).mode("overwrite").save()


def test_event_body_posts_once(spark, texts, tmp_path):
    lines = texts("1704067207179,8,worker-0,1,error,6", "1704067267179,9,worker-1,2,view,7", "bad")
    batch = lines.withColumn("ingested", F.current_timestamp())
    lookup = lambda: spark.createDataFrame([("error", "E!")], "dim1 string, dim1_val string")
    body = bodies.event_body(lookup, "1 hour", post=posting(str(tmp_path)), receipts=str(tmp_path / "out"))
    body(batch, 0)
    body(batch, 0)
    sent = "".join(f.read_text() for f in tmp_path.glob("*.req"))
    assert sent.count('{"index":{}}') == 2
    assert source.read_receipts(spark, str(tmp_path / "out")).agg(F.sum("docs")).first()[0] == 2

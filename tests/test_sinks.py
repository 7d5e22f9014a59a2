import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from weirflow.operators import windows
from weirflow.sinks import bulk, files, tables


@pytest.fixture
def table(spark, tmp_path):
    name = f"sink_{tmp_path.name}"
    yield name
    tables.drop_table(spark, name)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, seq bigint, v string")


def test_append_by_name_and_once(spark, table):
    df = rows(spark, ("a", 1, "x"))
    with pytest.raises(ValueError, match="does not exist"):
        tables.append_batch(df, table, 1)
    tables.append_batch(df, table, 1, create=True)
    tables.append_batch(df.select("v", "k"), table, 2)
    tables.append_batch(df.select("v", "k"), table, 2)
    tables.append_batch(df.withColumn("unknown", F.lit(1)), table, 3)
    found = spark.table(table).orderBy("ingest_batch").collect()
    assert [(r["k"], r["seq"], r["v"], r["ingest_batch"]) for r in found] == [
        ("a", 1, "x", 1), ("a", None, "x", 2), ("a", 1, "x", 3),
    ]


def test_number_of_files(spark, table, tmp_path):
    df = spark.range(300).selectExpr("CAST(id AS STRING) AS k", "id AS seq", "map('a', id) AS m")
    tables.create_table(spark, table, df.schema, str(tmp_path / "data"))
    tables.append_batch(df.repartition(7), table, 1, shards=3)
    tables.append_batch(df.repartition(7), table, 2, shards=0)
    tables.append_batch(df.repartition(7), table, 3)
    files_of = lambda n: len(list((tmp_path / f"data/ingest_batch={n}").glob("*/part-*")))
    assert (files_of(1), files_of(2), files_of(3)) == (3, 1, 7)
    assert spark.table(table).count() == 900


def test_upserts_read_as_last_row(spark, table):
    tables.upsert_batch(rows(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")), table, 1, ["k"], ["seq"])
    tables.upsert_batch(rows(spark, ("a", 1, "new")), table, 2, ["k"], ["seq"])
    found = {r["k"]: r["v"] for r in tables.current_rows(spark, table, ["k"], ["seq"]).collect()}
    assert found == {"a": "new", "b": "z"}


def test_folds_equal_the_whole_history(spark, table, tmp_path):
    rng = random.Random(6)
    fold, folds = None, []
    for batch in range(6):
        changed = [(f"k{rng.randrange(9)}", i, f"{batch}-{i}") for i in range(10)]
        tables.upsert_batch(rows(spark, *changed), table, batch, ["k"], ["seq"])
        whole = {tuple(r) for r in tables.current_rows(spark, table, ["k"], ["seq"]).collect()}
        quick = tables.current_rows(spark, table, ["k"], ["seq"], fold)
        assert {tuple(r) for r in quick.collect()} == whole
        if batch % 2:
            order = ["ingest_batch", "seq"]
            fold = tables.fold_batches(spark, table, ["k"], order, batch, str(tmp_path), fold)
            folds.append(fold)
    assert [f.upto for f in folds] == [{"batch": n} for n in (1, 3, 5)]
    assert spark.read.parquet(fold.path).count() == len(whole)


def test_merge_statement():
    assert tables.merge_statement("t", "s", ["k"]) == (
        "MERGE INTO t t USING s s ON t.k <=> s.k WHEN MATCHED THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *"
    )
    text = tables.merge_statement("t", "s", ["a", "b"], "_change", ["a", "b", "c"])
    assert "WHEN MATCHED AND s._change = 'DELETE' THEN DELETE" in text
    assert text.endswith(
        "WHEN NOT MATCHED AND s._change <> 'DELETE' THEN INSERT (a, b, c) VALUES (s.a, s.b, s.c)"
    )


def test_a_fold_leaves_out_what_another_writer_adds_later(spark, table, tmp_path):
    for batch in range(3):
        tables.upsert_batch(rows(spark, ("a", batch, f"old{batch}")), table, batch, ["k"], ["seq"])
    fold = tables.fold_batches(spark, table, ["k"], ["seq"], 2, str(tmp_path))
    key = "sql.streaming.queryId"  # what a stream with its own checkpoint has
    spark.sparkContext.setLocalProperty(key, "another")
    try:
        tables.upsert_batch(rows(spark, ("b", 9, "new")), table, 0, ["k"], ["seq"])
    finally:
        spark.sparkContext.setLocalProperty(key, None)
    found = {r["k"]: r["v"] for r in tables.current_rows(spark, table, ["k"], ["seq"], fold).collect()}
    assert found == {"a": "old2", "b": "new"}


def test_route_to_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    schema = T.StructType.fromDDL("v string")
    for name in ("shop.one", "shop.two"):
        tables.create_table(spark, name, schema)
    df = spark.createDataFrame([("shop.one", "a"), ("shop.two", "b"), ("shop.one", "c")], "destination string, v string")
    assert tables.route_to_tables(df, 7) == ["shop.one", "shop.two"]
    assert {r["v"] for r in spark.table("shop.one").collect()} == {"a", "c"}
    odd = spark.createDataFrame(
        [("SHOP.One", "d"), ("shop.one", "e"), ("shop.three", "f"), ("x.no-such", "g"), (None, "h")],
        "destination string, v string",
    )
    assert tables.route_to_tables(odd, 8, dead_table="shop.dead") == ["shop.one"]
    assert {r["v"] for r in spark.table("shop.one").collect()} == {"a", "c", "d", "e"}
    dead = spark.table("shop.dead").collect()
    assert {r["destination"] for r in dead} == {"shop.three", "x.no-such", None}
    for name in ("shop.one", "shop.two", "shop.dead", "unrouted_rows"):
        tables.drop_table(spark, name)


def test_window_text_folders_and_shards(spark, tmp_path):
    out = str(tmp_path / "text")
    df = spark.range(100).select(
        F.col("id").cast("string").alias("value"),
        F.timestamp_seconds(1704067200 + F.col("id") * 60).alias("ts"),
    )
    windowed = windows.with_window(df, "ts", "1 hour")
    files.write_window_text(windowed, F.col("window.end"), out, shards=3)
    folders = sorted(p.parent.relative_to(out).as_posix() for p in (tmp_path / "text").rglob("part-*"))
    assert set(folders) == {"yyyy=2024/mm=01/dd=01/hh=01", "yyyy=2024/mm=01/dd=01/hh=02"}
    assert max(folders.count(f) for f in set(folders)) <= 3
    assert spark.read.text(out).count() == 100


def test_window_records_and_day_partition(spark, tmp_path):
    df = spark.range(48).select(
        "id", (F.lit(1704067200) + F.col("id") * 3600).alias("event_ts")
    )
    windowed = windows.with_window(df.withColumn("ts", F.timestamp_seconds("event_ts")), "ts", "1 hour")
    files.write_window_records(windowed.drop("ts"), F.col("window.end"), str(tmp_path / "rec"))
    assert spark.read.parquet(str(tmp_path / "rec")).count() == 48
    files.write_by_day(df, "event_ts", str(tmp_path / "day"))
    back = spark.read.parquet(str(tmp_path / "day"))
    assert {str(r["event_day"]): r["count"] for r in back.groupBy("event_day").count().collect()} == {
        "2024-01-01": 24, "2024-01-02": 24,
    }


def test_bulk_body_and_retry():
    assert bulk.bulk_body(['{"a":1}', "{}"]) == '{"index":{}}\n{"a":1}\n{"index":{}}\n{}\n'
    pauses = []
    answers = iter([429, 429, 200])
    steady = lambda: 1.0
    assert bulk.post_with_retry(lambda b: next(answers), "", pauses.append, steady) == (3, 200)
    assert pauses == [5.0, 7.5]
    with pytest.raises(OSError, match="status 500 after 1"):
        bulk.post_with_retry(lambda b: 500, "", pauses.append)
    calls, pauses = [], []
    with pytest.raises(OSError, match="status 429 after 6"):
        bulk.post_with_retry(lambda b: calls.append(b) or 429, "x", pauses.append, steady)
    assert len(calls) == 6 and pauses == [5.0, 7.5, 11.25, 16.875, 19.375]


def test_bulk_answers():
    def answer(*statuses):
        items = [{"index": {"status": s, **({"error": "e"} if s > 299 else {})}} for s in statuses]
        return json.dumps({"errors": any(s > 299 for s in statuses), "items": items})

    assert bulk.answer_status(answer(201, 201)) == (200, "")
    assert bulk.answer_status(answer(201, 400, 429))[0] == 429
    assert bulk.answer_status(answer(201, 400))[0] == 400
    assert bulk.answer_status(503) == (503, "")
    answers = iter([answer(429), answer(201)])
    assert bulk.post_with_retry(lambda b: next(answers), "", lambda s: None) == (2, 200)


def test_bulk_limits(spark):
    docs = spark.range(25).select(F.concat(F.lit("d"), "id").alias("doc")).coalesce(1)
    sent = bulk.send_bulk(docs, lambda body: 200, max_docs=10).orderBy("batch").collect()
    assert [(r["batch"], r["docs"]) for r in sent] == [(0, 10), (1, 10), (2, 5)]
    by_size = bulk.send_bulk(docs, lambda body: 200, max_bytes=30).collect()
    # Three bytes per character: five two-letter documents, or four of three letters, reach 30.
    assert [r["docs"] for r in by_size] == [5, 5, 4, 4, 4, 3]
    assert sum(r["docs"] for r in by_size) == 25
    totals = bulk.bulk_totals(bulk.send_bulk(docs, lambda body: 200, max_docs=10)).first()
    assert tuple(totals) == (25, 3, 0)


def test_bulk_failure_fails_the_job(spark):
    docs = spark.range(3).select(F.lit("{}").alias("doc"))
    with pytest.raises(Exception, match="status 400"):
        bulk.send_bulk(docs, lambda body: 400).collect()


def test_bulk_parts_are_separate(spark):
    docs = spark.range(10).select(F.lit("{}").alias("doc"), (F.col("id") % 2).alias("p"))
    ordered = docs.repartition("p").sortWithinPartitions("p")
    sent = bulk.send_bulk(ordered, lambda body: 200, part="p", max_docs=4).collect()
    assert sorted((r["part"], r["batch"], r["docs"]) for r in sent) == [
        ("0", 0, 4), ("0", 1, 1), ("1", 0, 4), ("1", 1, 1),
    ]


def test_staged_rows_are_json_lines(spark, tmp_path):
    df = rows(spark, ("a", 1, None))
    path = files.stage_rows(df, str(tmp_path), 3)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert [json.loads(line) for line in lines] == [{"k": "a", "seq": 1}]

import json
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F, types as T

from weirflow import session
from weirflow.plans.queries import VERSIONS
from weirflow.sinks import tables
from weirflow.streaming import bodies

LINES = [
    "1704067207179,8,worker-0,1,error,6",
    "1704067267179,9,worker-1,2,view,7",
    "1704153607179,9,worker-1,3,view,8",
    "1704067207179,8",
]


@pytest.fixture
def table(spark, tmp_path):
    name = "b_" + "".join(c if c.isalnum() else "_" for c in tmp_path.name)
    yield name
    for suffix in ("", "_dead", "_two"):
        tables.drop_table(spark, name + suffix)


def test_events_reach_every_sink(spark, texts, table, tmp_path):
    lookup = lambda: spark.createDataFrame([("error", "E!")], "dim1 string, dim1_val string")
    body = bodies.event_body(
        lookup, "1 hour", table, str(tmp_path / "text"), str(tmp_path / "records"),
        str(tmp_path / "errors"), post=lambda b: 200, shards=1,
    )
    batch = texts(*LINES).withColumn("ingested", F.current_timestamp())
    body(batch, 0)
    body(batch, 0)
    rows = spark.table(table).orderBy("seq").collect()
    assert [(r["seq"], r["dim1_val"], str(r["event_day"])) for r in rows] == [
        (1, "E!", "2024-01-01"), (2, "Not Found", "2024-01-01"), (3, "Not Found", "2024-01-02"),
    ]
    lines = [r[0] for r in spark.read.text(str(tmp_path / "text")).select("value").collect()]
    assert len(lines) == 3 and all(len(line.split(",")) == 8 for line in lines)
    assert spark.read.parquet(str(tmp_path / "records")).count() == 3
    errors = spark.read.text(str(tmp_path / "errors")).collect()
    assert [r["value"] for r in errors] == [LINES[3]]
    assert (tmp_path / "text/ingest_writer=batch/batch_id=0/yyyy=2024/mm=01/dd=01/hh=01").is_dir()


def test_failed_post_fails_the_batch(spark, texts):
    lookup = lambda: spark.createDataFrame([], "dim1 string, dim1_val string")
    body = bodies.event_body(lookup, "1 hour", post=lambda b: 400)
    with pytest.raises(Exception, match="status 400"):
        body(texts(*LINES).withColumn("ingested", F.current_timestamp()), 0)


def test_sql_body_keeps_milliseconds(spark, texts, table):
    log = '{"timestamp":"2025-01-02T03:04:05.678Z","severity":"%s"}'
    body = bodies.sql_body(
        table, "SELECT * FROM PCOLLECTION WHERE severity != 'DEBUG'", dead_table=table + "_dead"
    )
    body(texts(log % "INFO", log % "DEBUG", "{").drop("seq"), 3)
    rows = spark.table(table).collect()
    assert [(r["severity"], r["timestamp"].microsecond) for r in rows] == [("INFO", 678000)]
    assert spark.table(table + "_dead").count() == 1


def test_basic_events_by_day(spark, texts, table):
    schema = T.StructType.fromDDL("event_ts bigint, kind string, user bigint")
    body = bodies.basic_event_body(table, schema, table + "_dead")
    good = '{"event_timestamp":1704067207179575,"perf_ts":1,"KIND":"k","user":5,"other":1}'
    body(texts(good, "nope"), 0)
    row = spark.table(table).drop("ingest_batch", "ingest_writer").first().asDict()
    assert {**row, "event_day": str(row["event_day"])} == {
        "event_ts": 1704067207, "kind": "k", "user": 5, "event_day": "2024-01-01",
    }
    assert spark.table(table + "_dead").first()["reason"] == "malformed"


def test_json_column(spark, texts, table):
    body = bodies.json_column_body(table, table + "_dead")
    body(texts('{"id":"1","sender_name":"s","x":{"y":736201984455120783}}', "nope"), 0)
    row = spark.table(table).first()
    assert (row["ID"], row["METADATA"]) == ("1", '{"x":{"y":736201984455120783}}')
    assert spark.table(table + "_dead").count() == 1


def test_declared_versions_in_turn(spark, texts, table, tmp_path):
    full = {
        "ID": "a", "SENDER_JSON": "{}", "NEW_TOP_LEVEL_FIELD": "t", "NEW_TOP_LEVEL_FIELD_V2": 7,
        "SENDER_RECORD": {"SENDER_NAME": "n", "SENDER_COMPANY": "c", "SENDER_MOBILE_PHONE": "p"},
    }
    for number, schema in enumerate([*VERSIONS, VERSIONS[0]]):
        body = bodies.declared_body(table, schema, str(tmp_path / "data"))
        body(texts(json.dumps(full)), number)
    rows = spark.table(table).orderBy("ingest_batch").collect()
    phones = [r["SENDER_RECORD"]["SENDER_MOBILE_PHONE"] for r in rows]
    assert phones == [None, "p", "p", None]
    assert [r["NEW_TOP_LEVEL_FIELD"] for r in rows] == [None, "t", "t", None]
    assert [r["NEW_TOP_LEVEL_FIELD_V2"] for r in rows] == [None, None, 7, None]


def test_declared_load_loses_nothing(spark, texts, table, tmp_path):
    schema = T.StructType([T.StructField("ID", T.StringType(), False), T.StructField("n", T.IntegerType())])
    batch = texts('{"ID":"a","n":1}', "{broken", "[1]", '{"ID":"b","n":"abc"}', '{"ID":"c","n":2,"EXTRA":"x"}', '{"n":3}')
    bodies.declared_body(table, schema, str(tmp_path / "data"))(batch, 0)
    assert {(r["ID"], r["n"]) for r in spark.table(table).collect()} == {("a", 1), ("c", 2)}
    dead = {(r["value"], r["reason"]) for r in spark.table(table + "_dead").collect()}
    assert dead == {
        ("{broken", "malformed"), ("[1]", "malformed"), ('{"ID":"b","n":"abc"}', "bad field"),
        ('{"ID":"c","n":2,"EXTRA":"x"}', "unknown field"), ('{"n":3}', "missing field"),
    }


def test_broken_text_is_not_staged(spark, texts, table, tmp_path):
    body = bodies.staged_load_body(table, str(tmp_path / "stage"))
    body(texts('{"ID":"1"}', "{broken").drop("seq"), 0)
    body(texts("{broken too").drop("seq"), 1)
    assert [r["ID"] for r in spark.table(table).collect()] == ["1"]
    assert spark.table(table + "_dead").count() == 2


def test_destinations_by_case_missing_and_invalid(spark, texts):
    spark.sql("CREATE DATABASE IF NOT EXISTS dest")
    bodies.create_change_table(spark, "dest.orders", T.StructType.fromDDL("ID bigint"))

    def message(database, table, number):
        return json.dumps(
            {"database": database, "table": table, "type": "INSERT", "ts": 1, "es": 1,
             "pkNames": ["ID"], "data": [{"ID": number}]}
        )

    batch = texts(
        message("DEST", "ORDERS", 1), message("dest", "orders", 2), message("dest", "no-such", 3),
        message("a`b", "x;y", 4), message("dest", "absent", 5), message("p.q", "r.s", 6),
    )
    bodies.routed_change_body("seq", "dest.dead")(batch, 0)
    assert {r["ID"] for r in spark.table("dest.orders").collect()} == {1, 2}
    dead = spark.table("dest.dead").collect()
    assert [r["reason"] for r in dead] == ["no table"] * 4
    spark.sql("DROP DATABASE dest CASCADE")


def test_all_sinks_see_one_time_stamp(spark, table, tmp_path):
    lines = spark.range(300).selectExpr(
        "concat('1704067207179,8,worker-0,', id, ',error,6') AS value", "timestamp_seconds(id) AS ingested"
    )
    lookup = lambda: spark.createDataFrame([("error", "E!")], "dim1 string, dim1_val string")
    folder = str(tmp_path / "text")
    bodies.event_body(lookup, "1 hour", table=table, text_folder=folder)(lines.repartition(4), 0)
    rows = {r["process_ts"] for r in spark.table(table).select("process_ts").collect()}
    written = spark.read.option("recursiveFileLookup", "true").text(folder).collect()
    assert len(written) == 300 and rows == {int(r["value"].split(",")[-2]) // 1000 for r in written}


def test_struct_field_needs_external_table(spark, table):
    tables.create_table(spark, table, T.StructType.fromDDL("r struct<a: int>"))
    with pytest.raises(ValueError, match="external"):
        tables.add_fields(spark, table, T.StructType.fromDDL("r struct<a: int, b: int>"))


def test_staged_load_body(spark, texts, table, tmp_path):
    body = bodies.staged_load_body(table, str(tmp_path / "stage"))
    body(texts('{"ID":"1"}').drop("seq"), 0)
    body(texts('{"ID":"2","n":4}').drop("seq"), 1)
    body(texts('{"ID":"2","n":4}').drop("seq"), 1)
    assert {(r["ID"], r["n"]) for r in spark.table(table).collect()} == {("1", None), ("2", 4)}
    assert spark.table(table).count() == 2


def test_changes_go_to_their_own_tables(spark, texts):
    spark.sql("CREATE DATABASE IF NOT EXISTS dest")
    bodies.create_change_table(spark, "dest.a", T.StructType.fromDDL("ID bigint, v string"))
    bodies.create_change_table(spark, "dest.b", T.StructType.fromDDL("ID bigint, w double"))

    def message(table, kind, ts, *records):
        return json.dumps(
            {"database": "dest", "table": table, "type": kind, "ts": ts, "es": ts,
             "pkNames": ["ID"], "data": list(records)}
        )

    big = 736201984455120783
    first = texts(
        message("a", "INSERT", 1, {"ID": big, "v": "x", "extra": 1}, {"ID": 2, "v": "y"}),
        message("b", "INSERT", 1, {"ID": 1, "w": 1.5}),
    )
    body = bodies.routed_change_body("seq", "dest.dead")
    body(first, 0)
    body(texts(message("a", "DELETE", 2, {"ID": 2}), message("b", "UPDATE", 2, {"ID": 1, "w": 2.5})), 1)
    unfit = texts(message("b", "UPDATE", 3, {"ID": 1, "w": "wide"}, {"ID": 5, "w": 1}))
    body(unfit, 2)
    dead = [(r["value"], r["reason"]) for r in spark.table("dest.dead").collect()]
    assert dead == [('{"ID":"1","w":"wide"}', "bad field")]
    try:
        assert [tuple(r) for r in bodies.current_table(spark.table("dest.a")).collect()] == [(big, "x")]
        assert sorted(tuple(r) for r in bodies.current_table(spark.table("dest.b")).collect()) == [(1, 2.5), (5, 1.0)]
    finally:
        tables.drop_table(spark, "dest.a")
        tables.drop_table(spark, "dest.b")
        tables.drop_table(spark, "dest.dead")


def test_routed_changes_fill_no_executor_memory(spark, texts, table, tmp_path, monkeypatch):
    """Parsed changes are as large as the batch: kept in files, which go at the end or at a failure."""
    persisted = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before, during, append = persisted(), [], tables.append_batch

    def watched(*args, **options):
        during.append((persisted(), sorted(p.name for p in tmp_path.iterdir())))
        append(*args, **options)

    monkeypatch.setattr(tables, "append_batch", watched)
    monkeypatch.setattr(session, "scratch_dir", lambda spark, label: str(tmp_path / label))
    bodies.create_change_table(spark, table, T.StructType.fromDDL("ID bigint"))
    good = {"database": "d", "type": "INSERT", "ts": 1, "es": 1, "pkNames": ["ID"]}
    batch = texts(
        json.dumps({**good, "table": "a", "data": [{"ID": 1}, {"ID": 2}]}), '{"table":', "",
        json.dumps({**good, "table": "b", "data": [{"ID": 3}]}), json.dumps({**good, "table": "a", "data": []}),
    )
    body = bodies.routed_change_body("seq", table + "_dead", table_of=lambda name: table if name == "d.a" else name)
    body(batch, 0)
    assert {r["ID"] for r in spark.table(table).collect()} == {1, 2}
    dead = {(r["value"], r["reason"]) for r in spark.table(table + "_dead").collect()}
    assert dead == {('{"table":', "malformed"), ('{"ID":"3"}', "no table")}
    assert len(during) == 2 and all(n <= before and staged for n, staged in during)
    assert not list(tmp_path.iterdir())
    monkeypatch.setattr(tables, "append_batch", lambda *args, **options: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        body(batch, 1)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("kind", ["json_column", "changes"])
def test_a_large_part_is_dealt_out_before_the_parse(spark, monkeypatch, kind):
    """A source's one part would be one task's, and what that task keeps of it would grow with it."""
    parts = []

    @contextmanager
    def watched(df, *args, **options):
        with kept(df, *args, **options) as stored:
            stored.count()
            parts.append(stored.rdd.getNumPartitions())
            yield stored

    kept = bodies.kept
    monkeypatch.setattr(bodies, "kept", watched)
    table, setting = f"dealt_{uuid.uuid4().hex}", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    text = 'concat(\'{"id":"\', id, \'","sender_name":"s","hash":"\', sha2(cast(id as string), 512), \'"}\') AS value'
    batch = spark.range(20_000).selectExpr("id AS arrival", text).coalesce(1)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "256k")
    try:
        if kind == "changes":
            bodies.applied_change_body(bodies.change_table(table), "arrival")(batch, 0)
        else:
            bodies.json_column_body(table)(batch, 0)
            assert spark.table(table).count() == 20_000
        assert parts[0] > 2
        bodies.json_column_body(table + "_small")(batch.limit(3), 0)
        assert parts[-1] == 1
    finally:
        spark.conf.set(setting, before)

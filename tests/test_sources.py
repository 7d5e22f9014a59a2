import pytest
from pyspark.sql import functions as F, types as T

from weirflow.sources import messages, schemas


def test_table_schema_nests():
    text = """{"Table Fields": [
      {"name": "ID", "type": "STRING", "mode": "REQUIRED"},
      {"name": "META", "type": "JSON"},
      {"name": "N", "type": "integer"},
      {"name": "TAGS", "type": "STRING", "mode": "REPEATED"},
      {"name": "AT", "type": "DATETIME"},
      {"name": "R", "type": "RECORD", "fields": [
        {"name": "A", "type": "FLOAT"},
        {"name": "B", "type": "RECORD", "fields": [{"name": "C", "type": "BOOLEAN"}]}]}]}"""
    schema = schemas.table_schema(text)
    assert schema.simpleString() == (
        "struct<ID:string,META:string,N:bigint,TAGS:array<string>,AT:timestamp_ntz,"
        "R:struct<A:double,B:struct<C:boolean>>>"
    )
    assert [f.nullable for f in schema.fields][:2] == [False, True]
    with pytest.raises(ValueError, match="GEO"):
        schemas.table_schema([{"name": "g", "type": "GEO"}])


def test_record_schema():
    text = """{"type": "record", "name": "r", "fields": [
      {"name": "a", "type": "string"}, {"name": "b", "type": ["null", "long"]},
      {"name": "c", "type": "int"}, {"name": "d", "type": "boolean"},
      {"name": "e", "type": "float"}, {"name": "f", "type": "double"}]}"""
    assert schemas.record_schema(text).simpleString() == (
        "struct<a:string,b:bigint,c:int,d:boolean,e:float,f:double>"
    )
    with pytest.raises(ValueError, match="bytes"):
        schemas.record_schema({"fields": [{"name": "x", "type": "bytes"}]})


def test_schema_from_file_and_live(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"fields": [{"name": "ID", "type": "STRING"}]}')
    text = schemas.read_text_file(spark, str(path))
    schema = schemas.table_schema(text)
    assert schemas.live_schema(spark, "no_such_table", schema) == schema
    with pytest.raises(ValueError, match="does not exist"):
        schemas.live_schema(spark, "no_such_table")


def test_kafka_options():
    options = messages.kafka_options("h:9092", "logs", consumer={"sasl.mechanism": "PLAIN"})
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "logs",
        "startingOffsets": "latest",
        "kafka.sasl.mechanism": "PLAIN",
    }


def test_topic_and_envelope_rows(spark):
    records = spark.sql(
        "SELECT X'6B' AS key, X'C3A9' AS value, 't' AS topic, 0 AS partition, 5L AS offset, "
        "TIMESTAMP'2024-01-01' AS timestamp, 0 AS timestampType"
    )
    assert messages.topic_rows(records).first()["value"] == "é"
    envelope = spark.createDataFrame(
        [(b"a", {"timestamp": "2024-05-06T07:08:09Z"}, "1", None), (b"b", {}, "2", None)],
        messages.ENVELOPE_SCHEMA,
    ).withColumn("publish_ts", F.to_timestamp(F.lit("2020-01-01")))
    found = messages.envelope_rows(envelope, "timestamp").orderBy("message_id").collect()
    assert [r["value"] for r in found] == ["a", "b"]
    assert [str(r["ts"]) for r in found] == ["2024-05-06 07:08:09", "2020-01-01 00:00:00"]
    plain = messages.envelope_rows(envelope).collect()
    assert {str(r["ts"]) for r in plain} == {"2020-01-01 00:00:00"}


def test_staged_read_and_memory_rows(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"a":1,"B":"x"}\n{"b":"y","c":2.5}\n')
    df = messages.read_staged(spark, str(path))
    assert sorted(df.columns) == ["B", "a", "c"]
    assert sorted(r["B"] for r in df.collect()) == ["x", "y"]
    path.write_text('{"a":1}\n{oops\n')
    with pytest.raises(Exception):
        messages.read_staged(spark, str(path), T.StructType.fromDDL("a int")).collect()
    rows = messages.memory_rows(spark, [("1", "n")], "ID string, SENDER_NAME string")
    assert rows.collect()[0].asDict() == {"ID": "1", "SENDER_NAME": "n"}

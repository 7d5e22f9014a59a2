import random

import pytest
from pyspark.sql import functions as F, types as T

from weirflow.operators import drift
from weirflow.sinks import files, tables
from weirflow.streaming import bodies

SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType(), nullable=False),
        T.StructField("SENDER_NAME", T.StringType()),
        T.StructField("n", T.IntegerType()),
    ]
)


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{tmp_path.name.replace('-', '_').replace('[', '_').replace(']', '_')}"
    yield name
    for suffix in ("", "_dead", "_registry"):
        tables.drop_table(spark, name + suffix)


def test_new_keys_ignore_case(texts):
    rows = drift.dynamic_rows(texts('{"id":1,"Sender_Name":"x","NEW":1,"New2":2}', "{}", "["))
    found = [r[0] for r in rows.select(drift.new_keys(F.col("row"), ["ID", "SENDER_NAME"])).collect()]
    assert sorted(found[0]) == ["new", "new2"] and found[1] == []
    assert [r["reason"] for r in rows.collect()] == [None, None, "malformed"]
    fields = drift.new_fields(rows, ["ID", "SENDER_NAME"]).collect()
    assert {(r["field"], r["spelling"]) for r in fields} == {("new", "NEW"), ("new2", "New2")}


def test_routes_by_live_and_startup_schema(texts):
    rows = drift.dynamic_rows(texts('{"ID":1}', '{"ID":1,"A":1}', '{"ID":1,"A":1,"B":2}'), ["seq"])
    live = drift.route_rows(rows, ["ID", "A"]).orderBy("seq").collect()
    assert [r["route"] for r in live] == ["NORMAL", "NORMAL", "DRIFTED"]
    assert live[2]["missing"] == ["b"]
    fixed = drift.route_rows(rows, ["ID", "A"], startup_columns=["ID"]).orderBy("seq").collect()
    assert [r["route"] for r in fixed] == ["NORMAL", "DRIFTED", "DRIFTED"]
    assert [r["missing"] for r in fixed] == [[], [], ["b"]]


def test_strict_split(texts):
    rows = drift.dynamic_rows(
        texts('{"id":"a","n":"1"}', '{"ID":"a","X":1}', '{"n":1}', '{"ID":"a","n":"one"}', "[", '{"ID":"a","n":null}'),
        ["seq"],
    )
    checked = drift.strict_split(rows, SCHEMA).orderBy("seq").collect()
    assert [r["reason"] for r in checked] == [
        None, "unknown field", "missing field", "bad field", "malformed", None,
    ]


def test_nested_values_reach_nested_columns(texts):
    schema = T.StructType.fromDDL("ID string, r struct<a: bigint, b: string>, l array<int>")
    rows = drift.dynamic_rows(
        texts('{"ID":"x","R":{"a":901807788764659968,"b":"c"},"l":[1,2]}', '{"ID":"y","l":"no list"}'),
        ["seq"],
    )
    checked = drift.strict_split(rows, schema).orderBy("seq")
    assert [r["reason"] for r in checked.collect()] == [None, "bad field"]
    row = drift.as_columns(checked.filter("reason IS NULL"), schema).first()
    assert row["r"].asDict() == {"a": 901807788764659968, "b": "c"} and row["l"] == [1, 2]


def test_versions_fill_nested_fields(spark):
    old = spark.sql("SELECT 'a' AS ID, named_struct('NAME', 'x') AS R UNION ALL SELECT 'b', NULL")
    target = T.StructType.fromDDL("ID string, R struct<NAME: string, PHONE: string>, N bigint")
    rows = drift.to_version(old, target).orderBy("ID").collect()
    assert rows[0].asDict(True) == {"ID": "a", "R": {"NAME": "x", "PHONE": None}, "N": None}
    assert rows[1]["R"] is None


@pytest.mark.parametrize("body_of", [bodies.healing_body, bodies.failed_rows_body])
def test_no_row_and_no_value_is_lost(spark, texts, table, body_of):
    rng = random.Random(11)
    tables.create_table(spark, table, T.StructType.fromDDL("ID string, SENDER_NAME string"))
    body = body_of(table, dead_table=table + "_dead")
    sent, broken, number = {}, 0, 0
    for batch in range(4):
        messages = []
        for _ in range(30):
            number += 1
            names = rng.sample(["F1", "f2", "Field3", "F4"], rng.randint(0, batch))
            row = {"ID": f"r{number}", rng.choice(["SENDER_NAME", "sender_name"]): "s"}
            row.update({n: f"{n}-{number}" for n in names})
            sent[f"r{number}"] = {k.upper(): v for k, v in row.items()}
            messages.append(str(row).replace("'", '"'))
        messages.append("{broken")
        broken += 1
        df = texts(*messages).drop("seq")
        body(df, batch)
        body(df, batch)  # a repeated micro-batch must not double anything
    rows = spark.table(table).drop("ingest_batch", "ingest_writer").collect()
    found = {
        r["ID"]: {k.upper(): v for k, v in r.asDict().items() if v is not None} for r in rows
    }
    assert len(rows) == number and found == sent
    assert spark.table(table + "_dead").count() == broken


def test_healing_creates_table_and_registry(spark, texts, table):
    batch = texts('{"ID":"a","x":"1"}', '{"ID":"b"}').withColumn(
        "ts", F.timestamp_seconds(F.col("seq"))
    )
    body = bodies.healing_body(table, ["ts"], registry_table=table + "_registry", ts="ts")
    body(batch.drop("seq"), 0)
    found = {r["ID"]: (r["x"], r["ts"].timestamp()) for r in spark.table(table).collect()}
    assert found == {"a": ("1", 0), "b": (None, 1)}
    seen = {r["field"]: r["seen"] for r in spark.table(table + "_registry").collect()}
    assert seen == {"ID": 2, "x": 1}


def test_value_of_wrong_type_is_a_dead_letter(spark, texts, table):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string, n int"))
    batch = texts('{"ID":"a","n":1}', '{"ID":"b","n":"many","new":2}').drop("seq")
    bodies.healing_body(table)(batch, 0)
    assert [(r["ID"], r["n"]) for r in spark.table(table).collect()] == [("a", 1)]
    assert "new" not in spark.table(table).columns  # a dead letter does not widen the table
    dead = spark.table(table + "_dead").collect()
    assert [r["reason"] for r in dead] == ["bad field"] and '"many"' in dead[0]["value"]


def test_field_names_that_sql_does_not_like(spark, texts, table):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string, ts string"))
    batch = texts('{"ID":1,"INGEST_BATCH":5}', '{"ID":2,"a`b":7}', '{"ID":3,"Seq":9}').drop("ts")
    bodies.healing_body(table, keep=["seq"])(batch.withColumn("seq", F.col("seq").cast("string")), 0)
    rows = spark.table(table).collect()
    assert [(r["ID"], r["a`b"]) for r in rows] == [("2", "7")]
    dead = {r["reason"] for r in spark.table(table + "_dead").collect()}
    assert dead == {"unknown field"}


def test_evolve_is_case_insensitive_and_repeatable(spark, texts, table):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string"))
    rows = drift.dynamic_rows(texts('{"id":1,"New":1}', '{"ID":1,"NEW":1}'))
    assert tables.evolve(rows, table) == ["NEW"]
    assert tables.evolve(rows, table) == []
    assert tables.add_columns(spark, table, {"new": "STRING"}) == []


def test_staged_load_infers_types(spark, texts, table, tmp_path):
    stage = str(tmp_path / "stage")
    first = files.stage_text(texts('{"ID":"1","n":5}'), stage, 1)
    assert set(files.load_inferred(spark, first, table, 1)) == {"ID", "n"}
    second = files.stage_text(
        texts('{"id":"2","n":7,"phone":"0123","d":1.5}', '{"ID":"3"}'), stage, 2
    )
    assert set(files.load_inferred(spark, second, table, 2)) == {"phone", "d"}
    kinds = {f.name: f.dataType.simpleString() for f in tables.table_columns(spark, table).fields}
    assert kinds == {"ID": "string", "n": "bigint", "phone": "string", "d": "decimal(38,18)"}
    found = {r["ID"]: (r["n"], r["phone"]) for r in spark.table(table).collect()}
    assert found == {"1": (5, None), "2": (7, "0123"), "3": (None, None)}
    third = files.stage_text(texts('{"ID":"4","n":"many"}'), stage, 3)
    assert files.load_inferred(spark, third, table, 3) == ["n_V2"]
    assert {r["ID"]: (r["n"], r["n_V2"]) for r in spark.table(table).collect()}["4"] == (None, "many")


def test_staged_load_with_schema(spark, table, tmp_path):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string, n bigint"))
    df = spark.createDataFrame([("a", 1), ("b", None)], "ID string, n bigint")
    path = files.stage_rows(df, str(tmp_path / "s"), 4)
    files.load_staged(spark, [path], table, df.schema, 4)
    assert {(r["ID"], r["n"]) for r in spark.table(table).collect()} == {("a", 1), ("b", None)}


def test_rows_are_routed_by_the_table_as_it_is(spark, texts, table):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string"))
    body = bodies.healing_body(table, ["seq"], route_table=table + "_routes")
    for number, batch in enumerate((['{"ID":1}'], ['{"ID":1,"A":1}', '{"ID":1}'], ['{"ID":1,"a":1}', '{"B":1}', "x"])):
        body(texts(*batch).withColumn("seq", F.col("seq") + 10 * number), number)
    routes = {r.seq: (r.route, r.missing) for r in spark.table(table + "_routes").collect()}
    assert routes == {
        0: ("NORMAL", []), 10: ("DRIFTED", ["a"]), 11: ("NORMAL", []), 20: ("NORMAL", []), 21: ("DRIFTED", ["b"]),
    }
    tables.drop_table(spark, table + "_routes")


def test_two_spellings_in_one_row(spark, texts, table):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string, FOO string"))
    batch = texts('{"ID":"2","FOO":"w","foo":"z"}', '{"ID":"3","foo":"z"}').select("value")
    bodies.healing_body(table)(batch, 0)
    assert [(r.ID, r.FOO) for r in spark.table(table).collect()] == [("3", "z")]
    dead = spark.table(table + "_dead").collect()
    assert [(r.value, r.reason) for r in dead] == [('{"ID":"2","FOO":"w","foo":"z"}', "repeated field")]

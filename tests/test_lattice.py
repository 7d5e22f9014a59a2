"""Types of undeclared fields: what is joined, where a value goes, and that none is lost."""

import json
import uuid
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F, types as T

from weirflow.operators import lattice
from weirflow.sinks import tables
from weirflow.streaming import bodies


@pytest.fixture
def load(spark, texts, tmp_path):
    """Loads messages as micro-batches of one table; gives its rows and letters."""
    table = f"inferred_{uuid.uuid4().hex}"

    def run(*batches):
        body = bodies.staged_load_body(table, str(tmp_path / "stage"))
        for number, batch in enumerate(batches):
            body(texts(*batch).select("value"), number)
        rows = spark.table(table).drop(*tables.RESERVED) if tables.table_exists(spark, table) else None
        return rows, [(r.value, r.reason) for r in spark.table(table + "_dead").collect()]

    yield run
    tables.drop_table(spark, table)
    tables.drop_table(spark, table + "_dead")


def test_join_does_not_depend_on_order():
    want = {
        ("bigint",): T.LongType(), ("bigint", "decimal"): lattice.EXACT, ("boolean",): T.BooleanType(),
        ("bigint", "boolean"): T.StringType(), ("nested",): T.VariantType(), ("nested", "text"): T.StringType(),
        ("null",): T.StringType(), ("bigint", "null"): T.LongType(), ("bigint", "decimal", "text"): T.StringType(),
    }
    for kinds, kind in want.items():
        assert all(lattice.join_kinds(p) == kind for p in permutations(kinds))


def test_wider_numbers_go_to_the_next_column(load):
    rows, dead = load(
        ['{"n":1.5}'], ['{"n":900000000000000001}'], ['{"n":0.12345678901234567890}'], ['{"n":"abc"}'], ['{"n":true}']
    )
    assert dead == [] and rows.columns == ["n", "n_V2"]
    got = {(r.n, r.n_V2) for r in rows.collect()}
    assert got == {
        (Decimal("1.5"), None), (Decimal(900000000000000001), None), (None, "0.12345678901234567890"),
        (None, "abc"), (None, "true"),
    }


def test_a_column_for_each_conflict(load):
    rows, dead = load(['{"n":1}'], ['{"n":2.5}', '{"n":7}'], ['{"n":"x"}', '{"n":3.5}', '{"n":null}'], ['{"n":[1,{"a":2.50}]}'])
    assert dead == [] and [(f.name, f.dataType.simpleString()) for f in rows.schema] == [
        ("n", "bigint"), ("n_V2", "decimal(38,18)"), ("n_V3", "string")
    ]
    got = sorted(map(str, ((r.n, r.n_V2 and float(r.n_V2), r.n_V3) for r in rows.collect())))
    assert got == sorted(map(str, [
        (1, None, None), (None, 2.5, None), (7, None, None), (None, None, "x"), (None, 3.5, None),
        (None, None, None), (None, None, '[1,{"a":2.50}]'),
    ]))


def test_nested_values_of_any_shape_stay_whole(load):
    sent = ['{"x":1}', '{"x":2,"y":3}', '{"x":"t","z":[1,null,{"X":1.5}]}']
    rows, dead = load(*[['{"o":%s}' % s] for s in sent])
    assert dead == [] and rows.schema["o"].dataType == T.VariantType()
    assert {json.dumps(json.loads(r[0]), sort_keys=True) for r in rows.select(F.to_json("o")).collect()} == {
        json.dumps(json.loads(s), sort_keys=True) for s in sent
    }
    rows, dead = load(['{"o":{"long":1.%s}}' % ("7" * 50)])
    assert [r.o_V2 for r in rows.filter("o_V2 IS NOT NULL").collect()] == ['{"long":1.%s}' % ("7" * 50)]


def test_what_has_no_place_is_a_letter(load):
    rows, dead = load(
        ['{"n":2,"N":3}', '{"ID":1,"ingest_batch":5}', "{broken", "[1]", '{"n":1}'],
        ['{"n":"text","n_V2":"own"}', '{"n_v2":"own too"}'],
    )
    assert sorted(reason for _, reason in dead) == ["bad field", "malformed", "malformed", "repeated field", "unknown field"]
    assert {v for v, r in dead if r == "bad field"} == {'{"n":"text","n_V2":"own"}'}
    assert {(r.n, r.n_V2) for r in rows.collect()} == {(1, None), (None, "own too")}


def test_poison_does_not_stop_a_declared_table(spark, texts, tmp_path):
    table = f"declared_{uuid.uuid4().hex}"
    tables.create_table(
        spark, table, T.StructType.fromDDL("n int, d double, at timestamp, o struct<a: int>, l array<int>, s string"),
        str(tmp_path / "t"),
    )
    batch = [
        '{"n":5,"d":0.1,"at":"2024-01-01 10:00:00","o":{"a":1},"l":[1],"s":5}',
        '{"n":3000000000,"d":0.12345678901234567,"at":"soon","o":{"a":1,"b":2},"l":["x"],"s":null}',
    ]
    body = bodies.staged_load_body(table, str(tmp_path / "stage"))
    body(texts(*batch).select("value"), 0)
    body(texts(*batch).select("value"), 0)
    rows = spark.table(table).orderBy(F.col("n").isNull()).collect()
    assert len(rows) == 2 and (rows[0].n, rows[0].d, rows[0].o.a, rows[0].l, rows[0].s) == (5, 0.1, 1, [1], "5")
    late = rows[1]
    assert (late.n, late.d, late["at"], late.o, late.l) == (None,) * 5
    assert late.n_V2 == 3_000_000_000 and late.d_V2 == Decimal("0.12345678901234567") and late.at_V2 == "soon"
    assert late.o_V2.toPython() == {"a": 1, "b": 2} and late.l_V2.toPython() == ["x"]
    assert spark.table(table + "_dead").count() == 0
    tables.drop_table(spark, table)


def test_nothing_to_load(load, spark):
    rows, dead = load(["{}", '{"a":null}', "{broken"])
    assert rows is None and sorted(r for _, r in dead) == ["malformed", "no field", "no field"]


def test_line_breaks_between_tokens(load):
    rows, dead = load(['{"a":\n 1,\r\n"b":"x\\ny"}'])
    assert dead == [] and [(r.a, r.b) for r in rows.collect()] == [(1, "x\ny")]


def test_two_writers_share_a_folder(spark, texts, tmp_path, monkeypatch):
    from weirflow.sinks import files

    for writer in ("one", "two", "one"):
        monkeypatch.setattr(files, "stream_id", lambda spark, w=writer: w)
        lines = texts(f"{writer} job").withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
        files.write_window_text(lines, F.col("at"), str(tmp_path / "text"), batch_id=0)
        files.write_by_day(lines.withColumn("s", F.lit(0)), "s", str(tmp_path / "day"), batch_id=0)
        files.stage_text(lines, str(tmp_path / "stage"), 0)
    for kind, read in (("text", spark.read.text), ("stage", spark.read.text), ("day", spark.read.parquet)):
        assert sorted(r.value for r in read(str(tmp_path / kind)).collect()) == ["one job", "two job"]

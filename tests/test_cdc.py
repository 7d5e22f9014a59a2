import json

from pyspark.sql import types as T

from weirflow.operators import cdc

BIG = 901807788764659968


def message(kind, rows, ts=1, es=1, table="T", database="D", **more):
    body = {"table": table, "database": database, "type": kind, "ts": ts, "es": es, "data": rows}
    return json.dumps({**body, "pkNames": ["ID"], **more})


def changes(texts, *messages):
    return cdc.changed_records(cdc.parse_changes(texts(*messages), ["seq"]), "seq")


def test_one_row_per_record_with_exact_ids(texts):
    rows = changes(texts, message("insert", [{"ID": BIG, "v": 1.5}, {"ID": BIG + 1, "v": None}]))
    found = rows.orderBy("pos").collect()
    assert [r["record"]["ID"] for r in found] == [str(BIG), str(BIG + 1)]
    assert {r["change_type"] for r in found} == {"UPSERT"}
    assert {r["destination"] for r in found} == {"D.T"}


def test_change_types(texts):
    kinds = ["INSERT", "update", "Delete", "TRUNCATE", None]
    rows = changes(texts, *[message(k, [{"ID": i}]) for i, k in enumerate(kinds)])
    assert [r["change_type"] for r in rows.orderBy("arrival").collect()] == [
        "UPSERT", "UPSERT", "DELETE", None, None,
    ]


def test_ddl_null_and_bad_messages(texts):
    parsed = cdc.parse_changes(
        texts(
            message("INSERT", [{"ID": 1}], isDdl=True),
            message("INSERT", None),
            message("INSERT", []),
            message("INSERT", [{"ID": 2}], database=None),
            message("CREATE", None, database=None, isDdl=True),
            "{",
            "",
        ),
        ["seq"],
    )
    assert cdc.changed_records(parsed, "seq").count() == 0
    reasons = [r["reason"] for r in parsed.orderBy("seq").collect()]
    assert reasons == [None, None, None, "no destination", None, "malformed", "empty"]


def test_marker_field_in_record_does_not_overwrite(texts):
    row = changes(texts, message("DELETE", [{"ID": 1, "_CHANGE_TYPE": "UPSERT"}])).first()
    assert row["change_type"] == "DELETE" and row["record"]["_CHANGE_TYPE"] == "UPSERT"


def test_apply_in_source_order(texts):
    rows = changes(
        texts,
        message("UPDATE", [{"ID": 1, "v": "second"}], ts=2),
        message("INSERT", [{"ID": 1, "v": "first"}], ts=1),
        message("INSERT", [{"ID": 2, "v": "x"}], ts=1),
        message("DELETE", [{"ID": 2}], ts=1, es=2),
        message("INSERT", [{"ID": 3, "v": "a"}, {"ID": 3, "v": "b"}], ts=1),
        message("INSERT", [{"ID": 1, "v": "other table"}], table="U"),
    )
    live = cdc.apply_changes(rows)
    found = {(r["destination"], r["record"]["ID"]): r["record"]["v"] for r in live.collect()}
    assert found == {("D.T", "1"): "second", ("D.T", "3"): "b", ("D.U", "1"): "other table"}


def test_apply_to_target(texts):
    first = changes(texts, message("INSERT", [{"ID": 1, "v": "a"}, {"ID": 2, "v": "b"}], ts=1))
    keyed = first.withColumn("record_key", cdc.record_key(first.pk_names, first.record))
    second = changes(texts, message("DELETE", [{"ID": 1}], ts=5))
    left = cdc.apply_changes(second, keyed).collect()
    assert [r["record"]["ID"] for r in left] == ["2"]


def test_record_columns_ignore_unknown_keys(texts):
    rows = changes(texts, message("INSERT", [{"ID": BIG, "n": "12", "extra": 1}]))
    schema = T.StructType.fromDDL("ID bigint, n int, missing string")
    assert tuple(cdc.record_columns(rows, schema).first()) == (BIG, 12, None)


def test_full_envelope(texts):
    text = message(
        "UPDATE", [{"ID": 1}], old=[{"ID": BIG}], sql="", mysqlType={"ID": "number"}, sqlType={"ID": 3}
    )
    row = cdc.parse_changes(texts(text), ["seq"], cdc.CHANGE_SCHEMA).first()
    assert row["old"] == [{"ID": str(BIG)}] and row["mysqlType"] == {"ID": "number"}
    assert row["sqlType"] == {"ID": 3} and row["reason"] is None
    assert "old" not in cdc.parse_changes(texts(text)).columns


def test_long_fractions_of_records_are_exact(texts):
    text = (
        '{"database":"d","table":"t","type":"INSERT","ts":1,"es":1,"pkNames":["ID"],'
        '"data":[{"ID":1,"PRICE":12345678901234567.89},{"ID":2,"PRICE":null}]}'
    )
    rows = cdc.changed_records(cdc.parse_changes(texts(text), ["seq"]), "seq").collect()
    assert [r["record"]["PRICE"] for r in rows] == ["12345678901234567.89", None]

import json
import random

from pyspark.sql import functions as F

from weirflow.functions.json_text import json_map
from weirflow.operators import cdc, compare


def maps(spark, rows):
    return spark.createDataFrame(rows, "key string, record map<string,string>")


def test_differences(spark):
    left = maps(spark, [("a", {"x": "1", "y": None, "z": "3"}), ("only", {"x": "1"})])
    right = maps(spark, [("a", {"x": "2", "y": None, "w": None}), ("new", {"q": None})])
    found = compare.compare_records(left, right, ["key"]).collect()
    assert {(r["key"], r["field"], r["status"]) for r in found} == {
        ("a", "x", "different"), ("a", "z", "missing"), ("a", "w", "extra"),
        ("only", "x", "missing"), ("new", "q", "extra"),
    }


def test_copies_cancel_out(spark):
    a, b, c = {"x": "1"}, {"x": "2"}, {"x": "3", "y": None}
    left = maps(spark, [("k", a)] * 5 + [("k", b), ("m", a), ("m", b)])
    right = maps(spark, [("k", a)] * 5 + [("k", c), ("m", b), ("m", b), ("m", c)])
    found = {tuple(r) for r in compare.compare_records(left, right, ["key"]).collect()}
    assert found == {
        ("k", "x", "different", "2", "3", 1),
        ("k", "y", "extra", None, None, 1),
        # One record against two: nothing to pair.
        ("m", "x", "missing", "1", None, 1),
        ("m", "x", "extra", None, "2", 1),
        ("m", "x", "extra", None, "3", 1),
        ("m", "y", "extra", None, None, 1),
    }


def test_surplus_copies_are_counted(spark):
    left = maps(spark, [("k", {"x": "1"})] * 7)
    right = maps(spark, [("k", {"x": "1"})] * 4)
    found = compare.compare_records(left, right, ["key"]).collect()
    assert [tuple(r) for r in found] == [("k", "x", "missing", "1", None, 3)]


def golden_record():
    """191 fields in the mix of a real change record: nulls, texts, integers, fractions."""
    rng = random.Random(8)
    kinds = ["null"] * 80 + ["text"] * 65 + ["int"] * 44 + ["fraction"] * 2
    record = {"ID": 736201984455120783, "MADE_AT": "2031-05-06 01:02:03"}
    for i, kind in enumerate(kinds[: 191 - len(record)]):
        record[f"F{i}"] = {
            "null": None, "text": f'te"xt é {i}', "int": rng.randrange(10**15), "fraction": i + 0.25,
        }[kind]
    return record


def test_golden_record_comes_through_unchanged(spark, texts):
    record = golden_record()
    message = {
        "table": "T", "database": "D", "type": "INSERT", "ts": 1765432100123, "es": 1765432100100,
        "isDdl": False, "sql": "", "old": None, "data": [record],
        "pkNames": ["ID", "MADE_AT"], "sqlType": {k: 3 for k in record},
    }
    rows = cdc.changed_records(cdc.parse_changes(texts(json.dumps(message)), ["seq"]), "seq")
    table = rows.select(F.lit("1").alias("key"), "record")
    source = texts(json.dumps(record)).select(F.lit("1").alias("key"), json_map(F.col("value")).alias("record"))
    assert tuple(compare.field_counts(table).first()) == (1, 191)
    assert compare.compare_records(source, table, ["key"]).count() == 0
    kept = table.first()["record"]
    assert kept["ID"] == "736201984455120783" and kept == {
        k: None if v is None else str(v) for k, v in record.items()
    }


def test_as_records(spark):
    df = spark.createDataFrame([(1, "a", None)], "key int, x string, n int")
    assert compare.as_records(df, ["key"]).first()["record"] == {"x": "a", "n": None}


def test_equal_ranges_are_told_by_their_digests(spark):
    rows = [(i % 50, {"v": str(i), "w": None}) for i in range(400)] + [(None, {"v": "x"}), (7, {}), (7, {})]
    left = spark.createDataFrame(rows, "key long, record map<string,string>")
    right = left.repartition(5).orderBy(F.rand(3))

    def differing(a, b):
        a, b = (compare._hashed(d, ["key"], 64) for d in (a, b))
        return {r.range for r in compare.differing_ranges(a, b).collect()}

    assert differing(left, right) == set()
    assert compare.compare_records(left, right, ["key"]).count() == 0
    own = {r.range for r in compare._hashed(left.filter("key = 7"), ["key"], 64).collect()}
    assert differing(left, right.union(left.filter("key = 7").limit(1))) == own  # a copy more
    assert differing(left, right.filter("key IS NULL OR key <> 7")) == own
    changed = right.withColumn("record", F.when(F.col("key") == 7, F.map_concat("record", F.create_map(F.lit("z"), F.lit("1")))).otherwise(F.col("record")))
    assert differing(left, changed) == own

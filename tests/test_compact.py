import uuid

import pytest
from pyspark.sql import functions as F, types as T

from weirflow.sinks import compact, tables


@pytest.fixture(params=["managed", "external", "by day"])
def table(spark, request, tmp_path):
    name = f"compact_{uuid.uuid4().hex}"
    location = str(tmp_path / "t") if request.param == "external" else None
    parts = ["day"] if request.param == "by day" else []
    tables.create_table(spark, name, T.StructType.fromDDL("v bigint, day date"), location, partitions=parts)
    yield name
    tables.drop_table(spark, name)


def batch(spark, number):
    day = F.when(F.col("id") != 2, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")))
    return spark.range(5).select((F.col("id") + 10 * number).alias("v"), day.alias("day"))


def values(spark, table):
    return sorted(r.v for r in spark.table(table).collect())


def fill(spark, table, numbers):
    for number in numbers:
        tables.append_batch(batch(spark, number), table, number)


def want(n):
    return [10 * b + i for b in range(n) for i in range(5)]


def test_many_batches_become_few_folders(spark, table):
    fill(spark, table, range(12))
    before = len(compact._folders(spark, table))
    assert compact.compact(spark, table, fanout=3) == 4  # three of tier 1, one of tier 2
    assert values(spark, table) == want(12)
    after = compact._folders(spark, table)
    assert len(after) <= before // 3 and max(b for _, b, _ in after) == 11
    assert tables.landed_ranges(spark, table, "batch") == [(0, 8, 2)]
    fill(spark, table, [0, 5, 8, 9, 11])  # merged, and not merged: each lands once
    assert values(spark, table) == want(12)
    fill(spark, table, range(12, 20))
    assert compact.compact(spark, table, fanout=3) > 0
    assert values(spark, table) == want(20)
    assert compact.compact(spark, table, fanout=3) == 0


def test_a_lost_run_is_finished_by_the_next(spark, table, monkeypatch):
    fill(spark, table, range(4))
    recover, calls = compact.recover, []

    def lost(*args):
        calls.append(args)
        if len(calls) == 2:  # the merged rows are written and named
            raise RuntimeError("lost")
        return recover(*args)

    monkeypatch.setattr(compact, "recover", lost)
    with pytest.raises(RuntimeError):
        compact.compact(spark, table, fanout=3)
    assert values(spark, table) == want(4)
    monkeypatch.setattr(compact, "recover", recover)
    move = compact._Files.move

    def lost_later(self, name, to):
        move(self, name, to)
        raise RuntimeError("lost again")

    monkeypatch.setattr(compact._Files, "move", lost_later)
    with pytest.raises(RuntimeError):
        compact.recover(spark, table)
    monkeypatch.setattr(compact._Files, "move", move)
    assert compact.recover(spark, table) and not compact.recover(spark, table)
    assert values(spark, table) == want(4)
    assert tables.landed_ranges(spark, table, "batch") == [(0, 2, 1)]


def test_writers_are_merged_apart(spark, table, monkeypatch):
    fill(spark, table, range(4))
    monkeypatch.setattr(tables, "stream_id", lambda spark: "other")
    fill(spark, table, range(4))
    compact.compact(spark, table, fanout=3)
    assert values(spark, table) == sorted(want(4) * 2)
    assert tables.landed_ranges(spark, table, "other") == tables.landed_ranges(spark, table, "batch") == [(0, 2, 1)]

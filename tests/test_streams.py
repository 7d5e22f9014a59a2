import json
import os
import random
import time
import uuid

import pytest
from panes_by_hand import firings, random_ticks
from pyspark.sql import functions as F, types as T

from weirflow.operators import cdc, logs, rows, windows
from weirflow.sinks import tables, upserted
from weirflow.sources.messages import with_fresh_lookup
from weirflow.streaming import batches, bodies, dedup
from weirflow.streaming.panes import pane_stream


class Feed:
    """A folder of JSON files, one micro-batch per file, in the order they were sent."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.sent = spark, folder, schema, 0
        folder.mkdir()

    def send(self, items):
        self.sent += 1
        path = self.folder / f"f{self.sent:04d}.json"
        temporary = self.folder / f".f{self.sent:04d}"
        temporary.write_text("".join(json.dumps(i) + "\n" for i in items))
        os.utime(temporary, (1_700_000_000 + self.sent * 10,) * 2)
        temporary.rename(path)

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.json(str(self.folder))


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, tmp_path / "feed", schema)


@pytest.fixture
def run(tmp_path):
    """Drain a stream into a body; the same progress folder is used on each call."""

    def drain(df, body, mode="append"):
        writer = tables.write_each_batch(df, body, str(tmp_path / "progress"), None, mode)
        query = writer.start()
        query.awaitTermination()

    return drain


@pytest.fixture
def table(spark, tmp_path):
    name = "s_" + "".join(c if c.isalnum() else "_" for c in tmp_path.name)
    yield name
    for suffix in ("", "_dead"):
        tables.drop_table(spark, name + suffix)


SIZE = 60_000


@pytest.mark.parametrize("late_count", [1, 3])
def test_pane_stream_equals_rules(spark, feed, run, table, late_count):
    ticks = random_ticks(random.Random(20 + late_count), SIZE, 14)
    source = feed("dim1 string, at bigint, metrics1 bigint")
    for tick in sorted(ticks):
        source.send([{"dim1": d, "at": at, "metrics1": m} for d, at, m in ticks[tick]])
    events = source.stream().withColumn("ts", F.timestamp_millis("at"))
    panes = pane_stream(events, "ts", SIZE // 1000, 2 * SIZE // 1000, late_count)
    run(panes, bodies.append_body(table))
    found = sorted(
        (
            r["dim1"], int(r["window_start"].timestamp() * 1000), r["timing"], r["pane_idx"],
            r["nonspeculative_idx"], r["is_first"], r["is_last"], r["num_records"], r["sum"],
            r["min"], r["max"], r["acc_num_records"], r["acc_sum"],
        )
        for r in spark.table(table).collect()
    )
    expected = firings(ticks, SIZE, 2 * SIZE, late_count)
    assert any(p[2] == "LATE" for p in expected)
    assert found == sorted(expected)


def test_panes_of_micro_batches_that_hold_several_ticks(spark, feed, run, table):
    ticks = random_ticks(random.Random(5), SIZE, 14)
    source = feed("tick bigint, dim1 string, at bigint, metrics1 bigint")
    for part in (range(5), range(5, 14)):
        source.send([{"tick": t, "dim1": d, "at": at, "metrics1": m} for t in part for d, at, m in ticks.get(t, [])])
    events = source.stream().withColumn("ts", F.timestamp_millis("at"))
    marks, size = table + "_dead", f"{SIZE // 1000} seconds"
    run(events, bodies.pane_parts_body(table, marks, "ts", size, f"{2 * SIZE // 1000} seconds", F.col("tick")))
    panes = windows.tick_panes(spark.table(table), spark.table(marks), size)
    found = sorted(
        (
            r["dim1"], int(r["window_start"].timestamp() * 1000), r["timing"], r["pane_idx"],
            r["nonspeculative_idx"], r["is_first"], r["is_last"], r["num_records"], r["sum"] or 0,
            r["min"], r["max"], r["acc_num_records"], r["acc_sum"],
        )
        for r in panes.collect()
    )
    expected = firings(ticks, SIZE, 2 * SIZE)
    assert {p[2] for p in expected} == {"EARLY", "ON_TIME", "LATE"}
    assert found == sorted(expected)


def test_window_queries_fire_every_half_hour(spark, tmp_path):
    from weirflow.plans.queries import late_drop, window_tall, window_wide

    # By arrival: 1, 2, then 14 (delayed) with 4, which passes the first window's end, 13 (delayed), 3, 26 (delayed).
    sent = [(1, "01 00:10"), (2, "01 00:40"), (14, "01 00:50"), (4, "01 02:10"), (13, "01 00:20"), (3, "03 00:00"), (26, "01 20:00")]
    rows_ = [(i, f"2024-01-{at}:00", 1, "view", 2.0) for i, at in sent]
    df = spark.createDataFrame(rows_, "event_id bigint, ts string, user_id bigint, event_type string, value double")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    tall = window_tall(spark, str(tmp_path)).filter("win_start_ts = 1704067200000").orderBy("pane_idx").collect()
    assert [(r["timing"], r["num_records"]) for r in tall] == [("EARLY", 1), ("EARLY", 2), ("EARLY", 3), ("ON_TIME", 3), ("LATE", 4)]
    wide = window_wide(spark, str(tmp_path)).filter("row_key LIKE '%#1704067200000#%' AND column LIKE 'num%'").collect()
    assert {(r["column"], r["value"]) for r in wide} == {(f"num_records#{i}", "1") for i in (0, 1, 2, 4)}
    timing = {r["seq"]: r["timing"] for r in late_drop(spark, str(tmp_path)).collect()}
    assert timing == {**dict.fromkeys((1, 2, 14, 4, 3), "IN_TIME"), 13: "LATE", 26: "DROPPED"}


def test_update_mode_statistics(spark, feed, run, table):
    source = feed("dim1 string, at bigint, metrics1 bigint")
    base = 1_704_067_200_000
    source.send([{"dim1": "a", "at": base, "metrics1": 4}, {"dim1": "b", "at": base, "metrics1": 1}])
    source.send([{"dim1": "a", "at": base + 1, "metrics1": 6}])
    events = source.stream().withColumn("ts", F.timestamp_millis("at")).withWatermark("ts", "1 hour")
    run(windows.window_stats(events, "ts", "1 minute"), bodies.append_body(table), "update")
    firing_counts = [r["num_records"] for r in spark.table(table).filter("dim1 = 'a'").orderBy("ingest_batch").collect()]
    assert firing_counts == [1, 2]
    last = tables.current_rows(spark, table, ["window_start", "dim1"]).collect()
    assert {r["dim1"]: r["sum"] for r in last} == {"a": 10, "b": 1}


def test_dedup_forgets_keys_after_a_while(spark, feed, run, table):
    source = feed("uuid string, seq bigint")
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(setting, "false")
    try:
        def go(items, ttl=3600):
            source.send(items)
            run(dedup.dedup_stream(source.stream(), "uuid", "seq", ttl), bodies.append_body(table))

        go([{"uuid": "a", "seq": 2}, {"uuid": "a", "seq": 1}, {"uuid": "b", "seq": 3}, {"seq": 4}])
        go([{"uuid": "a", "seq": 5}, {"uuid": "c", "seq": 6}])
    finally:
        spark.conf.set(setting, "true")
    assert {(r["uuid"], r["seq"]) for r in spark.table(table).collect()} == {
        ("a", 1), ("b", 3), ("c", 6),
    }


def test_dedup_ttl_expires(spark, feed, run, table):
    source = feed("uuid string, seq bigint")
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(setting, "false")
    try:
        for seq in (1, 2):
            source.send([{"uuid": "a", "seq": seq}])
            run(dedup.dedup_stream(source.stream(), "uuid", "seq", 1), bodies.append_body(table))
            time.sleep(2)
    finally:
        spark.conf.set(setting, "true")
    assert [r["seq"] for r in spark.table(table).orderBy("seq").collect()] == [1, 2]


def test_dedup_by_a_column_equals_rules(spark, feed, run, table):
    """Micro-batches in order of time, each with many times: a key is free again by those."""
    rng = random.Random(4)
    source = feed("k string, o bigint, s bigint")
    rows_ = [(rng.choice(["hot"] * 5 + ["a", "b"]), i, s) for i, s in enumerate(sorted(rng.sample(range(40_000), 300)))]
    for part in range(3):
        source.send([{"k": k, "o": o, "s": s} for k, o, s in rows_[part * 100 : part * 100 + 100]])
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(setting, "false")
    try:
        timed = source.stream().withColumn("at", F.timestamp_seconds("s"))
        run(dedup.dedup_stream(timed, "k", "o", 300, at="at"), bodies.append_body(table))
    finally:
        spark.conf.set(setting, "true")
    expected, free = set(), {}
    for key, order, at in rows_:
        if key not in free or at >= free[key]:
            free[key] = at + 300
            expected.add((key, order))
    assert {(r["k"], r["o"]) for r in spark.table(table).collect()} == expected


@pytest.fixture
def no_empty_batches(spark):
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, "true")


def test_batches_span_micro_batches(spark, feed, run, table, no_empty_batches):
    source = feed("k string, n bigint")
    for part in range(5):  # with a restart before each
        source.send([{"k": "ab"[i % 3 == 0], "n": part * 40 + i} for i in range(40)] + [{"n": part}])
        run(batches.batch_stream(source.stream(), "k", "n", 30, 3600), bodies.append_body(table))
    got = {(r["key"], r["batch"]): [x["n"] for x in r["rows"]] for r in spark.table(table).collect()}
    for key in "ab":
        sent = [p * 40 + i for p in range(5) for i in range(40) if "ab"[i % 3 == 0] == key]
        whole = [sent[i : i + 30] for i in range(0, len(sent) - 29, 30)]
        assert [got[key, i] for i in range(len(whole))] == whole and (key, len(whole)) not in got
    assert not any(k is None for k, _ in got)  # five rows without a key still wait
    assert {r["closed"] for r in spark.table(table).collect()} == {"full"}


def test_a_batch_closes_after_its_time(spark, feed, run, table, no_empty_batches):
    source = feed("k string, n bigint")
    for n in range(3):
        source.send([{"k": "a", "n": n}])
        run(batches.batch_stream(source.stream(), "k", "n", 30, 1), bodies.append_body(table))
        time.sleep(2)
    found = {r["batch"]: ([x["n"] for x in r["rows"]], r["closed"]) for r in spark.table(table).collect()}
    assert all(closed == "time" for _, closed in found.values())
    assert sorted(n for ns, _ in found.values() for n in ns) in ([0, 1], [0], [0, 1, 2])


def test_late_rows_over_a_restart(spark, feed, run, table):
    source = feed("n bigint, at bigint")
    marks = table + "_dead"
    for part in ([(1, 100), (2, 500)], [(3, 430), (4, 150), (5, 800)], [(6, 500), (7, 790)]):
        source.send([{"n": n, "at": at} for n, at in part])
        df = source.stream().withColumn("ts", F.timestamp_seconds("at"))
        run(df, bodies.late_body(table, marks, "ts", "1 minute", "2 minutes"))
    assert {r["n"]: r["timing"] for r in spark.table(table).collect()} == {
        1: "IN_TIME", 2: "IN_TIME", 3: "LATE", 4: "DROPPED", 5: "IN_TIME", 6: "DROPPED", 7: "IN_TIME",
    }


def test_late_rows_of_a_micro_batch_that_holds_several_ticks(spark, feed, run, table):
    source = feed("n bigint, at bigint, tick bigint")
    marks = table + "_dead"
    for part in ([(1, 100, 0), (2, 500, 0), (3, 430, 1), (4, 150, 1), (5, 800, 1)], [(6, 500, 2), (7, 790, 2), (8, 90, None)]):
        source.send([{"n": n, "at": at, "tick": t} for n, at, t in part])
        df = source.stream().withColumn("ts", F.timestamp_seconds("at"))
        run(df, bodies.late_body(table, marks, "ts", "1 minute", "2 minutes", F.col("tick")))
    assert {r["n"]: r["timing"] for r in spark.table(table).collect()} == {
        1: "IN_TIME", 2: "IN_TIME", 3: "LATE", 4: "DROPPED", 5: "IN_TIME", 6: "DROPPED", 7: "IN_TIME", 8: "DROPPED",
    }


def test_ticks_take_every_row_in_order(spark, run, table):
    from weirflow.plans.queries import ticks

    rows_ = spark.range(50).select(F.when(F.col("id") != 7, F.col("id")).alias("id"))
    run(ticks(rows_, F.call_function("div", F.col("id"), F.lit(20)) - 1, "test"), bodies.append_body(table))
    got = sorted((r["ingest_batch"], -1 if r["id"] is None else r["id"]) for r in spark.table(table).collect())
    assert got == [(0, -1), *((1 + i // 20, i) for i in range(50) if i != 7)]


def test_dedup_in_event_time(spark, feed, run, table):
    source = feed("uuid string, at bigint")
    source.send([{"uuid": "a", "at": 1000}, {"uuid": "a", "at": 1001}, {"uuid": "b", "at": 1000}])
    source.send([{"uuid": "a", "at": 1100}])
    df = source.stream().withColumn("ts", F.timestamp_seconds("at"))
    run(dedup.dedup_event_time(df, "uuid", "ts"), bodies.append_body(table))
    assert spark.table(table).count() == 2


LOG = '{"timestamp":"2025-01-02T03:04:0%d.678Z","trace_id":"t%d","latency_ms":%d}'


def test_log_stream_with_dead_letters_and_restart(spark, feed, run, table):
    source = feed("value string, seq bigint")
    source.send([{"value": LOG % (1, 1, 1), "seq": 1}, {"value": "{x", "seq": 2}])
    run(source.stream(), bodies.log_body(table, table + "_dead", ["seq"]))
    source.send([{"value": LOG % (2, 2, 2), "seq": 3}])
    run(source.stream(), bodies.log_body(table, table + "_dead", ["seq"]))
    assert {r["seq"] for r in spark.table(table).collect()} == {1, 3}
    assert [(r["seq"], r["reason"]) for r in spark.table(table + "_dead").collect()] == [(2, "malformed")]


def test_failed_batch_is_run_again_without_doubles(spark, feed, run, table):
    source = feed("value string, seq bigint")
    source.send([{"value": LOG % (1, 1, 1), "seq": 1}])
    good = bodies.log_body(table, keep=["seq"])

    def fails(batch, batch_id):
        good(batch, batch_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        run(source.stream(), fails)
    run(source.stream(), good)
    assert spark.table(table).count() == 1


def test_upsert_stream(spark, feed, run):
    name = f"upserted_{uuid.uuid4().hex}"
    source = feed("value string, seq bigint")
    source.send([{"value": LOG % (1, 1, 1), "seq": 1}, {"value": LOG % (1, 1, 2), "seq": 2}])
    source.send([{"value": LOG % (1, 1, 9), "seq": 0}, {"value": LOG % (1, 2, 4), "seq": 4}])
    parse = lambda b: logs.good_rows(logs.parse_logs(b, ["seq"]))
    run(source.stream(), bodies.upsert_body(name, ["trace_id"], "seq", parse))
    found = spark.sql(f"SELECT * FROM {name}").collect()
    assert {r["trace_id"]: r["latency_ms"] for r in found} == {"t1": 9, "t2": 4}
    upserted.drop(spark, upserted.UpsertTable(name, [], []))


def test_change_stream_equals_batch(spark, feed, run, table, tmp_path):
    rng = random.Random(5)
    source = feed("value string, seq bigint")
    everything = []
    for part in range(3):
        batch = []
        for i in range(20):
            body = {
                "table": "T", "database": "D", "type": rng.choice(["INSERT", "UPDATE", "DELETE"]),
                "ts": rng.randrange(5), "es": rng.randrange(3), "pkNames": ["ID"],
                "data": [{"ID": rng.randrange(8), "v": rng.random()} for _ in range(rng.randint(0, 3))],
            }
            batch.append({"value": json.dumps(body), "seq": part * 100 + i})
        source.send(batch)
        everything += batch
    run(source.stream(), bodies.change_body(table, "seq", table + "_dead"))
    streamed = bodies.current_records(spark.table(table))
    whole = spark.createDataFrame([(b["value"], b["seq"]) for b in everything], "value string, seq bigint")
    applied = cdc.apply_changes(cdc.changed_records(cdc.parse_changes(whole, ["seq"]), "seq"))
    as_set = lambda df: {(r["record"]["ID"], r["record"]["v"]) for r in df.collect()}
    assert as_set(streamed) == as_set(applied)
    target = bodies.change_table(f"now_{uuid.uuid4().hex}", buckets=3)
    tables.write_each_batch(
        source.stream(), bodies.applied_change_body(target, "seq", table + "_dead"), str(tmp_path / "applied"), None
    ).start().awaitTermination()
    assert as_set(spark.sql(f"SELECT * FROM {target.name}")) == as_set(applied)
    upserted.drop(spark, target)


def test_two_streams_share_a_table(spark, table, tmp_path):
    for name in ("one", "two"):
        folder = str(tmp_path / name)
        spark.createDataFrame([(name,)], "value string").write.parquet(folder)
        rows = spark.readStream.schema("value string").parquet(folder)
        for _ in range(2):  # draining again changes nothing
            tables.write_each_batch(
                rows, bodies.append_body(table), str(tmp_path / f"progress-{name}"), None
            ).start().awaitTermination()
    assert {r["value"] for r in spark.table(table).collect()} == {"one", "two"}
    assert spark.table(table).select("ingest_writer").distinct().count() == 2


def test_drift_stream_widens_between_batches(spark, feed, run, table):
    tables.create_table(spark, table, T.StructType.fromDDL("ID string"))
    source = feed("value string")
    for extra in ({}, {"A": "1"}, {"A": "2", "B": "3"}):
        source.send([{"value": json.dumps({"ID": f"r{i}", **extra})} for i in range(3)])
    run(source.stream(), bodies.healing_body(table))
    found = spark.table(table).groupBy("ingest_batch", "A", "B").count().collect()
    assert {(r["A"], r["B"]): r["count"] for r in found} == {
        (None, None): 3, ("1", None): 3, ("2", "3"): 3,
    }


def test_lookup_is_read_again_per_batch(spark, feed, run):
    source = feed("dim1 string")
    versions = iter(["one", "two"])
    seen = []

    def load():
        return spark.createDataFrame([("a", next(versions))], "dim1 string, dim1_val string")

    def apply(batch, lookup, batch_id):
        seen.extend(r["dim1_val"] for r in rows.with_lookup(batch, lookup, "dim1", "dim1_val").collect())

    source.send([{"dim1": "a"}])
    source.send([{"dim1": "a"}])
    run(source.stream(), with_fresh_lookup(load, apply))
    assert seen == ["one", "two"]


def test_write_cadence(spark, feed, tmp_path):
    source = feed("value string")
    source.send([{"value": "x"}])
    got = []
    writer = tables.write_each_batch(
        source.stream(), lambda b, i: got.append(b.count()), str(tmp_path / "p"), seconds=1
    )
    query = writer.start()
    query.processAllAvailable()
    query.stop()
    assert got == [1]

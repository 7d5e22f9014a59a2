from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from weirflow.operators import windows
from weirflow.streaming import jobs
from weirflow.streaming.panes import PANES

def test_late_rows_by_a_watermark(spark):
    base = datetime(2024, 1, 1)
    rows = [(i, base + timedelta(seconds=10 * i)) for i in range(60)]
    df = spark.createDataFrame(rows, "n long, ts timestamp")

    def timings(watermark):
        marked = windows.mark_late(df, "ts", "1 minute", "2 minutes", watermark)
        return {r["n"]: r["timing"] for r in marked.collect()}

    assert set(timings(None).values()) == {"IN_TIME"}
    mark = base + timedelta(minutes=5)
    for n, timing in timings(mark).items():
        end = rows[n][1].replace(second=0) + timedelta(minutes=1)
        want = "DROPPED" if mark >= end + timedelta(minutes=2) else "LATE" if mark >= end else "IN_TIME"
        assert timing == want


def test_stats_are_64_bit(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:01' AS ts, 'a' AS dim1, 2147483647L AS metrics1")
    row = windows.window_stats(df.union(df), "ts", "5 minutes").first()
    assert (row["num_records"], row["sum"], row["avg"]) == (2, 4294967294, 2147483647.0)


def test_stats_combine_before_the_shuffle(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:01' AS ts, 'a' AS dim1, 1L AS metrics1")
    stats = windows.window_stats(df, "ts", "5 minutes")
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan
    physical = stats._jdf.queryExecution().sparkPlan().toString()
    assert "partial_sum" in physical and "partial_count" in physical


def test_tall_and_wide_forms(spark):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1)
    panes = spark.createDataFrame(
        [
            ("a", start, end, "EARLY", 0, -1, True, False, 2, 10, 4, 6, 2, 10, 4, 6),
            ("a", start, end, "EARLY", 1, -1, False, False, 1, 1, 1, 1, 3, 11, 1, 6),
        ],
        PANES,
    )
    tall = windows.tall_rows(panes, process_ts=F.lit(1000)).orderBy("pane_idx").collect()
    assert [(r["row_key"], r["sum"], r["num_records"]) for r in tall] == [
        ("a#9223372036854774807", 10, 2),
        ("a#9223372036854774807", 11, 3),
    ]
    wide = windows.wide_rows(panes).first()
    assert wide["row_key"] == "a#1704067200000#1704067260000"
    assert wide["cells"]["sum#0"] == "10" and wide["cells"]["sum#1"] == "1"
    assert wide["cells"]["avg#0"] == "5.0"
    pivot = windows.wide_pivot(panes, [0, 1]).first()
    assert (pivot["0_sum"], pivot["1_sum"], pivot["1_num_records"]) == (10, 1, 1)


def test_failures_in_processing_time_windows(spark, texts):
    stamped = jobs.stamp_ingest(texts("bad", "worse"))
    counted = windows.with_window(stamped, "ingested", "10 minutes").groupBy("window").count()
    row = counted.first()
    assert row["count"] == 2
    assert row["window"]["start"] <= datetime.now(UTC).replace(tzinfo=None) + timedelta(minutes=1)

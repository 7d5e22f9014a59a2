from datetime import datetime

from weirflow.operators import logs
from weirflow.operators.rows import latest_by

GOOD = (
    '{"timestamp":"2025-01-02T03:04:05.678Z","severity":"INFO","service":"s","message":"m",'
    '"trace_id":"t1","request_details":{"method":"GET","http_status":200,"other":1},"latency_ms":45}'
)


def test_good_row(texts):
    row = logs.good_rows(logs.parse_logs(texts(GOOD))).first()
    assert row.asDict() == {
        "timestamp": "2025-01-02 03:04:05",
        "severity": "INFO",
        "service": "s",
        "message": "m",
        "trace_id": "t1",
        "request_details": '{"method":"GET","http_status":200}',
        "latency_ms": 45,
    }


def test_milliseconds_kept(texts):
    row = logs.good_rows(logs.parse_logs(texts(GOOD), millis=True)).first()
    assert row["timestamp"] == datetime(2025, 1, 2, 3, 4, 5, 678000)


def test_absent_details_are_the_text_null(texts):
    row = logs.good_rows(logs.parse_logs(texts('{"timestamp":"2025-01-02T03:04:05Z"}'))).first()
    assert row["request_details"] == "null" and row["latency_ms"] is None


def test_reasons(texts):
    bad = texts(
        GOOD,
        "",
        None,
        "null",
        "{broken",
        '{"severity":"INFO"}',
        '{"timestamp":"soon"}',
        '{"timestamp":"2025-01-02T03:04:05Z","latency_ms":"slow"}',
    )
    parsed = logs.parse_logs(bad, ["seq"])
    reasons = [r["reason"] for r in parsed.orderBy("seq").collect()]
    assert reasons == [
        None, "empty", "empty", "empty", "malformed", "no timestamp", "bad timestamp", "malformed",
    ]
    dead = logs.dead_letters(parsed, ["seq"]).orderBy("seq").collect()
    assert [(r["seq"], r["reason"]) for r in dead] == [
        (4, "malformed"), (5, "no timestamp"), (6, "bad timestamp"), (7, "malformed"),
    ]
    assert dead[0]["value"] == "{broken"


def test_sql_over_rows(texts):
    parsed = logs.good_rows(logs.parse_logs(texts(GOOD, GOOD.replace("INFO", "DEBUG"))))
    out = logs.sql_over(parsed, "SELECT * FROM PCOLLECTION WHERE severity != 'DEBUG'")
    assert [r["severity"] for r in out.collect()] == ["INFO"]


def test_upsert_last_arrival_wins(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "keep")], "k string, seq int, v string")
    batch = spark.createDataFrame([("a", 5, "new"), ("a", 4, "mid"), ("c", 6, "add")], target.schema)
    out = {r["k"]: r["v"] for r in logs.upsert_rows(batch, ["k"], ["seq"], target).collect()}
    assert out == {"a": "new", "b": "keep", "c": "add"}


def test_latest_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 AS k", "id AS v")
    plan = latest_by(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")


def test_parse_runs_once(texts):
    plan = (
        logs.good_rows(logs.parse_logs(texts(GOOD)))
        .filter("severity = 'INFO'")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert plan.count("from_json(") == 1

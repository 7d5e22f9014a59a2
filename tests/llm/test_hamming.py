import random

import pytest

from weirflow.llm import hamming

COLUMNS = "vec_id bigint, embedding array<float>, rank string, seg string"


def brute(rows, bits, k, every):
    code = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and len(v) == bits:
            code[i] = tuple(x is not None and x == x and x > 0 for x in v)
    out = set()
    for q in code:
        if q % every == 0:
            order = sorted((sum(a != b for a, b in zip(code[q], code[c])), c) for c in code)
            out |= {(q, n, c, d) for n, (d, c) in enumerate(order[:k], 1)}
    return out


@pytest.mark.parametrize("bits,n,k", [(64, 400, 10), (128, 60, 3), (16, 300, 5), (8, 3, 5)])
def test_all_queries_equal_brute_force(spark, bits, n, k):
    draw = random.Random(bits)
    hub = [draw.uniform(-1, 1) for _ in range(bits)]
    rows = []
    for i in range(n):
        if i % 5 == 0:
            v = hub  # many copies
        elif i % 5 == 1:
            v = [x if draw.random() > 0.1 else -x for x in hub]
        else:
            v = [draw.uniform(-1, 1) for _ in range(bits)]
        rows.append((i, v, "x", "y"))
    rows += [(None, hub, "x", "y"), (n, None, "x", "y"), (n + 1, hub[1:], "x", "y"), (n + 2, [float("nan"), None, *hub[2:]], "x", "y")]
    rows += rows[:3]
    vectors = spark.createDataFrame(rows, COLUMNS)
    got = hamming.nearest(vectors, vectors.where("vec_id % 10 = 0").dropDuplicates(["vec_id"]), "vec_id", "embedding", bits, k)
    assert {tuple(r) for r in got.collect()} == brute(rows, bits, k, 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], COLUMNS)
    some = spark.createDataFrame([(1, [1.0] * 64, "x", "y")], COLUMNS)
    assert hamming.nearest(none, none, "vec_id", "embedding", 64, 3).count() == 0
    assert hamming.nearest(none, some, "vec_id", "embedding", 64, 3).count() == 0
    assert hamming.nearest(some, some, "vec_id", "embedding", 64, 3).count() == 1


def test_what_is_looked_up_is_not_broadcast(spark, monkeypatch):
    draw = random.Random(1)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(64)], "x", "y") for i in range(300)]
    vectors = spark.createDataFrame(rows, COLUMNS)
    plans, keep = [], hamming.materialize

    def watched(df, label):
        if label == "best":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(hamming, "materialize", watched)
    got = hamming.nearest(vectors, vectors.where("vec_id % 10 = 0"), "vec_id", "embedding", 64, 10)
    assert {tuple(r) for r in got.collect()} == brute(rows, 64, 10, 10)
    # Queries are few rows, the values they look up at a radius are up to 12,870 times as many.
    assert plans and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)

import itertools
import random
import re

import pytest

from weirflow.llm import neardup

COLUMNS = "doc_id bigint, text string, cid bigint, k1 string"


def corpus(seed, groups=12):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(4))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(draw.choice([3, 30, 80]))]
        for _ in range(draw.randint(1, 6)):
            own = list(base)
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = word()
            texts.append(" ".join(own))
    return texts


def by_hand(rows):
    grams = {}
    for i, text, *_ in rows:
        w = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(w))
        grams[i] = {tuple(w[a : a + n]) for a in range(len(w) - n + 1)} if w else set()
    root, links = {i: i for i in grams}, dict.fromkeys(grams, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(grams), 2):
        both = len(grams[a] & grams[b])
        if both and both >= 0.8 * len(grams[a] | grams[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (find(i), links[i]) for i in grams}


def frame(spark, texts):
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_and_links_equal_all_pairs(spark, seed):
    texts = corpus(seed) + [None, "", "...", "One", "one!", "x " * 30_000, "x " * 30_000]
    rows, docs = frame(spark, texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.jaccard_join(docs).collect()}
    assert got == by_hand(rows)


def test_large_groups_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 8)
    draw = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        own = list(base)
        own[draw.randrange(120)] = f"n{i}"
        texts.append(" ".join(own))
    rows, docs = frame(spark, texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.jaccard_join(docs).collect()}
    assert got == by_hand(rows)


def test_one_of_each_group_stays(spark):
    texts = corpus(4) + [None, "", "!!"]
    rows, docs = frame(spark, texts)
    kept = sorted(r.doc_id for r in neardup.keep_one(docs.union(docs)).collect())
    assert kept == sorted({root for root, _ in by_hand(rows).values()})
    assert neardup.keep_one(docs).columns == docs.columns


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f", 0, "x"), (None, "a b c d e f", 0, "x"), (None, "q r s", 0, "x"), (7, "q r s", 0, "x")]
    got = neardup.jaccard_join(spark.createDataFrame(rows, COLUMNS)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == [
        ("7", "7", 1), ("None", "7", 1), ("None", "None", 1), ("None", "None", 1)
    ]
    empty = spark.createDataFrame([], COLUMNS)
    assert neardup.jaccard_join(empty).count() == 0 and neardup.keep_one(empty).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (200, 200)]
    got = neardup.components(spark.createDataFrame(edges, "node bigint, parent bigint")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.9), (0.9, 0.999)):
        bands, rows = neardup.choose_bands(threshold, recall, 200)
        assert bands * rows <= 200 and 1 - (1 - threshold**rows) ** bands >= recall


def test_components_of_a_hub_and_of_chains(spark):
    draw = random.Random(6)
    edges = [(i, 0) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 2000), (2000, 3)]
    draw.shuffle(edges)
    frame = spark.createDataFrame(edges, "node bigint, parent bigint").repartition(3)
    got = {r.node: r.root for r in neardup.components(frame).collect()}
    want = {i: 0 for i in range(1, 400)} | {2000: 0} | {i: 1000 for i in range(1001, 1061)}
    assert got == want

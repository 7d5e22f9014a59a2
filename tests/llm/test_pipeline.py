"""The pipeline against brute force on a small corpus, and its stages on odd rows."""

import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from weirflow.llm import decontam, lines
from weirflow.llm.tokens import default_vocabulary

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(seed=5):
    """Documents, labels and benchmark with something for every stage to find."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefghijklm", k=draw.randrange(3, 8))) for _ in range(3000)]
    words = lambda n: draw.choices(vocabulary, k=n)
    said = lambda n: " ".join(words(n)) + "."
    bench = [(i, " ".join(words(25))) for i in range(8)] + [(20, None), (21, "two words")]
    texts = []
    for i in range(160):
        page = [said(12) for _ in range(draw.randrange(3, 9))]
        if i % 9 == 0:
            page[draw.randrange(len(page))] = f"You {draw.choice(['vile', 'rotten'])} thing."
        if i % 3 == 0:
            page.insert(0, "Home About Contact")
        if i % 17 == 5:
            own = bench[i % 8][1].split()
            for _ in range(i % 4):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            page.append(" ".join(own))
        texts.append("\n".join(page))
    base = [said(12) for _ in range(10)]
    for i in range(24):  # near copies of one page
        own = list(base)
        own[draw.randrange(10)] = said(12)
        texts.append("\n".join(own))
    texts += [texts[1], texts[2], None, "", "\n\n", " ".join(words(6000))]
    docs = [(i, t, "xx", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, 1, int(bool(re.search("vile|rotten", t or "")))) for i, t in enumerate(texts) if i % 2 == 0]
    return docs, labels, bench


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def without_lines(docs):
    pages = defaultdict(set)
    for _, text, _, source, _ in docs:
        if text is not None:
            pages[source].add(text)
    bad = defaultdict(set)
    for source, own in pages.items():
        holders = defaultdict(set)
        for text in own:
            for line in {x.strip(" \t\r") for x in text.split("\n")} - {""}:
                holders[line].add(text)
        for line, some in holders.items():
            # Near copies of one page count as one: here, those it shares nearly all lines with.
            seen = []
            for text in sorted(some):
                mine = grams(text)
                if not any(len(mine & o) >= 0.6 * len(mine | o) for o in seen):
                    seen.append(mine)
            if len(own) >= lines.MIN_PAGES and len(seen) >= lines.MIN_LINE_PAGES and len(seen) > lines.RATIO * len(own):
                bad[source].add(line)
    out = []
    for i, text, lang, source, _ in docs:
        if text is not None:
            text = "\n".join(x for x in text.split("\n") if x.strip(" \t\r") not in bad[source])
        out.append((i, text, lang, source, None if text is None else len(text)))
    return out


def one_of_each(docs):
    sets = {i: grams(t) for i, t, *_ in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(i for i in sets if sets[i]), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [d for d in docs if find(d[0]) == d[0]]


def aligned(item, text):
    a, b = (re.findall(r"\w+", t.lower()) for t in (item, text))
    above, best = [0] * (len(b) + 1), 0
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best / (2 * len(a))


def uncontaminated(docs, bench):
    items = [t for _, t in bench if t and len(t.split()) >= decontam.LEAST_WORDS]
    return [d for d in docs if not any(aligned(t, d[1] or "") >= decontam.THRESHOLD for t in items)]


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs, labels, bench = corpus()
    folder = str(tmp_path)
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")

    clean = [d for d in docs if not re.search("vile|rotten", d[1] or "")]
    stripped = without_lines(clean)
    kept = one_of_each(stripped)
    want = [clean, stripped, kept, uncontaminated(kept, bench)]
    assert len(docs) > len(clean) > len(kept) > len(want[3]) and stripped != clean

    got = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), rows in zip(corpus_pipeline.STAGES, want):
        got = corpus_pipeline.materialize(stage(spark, got, folder), f"test-{name}")
        assert sorted(map(tuple, got.collect())) == sorted(rows), name
    packed = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(default_vocabulary())
    lengths = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t, *_ in want[3]}
    found, used = defaultdict(int), defaultdict(int)
    for r in packed:
        found[r.doc_id] += r.length
        used[r.sequence_id] += r.length
    assert dict(found) == lengths and max(used.values()) <= 2048
    assert len(used) == -(-sum(lengths.values()) // 2048)  # as few as can be


@pytest.mark.parametrize("stage", range(5))
def test_odd_rows_pass_every_stage(spark, tmp_path, stage):
    names = ["_rid", "_t1", "_ld_host", "row", "host", "body", "found", "kept", "n_lines", "score", "words", "piece", "length", "k1", "cid"]
    odd = [(None, None, None, None, None), (1, "", "x", None, 0), (1, "", "x", None, 0), (2, "💡 \x01 ok", None, "s", 3)]
    odd += [(3, "word" * 300_000, "x", "s", 1), (4, "same text here for all\nand more", "x", "s", 1), (4, "same text here for all\nand more", "x", "s", 1)]
    odd += [(None, "no id but a text of some words", "x", "s", None)]
    rows = [(*r, *[f"{n}-{i}" for n in names]) for i, r in enumerate(odd)]
    frame = spark.createDataFrame(rows, COLUMNS + "".join(f", `{n}` string" for n in names))
    folder = str(tmp_path)
    spark.createDataFrame([(4, 1, 0), (None, None, None), (3, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, "no item with such words in it"), (1, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    name, run = corpus_pipeline.STAGES[stage]
    got = run(spark, frame, folder)
    if name == "packing":
        assert got.select("doc_id").distinct().count() == len({r[0] for r in odd})
        return
    assert got.columns == frame.columns
    back = sorted(map(repr, map(tuple, got.drop("n_chars").collect())))
    want = [r[:4] + r[5:] for r in rows]
    if name == "near_duplicates":
        # One of each repeated row; which of two rows equal in id and text is not told.
        assert len(back) == 6 and set(back) <= set(map(repr, want))
    else:
        assert back == sorted(map(repr, want))

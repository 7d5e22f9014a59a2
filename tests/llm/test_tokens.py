import random
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from weirflow.llm import packing, simple8b, tokens  # noqa: E402

VOCABULARY = tokens.default_vocabulary()
ODD = [
    None, "", " ", "\n\n", "It's we'll DON'T 'tis ''s", "İstanbul ŉ ǅ Ⅷ x²½ ªº", "a b\xa0c\x1cd\x85e\x0bf",
    "<|endoftext|> x<|startoftext|>y <|", "日本語 テキスト🙂🙂 é ́a", "ΣΑΣ ς", "a_b-c.d,e;;f!!! 123 4.5 $$$a***",
    "Ÿ ſ ß ẞ K Å", "x" * 500, "</w> <w>", "tab\tand\rreturn", "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(library):
    draw = random.Random(1)
    made = ["".join(draw.choice("aeThn .,'!?éÜß1_-\n") for _ in range(draw.randint(1, 80))) for _ in range(400)]
    encoder = tokens.Encoder(VOCABULARY, limit=50)  # a full table too
    for text, ids in zip(ODD + made, encoder.batch(ODD + made)):
        assert ids.tolist() == library(text), text


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_words_round_trip(n):
    draw = np.random.default_rng(n)
    for high in (1, 2, 50, 40_000, 2**31, 2**60, 2**64 - 1):
        ids = draw.integers(0, high, n, dtype=np.uint64, endpoint=True)
        ids[n // 3 : n // 2] = 0
        assert (simple8b.unpack_words(*simple8b.pack_words(ids), n) == ids).all()


def test_blocks_decode_alone():
    ids = np.arange(2000, dtype=np.uint64) * np.uint64(31)
    words, firsts, escapes = simple8b.pack_words(ids)
    third = words[int(firsts[2]) : int(firsts[3])]
    got = simple8b.unpack_words(third, np.zeros(1, np.uint64), escapes, simple8b.BLOCK)
    assert (got == ids[1024:1536]).all()


def frame(spark):
    texts = ODD + [f"document number {i} of many words" for i in range(200)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (3, None, "x"), (3, None, "x")]
    draw = random.Random(2)
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(3)


def test_files_read_back_in_order(spark, library, monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", 300)
    rows, docs = frame(spark)
    got = simple8b.round_trip(docs, VOCABULARY, 2).collect()
    want = sorted(
        (-1 if d is None else d, len(ids := library(t) + [2]), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, t, _ in rows
    )
    ordered = sorted(got, key=lambda r: r.start)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)


def test_no_files_for_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simple8b.round_trip(empty, VOCABULARY, 2).count() == 0
    assert packing.pack_documents(empty, VOCABULARY).count() == 0


def test_pieces_fill_sequences(spark, library):
    rows, docs = frame(spark)
    got = packing.pack_documents(docs, VOCABULARY).collect()
    total = sum(len(library(t)) + 1 for _, t, _ in rows)
    assert sum(r.length for r in got) == total
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        assert sum(n for _, n in own) <= 2048
    assert len(places) <= -(-total // 2048) + 1
    whole = {d: library(t) + [0] for d, t, _ in rows if d is not None and d != 3}
    for r in got:
        if r.doc_id in whole:
            part = np.array(whole[r.doc_id][r.start : r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32


def test_sequences_are_put_together(spark):
    pieces = packing.token_pieces(frame(spark)[1], VOCABULARY, capacity=64, keep_ids=True)
    packed = packing.pack(pieces, ["doc_id", "piece", "ids"], 64)
    got = packing.sequences(packed).collect()
    assert all(0 < len(r.ids) <= 64 for r in got)
    assert sum(len(r.ids) for r in got) == pieces.selectExpr("sum(length)").first()[0]


def test_fullest_is_the_best_of_all_sums():
    draw = random.Random(6)
    for _ in range(200):
        items = [draw.randint(1, 30) for _ in range(draw.randint(0, 9))]
        room = draw.randint(0, 60)
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums if s + n <= room}
        chosen = packing.fullest({n: items.count(n) for n in items}, room)
        assert sum(chosen) == max(sums)
        assert all(chosen.count(n) <= items.count(n) for n in chosen)


def test_combinations_use_every_piece_once():
    draw = random.Random(7)
    counts = {n: draw.randint(1, 40) for n in draw.sample(range(1, 101), 30)}
    found = packing.combinations(counts, 100)
    used = dict.fromkeys(counts, 0)
    for uses, repeats in found:
        assert sum(n * u for n, u in uses) <= 100
        for n, u in uses:
            used[n] += u * repeats
    assert used == counts

"""Fill-in-middle: the table of pieces, and documents against plain string work."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from weirflow.llm import piece_table
from weirflow.llm.piece_table import PieceTable, Rates


def by_hand(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def run(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return piece_table.restored(
        piece_table.transformed(frame).withColumn("written", F.col("output"))
    ).collect()


def check(spark, rows):
    got = run(spark, rows)
    assert sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.written) for r in got))) == sorted(
        map(repr, ((i, *by_hand(i, t)) for i, t in rows))
    )
    assert all(r.output_sha256 == hashlib.sha256(r.written.encode()).hexdigest() for r in got)
    assert sorted((repr(r.doc_id), r.restored) for r in got) == sorted((repr(i), t or "") for i, t in rows)
    return got


def test_random_documents(spark):
    rng = random.Random(3)
    letters = ["a", "é", "中", "😀", "é", "\n", "\x00", "<", ">", "P", "S", "M", " "]
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(12)))) for i in range(600)]
    got = check(spark, rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_pieces_describe_the_output(spark):
    frame = spark.createDataFrame([(i, f"é{i} text of some length") for i in range(60)], "doc_id long, text string")
    for r in piece_table.transformed(frame).collect():
        buffers = f"é{r.doc_id} text of some length".encode(), piece_table.SENTINELS
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in r.pieces) == r.output.encode()
        assert len(r.pieces) == (1 if r.form == "plain" else 6)


def test_odd_rows(spark):
    rows = [(None, None), (1, None), (1, ""), (2, "x"), (2, "x"), (None, "null id"), (3, "a <M> b"), (-4, "<P"), (5, ">S>")]
    check(spark, rows)
    assert run(spark, []) == []


def test_very_long_text(spark):
    check(spark, [(i, "wörd " * 400_000) for i in range(4)])


def test_clashing_columns_stay_out(spark):
    names = ["n", "form", "output", "pieces", "body", "_form", "_output"]
    frame = spark.createDataFrame([(1, "some text", *names)], ["doc_id", "text", *names])
    written = piece_table.transformed(frame)
    assert written.columns == ["doc_id", *piece_table.RESULT]
    assert piece_table.restored(written).first().restored == "some text"
    with pytest.raises(ValueError):
        piece_table.transformed(frame, id_column="n")


def test_cuts_and_arrangements_restore():
    rng = random.Random(1)
    for _ in range(200):
        text = bytes(rng.randrange(97, 100) for _ in range(rng.randrange(20)))
        table = PieceTable.of(text)
        for at in sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(5))):
            table = table.cut(at)
            assert table.content() == text
        order = list(range(len(table.pieces)))
        rng.shuffle(order)
        mixed = table.arranged(order)
        assert mixed.restored(order) == table and len(mixed.content()) == len(text)
        assert mixed.sha256() == hashlib.sha256(mixed.content()).hexdigest()
    with pytest.raises(ValueError):
        PieceTable.of(b"abc").cut(4)


def test_rates():
    forms = [piece_table.arrange(b"some text", i, Rates(plain=0, spm=50))[1] for i in range(400)]
    assert "plain" not in forms and 150 < forms.count("spm") < 250
    assert {piece_table.arrange(b"some text", i, Rates(plain=100))[1] for i in range(50)} == {"plain"}

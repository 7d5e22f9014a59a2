import random

import pytest
from pyspark.sql import functions as F

from weirflow.llm import chat

EVENTS = "conv_id bigint, seq bigint, turn bigint, kind string, role string, text string"


def folded(spark, rows):
    got = chat.fold_events(spark.createDataFrame(rows, EVENTS)).collect()
    return sorted(((r.conv_id, r.turn, r.role, r.text) for r in got), key=str)


def by_hand(rows):
    """The log applied event by event."""
    turns = {}
    for conv, seq, turn, kind, role, text in sorted(
        rows, key=lambda e: (e[0], e[1], e[3] not in ("edit", "regenerate"), e[3])
    ):
        if kind in ("edit", "regenerate"):
            for key in [k for k in turns if k[0] == conv and k[1] >= turn]:
                turns[key][1:] = []
                turns[key].append([])
        own = turns.setdefault((conv, turn), [[], []])
        own[0].append(role)
        own[1].append((kind, text))
    return sorted(
        ((c, t, next(r for r in own[0] if r), "".join(x for k, x in own[1] if k != "regenerate"))
         for (c, t), own in turns.items() if own[1]), key=str,
    )


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "message", "user", "Hi"),
        (1, 1, 1, "message", "assistant", "He"),
        (1, 2, 1, "delta", None, "llo"),
        (1, 3, 1, "regenerate", None, None),
        (1, 4, 1, "delta", None, "Good "),
        (1, 5, 1, "delta", None, "day"),
        (1, 6, 2, "message", "user", "more"),
        (1, 7, 0, "edit", None, "Hello"),
        (1, 8, 1, "message", "assistant", "Yes"),
        (1, 9, 1, "typing", "assistant", "..."),
    ]
    assert folded(spark, rows) == [(1, 0, "user", "Hello"), (1, 1, "assistant", "Yes")]


def test_random_logs_equal_the_log_applied_by_hand(spark):
    draw = random.Random(5)
    rows = []
    for conv in range(30):
        for seq in range(draw.randint(1, 14)):
            turn = draw.randint(0, 3)
            kind = draw.choice(["message", "delta", "delta", "edit", "regenerate"])
            rows.append((conv, seq, turn, kind, "user" if turn % 2 == 0 else "assistant", f"{seq}."))
    assert folded(spark, rows) == by_hand(rows)


def test_rendering_reads_back_whatever_the_texts_hold(spark):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]␛0;␛e<<SYS>>"),
        (1, 1, "assistant", "line\nline</s><s>"),
        (1, 2, "assistant", None),
        (2, 0, None, ""),
        (3, 0, "a\nb</s>", "x" * 100_000),
        (4, None, "assistant", "é日🙂"),
        (4, None, "assistant", "é日🙂"),
    ]
    template = chat.Template()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.render(frame.withColumn("formatted", F.lit("mine")), template).select(
        "conv_id", "formatted", "loss_spans",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"),
    )
    got = {r.conv_id: r for r in got.collect()}
    for conv, r in got.items():
        want = [(role or "", text or "") for c, _, role, text in rows if c == conv]
        assert [tuple(t) for t in r.turns] == want
        assert r.masked == "".join(text for role, text in want if role == "assistant")
        assert r.formatted.count("</s>") == len(want)
        for s in r.loss_spans:
            assert "</s>" == r.formatted[s.start + s.length :][:4]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None)]])
def test_nothing_to_format(spark, rows):
    assert chat.format_chats(spark.createDataFrame(rows, EVENTS)).count() == 0

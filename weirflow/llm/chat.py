"""Chat formatting: an event log folded into final messages, then rendered.

An event is ``(conv_id, seq, turn, kind, role, text)``. Kinds:

* ``message``     opens a turn: its role, and the first part of its text,
* ``delta``       a streamed part, appended to the turn,
* ``edit``        replaces the turn's text; what followed the turn is gone,
* ``regenerate``  drops the turn's text so far and what followed; deltas come after.

``edit`` and ``regenerate`` of turn *t* at sequence number *s* undo every event of
turn *t* or a later turn with a smaller sequence number. A turn all of whose
events are undone, or that holds none of the four kinds, disappears.

Nulls: a null text is empty, a null role the empty role, a null ``seq`` or ``turn``
sorts first, a null ``conv_id`` is one conversation, an unknown or null kind is
ignored. Events with equal ``seq`` apply in the order of kind (resets first), role
and text. Only the columns named above are read, so further columns never clash.
An empty log gives an empty result.

Everything is built-in column functions. Events are first folded per turn, so a
conversation with very many events is spread over tasks until it is one row per
turn; only then do turns of a conversation meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

# A mark that is rare in text; a mark inside a text is escaped itself.
MARK = "␛"

EVENT_COLUMNS = ("conv_id", "seq", "turn", "kind", "role", "text")


@dataclass(frozen=True)
class Template:
    """How a turn is written: ``begin role NEWLINE text end``.

    ``controls`` are further strings that a model's chat format reserves. Neither
    they nor ``begin`` and ``end`` can occur inside an escaped text.
    """

    begin: str = "<s>"
    end: str = "</s>"
    controls: tuple[str, ...] = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    trained_role: str = "assistant"

    def reserved(self) -> tuple[str, ...]:
        return (self.begin, self.end, *self.controls)


def escape(text: Column, template: Template) -> Column:
    """``text`` without any reserved string; ``unescape`` gives the text back.

    The mark itself becomes ``mark e``, the i-th reserved string ``mark i ;``. A
    replacement ends reserved strings on both sides of it, so none can form anew.
    """
    text = F.replace(text, F.lit(MARK), F.lit(f"{MARK}e"))
    for i, reserved in enumerate(template.reserved()):
        text = F.replace(text, F.lit(reserved), F.lit(f"{MARK}{i};"))
    return text


def unescape(text: Column, template: Template) -> Column:
    for i, reserved in enumerate(template.reserved()):
        text = F.replace(text, F.lit(f"{MARK}{i};"), F.lit(reserved))
    return F.replace(text, F.lit(f"{MARK}e"), F.lit(MARK))


def _escape_role(role: Column, template: Template) -> Column:
    return F.replace(escape(role, template), F.lit("\n"), F.lit(f"{MARK}n"))


def _unescape_role(role: Column, template: Template) -> Column:
    return unescape(F.replace(role, F.lit(f"{MARK}n"), F.lit("\n")), template)


def fold_events(events: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)``: the messages that stand at the end of the log."""
    resets = F.col("kind").isin("edit", "regenerate")
    first = F.coalesce(F.col("seq").cast("long"), F.lit(-(2**63)))
    turns = (
        events.select(*EVENT_COLUMNS)
        .where(F.col("kind").isin("message", "delta", "edit", "regenerate"))
        .withColumn("seq", first)
        .groupBy("conv_id", "turn")
        .agg(
            F.max(F.when(resets, F.col("seq"))).alias("reset"),
            F.collect_list(
                F.struct(
                    "seq",
                    (~resets).alias("late"),  # at equal seq a reset comes before what it leaves
                    "kind",
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            ).alias("events"),
        )
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"))
    cut = F.max("reset").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # An event of this turn stands if no reset of this or an earlier turn came after it.
    kept = F.filter("events", lambda e: F.col("cut").isNull() | (e["seq"] >= F.col("cut")))
    texts = F.transform(
        F.filter("kept", lambda e: e["kind"] != "regenerate"), lambda e: e["text"]
    )

    def first_role(events: str) -> Column:
        return F.try_element_at(
            F.filter(F.transform(events, lambda e: e["role"]), lambda r: r != ""), F.lit(1)
        )

    return (
        turns.withColumn("cut", cut)
        .withColumn("events", F.array_sort("events"))
        .withColumn("kept", kept)
        .where(F.size("kept") > 0)
        .select(
            "conv_id",
            "turn",
            F.coalesce(first_role("kept"), first_role("events"), F.lit("")).alias("role"),
            F.array_join(texts, "").alias("text"),
        )
    )


def render(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` marks the text that a model is trained on, in code points of
    ``formatted``: ``turn`` (place of the turn, from 1), ``start`` (in the whole),
    ``offset`` (in the turn's own part) and ``length``.
    """
    role = _escape_role(F.coalesce("role", F.lit("")), template)
    text = escape(F.coalesce("text", F.lit("")), template)
    head = F.concat(F.lit(template.begin), role, F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "head", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    part = F.concat("head", "body", F.lit(template.end))
    parts = (
        messages.select(
            "conv_id", "turn", head.alias("head"), text.alias("body"),
            F.coalesce(F.col("role") == template.trained_role, F.lit(False)).alias("trained"),
        )
        .withColumn("part", part)
        .withColumn("place", F.row_number().over(order))
        .withColumn("at", F.coalesce(F.sum(F.char_length("part")).over(before), F.lit(0)))
        .withColumn("offset", F.char_length("head"))
    )
    span = F.struct(
        F.col("place").alias("turn"),
        (F.col("at") + F.col("offset")).alias("start"),
        F.col("offset"),
        F.char_length("body").alias("length"),
    )
    return (
        parts.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("place", "part"))).alias("parts"),
            F.array_sort(F.collect_list(F.when(F.col("trained"), span))).alias("loss_spans"),
        )
        .select(
            "conv_id",
            F.array_join(F.col("parts.part"), "").alias("formatted"),
            "loss_spans",
        )
    )


def _parts(formatted: Column, template: Template) -> Column:
    """The rendered turns, each still with its head and without its end mark."""
    pieces = F.split(formatted, "\\Q" + template.end + "\\E")
    return F.slice(pieces, 1, F.size(pieces) - 1)


def parse(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a rendered conversation, unescaped: array of ``(role, text)``."""
    head = len(template.begin) + 1

    def turn(part: Column) -> Column:
        role = F.substring_index(F.substr(part, F.lit(head)), "\n", 1)
        text = F.substr(part, F.char_length(role) + head + 1)
        return F.struct(
            _unescape_role(role, template).alias("role"), unescape(text, template).alias("text")
        )

    return F.transform(_parts(formatted, template), turn)


def masked_text(formatted: Column, spans: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between.

    Each span is cut from its own turn, so the work is linear in the conversation.
    """
    parts = _parts(formatted, template)
    cut = F.transform(
        spans,
        lambda s: F.substr(F.element_at(parts, s["turn"]), s["offset"] + 1, s["length"]),
    )
    return unescape(F.array_join(cut, ""), template)


def format_chats(events: DataFrame, template: Template = Template()) -> DataFrame:
    """Fold the event log and render it: ``conv_id, formatted, loss_spans``."""
    return render(fold_events(events), template)

"""JSON columns that keep every number digit for digit, in the JVM.

A JSON parser gives numbers as doubles where it doesn't know their type, and rewrites
those inside nested values. So numbers are marked before the parse: one regular
expression walks over the text from token to token, past whole strings, and turns each
number, ``true``, ``false`` and ``null`` into a marked string. One ``from_json`` then gives
each value with its digits and its kind, at any depth, of any length, with or without an
exponent; the marks come off afterwards. All loops of the expression are possessive, so
it neither backtracks nor recurses, however long the text.

Marks are private-use characters. Where a text holds one itself, it is escaped first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F, types as T

# Fixed value: a bare integer of at least this many digits loses precision as a double.
BIG_DIGITS = 16


# The parser's own limits would turn a message with one very long number or text into a
# malformed one. (Its limit of 1,000 nested levels can't be set.) Only what JSON itself
# allows is read.
JSON_LIMITS = {
    "maxNumLen": str(2**31 - 1),
    "maxStringLen": str(2**31 - 1),
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


TEXT_MAP = T.MapType(T.StringType(), T.StringType())

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_LITERAL = (
    r"(?:-?(?:0|[1-9]\d*+)(?:\.\d++)?+(?:[eE][+-]?+\d++)?+|true|false|null)(?![\w.+-])(?!\s*+:)"
)
# What lies before the next value: anything but a value's start, keys, strings in arrays.
_BEFORE = r'(?:[^"\-\dtfn:]++|' + _STRING + r'|:(?!\s*+"))*+'
_VALUE = rf'(?s)\G({_BEFORE})(?:({_LITERAL})|(:)\s*+"((?:[^"\\]++|\\.)*+)")'
# Half of a surrogate pair has no UTF-8 form; its escape is kept as text.
_HALF = r"((?<!\\)(?:\\\\)*+)\\(u[dD](?:[89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])|[c-fC-F][0-9a-fA-F]{2}))"
_PAIR = r"((?<!\\)(?:\\\\)*+)\\(u[dD][89abAB][0-9a-fA-F]{2})\\(u[dD][c-fC-F][0-9a-fA-F]{2})"


# Private-use characters. ``OPEN literal TEXT string``: a literal lies before
# TEXT, a string after it. HALF and PAIR stand for backslashes before halves of pairs, SELF
# before a letter for a character of these that the text holds itself.
OPEN, TEXT, HALF, PAIR, SELF = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
_OWN = dict(zip((OPEN, TEXT, HALF, PAIR, SELF), "abcde"))


def parsed_json(value: Column | str, schema: T.DataType, **options: str) -> Column:
    """``from_json`` without limits on the length of numbers and texts."""
    return F.from_json(value, schema, {**JSON_LIMITS, **options})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sole(value: Column, schema: T.DataType) -> Column:
    """The text parsed as one value of the schema, with nothing after it."""
    several = parsed_json(F.concat(F.lit("["), value, F.lit("]")), T.ArrayType(schema))
    return let(several, lambda found: F.when(F.size(found) == 1, F.get(found, 0)))


def _replaced(value: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(value, F.lit(pattern), F.lit(by))


def _own_escaped(value: Column) -> Column:
    out = value
    for own in _OWN:
        out = _replaced(out, rf"((?<!\\)(?:\\\\)*+)\\u(?i:{ord(own):04x})", f"$1{own}")
    for own, letter in reversed(_OWN.items()):
        out = F.replace(out, F.lit(own), F.lit(SELF + letter))
    return F.when(value.rlike("[\ue000-\ue004]|(?i:\\\\ue00[0-4])"), out).otherwise(value)


def _finished(text: Column) -> Column:
    """The text as it was where it held marks itself."""
    text = F.replace(text, F.lit(HALF), F.lit("\\"))
    out = text
    for own, letter in _OWN.items():
        out = F.replace(out, F.lit(SELF + letter), F.lit(own))
    return F.when(text.contains(SELF), out).otherwise(text)


def marked(value: Column) -> Column:
    """JSON text whose literals, and strings that are a field's value, carry marks."""
    value = _own_escaped(value)
    half = _replaced(_replaced(value, _PAIR, f"$1{PAIR}$2{PAIR}$3"), _HALF, f"$1{HALF}$2")
    safe = F.when(value.rlike(r"\\u[dD]"), F.replace(half, F.lit(PAIR), F.lit("\\"))).otherwise(value)
    return _replaced(safe, _VALUE, f'$1$3"{OPEN}$2{TEXT}$4"')


def is_text(value: Column) -> Column:
    return value.startswith(OPEN + TEXT)


def is_literal(value: Column) -> Column:
    return value.startswith(OPEN) & ~is_text(value)


def literal(value: Column) -> Column:
    return F.substr(F.substring_index(value, TEXT, 1), F.lit(2))


def _string(value: Column) -> Column:
    return F.substr(value, F.lit(3))


def _bare(text: Column, quote_big: bool = False) -> Column:
    """JSON text without its marks; big integers can stay quoted."""
    if quote_big:
        text = _replaced(text, f'"{OPEN}(-?\\d{{{BIG_DIGITS},}}+){TEXT}"', '"$1"')
    text = _replaced(text, f'"{OPEN}([^{TEXT}"]++){TEXT}"', "$1")
    return F.replace(F.replace(text, F.lit(OPEN + TEXT), F.lit("")), F.lit(HALF), F.lit("\\"))


def plain_text(value: Column) -> Column:
    """A marked value as text: NULL for ``null``, the JSON text of a nested one."""
    return _finished(
        F.when(is_text(value), _string(value))
        .when(value.startswith(OPEN), F.nullif(literal(value), F.lit("null")))
        .otherwise(_bare(value))
    )


def plain_map(entries: Column) -> Column:
    """A map of marked values as key -> text; the last of equal keys wins."""
    return F.map_from_entries(
        F.transform(
            F.map_entries(entries),
            lambda e: F.struct(_finished(e["key"]).alias("key"), plain_text(e["value"]).alias("value")),
        )
    )


def needs_marks(value: Column | str) -> Column:
    """Whether a parse alone might change what the text says: fractions, exponents, -0, halves
    of surrogate pairs. Integers come through a parse as they are."""
    column = F.col(value) if isinstance(value, str) else value
    return column.rlike(r"\d[.eE]|-0|\\u[dD]")


def json_map(value: Column) -> Column:
    """JSON object text to a key -> text map; NULL when it is not one object and no more.

    The last of equal keys wins (``spark.sql.mapKeyDedupPolicy``). Numbers keep their
    digits, also inside nested values, which are JSON text.
    """
    plain = last_of_equal(_sole(value, TEXT_MAP))
    return F.when(needs_marks(value), plain_map(_sole(marked(value), TEXT_MAP))).otherwise(plain)


def last_of_equal(entries: Column) -> Column:
    return F.map_from_entries(F.map_entries(entries))


def json_texts(value: Column, names: Sequence[str]) -> Column:
    """Struct of the named fields of a JSON object, each as exact text.

    For fields known beforehand; cheaper than ``json_map``, as others are skipped.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])

    exact = let(
        parsed_json(marked(value), schema), lambda s: F.struct(*[plain_text(s[n]).alias(n) for n in names])
    )
    return F.when(needs_marks(value), exact).otherwise(parsed_json(value, schema))


def payload_text(payload: Column) -> Column:
    """Message payload bytes as UTF-8 text."""
    return F.decode(payload, "UTF-8")


def struct_text(column: Column) -> Column:
    """Struct to JSON text without its null fields; an absent struct gives ``null``."""
    return F.coalesce(F.to_json(column), F.lit("null"))


def row_text(*columns: Column | str) -> Column:
    """The given columns of a row as one JSON text."""
    return F.to_json(F.struct(*columns))


def json_field(column: Column | str, path: str) -> Column:
    """One field of a JSON column, as text."""
    return F.get_json_object(column, "$." + path)


def flatten_json(value: Column, bigint_as_string: bool = False) -> Column:
    """JSON text to JSON text with every nested value turned into a JSON string.

    Numbers keep their digits. With ``bigint_as_string`` integers of 16 digits or
    more become strings. Text that is no JSON object gives NULL.
    """

    def flat(_: Column, v: Column) -> Column:
        return (
            F.when(is_text(v), _string(v)).when(v.startswith(OPEN), v).otherwise(_bare(v, bigint_as_string))
        )

    entries = last_of_equal(_sole(marked(value), TEXT_MAP))
    # Literals are still marked when the map is written, and lose quotes and marks then.
    return _finished(_bare(F.to_json(F.transform_values(entries, flat)), bigint_as_string))


def _json_string(text: Column) -> Column:
    return let(F.to_json(F.array(text)), lambda t: F.substr(t, F.lit(2), F.char_length(t) - 2))


def split_metadata(value: Column, flat_keys: tuple[str, ...] = ("id", "sender_name")) -> Column:
    """Struct of the flat keys (any case, upper-cased) and ``METADATA``, a JSON text of the rest.

    ``parsed`` is false for text that is no JSON object, so a caller can route it to
    dead letters; a null flat key is NULL.
    """
    names = [key.upper() for key in flat_keys]

    def written(v: Column) -> Column:
        return F.when(is_text(v), _json_string(_string(v))).when(v.startswith(OPEN), literal(v)).otherwise(_bare(v))

    def split(entries: Column) -> Column:
        def flat(name: str) -> Column:
            own = F.filter(F.map_entries(entries), lambda e: F.upper(e["key"]) == name)
            return F.try_element_at(own, F.lit(-1))["value"]

        rest = F.filter(F.map_entries(entries), lambda e: ~F.upper(e["key"]).isin(names))
        pairs = F.transform(rest, lambda e: F.concat(_json_string(e["key"]), F.lit(":"), written(e["value"])))
        text = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
        return F.struct(
            *[plain_text(flat(name)).alias(name) for name in names],
            F.when(entries.isNotNull(), _finished(text)).alias("METADATA"),
            entries.isNotNull().alias("parsed"),
        )

    return let(last_of_equal(_sole(marked(value), TEXT_MAP)), split)


def json_values(value: Column) -> Column:
    """JSON object text to a key -> ``(kind, text)`` map; NULL when it is not one object.

    ``kind`` is ``null``, ``boolean``, ``number``, ``text`` or ``nested``; ``text`` is as in
    ``json_map``.
    """

    def kind(v: Column) -> Column:
        word = literal(v)
        return (
            F.when(is_text(v), "text")
            .when(~v.startswith(OPEN), "nested")
            .when(word == "null", "null")
            .otherwise(F.when(word.isin("true", "false"), "boolean").otherwise("number"))
        )

    return F.map_from_entries(
        F.transform(
            F.map_entries(_sole(marked(value), TEXT_MAP)),
            lambda e: F.struct(
                _finished(e["key"]).alias("key"),
                F.struct(kind(e["value"]).alias("kind"), plain_text(e["value"]).alias("text")).alias("value"),
            ),
        )
    )

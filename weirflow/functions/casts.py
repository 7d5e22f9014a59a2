"""Positional text fields and casts that give NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The field types a record schema may use.
RECORD_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def split_line(line: Column, delimiter: str = ",") -> Column:
    """Text to its fields; the delimiter is literal, empty trailing fields are kept."""
    return F.split(line, "\\Q" + delimiter + "\\E", -1)


def field(fields: Column, position: int) -> Column:
    """Field by zero-based position, NULL beyond the end."""
    return F.try_element_at(fields, F.lit(position + 1))


def typed(text: Column, data_type: T.DataType) -> Column:
    """Text as the given type, NULL where it does not parse.

    A boolean is true only for ``true`` in any case and false for all else.
    """
    if isinstance(data_type, T.BooleanType):
        return F.lower(text) == "true"
    if isinstance(data_type, T.StringType):
        return text
    return text.try_cast(data_type)


def from_text(text: Column, data_type: T.DataType, lenient: bool = False) -> Column:
    """A message value, known as text, in the type of its column.

    Structs, arrays and maps are JSON text. A scalar that does not parse fails the
    job, or is NULL when ``lenient``.
    """
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, data_type)
    return text.try_cast(data_type) if lenient else text.cast(data_type)


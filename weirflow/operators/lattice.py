"""Types of fields nobody declared: a lattice that grows with the values, and loses none.

A value has a kind; kinds are joined to the narrowest column type that holds them all:
``bigint`` below ``decimal(38,18)`` below ``string``, ``boolean`` below ``string``, objects and
arrays of any shape in ``variant``, and ``string`` for what is mixed or has more digits than
the others hold. The join is associative, so a micro-batch is judged by one aggregate.

A table's column keeps its type. A value it can't hold exactly goes to the field's next
column, ``<name>_V2``, ``<name>_V3``, made for the kinds that need it. As ``string`` holds
everything, a field has at most a few.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.json_text import json_values, parsed_json
from weirflow.operators.rows import compute_once

EXACT = T.DecimalType(38, 18)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def value_kinds(value: Column) -> Column:
    """Message text to an array of ``(name, spelling, kind, text)``, a field each; NULL if no object.

    ``name`` is in lower case. Kinds: ``null boolean bigint decimal text nested``; a number
    beyond ``decimal(38,18)``, and an object that holds one, is ``text``.
    """

    def kind(v: Column) -> Column:
        text = v["text"]
        whole = text.rlike(r"^-?\d+$") & text.try_cast("bigint").isNotNull()
        # At most 20 digits before and 18 after the point, and no exponent.
        exact = text.rlike(r"^-?\d{1,20}(\.\d{1,18})?$")
        number = F.when(whole, "bigint").when(exact, "decimal").otherwise("text")
        # A variant holds numbers of up to 38 digits as they are.
        long = text.rlike(r"\d[\d.]{37}|\d[eE][-+\d]")
        return (
            F.when(v["kind"] == "number", number)
            .when((v["kind"] == "nested") & (long | F.try_parse_json(text).isNull()), "text")
            .otherwise(v["kind"])
        )

    return F.transform(
        F.map_entries(json_values(value)),
        lambda e: F.struct(
            F.lower(e["key"]).alias("name"),
            e["key"].alias("spelling"),
            kind(e["value"]).alias("kind"),
            e["value"]["text"].alias("text"),
        ),
    )


def join_kinds(kinds: Iterable[str]) -> T.DataType:
    """The narrowest type that holds values of all the kinds."""
    found = set(kinds) - {"null"}
    if found == {"boolean"}:
        return T.BooleanType()
    if found == {"bigint"}:
        return T.LongType()
    if found and found <= {"bigint", "decimal"}:
        return EXACT
    if found == {"nested"}:
        return T.VariantType()
    return T.StringType()


def fits(kind: Column, text: Column, data_type: T.DataType) -> Column:
    """Whether a column of the type holds the value exactly."""
    if isinstance(data_type, T.StringType):
        return F.lit(True)
    number = kind.isin("bigint", "decimal")
    if isinstance(data_type, T.BooleanType):
        held = kind == "boolean"
    elif isinstance(data_type, WHOLE):
        held = (kind == "bigint") & text.try_cast(data_type).isNotNull()
    elif isinstance(data_type, (T.DecimalType, T.DoubleType, T.FloatType)):
        held = number & (text.try_cast(data_type).try_cast(EXACT) == text.try_cast(EXACT))
    elif isinstance(data_type, T.VariantType):
        held = kind == "nested"
    elif isinstance(data_type, T.StructType):
        names = F.array(*[F.lit(n) for n in data_type.names]).cast("array<string>")
        known = F.size(F.array_except(F.json_object_keys(text), names)) == 0
        held = (kind == "nested") & known & _parses(text, data_type)
    elif isinstance(data_type, (T.ArrayType, T.MapType)):
        held = (kind == "nested") & _parses(text, data_type)
    else:
        held = (kind == "text") & text.try_cast(data_type).isNotNull()
    return (kind == "null") | F.coalesce(held, F.lit(False))


def _parses(text: Column, data_type: T.DataType) -> Column:
    whole = T.StructType([T.StructField("v", data_type), T.StructField("_bad", T.StringType())])
    return parsed_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), whole, columnNameOfCorruptRecord="_bad"
    )["_bad"].isNull()


def as_type(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.VariantType):
        return F.try_parse_json(text)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return parsed_json(text, data_type)
    return text.try_cast(data_type)


def chains(schema: T.StructType) -> dict[str, list[T.StructField]]:
    """Per field in lower case its columns in order: ``n, n_V2, n_V3``.

    ``n_V2`` also starts a chain of its own, for a message field of that name.
    """
    by_name = {f.name.lower(): f for f in schema.fields}
    out = {}
    for name, first in by_name.items():
        out[name] = [first]
        while (more := f"{name}_v{len(out[name]) + 1}") in by_name:
            out[name].append(by_name[more])
    return out


def misfits(rows: DataFrame, schema: T.StructType, column: str = "fields") -> DataFrame:
    """Fields with a value that no column of theirs holds: ``name, spelling, kinds``.

    One row per such field, whatever the number of messages.
    """
    found = rows.select(F.inline(column)).filter("kind <> 'null'")
    held = F.lit(False)
    for name, columns in chains(schema).items():
        some = F.lit(False)
        for f in columns:
            some = some | fits(F.col("kind"), F.col("text"), f.dataType)
        held = held | ((F.col("name") == name) & some)
    return (
        found.filter(~held)
        .groupBy("name")
        .agg(F.min("spelling").alias("spelling"), F.sort_array(F.collect_set("kind")).alias("kinds"))
    )


def columns_for(found: Iterable[Mapping], schema: T.StructType) -> dict[str, T.DataType]:
    """Columns to add for the rows of ``misfits``: name to type."""
    have = chains(schema)
    out = {}
    for row in found:
        own = have.get(row["name"])
        name = row["spelling"] if own is None else f"{own[0].name}_V{len(own) + 1}"
        out[name] = join_kinds(row["kinds"])
    return out


def placed(rows: DataFrame, schema: T.StructType, keep: Sequence[str] = (), column: str = "fields") -> DataFrame:
    """``keep``, a column per field of the schema, and ``misplaced``: a value found no column.

    A value goes to the first of its field's columns that holds it. It finds none where
    the message has a field of its own with that column's name.
    """
    entries = F.map_from_entries(
        F.transform(column, lambda e: F.struct(e["name"], F.struct(e["kind"], e["text"])))
    )
    own = chains(schema)
    values: dict[str, list[Column]] = {f.name: [] for f in schema.fields}
    lost = F.lit(False)
    for name, columns in own.items():
        at = F.try_element_at("_e", F.lit(name))
        kind, text = at["kind"], at["text"]
        waiting = kind.isNotNull() & (kind != "null")
        for i, f in enumerate(columns):
            # A later column of the chain may be another field's first.
            free = F.lit(True) if i == 0 else F.try_element_at("_e", F.lit(f.name.lower())).isNull()
            here = waiting & free & fits(kind, text, f.dataType)
            values[f.name].append(F.when(here, as_type(text, f.dataType)))
            waiting = waiting & ~here
        # Reserved and unknown names have no chain; callers refuse those rows first.
        lost = lost | waiting
    out = [F.coalesce(*options).alias(name) for name, options in values.items()]
    return compute_once(rows, [*keep, column], _e=entries).select(
        *keep, *out, F.coalesce(lost, F.lit(False)).alias("misplaced")
    )

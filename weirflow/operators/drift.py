"""Fields a table does not have yet: finding them, routing rows, widening rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.casts import from_text
from weirflow.functions.json_text import json_map
from weirflow.operators.rows import compute_once


def dynamic_rows(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``value`` text to a ``row`` map plus ``reason`` (``malformed`` or NULL)."""
    parsed = compute_once(messages, [*keep, "value"], row=json_map(F.col("value")))
    return parsed.withColumn("reason", F.when(F.col("row").isNull(), "malformed"))


def lower_names(columns: Sequence[str]) -> list[str]:
    return sorted({c.lower() for c in columns})


def new_keys(row: Column, columns: Sequence[str]) -> Column:
    """Keys of the row map that match no column, whatever their case, in lower case."""
    known = F.array(*[F.lit(c) for c in lower_names(columns)]).cast("array<string>")
    return F.array_except(F.transform(F.map_keys(row), F.lower), known)


def new_fields(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """New fields (per ``by`` columns): ``field`` in lower case and one ``spelling`` as sent."""
    keys = rows.select(*by, F.explode(F.map_keys("row")).alias("_key"))
    fresh = keys.filter(~F.lower("_key").isin(lower_names(columns)))
    return fresh.groupBy(*by, F.lower("_key").alias("field")).agg(F.min("_key").alias("spelling"))


def route_rows(
    rows: DataFrame, live_columns: Sequence[str], startup_columns: Sequence[str] | None = None
) -> DataFrame:
    """Adds ``route`` (NORMAL or DRIFTED) and ``missing``, the fields to be added.

    By default a row is judged by the live table, so it is normal again once the
    table has its fields. With ``startup_columns`` whatever they lack stays
    drifted, while fields are requested only if the live table lacks them.
    """
    judged_by = live_columns if startup_columns is None else startup_columns
    drifted = F.size(new_keys(F.col("row"), judged_by)) > 0
    return rows.withColumns(
        {
            "route": F.when(drifted, "DRIFTED").otherwise("NORMAL"),
            "missing": new_keys(F.col("row"), live_columns),
        }
    )


def as_columns(rows: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Row map to the columns of the table by name, whatever the case of the key.

    Keys the table lacks are ignored; columns the row lacks are NULL.
    """
    lowered = F.map_from_entries(
        F.transform(
            F.map_entries("row"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"])
        )
    )
    values = [
        from_text(F.try_element_at("_row", F.lit(f.name.lower())), f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*keep, lowered.alias("_row")).select(*keep, *values)


def strict_split(
    rows: DataFrame,
    schema: T.StructType,
    ignore_unknown: bool = False,
    refused: Sequence[str] = (),
) -> DataFrame:
    """Adds ``reason`` for rows a strict write would refuse, NULL for the others.

    ``repeated field``: two fields whose names differ in case only, as one column can't
    hold both;
    ``unknown field``: a key the table lacks, unless those are ignored, or one of the
    ``refused`` names; ``missing
    field``: a required column is absent; ``bad field``: a value does not parse as
    its column's type.
    """
    lookup = {f.name.lower(): f for f in schema.fields}

    def value(name: str) -> Column:
        hits = F.filter(F.map_entries("row"), lambda e: F.lower(e["key"]) == name)
        return F.try_element_at(hits, F.lit(-1))["value"]

    missing = bad = F.lit(False)
    for name, f in lookup.items():
        if not f.nullable:
            missing = missing | value(name).isNull()
        if not isinstance(f.dataType, T.StringType):
            parsed = from_text(value(name), f.dataType, lenient=True)
            bad = bad | (value(name).isNotNull() & parsed.isNull())
    if ignore_unknown:
        names = F.transform(F.map_keys("row"), F.lower)
        banned = F.array(*[F.lit(n) for n in lower_names(refused)]).cast("array<string>")
        unknown = F.arrays_overlap(names, banned)
    else:
        unknown = F.size(new_keys(F.col("row"), list(lookup))) > 0
    lowered = F.transform(F.map_keys("row"), F.lower)
    repeated = F.size(F.array_distinct(lowered)) < F.size(lowered)
    checked = (
        F.when(repeated, "repeated field")
        .when(unknown, "unknown field")
        .when(missing, "missing field")
        .when(bad, "bad field")
    )
    known = F.col("reason") if "reason" in rows.columns else F.lit(None)
    return rows.withColumn("reason", F.coalesce(known, checked))


def field_registry(rows: DataFrame, table: str, ts: str) -> DataFrame:
    """Which fields were seen per table: name as sent, first and last time, count."""
    return (
        rows.select(table, ts, F.explode(F.map_keys("row")).alias("field"))
        .groupBy(table, "field")
        .agg(
            F.min(ts).alias("first_seen"),
            F.max(ts).alias("last_seen"),
            F.count("*").alias("seen"),
        )
    )


def to_version(df: DataFrame, target: T.StructType) -> DataFrame:
    """Rows of an older declared schema in the shape of the target, nested structs included."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                shaped(F.col(f.name), have[f.name], f)
                if f.name in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
    )


def shaped(column: Column, have: T.DataType, want: T.StructField) -> Column:
    """The column in the wanted type; struct fields go by name, absent ones are NULL."""
    if isinstance(want.dataType, T.StructType) and isinstance(have, T.StructType):
        parts = [
            (
                shaped(column[f.name], have[f.name].dataType, f)
                if f.name in have.fieldNames()
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.dataType.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    return column.cast(want.dataType)


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old schema with the new one's further fields, nested structs included.

    Names match in any case; a field both have keeps its old type.
    """
    fields = []
    added = {f.name.lower(): f for f in new.fields}
    for f in old.fields:
        other = added.pop(f.name.lower(), None)
        if other and isinstance(f.dataType, T.StructType) and isinstance(other.dataType, T.StructType):
            f = T.StructField(f.name, widened(f.dataType, other.dataType), f.nullable)
        fields.append(f)
    return T.StructType([*fields, *(f for f in new.fields if f.name.lower() in added)])

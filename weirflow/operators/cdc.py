"""Change envelopes to one row per changed record, and their effect on a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.casts import from_text
from weirflow.functions.json_text import (
    is_literal,
    let,
    literal,
    marked,
    needs_marks,
    parsed_json,
    plain_map,
    plain_text,
)
from weirflow.operators.rows import compute_once, latest_by

RECORD = T.MapType(T.StringType(), T.StringType())

# Record values stay text, so integers of any length are exact.
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("sql", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("es", T.LongType()),
        T.StructField("isDdl", T.BooleanType()),
        T.StructField("data", T.ArrayType(RECORD)),
        T.StructField("old", T.ArrayType(RECORD)),
        T.StructField("pkNames", T.ArrayType(T.StringType())),
        T.StructField("mysqlType", T.MapType(T.StringType(), T.StringType())),
        T.StructField("sqlType", T.MapType(T.StringType(), T.IntegerType())),
    ]
)

# The part of the envelope that applying changes needs; the rest is skipped, not parsed.
APPLY_FIELDS = ("table", "database", "type", "ts", "es", "isDdl", "data", "pkNames")
APPLY_SCHEMA = T.StructType([f for f in CHANGE_SCHEMA.fields if f.name in APPLY_FIELDS])

# Columns that order changes of one record: source times, then arrival, then place in message.
CHANGE_ORDER = ("ts", "es", "arrival", "pos")

# What a destination table stores beside the record: enough to apply changes on reading.
CHANGE_FIELDS = T.StructType(
    [
        T.StructField("change_type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("es", T.LongType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("record_key", T.StringType()),
    ]
)
CHANGE_COLUMNS = CHANGE_FIELDS.fieldNames()


def change_type(kind: Column) -> Column:
    """INSERT and UPDATE are UPSERT, DELETE is DELETE (any case); NULL otherwise."""
    upper = F.upper(kind)
    return F.when(upper.isin("INSERT", "UPDATE"), "UPSERT").when(upper == "DELETE", "DELETE")


def destination(database: Column, table: Column) -> Column:
    """``database.table``; NULL when either part is."""
    return F.concat(database, F.lit("."), table)


def _marked_schema(kind: T.DataType) -> T.DataType:
    """The same shape with text for every scalar, as marked values are text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _marked_schema(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_marked_schema(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), _marked_schema(kind.valueType))
    return T.StringType()


def _unmarked(value: Column, kind: T.DataType) -> Column:
    """A marked value in its type; NULL where it is not of that JSON type."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _unmarked(v, kind.elementType))
    if isinstance(kind, T.MapType):
        if isinstance(kind.valueType, T.StringType):
            return plain_map(value)
        return F.transform_values(value, lambda _, v: _unmarked(v, kind.valueType))
    if isinstance(kind, T.StringType):
        return plain_text(value)
    return F.when(is_literal(value), literal(value).try_cast(kind))


def _message(value: Column, schema: T.StructType) -> Column:
    """The envelope's fields, every number of a record digit for digit, and ``_bad``."""
    corrupt = T.StructField("_bad", T.StringType())
    checked = T.StructType([*schema.fields, corrupt])
    plain = parsed_json(value, checked, columnNameOfCorruptRecord="_bad")

    shape = T.StructType([*_marked_schema(schema).fields, corrupt])

    def fields(found: Column) -> Column:
        # A scalar of another JSON type than the envelope's makes the message malformed.
        wrong = F.lit(False)
        for f in schema.fields:
            if not isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType)):
                given = plain_text(found[f.name]).isNotNull()
                wrong = wrong | (given & _unmarked(found[f.name], f.dataType).isNull())
        return F.struct(
            *[_unmarked(found[f.name], f.dataType).alias(f.name) for f in schema.fields],
            F.coalesce(found["_bad"], F.when(wrong, "type")).alias("_bad"),
        )

    exact = let(parsed_json(marked(value), shape, columnNameOfCorruptRecord="_bad"), fields)
    return F.when(needs_marks(value), exact).otherwise(plain)


def parse_changes(
    messages: DataFrame, keep: Sequence[str] = (), schema: T.StructType = APPLY_SCHEMA
) -> DataFrame:
    """``value`` text to envelope fields, ``destination`` and ``reason`` (NULL when good).

    ``CHANGE_SCHEMA`` as schema also gives the old values and the source types.
    """
    parsed = compute_once(messages, [*keep, "value"], m=_message(F.col("value"), schema)).select(
        *keep, "value", "m.*"
    )
    blank = F.col("value").isNull() | F.trim("value").isin("", "null")
    target = destination(F.col("database"), F.col("table"))
    ddl = F.coalesce(F.col("isDdl"), F.lit(False))
    reason = (
        F.when(blank, "empty")
        .when(F.col("_bad").isNotNull(), "malformed")
        .when(~ddl & target.isNull(), "no destination")
    )
    return parsed.withColumns({"destination": target, "reason": reason}).drop("_bad")


def changed_records(parsed: DataFrame, arrival: str) -> DataFrame:
    """One row per element of ``data`` of each good message that is no DDL.

    A null or empty list gives no row. The change marker is a column of its own,
    so a field of the same name inside the record cannot overwrite it.
    """
    live = parsed.filter(
        F.col("reason").isNull() & ~F.coalesce(F.col("isDdl"), F.lit(False))
    )
    return live.select(
        "destination",
        change_type(F.col("type")).alias("change_type"),
        "ts",
        "es",
        F.col(arrival).alias("arrival"),
        F.col("pkNames").alias("pk_names"),
        F.posexplode("data").alias("pos", "record"),
    )


def record_key(pk_names: Column, record: Column) -> Column:
    """Primary-key values of a record as one JSON text."""
    return F.to_json(F.transform(pk_names, lambda name: F.try_element_at(record, name)))


def apply_changes(changes: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Table contents after the changes: last change per record, deletes removed.

    ``target`` holds earlier changes in the same columns. A change that is neither
    UPSERT nor DELETE leaves its row in place.
    """
    keyed = changes.withColumn("record_key", record_key(F.col("pk_names"), F.col("record")))
    if target is not None:
        keyed = target.unionByName(keyed, allowMissingColumns=True)
    last = latest_by(keyed, ["destination", "record_key"], CHANGE_ORDER)
    return last.filter(F.coalesce(F.col("change_type"), F.lit("UPSERT")) != "DELETE")


def bad_record(record: Column, schema: T.StructType) -> Column:
    """Whether a value of the record does not parse as its column's type."""
    bad = F.lit(False)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            value = F.try_element_at(record, F.lit(f.name))
            parsed = from_text(value, f.dataType, lenient=True)
            bad = bad | (value.isNotNull() & parsed.isNull())
    return bad


def record_columns(rows: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Record map to typed columns of the target; unknown keys are ignored.

    A value that does not parse fails the job: split such rows off first.
    """
    values = [
        from_text(F.try_element_at("record", F.lit(f.name)), f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*keep, *values)

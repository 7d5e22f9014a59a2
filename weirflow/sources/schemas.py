"""Table and record schemas from their JSON descriptions, or from a live table."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, types as T

from weirflow.functions.casts import RECORD_TYPES

# Type names of a table description. JSON columns hold text.
TABLE_TYPES = {
    "STRING": T.StringType(),
    "JSON": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
}


def table_schema(description: str | dict | list) -> T.StructType:
    """Fields ``{name, type, mode, fields}`` to a struct; RECORD nests, REPEATED is an array.

    The description is the list of fields, or an object whose one list holds them.
    """
    if isinstance(description, str):
        description = json.loads(description)
    if isinstance(description, dict):
        description = next(v for v in description.values() if isinstance(v, list))
    return T.StructType([_table_field(field) for field in description])


def _table_field(field: dict) -> T.StructField:
    kind = field["type"].upper()
    if kind in ("RECORD", "STRUCT"):
        data_type: T.DataType = table_schema(field["fields"])
    elif kind in TABLE_TYPES:
        data_type = TABLE_TYPES[kind]
    else:
        raise ValueError(f"unsupported table type {kind} of field {field['name']}")
    mode = field.get("mode", "NULLABLE").upper()
    if mode == "REPEATED":
        data_type = T.ArrayType(data_type)
    return T.StructField(field["name"], data_type, nullable=mode != "REQUIRED")


def record_schema(description: str | dict) -> T.StructType:
    """Flat Avro record schema to a struct; any type beyond the primitive ones is an error."""
    record = json.loads(description) if isinstance(description, str) else description
    fields = []
    for field in record["fields"]:
        kind = field["type"]
        if isinstance(kind, list):
            kind = next(k for k in kind if k != "null")
        if not isinstance(kind, str) or kind.lower() not in RECORD_TYPES:
            raise ValueError(f"field type {kind} is not supported")
        fields.append(T.StructField(field["name"], RECORD_TYPES[kind.lower()]))
    return T.StructType(fields)


def read_text_file(spark: SparkSession, path: str) -> str:
    """A small description file from any file system Spark can read."""
    return spark.read.text(path, wholetext=True).first()[0]


def quoted(name: str) -> str:
    """A table's name for SQL text, each of its parts quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def live_schema(
    spark: SparkSession, table: str, fallback: T.StructType | None = None
) -> T.StructType:
    """Schema of the table as it is now; the fallback stands in for a missing table."""
    if spark.catalog.tableExists(quoted(table)):
        spark.catalog.refreshTable(quoted(table))
        return spark.table(quoted(table)).schema
    if fallback is None:
        raise ValueError(f"table {table} does not exist")
    return fallback

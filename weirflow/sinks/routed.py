"""Rows to the table each one names, in one clustered write for all tables of one shape.

``tables.route_to_tables`` appends per table, one job each. Here the tables are grouped by
shape (columns, format); a micro-batch is written once per shape, a folder per table, and each
folder then becomes the table's partition of this batch and writer by statements to the catalog,
which read no rows. Jobs and plan depend on the number of shapes, not of tables.

A run writes to folders of its own and turns each partition to them when all are written, so
one that is lost in between leaves every table as it was, and one that runs again replaces its
rows. Folders that a repeated run has left behind are named by no table.

Null, unknown and unreadable destinations are dead letters; names that differ in case are one
table; fields a table lacks are ignored, and columns the rows lack are NULL. An empty
micro-batch changes nothing. A destination that holds most rows is cut by size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.operators.drift import shaped
from weirflow.sinks.tables import (
    BATCH,
    RESERVED,
    WRITER,
    append_batch,
    known_tables,
    landed_ranges,
    quoted_column,
    stream_id,
)
from weirflow.sources.schemas import quoted

SLOT = "_slot"  # number of a table within its shape; also the name of its folder


@dataclass
class Shape:
    """Tables with the same columns in the same format, and the destinations that name them."""

    columns: T.StructType
    provider: str
    names: dict[str, list[str]] = field(default_factory=dict)

    def slots(self) -> list[tuple[str, int]]:
        """Destination to table number."""
        return [(name, slot) for slot, own in enumerate(self.names.values()) for name in own]


def shapes_of(spark: SparkSession, found: dict[str, list[str]]) -> tuple[list[Shape], list[str]]:
    """Tables by shape, and those that have further partition columns, such as a day."""
    shapes: dict[tuple, Shape] = {}
    layered = []
    for table, names in found.items():
        # A catalog statement, which runs no job: columns, partition columns, then facts.
        facts = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE EXTENDED {quoted(table)}").collect()]
        schema = spark.table(quoted(table)).schema
        listed = [name for name, _ in facts]
        first = listed.index("# Partition Information") + 2 if "# Partition Information" in listed else len(listed)
        parts = listed[first : listed.index("", first)] if first < len(listed) else []
        if sorted(parts) != sorted(RESERVED):
            layered.append(table)
            continue
        columns = T.StructType([f for f in schema.fields if f.name not in RESERVED])
        provider = dict(facts)["Provider"]
        shape = shapes.setdefault((columns.simpleString(), provider), Shape(columns, provider))
        shape.names[table] = names
    return list(shapes.values()), layered


def in_shape(rows: DataFrame, columns: T.StructType) -> DataFrame:
    """The rows in the columns of the tables, by name in any case, and their ``SLOT``."""
    have = {f.name.lower(): f for f in rows.schema.fields if f.name != SLOT}
    values = []
    for f in columns.fields:
        source = have.get(f.name.lower())
        value = (
            shaped(F.col(quoted_column(source.name)), source.dataType, f)
            if source
            else F.lit(None).cast(f.dataType)
        )
        values.append(value.alias(f.name))
    return rows.select(*values, SLOT)


def with_slots(rows: DataFrame, shape: Shape, column: str) -> DataFrame:
    """The rows whose destination is a table of the shape, and its number.

    Destinations are names of tables of the catalog: the list is as long as that at most.
    """
    listed = rows.sparkSession.createDataFrame(shape.slots(), f"_name string, {SLOT} int")
    return rows.join(listed, rows[quoted_column(column)] == listed["_name"]).drop("_name")


def land(rows: DataFrame, shape: Shape, batch_id: int, folder: str) -> None:
    """Write rows in the tables' columns once, then make each folder its table's partition."""
    spark = rows.sparkSession
    writer = stream_id(spark)
    path = f"{folder.rstrip('/')}/{writer}-{int(batch_id)}-{uuid.uuid4().hex}"
    # Neighbouring tables share a task, a large one has several: AQE cuts by size.
    clustered = rows.hint("rebalance", SLOT)
    clustered.write.format(shape.provider).partitionBy(SLOT).save(path)
    filled = spark.read.schema(f"{SLOT} int").format(shape.provider).load(path).distinct()
    slots = {r[0] for r in filled.collect()}  # numbers of tables
    spec = f"PARTITION ({BATCH} = {int(batch_id)}, {WRITER} = '{writer}')"
    for slot, table in enumerate(shape.names):
        if slot not in slots:
            continue
        if any(first <= batch_id <= last for first, last, _ in landed_ranges(spark, table, writer)):
            continue
        place = f"{path}/{SLOT}={slot}"
        spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {spec} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {quoted(table)} {spec} SET LOCATION '{place}'")
        spark.catalog.refreshTable(quoted(table))


def route_once(
    rows: DataFrame,
    batch_id: int,
    folder: str,
    column: str = "destination",
    dead_table: str = "unrouted_rows",
) -> list[str]:
    """Append each row to the table its ``column`` names, in one write per shape of table.

    ``folder`` keeps the rows of all routed tables and is shared by the driver and the
    executors. Returns the tables there are for the destinations of the batch.
    """
    spark = rows.sparkSession
    kept = rows.persist()
    try:
        named: Iterable = (r[0] for r in kept.select(quoted_column(column)).distinct().collect())
        found = known_tables(spark, named)
        shapes, layered = shapes_of(spark, found)
        for shape in shapes:
            own = with_slots(kept, shape, column).drop(column)
            land(in_shape(own, shape.columns), shape, batch_id, folder)
        for table in layered:
            own = kept.filter(F.col(quoted_column(column)).isin(found[table])).drop(column)
            append_batch(own, table, batch_id)
        known = [name for names in found.values() for name in names]
        target = F.col(quoted_column(column))
        lost = kept.filter(target.isNull() | ~target.isin(known))
        whole = F.struct(*[F.col(quoted_column(c)) for c in rows.columns])
        letters = lost.select(
            target.alias(column), F.to_json(whole).alias("value"), F.lit("no table").alias("reason")
        )
        append_batch(letters, dead_table, batch_id, create=True)
        return sorted(found)
    finally:
        kept.unpersist()

"""Few files instead of one folder per micro-batch, while every batch still lands once.

A stream leaves a folder per micro-batch. ``compact`` merges neighbouring batches of a writer
by tiers: ``fanout`` folders of one tier become one of the next, so a row is rewritten
log(batches) times, and a table of *n* batches has about ``fanout`` * log(n) folders a day.
The newest batches are left alone: only the last one can run again from a checkpoint.

What was merged is kept as a mark of the table (from batch, to batch, tier). A batch inside a
mark has landed; ``append_batch`` skips it, so a run repeated late changes nothing.

The merged rows are written first, then named in the table's properties, and only then take
the place of the folders they were made of. A run that is lost in between is finished by the
next: ``recover`` repeats the steps that are left. Between dropping the old folders and
adding the new one a reader of the table misses those rows; call it from the writer's body
or while nobody reads, as with any table that has no snapshots.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession, functions as F

from weirflow.sinks.tables import BATCH, COMPACTED, RESERVED, WRITER, landed_ranges, quoted_column, table_property
from weirflow.sources.schemas import quoted

PENDING = "weirflow.compacting"
_NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Merge:
    """``old`` folders of a writer's batches that become ``new``, from those written in ``path``."""

    writer: str
    first: int
    last: int
    tier: int
    path: str
    old: list[str]
    new: list[str]


class _Files:
    """The table's folder in whatever store it lies."""

    def __init__(self, spark: SparkSession, location: str) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.location = location.rstrip("/")
        self.store = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}" if name else self.location)

    def delete(self, name: str) -> None:
        self.store.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        """Does nothing if an earlier run has done it."""
        if self.store.exists(self.path(name)):
            self.store.delete(self.path(to), True)
            self.store.mkdirs(self.path(to).getParent())
            if not self.store.rename(self.path(name), self.path(to)):
                raise OSError(f"could not move {name} to {to}")


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {quoted(table)}").collect()}


def _folders(spark: SparkSession, table: str) -> list[tuple[str, int, str]]:
    """``(folders above the batch, batch, writer)`` of every partition but those without a day."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect():
        *above, batch, writer = row[0].split("/")
        if _NULL not in row[0]:
            out.append(("/".join(above), int(batch.split("=")[1]), writer.split("=", 1)[1]))
    return out


def _spec(folder: str) -> str:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return "PARTITION (" + ", ".join(f"{quoted_column(k)} = '{v}'" for k, v in pairs) + ")"


def _name(above: str, batch: int, writer: str) -> str:
    return "/".join([*([above] if above else []), f"{BATCH}={batch}", f"{WRITER}={writer}"])


def compact(spark: SparkSession, table: str, fanout: int = 8, keep: int = 1) -> int:
    """Merge what can be merged; returns how many merges were made.

    The newest ``keep`` batches of each writer, at least one, stay as they are.
    """
    recover(spark, table)
    merges = 0
    while (merge := _next(spark, table, fanout, max(keep, 1))) is not None:
        _write(spark, table, merge)
        spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('{PENDING}' = '{json.dumps(asdict(merge))}')")
        recover(spark, table)
        merges += 1
    return merges


def _next(spark: SparkSession, table: str, fanout: int, keep: int) -> Merge | None:
    """The first ``fanout`` neighbours of one tier among a writer's older batches."""
    folders = _folders(spark, table)
    for writer in sorted({w for *_, w in folders}):
        marks = {last: (first, tier) for first, last, tier in landed_ranges(spark, table, writer)}
        batches = sorted({b for _, b, w in folders if w == writer})[:-keep]
        tiers = [marks.get(b, (b, 0)) for b in batches]
        for i in range(len(batches) - fanout + 1):
            if len({tier for _, tier in tiers[i : i + fanout]}) == 1:
                own = set(batches[i : i + fanout])
                last = max(own)
                above = sorted({a for a, b, w in folders if w == writer and b in own})
                return Merge(
                    writer, tiers[i][0], last, tiers[i][1] + 1, f"_compacting/{uuid.uuid4().hex}",
                    [_name(a, b, writer) for a, b, w in folders if w == writer and b in own],
                    [_name(a, last, writer) for a in above],
                )
    return None


def _write(spark: SparkSession, table: str, merge: Merge) -> None:
    facts = _facts(spark, table)
    layout = [c.name for c in spark.catalog.listColumns(quoted(table)) if c.isPartition and c.name not in RESERVED]
    batches = {int(name.split(f"{BATCH}=")[1].split("/")[0]) for name in merge.old}
    rows = spark.table(quoted(table)).filter(F.col(BATCH).isin(*batches) & (F.col(WRITER) == merge.writer))
    for name in layout:
        rows = rows.filter(F.col(quoted_column(name)).isNotNull())
    # Files of the size AQE is set to, whatever the number of folders they came from.
    sized = rows.drop(*RESERVED).hint("rebalance", *layout)
    writer = sized.write.format(facts["Provider"])
    (writer.partitionBy(*layout) if layout else writer).save(f"{facts['Location'].rstrip('/')}/{merge.path}")


def recover(spark: SparkSession, table: str) -> bool:
    """Finish a merge whose rows are written; returns whether there was one."""
    text = table_property(spark, table, PENDING)
    if text is None:
        return False
    merge = Merge(**json.loads(text))
    files = _Files(spark, _facts(spark, table)["Location"])
    dropped = ", ".join(_spec(name) for name in merge.old)
    spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {dropped}")
    for name in merge.old:
        if name not in merge.new:
            files.delete(name)
    for name in merge.new:
        above = name.split(f"{BATCH}=")[0].rstrip("/")
        files.move(f"{merge.path}/{above}" if above else merge.path, name)
    added = " ".join(_spec(name) for name in merge.new)
    spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {added}")
    marks = json.loads(table_property(spark, table, COMPACTED) or "{}")
    own = [m for m in marks.get(merge.writer, []) if not merge.first <= m[0] <= merge.last]
    marks[merge.writer] = sorted([*own, [merge.first, merge.last, merge.tier]])
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('{COMPACTED}' = '{json.dumps(marks)}')")
    spark.sql(f"ALTER TABLE {quoted(table)} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    files.delete(merge.path)
    spark.catalog.refreshTable(quoted(table))
    return True

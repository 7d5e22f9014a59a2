"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import weirflow

# Runtime settings: safe to set on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows reach Python in batches of bounded size, however long their texts are. Each running
    # task holds a few of them in the JVM and in its worker, which keeps what it once had.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set what the operators need: UTC text, last key wins in JSON, AQE, RocksDB state."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    # Python tasks carry this package's functions, so executors need no copy of it.
    cloudpickle.register_pickle_by_value(weirflow)
    return spark


def local_session(
    cpus: int | str = 8, app: str = "weirflow", warehouse: str | None = None
) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.files.maxPartitionBytes", "16m")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = prepare_session(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset, a
    local temporary folder stands in on a local master, the only place where all
    tasks see it; elsewhere it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="weirflow-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the files.

    For results read more than once that are much smaller than their input: the
    input is then read once, and a lost executor re-reads files, not the input.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A result that is read more than once, from files that go when the block ends.

    For results as large as their input, which fill the executors' memory when persisted.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)

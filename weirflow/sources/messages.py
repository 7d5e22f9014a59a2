"""Message sources. Each gives a DataFrame, so operators never see the connector."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.json_text import parsed_json, payload_text
from weirflow.session import materialize

# Envelope of a message service: payload bytes plus attributes.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.BinaryType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_ts", T.TimestampType()),
    ]
)


def kafka_options(
    servers: str, topic: str, start: str = "latest", consumer: dict[str, str] | None = None
) -> dict[str, str]:
    """Options of a topic read; consumer properties pass through with the ``kafka.`` prefix."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    options.update({f"kafka.{name}": value for name, value in (consumer or {}).items()})
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded topic read; offsets are committed by the query's checkpoint after each write."""
    return topic_rows(spark.readStream.format("kafka").options(**options).load())


def read_topic_bounded(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """What the topic holds now, as a batch."""
    bounded = {**options, "startingOffsets": "earliest", "endingOffsets": "latest"}
    return topic_rows(spark.read.format("kafka").options(**bounded).load())


def topic_rows(records: DataFrame) -> DataFrame:
    """Message text with its position in the topic; the key is not used downstream."""
    return records.select(
        F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp"
    )


def envelope_rows(messages: DataFrame, time_attribute: str | None = None) -> DataFrame:
    """Payload text and event time, from an attribute where one is named."""
    event_time = F.col("publish_ts")
    if time_attribute:
        event_time = F.coalesce(
            F.try_to_timestamp(F.col("attributes")[time_attribute]), event_time
        )
    return messages.select(
        payload_text(F.col("payload")).alias("value"), "message_id", event_time.alias("ts")
    )


def stream_table(spark: SparkSession, folder: str, name: str, **options: str) -> DataFrame:
    """Stream over a parquet table, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A pattern that matches only this name works for a file and for a folder.
    pattern = path[:-1] + f"[{path[-1]}]"
    return spark.readStream.schema(schema).options(**options).parquet(pattern)


def read_lookup(
    spark: SparkSession, url: str, query: str = "select dim1, dim1_val from t_dim1", **options: str
) -> DataFrame:
    """Lookup table over JDBC."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**options).load()


def with_fresh_lookup(
    load: Callable[[], DataFrame], apply: Callable[[DataFrame, DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that reads the lookup again for each micro-batch.

    It is written first, so Spark knows its size: a small one is broadcast.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        apply(batch, materialize(load(), "lookup"), batch_id)

    return body


def memory_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_staged(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Staged newline-JSON files; without a schema names and types are inferred.

    Inferred names that differ only in case are one column. A line that does not
    parse fails the read.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if schema:
        return reader.schema(schema).json(paths)
    setting = "spark.sql.caseSensitive"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        inferred = reader.json(paths).schema
    finally:
        spark.conf.set(setting, before)
    spellings: dict[str, list[T.StructField]] = {}
    for found in inferred.fields:
        spellings.setdefault(found.name.lower(), []).append(found)
    width = max((len(found) for found in spellings.values()), default=0)
    if width <= 1:
        return reader.schema(inferred).json(paths)
    # One parse per spelling: names that differ in case cannot share a struct.
    parses = [T.StructType([f[i] for f in spellings.values() if i < len(f)]) for i in range(width)]
    lines = spark.read.text(paths).select(
        *[parsed_json("value", p, mode="FAILFAST").alias(f"_p{i}") for i, p in enumerate(parses)]
    )
    return lines.select(
        *[
            F.coalesce(*[F.col(f"_p{i}")[f.name] for i, f in enumerate(found)]).alias(found[0].name)
            for found in spellings.values()
        ]
    )

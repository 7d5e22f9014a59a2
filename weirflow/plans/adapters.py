"""Message streams made from the given tables, so every job has real input.

Each adapter is a narrow projection that works on a batch or a stream. A few
messages are broken on purpose, by position, to exercise the dead-letter paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.times import epoch_millis, from_millis

HOUR_MS = 3_600_000
# Base that lifts keys to 18 digits, beyond what a double holds exactly.
BIG = 900_000_000_000_000_000


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def whole_value() -> Column:
    return F.floor("value").cast("bigint")


def log_messages(events: DataFrame) -> DataFrame:
    """JSON log messages: ``seq, ts, value``."""
    kind = F.col("event_type")
    details = F.when(
        kind != "signup",
        F.struct(
            F.when(kind == "purchase", "POST").otherwise("GET").alias("method"),
            F.concat(F.lit("/"), kind).alias("url"),
            F.when(kind == "error", 500).otherwise(200).alias("http_status"),
            F.lit(None).cast("string").alias("user_agent"),
            F.concat(F.lit("10.0.0."), _text(F.col("user_id") % 256)).alias("ip_address"),
        ),
    )
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    message = F.to_json(
        F.struct(
            F.when(_every("event_id", 101), None)
            .when(_every("event_id", 107), "yesterday")
            .otherwise(stamp)
            .alias("timestamp"),
            F.when(kind == "error", "ERROR")
            .when(kind == "view", "DEBUG")
            .otherwise("INFO")
            .alias("severity"),
            F.concat(F.lit("svc-"), _text(F.col("user_id") % 10)).alias("service"),
            kind.alias("message"),
            F.concat(_text("user_id"), F.lit("-"), _text(F.col("event_id") % 20)).alias("trace_id"),
            details.alias("request_details"),
            whole_value().alias("latency_ms"),
        )
    )
    value = (
        F.when(_every("event_id", 103), "")
        .when(_every("event_id", 97), F.concat(F.lit('{"timestamp": '), stamp))
        .otherwise(message)
    )
    return events.select(F.col("event_id").alias("seq"), "ts", value.alias("value"))


def csv_lines(events: DataFrame) -> DataFrame:
    """CSV events: ``seq, arrival, value``; some arrive late, some lack fields."""
    millis = epoch_millis(F.col("ts"))
    delay = (
        F.when(_every("event_id", 13), 29 * HOUR_MS)
        .when(_every("event_id", 7), F.lit(3 * HOUR_MS // 2))
        .otherwise(0)
    )
    head = F.concat_ws(
        ",", _text(millis), _text("user_id"), F.concat(F.lit("worker-"), _text(F.col("user_id") % 8))
    )
    whole = F.concat_ws(",", head, _text("event_id"), F.col("event_type"), _text(whole_value()))
    return events.select(
        F.col("event_id").alias("seq"),
        from_millis(millis + delay).alias("arrival"),
        F.when(_every("event_id", 89), head).otherwise(whole).alias("value"),
    )


def lookup_table(events: DataFrame) -> DataFrame:
    """Dimension values of all event types but one, which is therefore not found."""
    kinds = events.select(F.col("event_type").alias("dim1")).distinct()
    return kinds.filter("dim1 <> 'click'").withColumn(
        "dim1_val", F.concat(F.lit("dim-"), F.col("dim1"))
    )


def hot_orders(orders: DataFrame) -> DataFrame:
    """Orders of which three in five are of customer 1, and one in seven others of nobody."""
    key = F.when(F.col("o_orderkey") % 5 < 3, 1).when(~_every("o_orderkey", 7), F.col("o_custkey"))
    return orders.select(F.col("o_orderkey").alias("order_id"), key.cast("string").alias("customer"))


def basic_messages(events: DataFrame) -> DataFrame:
    """Free-form JSON events with microsecond times: ``seq, value``."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    message = F.to_json(
        F.struct(
            F.when(~_every("event_id", 109), micros).alias("event_timestamp"),
            (micros + 5).alias("perf_ts"),
            F.col("event_type").alias("kind"),
            F.col("user_id").alias("user"),
        )
    )
    value = F.when(_every("event_id", 113), "not json").otherwise(message)
    return events.select(F.col("event_id").alias("seq"), value.alias("value"))


def change_messages(orders: DataFrame) -> DataFrame:
    """Change envelopes, one per order: ``arrival, value``.

    The record key is the customer, so keys repeat; urgent orders carry a second
    record. Record ids have 18 digits.
    """
    millis = epoch_millis(F.col("o_orderdate"))
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    record = [
        F.lit("SHOP").alias("SOURCE"),
        status.alias("STATUS"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("CENTS"),
        key.alias("ORDER_ID"),
    ]
    first = F.struct((F.col("o_custkey") + BIG).alias("ID"), *record)
    second = F.struct((F.col("o_custkey") + (BIG + 50_000_000_000_000_000)).alias("ID"), *record)
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    kind = (
        F.when(_every("o_orderkey", 199), "REPLACE")
        .when(status == "O", "INSERT")
        .when(status == "P", "update")
        .otherwise("DELETE")
    )
    message = F.to_json(
        F.struct(
            F.concat(F.lit("ORDERS_"), F.substring("o_orderpriority", 1, 1)).alias("table"),
            F.when(~_every("o_orderkey", 223), "SHOP").alias("database"),
            kind.alias("type"),
            F.lit("").alias("sql"),
            millis.alias("ts"),
            (millis - key % 1000).alias("es"),
            _every("o_orderkey", 211).alias("isDdl"),
            F.when(urgent, F.array(first, second)).otherwise(F.array(first)).alias("data"),
            F.array(F.lit("ID")).alias("pkNames"),
        )
    )
    value = F.when(_every("o_orderkey", 197), F.lit('{"table":')).otherwise(message)
    return orders.select(key.alias("arrival"), value.alias("value"))


def big_number_messages(lineitem: DataFrame) -> DataFrame:
    """Objects with 18- and 20-digit integers on two levels: ``value``."""
    number = _text(F.col("l_orderkey") * 10 + F.col("l_linenumber") + BIG)
    wide = F.concat(F.lit("12345678"), F.lpad(_text("l_partkey"), 12, "0"))
    text = F.concat(
        F.lit('{"ID":'), number,
        F.lit(',"wide":'), wide,
        F.lit(',"wrapper":{"ID":'), number, F.lit(',"name":"'), F.col("l_returnflag"),
        F.lit('"},"code":"'), wide,
        F.lit('","qty":'), _text(F.col("l_quantity").cast("bigint")),
        F.lit(',"old":null,"flag":true}'),
    )
    return lineitem.select(text.alias("value"))


def nested_messages(orders: DataFrame) -> DataFrame:
    """Envelopes with nested arrays and objects: ``seq, value``; some are no objects."""
    number = _text(F.col("o_orderkey") + BIG)
    text = F.concat(
        F.lit('{"topic":"stock","data":[{"NO":'), number,
        F.lit(',"rank":"'), F.col("o_orderpriority"), F.lit('"}],"big":'), number,
        F.lit(',"n":'), _text("o_custkey"),
        F.lit(',"origin":{"site":"north","shelf":7},"gone":null,"sold":false}'),
    )
    value = F.when(_every("o_orderkey", 251), F.lit("[1]")).otherwise(text)
    return orders.select(F.col("o_orderkey").alias("seq"), value.alias("value"))


def bundle_messages(events: DataFrame) -> DataFrame:
    """Objects that name their bundle and mostly a uuid: ``seq, value``; some are broken."""
    message = F.to_json(
        F.struct(
            F.col("event_type").alias("bundle_id"),
            F.when(~_every("event_id", 17), F.concat(F.lit("u"), _text("user_id"))).alias("uuid"),
            F.concat(F.lit("v"), _text("event_id")).alias("v"),
            F.when(_every("event_id", 5), F.lit("more")).alias("extra"),
        )
    )
    value = F.when(_every("event_id", 103), F.lit("{broken")).otherwise(message)
    return events.select(F.col("event_id").alias("seq"), value.alias("value"))


def sender_messages(customer: DataFrame) -> DataFrame:
    """Objects with two flat keys and free metadata: ``value``."""
    text = F.concat(
        F.lit('{"id":"'), _text("c_custkey"),
        F.lit('","Sender_Name":"'), F.col("c_name"),
        F.lit('","account":'), _text(F.col("c_custkey") + BIG),
        F.lit(',"profile":{"segment":"'), F.col("c_mktsegment"),
        F.lit('","nation":'), _text("c_nationkey"), F.lit("}}"),
    )
    return customer.select(text.alias("value"))


def drift_messages(events: DataFrame) -> DataFrame:
    """Objects whose fields grow over three periods of the month: ``seq, ts, batch, value``."""
    batch = F.least(F.floor((F.dayofmonth("ts") - 1) / 10) + 1, F.lit(3)).cast("bigint")
    sender = F.concat(F.lit("Sender-"), _text("user_id"))
    message = F.to_json(
        F.struct(
            F.concat(F.lit("ev-"), _text("event_id")).alias("ID"),
            F.when(~_every("event_id", 19), sender).alias("SENDER_NAME"),
            F.when(_every("event_id", 19), sender).alias("sender_name"),
            F.when(batch >= 2, F.concat(F.lit("v-"), F.col("event_type"))).alias("CHANNEL"),
            F.when(batch >= 3, F.col("event_id")).alias("VISIT"),
        )
    )
    value = F.when(_every("event_id", 103), F.lit("{broken")).otherwise(message)
    return events.select(
        F.col("event_id").alias("seq"), "ts", batch.alias("batch"), value.alias("value")
    )

"""Stream sources and message decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_source(spark: SparkSession, fmt: str, schema=None, **options: str) -> DataFrame:
    """Any streaming source by format and options."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def kafka_source(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """A topic; consumed offsets live in the query's checkpoint (needs the connector jar)."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    return event_source(spark, "kafka", **settings, **options)


def decode_json(df: DataFrame, schema, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of a JSON message.

    Bad JSON gives nulls in all columns, a wrong type null in its column,
    unknown fields are ignored.
    """
    data = F.from_json(F.col(column).cast("string"), schema)
    return df.select(*keep, data.alias("_data")).select(*keep, "_data.*")


def with_arrival_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Processing time as event time (one value per micro-batch)."""
    return df.withColumn(column, F.current_timestamp())


SOCIAL_SCHEMA = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
PRICE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def with_payload_time(df: DataFrame, millis: str = "timestamp") -> DataFrame:
    """Event time from the epoch milliseconds of the message."""
    return df.withColumn("event_time", F.timestamp_millis(millis)).drop(millis)

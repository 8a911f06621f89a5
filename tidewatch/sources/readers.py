"""Batch readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as V
from tidewatch.functions.numeric import to_number

TEXT = T.StringType()
COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        *[
            T.StructField(name, TEXT)
            for name in (
                "body",
                "rule",
                "positive_example_1",
                "positive_example_2",
                "negative_example_1",
                "negative_example_2",
            )
        ],
        T.StructField("rule_violation", T.IntegerType()),
    ]
)

ENTRY = T.StructType(
    [
        T.StructField("offense", TEXT),
        T.StructField("points", T.IntegerType()),
        T.StructField("content", TEXT),
        T.StructField("timestamp", TEXT),
    ]
)
LEDGER = T.MapType(
    TEXT,
    T.StructType(
        [
            T.StructField("name", TEXT),
            T.StructField("behavior_score", T.LongType()),
            T.StructField("history", T.ArrayType(ENTRY)),
        ]
    ),
)
LEDGER_ROWS = "user_id string, name string, behavior_score bigint, history array<struct<offense string, points int, content string, timestamp string>>"

SERIES = T.MapType(TEXT, T.MapType(TEXT, TEXT))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_comments(
    spark: SparkSession, path: str, schema: T.StructType = COMMENT_SCHEMA, missing: str = "error"
) -> DataFrame:
    """Labelled comments from CSV (quoted fields may span lines).

    Columns are found by their header name, so their order is free. A missing
    path fails here, not at the first action; ``missing="empty"`` gives no rows.
    """
    if not path_exists(spark, path):
        if missing == "empty":
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(path)
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    texts = spark.read.options(**options).csv(path)
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger file {user: {name, behavior_score, history}}, one row per user.

    Missing or corrupt files give no rows. A file is one JSON value and so one
    task's work; give a folder of files to read them side by side.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_ROWS)
    users = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", LEDGER)))
    return users.select(F.col("key").alias("user_id"), "value.*")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A result table of a database (the driver jar must be on the class path)."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def flatten_keyed_series(payloads: DataFrame, key: str = "symbol", payload: str = "payload") -> DataFrame:
    """Keyed series JSON to rows (key, date, open, high, low, close, volume).

    The daily series is taken by its exact name, else the first entry whose name
    contains "Time Series". Error or unknown payloads give no rows, values that
    are not numbers become null.
    """
    parts = F.from_json(payload, T.MapType(TEXT, TEXT))
    names = F.filter(F.map_keys("_parts"), lambda k: F.contains(k, F.lit(V.SERIES_NAME_PART)))
    wanted = F.when(F.array_contains(names, V.SERIES_DAILY), V.SERIES_DAILY).otherwise(F.get(names, 0))
    series = F.from_json(F.try_element_at("_parts", wanted), SERIES)
    points = payloads.withColumn("_parts", parts).select(key, F.explode(series).alias("date", "_m"))
    columns = [
        to_number(F.try_element_at("_m", F.lit(source))).alias(name) for name, source in V.SERIES_METRICS.items()
    ]
    return points.select(key, F.col("date").try_cast("timestamp").alias("date"), *columns)

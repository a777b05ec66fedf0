"""Topic scans and their file twins. Every reader yields ``key`` and ``value`` text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the event pipeline.
EVENT_TOPIC = "chat_events"
CHANGE_TOPIC = "cdc.public.stock_trades"
FLUSH_EVENTS = 500
FLUSH_INTERVAL = "2 seconds"
MAX_IN_FLIGHT = 10_000
BROKER_TIMEOUT_MS = 5_000


def topic_options(servers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Source options: whole topic from the earliest offset.

    A micro-batch takes all that is there unless ``max_per_trigger`` (such as
    ``MAX_IN_FLIGHT``) rate-limits it; nothing is dropped either way. Offsets live in the query's checkpoint, so a failed micro-batch is read again.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def _text_columns(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def stream_topic(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC, max_per_trigger: int | None = None):
    """Structured stream of a topic (needs the Kafka connector on the classpath)."""
    return _text_columns(spark.readStream.format("kafka").options(**topic_options(servers, topic, max_per_trigger)).load())


def read_topic(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC) -> DataFrame:
    """Batch read of everything a topic holds now."""
    return _text_columns(spark.read.format("kafka").options(**topic_options(servers, topic, None)).load())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON body per line, as the batch twin of a topic."""
    return spark.read.text(path).select(F.lit(None).cast("string").alias("key"), "value")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One JSON body per line from files landing in ``path``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(F.lit(None).cast("string").alias("key"), "value")


def stream_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``key``/``value`` records published by the file sink."""
    reader = spark.readStream.schema("key string, value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)

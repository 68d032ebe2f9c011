"""Queue intake: one raw envelope per row, as text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _shape(raw: DataFrame) -> DataFrame:
    return raw.select(
        "value",
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes from text files, one JSON document per line."""
    return _shape(spark.read.text(path))


def stream_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a file stream."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _shape(reader.load(path))


def stream_kafka_events(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Envelopes from a Kafka topic (needs Spark's Kafka package on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived_at"))
    )

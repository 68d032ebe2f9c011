"""Scalar functions not already covered by another query."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from tidemark.functions.text import epoch_millis, first_or_null, time_text


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS s FROM events")
def time_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time stamp with six fraction digits."""
    return table(spark, sf_dir, "events").select("event_id", time_text(F.col("ts")).alias("s"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch milliseconds, truncated."""
    return table(spark, sf_dir, "events").select("event_id", epoch_millis(F.col("ts")).alias("ms"))


@query(
    """SELECT doc_id, string_split(text, chr(10))[1] AS first_line,
              CASE WHEN lang = 'en' THEN NULL ELSE lang END AS first_tag
       FROM documents"""
)
def first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First element of an array, NULL when it is empty."""
    tags = F.array_remove(F.array("lang"), "en")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        first_or_null(F.split("text", "\n")).alias("first_line"),
        first_or_null(tags).alias("first_tag"),
    )

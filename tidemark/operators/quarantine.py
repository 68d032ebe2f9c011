"""Records that can't be read: kept with their raw text and reason, and fed back once.

``quarantined`` says why a record was refused and keeps what came. ``pending_redrive`` picks
those that no earlier batch has fed back; the batch that feeds them back writes their ids
under its own number, so repeating it picks the same ones and a later one none of them.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import first_or_null
from tidemark.operators.events import open_envelopes
from tidemark.operators.snapshots import numbered_folders

QUARANTINE = "id STRING, value STRING, record_pos INT, body STRING, reason STRING, copies BIGINT, batch INT"
REDRIVEN = "id STRING, from_batch INT, batch INT"

#: From quarantined rows to envelopes (``value``) that may now be readable.
Repair = Callable[[DataFrame], DataFrame]


def quarantined(raw: DataFrame, value: str = "value") -> DataFrame:
    """Refused records of the envelopes in ``raw``: id, value, record_pos, body, reason, copies.

    A record that came several times in the same form has one row with its ``copies``.
    ``record_pos`` and ``body`` are NULL where the envelope as a whole is refused.
    """
    opened = open_envelopes(raw.select(F.col(value).alias("_raw"), F.col(value).alias(value)), value)
    manual = F.col("manual").isNotNull()
    dataset = F.when(manual, F.col("manual.data_set_id")).otherwise(first_or_null(F.col("event.resources")))
    n_revisions = F.when(manual, F.when(F.col("manual.RevisionIds").isNotNull(), 1).otherwise(0)).otherwise(
        F.coalesce(F.size(F.array_compact("event.detail.RevisionIds")), F.lit(0))
    )
    read = F.from_json("_raw", "map<string,string>")
    reason = (
        F.when(~manual & F.col("record_pos").isNull() & read.isNull(), "envelope is not JSON")
        .when(~manual & F.col("record_pos").isNull(), "envelope has no records")
        .when(~manual & F.col("body").isNull(), "record has no body")
        .when(~manual & F.from_json("body", "map<string,string>").isNull(), "body is not JSON")
        .when(dataset.isNull(), "no data set")
        .when(n_revisions <= 0, "no revision")
    )
    refused = opened.select(F.col("_raw").alias("value"), "record_pos", "body", reason.alias("reason"))
    refused = refused.where("reason IS NOT NULL")
    keys = ["value", "record_pos", "body", "reason"]
    told = F.concat_ws("\n", F.coalesce(F.col("record_pos").cast("string"), F.lit("")), "value")
    return (
        refused.groupBy(F.sha2(told, 256).alias("id"))
        .agg(*[F.any_value(c).alias(c) for c in keys], F.count(F.lit(1)).alias("copies"))
        .select("id", *keys, "copies")
    )


def write_quarantine(raw: DataFrame, path: str, batch: int) -> None:
    quarantined(raw).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _numbered(spark: SparkSession, path: str, schema: str, before: int | None) -> DataFrame:
    batches = [n for n in numbered_folders(spark, path, "batch") if before is None or n < before]
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/batch={n}" for n in batches])


def read_quarantine(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Refused records of all batches, or of those before one."""
    return _numbered(spark, path, QUARANTINE, before)


def pending_redrive(spark: SparkSession, quarantine: str, redriven: str, batch: int) -> DataFrame:
    """Refused records of earlier batches that no earlier batch has fed back."""
    done = _numbered(spark, redriven, REDRIVEN, batch).select("id", F.col("from_batch").alias("batch"))
    return read_quarantine(spark, quarantine, batch).join(done, ["id", "batch"], "left_anti")


def redrive(
    spark: SparkSession, quarantine: str, redriven: str, batch: int, repair: Repair
) -> DataFrame:
    """Envelopes to take into ``batch`` again, their records noted as fed back by it.

    ``repair`` decides what comes back: rows it leaves out stay in quarantine and may be
    fed back later. It must keep ``id`` and ``batch`` beside the new ``value``.
    """
    chosen = repair(pending_redrive(spark, quarantine, redriven, batch)).select("id", "batch", "value")
    place = f"{redriven}/batch={batch}"
    noted = chosen.select("id", F.col("batch").alias("from_batch"), "value")
    noted.write.mode("overwrite").parquet(place)
    return spark.read.schema(noted.schema).parquet(place).select("value")

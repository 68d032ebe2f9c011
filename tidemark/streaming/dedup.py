"""Content de-duplication on a stream."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import content_hash


def dedup_events_stream(
    events: DataFrame, group: Sequence[str], body: str, ts: str, span: str
) -> DataFrame:
    """Drop a body seen in its group within at least ``span`` of event time.

    State is one hash per distinct body and expires with the watermark. Spark
    guarantees the span as a minimum: a copy somewhat later may be dropped too.
    """
    return (
        events.withColumn("_h", content_hash(F.col(body)))
        .withWatermark(ts, span)
        .dropDuplicatesWithinWatermark([*group, "_h"])
        .drop("_h")
    )

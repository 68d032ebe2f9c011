"""The feed as a stream: each micro-batch is one run of the batch plan."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.feed import Feed, Listing, run_batch, stored
from tidemark.streaming.dedup import dedup_events_stream


def batch_clock(raw: DataFrame) -> datetime | None:
    """The clock of a micro-batch: its newest arrival, the same again on a replay."""
    return raw.agg(F.max("arrived_at").alias("at")).first()["at"]


def run_stream(
    feed: Feed,
    raw: DataFrame,
    listing: Listing,
    checkpoint: str,
    once: bool = True,
    interval: str = "1 minute",
    dedup_span: str | None = None,
) -> StreamingQuery:
    """Run ``raw`` (``value``, ``arrived_at``) through the feed.

    ``once`` processes what is there and stops. With ``dedup_span`` an envelope equal
    to one that arrived within the span is dropped, also across batches. Spark allows
    one running query per checkpoint, and numbers its batches the same after a
    restart, so a repeated batch overwrites its own outputs; a new checkpoint starts
    at 0 again and needs a new ``work`` folder.
    """
    if dedup_span is not None:
        raw = dedup_events_stream(raw, [], "value", "arrived_at", dedup_span)

    def one_batch(df: DataFrame, batch_id: int) -> None:
        arrived = stored(df.select("value", "arrived_at"), feed.folder("raw", batch_id))
        clock = batch_clock(arrived)
        if clock is not None:
            run_batch(feed, arrived, listing, batch_id, clock)

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        raw.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

"""Event rule, envelope parsing and content de-duplication."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import content_hash, first_or_null
from tidemark.operators.latest import earliest_by
from tidemark.schemas import ENVELOPE, EVENT


def event_rule(
    event: Column,
    sources: Sequence[str],
    detail_types: Sequence[str],
    datasets: Sequence[str] | None = None,
) -> Column:
    """True when source, type and at least one resource match; never NULL.

    ``datasets=None`` accepts every resource.
    """
    rule = event["source"].isin(*sources) & event["detail-type"].isin(*detail_types)
    if datasets is not None:
        wanted = F.array(*[F.lit(d) for d in datasets])
        rule = rule & F.arrays_overlap(event["resources"], wanted)
    return F.coalesce(rule, F.lit(False))


def match_events(
    events: DataFrame,
    sources: Sequence[str],
    detail_types: Sequence[str],
    datasets: Sequence[str] | None = None,
    event: str = "event",
) -> DataFrame:
    """Rows whose ``event`` struct satisfies the rule."""
    return events.where(event_rule(F.col(event), sources, detail_types, datasets))


def open_envelopes(raw: DataFrame, value: str = "value", last_only: bool = False) -> DataFrame:
    """One row per queue record or manual start, with the parsed ``event``.

    A manual start wins when both shapes are present. ``last_only`` keeps the last
    record of each envelope; by default every record counts. Bodies are parsed
    before the records are unnested: a later filter on ``event`` then reads fields
    of a finished value instead of parsing the body again for each of them.
    """
    keep = [c for c in raw.columns if c != value]
    opened = raw.select(*keep, F.from_json(value, ENVELOPE).alias("_e"))
    records = F.when(F.col("_e.InitialInit").isNull(), F.col("_e.Records"))
    if last_only:
        records = F.slice(records, F.when(F.size(records) > 0, -1).otherwise(1), 1)
    parsed = F.transform(
        records, lambda r: F.struct(r["body"].alias("body"), F.from_json(r["body"], EVENT).alias("event"))
    )
    return opened.select(
        *keep,
        F.col("_e.InitialInit").alias("manual"),
        F.posexplode_outer(parsed).alias("record_pos", "_r"),
    ).select(*keep, "manual", "record_pos", "_r.body", "_r.event")


def requested_revisions(opened: DataFrame) -> DataFrame:
    """(dataset_id, revision_id) of every opened record; both start forms alike."""
    keep = [c for c in opened.columns if c not in ("manual", "record_pos", "body", "event")]
    manual = F.col("manual").isNotNull()
    dataset = F.when(manual, F.col("manual.data_set_id")).otherwise(first_or_null(F.col("event.resources")))
    revisions = F.when(manual, F.array("manual.RevisionIds")).otherwise(F.col("event.detail.RevisionIds"))
    return (
        opened.select(*keep, dataset.alias("dataset_id"), F.explode(revisions).alias("revision_id"))
        .where(F.col("dataset_id").isNotNull() & F.col("revision_id").isNotNull())
    )


def parse_events(raw: DataFrame, value: str = "value", last_only: bool = False) -> DataFrame:
    """Envelope text to (dataset_id, revision_id) rows, without the event rule."""
    return requested_revisions(open_envelopes(raw, value, last_only))


def unreadable_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Records that name no data set or no revision: the reject output of intake."""
    opened = open_envelopes(raw, value)
    manual = F.col("manual").isNotNull()
    named = F.when(
        manual, F.col("manual.data_set_id").isNotNull() & F.col("manual.RevisionIds").isNotNull()
    ).otherwise(
        first_or_null(F.col("event.resources")).isNotNull()
        & (F.size(F.array_compact("event.detail.RevisionIds")) > 0)
    )
    return opened.where(~F.coalesce(named, F.lit(False)))


def dedup_events(events: DataFrame, group: Sequence[str], body: str, order: Sequence[str]) -> DataFrame:
    """Keep the earliest of equal bodies within a message group.

    Bodies are compared by SHA-256, so the shuffle key is short and copies are
    reduced to one row per map task before they move.
    """
    hashed = events.withColumn("_h", content_hash(F.col(body)))
    return earliest_by(hashed, [*group, "_h"], order).drop("_h")

"""One run of the feed: requested revisions in, CSV, state and messages out.

Every output of a run is written under its batch number and written again from the
same inputs by a replay, so a run that died anywhere can simply be repeated: CSV
and state come out unchanged, messages are sent at least once.
"""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import file_stem, parent, revision_prefix
from tidemark.operators.events import event_rule, open_envelopes, requested_revisions, unreadable_events
from tidemark.operators.mapping import HEARTBEAT_MAPPING, Mapping, apply_mapping, failure_counts
from tidemark.operators.messages import outbound_messages, split_oversize
from tidemark.operators.quarantine import Repair, redrive, write_quarantine
from tidemark.operators.revisions import (
    LIST_ROWS,
    asset_descriptor,
    build_revisions,
    clashing_names,
    data_assets,
)
from tidemark.operators.sizing import broadcast_if_small, short_lists
from tidemark.operators.snapshots import drop_snapshots, state_as_of, write_snapshot
from tidemark.operators.state import (
    STEP_PUT,
    STEP_UPDATE,
    append_assets,
    append_state,
    assets_of,
    given_up,
    read_asset_log,
    ready_rows,
    update_revisions,
)
from tidemark.schemas import CORRUPT, KEYS, MESSAGE_LIMIT_BYTES, READY, SUCCESS
from tidemark.sinks.csv import name_folders, write_csv
from tidemark.sinks.manifest import live_parts, publish
from tidemark.sinks.messages import write_messages
from tidemark.sources.assets import common_folder, existing_folders, locate_assets, scan_assets, scan_folders

#: Partition columns of the CSV output: one folder per asset.
CSV_BY = [*KEYS, "asset_stem"]


@dataclass(frozen=True)
class Feed:
    """Where a feed reads and writes, and its choices.

    ``root`` is the folder asset keys are relative to; ``work`` holds the logs,
    messages and rejects, all by batch number: one series of numbers per ``work``
    folder. The CSV stays in its partitioned layout below ``root``, and a manifest gives the
    parts, bytes and rows of every named output (``feed_outputs``); ``named=True`` renames
    each output from the driver instead. ``inputs`` is
    the folder below ``root`` that holds all data files, if there is one: a scan of more
    folders than can be named reads that, or else the deepest folder common to the batch's
    files. A revision that can't be
    exported is listed again by later batches, ``max_attempts`` times in all, and is then
    REJECTED until an event asks for it anew. After every ``snapshot_every`` batches the
    state is compacted.
    """

    root: str
    work: str
    bucket: str
    sources: tuple[str, ...]
    detail_types: tuple[str, ...]
    datasets: tuple[str, ...] | None = None
    prefix: str = "heartbeat"
    csv_prefix: str = "heartbeat_csv"
    mappings: tuple[Mapping, ...] = tuple(HEARTBEAT_MAPPING)
    mode: str = "revision"
    limit_bytes: int = MESSAGE_LIMIT_BYTES
    list_rows: int = LIST_ROWS
    named: bool = False
    inputs: str = ""
    max_attempts: int = 8
    snapshot_every: int = 16

    @property
    def state_log(self) -> str:
        return f"{self.work}/state"

    @property
    def asset_log(self) -> str:
        return f"{self.work}/assets"

    @property
    def snapshots(self) -> str:
        return f"{self.work}/snapshots"

    @property
    def manifest(self) -> str:
        return f"{self.work}/manifest"

    @property
    def quarantine(self) -> str:
        return f"{self.work}/quarantine"

    @property
    def redriven(self) -> str:
        return f"{self.work}/redriven"

    def folder(self, name: str, batch: int) -> str:
        return f"{self.work}/{name}/batch={batch}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: short lineage, and it can be measured."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: From the requested (dataset_id, revision_id) rows to their files.
Listing = Callable[[DataFrame], DataFrame]


def intake(
    feed: Feed, raw: DataFrame, listing: Listing, batch: int, clock: datetime, repair: Repair | None = None
) -> None:
    """Event envelopes to READY rows.

    ``listing`` gives (dataset_id, revision_id, pos, name[, key][, file_path, bytes]) of the
    revisions it is handed; other revisions in it are ignored, so a fixed table will do. A
    revision asked for twice in a batch is put once. Records that can't be read go to
    ``quarantine`` with their text; ``repair`` takes earlier ones back in (see ``redrive``).
    """
    spark = raw.sparkSession
    drop_snapshots(spark, feed.snapshots, batch)
    taken = raw.select("value")
    if repair is not None:
        taken = taken.unionByName(redrive(spark, feed.quarantine, feed.redriven, batch, repair))
    opened = open_envelopes(taken)
    matches = event_rule(F.col("event"), feed.sources, feed.detail_types, feed.datasets)
    wanted = opened.where(F.col("manual").isNotNull() | matches)
    unreadable_events(taken).select("manual", "record_pos", "body").write.mode("overwrite").json(
        feed.folder("unreadable", batch)
    )
    write_quarantine(taken, feed.quarantine, batch)
    asked = requested_revisions(wanted).select(*KEYS).distinct().withColumn("attempts", F.lit(1).cast("long"))
    # what is still READY could not be exported before: it is listed again, as its next attempt
    before = state_as_of(spark, feed.state_log, feed.snapshots, (batch - 1, STEP_UPDATE), READY, feed.datasets)
    again = before.select(*KEYS, (F.coalesce("attempts", F.lit(1)) + 1).alias("attempts"))
    asked = asked.unionByName(again).groupBy(*KEYS).agg(F.min("attempts").alias("attempts"))
    requested = stored(asked, feed.folder("requested", batch))
    found = listing(requested.select(*KEYS)).join(broadcast_if_small(requested.select(*KEYS)), KEYS, "left_semi")
    at = F.lit(clock)
    if "key" not in found.columns:
        found = found.withColumn(
            "key",
            F.concat(revision_prefix(feed.prefix, at, F.col("dataset_id"), F.col("revision_id")), F.col("name")),
        )
    append_assets(found, feed.asset_log, batch)
    listed = read_asset_log(spark, feed.asset_log).where(F.col("batch") == batch)
    revisions = build_revisions(listed, feed.bucket, max_rows=feed.list_rows)
    # every requested revision gets its row, with or without files
    every = requested.join(revisions, KEYS, "left").withColumn("n_data_files", F.coalesce("n_data_files", F.lit(0)))
    append_state(ready_rows(every, at), feed.state_log, batch, STEP_PUT)


def _reject(df: DataFrame, reason: str) -> DataFrame:
    return df.select(*KEYS, F.lit(reason).alias("reason"))


def _rejected(ready: DataFrame, assets: DataFrame) -> DataFrame:
    """Ready revisions that cannot be exported as they stand; they stay READY."""
    return (
        _reject(ready.where("n_data_files = 0"), "no data files")
        .unionByName(_reject(assets.where("file_path IS NULL"), "missing or empty file"))
        .unionByName(_reject(clashing_names(assets, CSV_BY), "name clash"))
        .groupBy(*KEYS)
        .agg(F.max("reason").alias("reason"))
    )


def _located(wanted: DataFrame, root: str, folders: list[str] | None) -> DataFrame:
    """Assets with the path of their file: as the listing told it, else looked up by key."""
    known = wanted.where("file_path IS NOT NULL")
    unknown = wanted.where("file_path IS NULL").drop("file_path", "bytes")
    if unknown.isEmpty():
        return known
    return known.unionByName(locate_assets(unknown, root, folders))


def _write_csv(feed: Feed, assets: DataFrame, folders: list[str] | None, batch: int) -> tuple[DataFrame, dict]:
    """All assets through one scan, one mapping and one write; returns their CSV keys.

    The rows never shuffle: each scan task writes the parts of the files it read.
    Lines that did not parse are counted during the write and left out.
    """
    spark = assets.sparkSession
    lines = Observation("lines")
    found = scan_assets(assets.select(*CSV_BY, "file_path"), feed.root, folders=folders)
    scanned = found.observe(
        lines,
        F.count(F.lit(1)).alias("n_lines"),
        F.count(CORRUPT).alias("n_corrupt"),
        *failure_counts(found.schema, feed.mappings, "n_bad_"),
    )
    rows = apply_mapping(scanned.where(F.col(CORRUPT).isNull()), feed.mappings, keep=CSV_BY)

    def counts() -> dict:
        """Counts of the write; lines that did not parse are kept with their text."""
        told = {k: v for k, v in lines.get.items() if v or not k.startswith("n_bad_")}
        bad = found.where(F.col(CORRUPT).isNotNull()) if told["n_corrupt"] else found.limit(0)
        # what could be read of a line stands beside it: a field that isn't read isn't checked
        parsed = F.to_json(F.struct(*[c for c in found.columns if c not in (*CSV_BY, "file_path", CORRUPT)]))
        bad.select(*CSV_BY, F.col(CORRUPT).alias("line"), parsed.alias("parsed")).write.mode("overwrite").parquet(
            feed.folder("corrupt_lines", batch)
        )
        return told

    names = assets.select(*CSV_BY, F.col("csv_key").alias("target"))
    if feed.named:
        staging = feed.folder("staging", batch)
        write_csv(rows, staging, "overwrite", CSV_BY)
        header = ",".join(c for c in rows.columns if c not in CSV_BY)
        name_folders(spark, staging, feed.root, names, CSV_BY, header)
        return stored(assets, feed.folder("csv_assets", batch)), counts()
    place = f"{feed.csv_prefix}/batch={batch}"
    write_csv(rows, f"{feed.root}/{place}", "overwrite", CSV_BY)
    parts = publish(spark, feed.root, place, names, CSV_BY, feed.manifest, batch)
    folders = parts.groupBy(*CSV_BY).agg(parent(F.min("key")).alias("csv_key"))
    keyed = assets.drop("csv_key").join(folders, CSV_BY, "left")
    return stored(keyed, feed.folder("csv_assets", batch)), counts()


def export(feed: Feed, spark: SparkSession, batch: int, clock: datetime) -> dict:
    """Ready revisions to CSV, then SUCCESS rows, then messages; returns line counts.

    State is read as of this batch's intake, so a replay sees the same revisions
    even when the first attempt already marked them.
    """
    state = state_as_of(spark, feed.state_log, feed.snapshots, (batch, STEP_PUT), READY, feed.datasets)
    ready = stored(state, feed.folder("ready", batch))
    # whatever is READY was put by this batch: what earlier ones left was listed again
    asset_log = read_asset_log(spark, feed.asset_log).where(F.col("batch") == batch)
    found = assets_of(asset_log, broadcast_if_small(ready.select(*KEYS, "batch")))
    target = revision_prefix(feed.csv_prefix, F.lit(clock), F.col("dataset_id"), F.col("revision_id"))
    wanted = (
        data_assets(found, feed.bucket, also=("file_path", "bytes"))
        .withColumn("asset_stem", file_stem(F.col("name")))
        .withColumn("key", F.col("asset.key"))
        .withColumn("csv_key", F.concat(target, "asset_stem", F.lit(".csv")))
    )
    narrowed = scan_folders(wanted, feed.root, inputs=feed.inputs) or common_folder(wanted, feed.root)
    folders = existing_folders(spark, narrowed or []) or None
    assets = stored(_located(wanted, feed.root, folders), feed.folder("ready_assets", batch))
    rejects = stored(_rejected(ready, assets), feed.folder("rejects", batch))
    accepted = stored(
        assets.join(broadcast_if_small(rejects), KEYS, "left_anti"), feed.folder("exported_assets", batch)
    )
    counts = {"n_lines": 0, "n_corrupt": 0}
    if accepted.isEmpty():
        written = accepted
    else:
        written, counts = _write_csv(feed, accepted, folders, batch)

    csv_asset = asset_descriptor(feed.bucket, F.col("csv_key"))
    csv_lists = short_lists(written, KEYS, ["pos", "name"], csv_asset, feed.list_rows, "data_files_csv")
    # a list too long for a row is NULL there; its rows are those of feed_files
    n_files = written.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_csv_files"))
    changes = csv_lists.join(n_files, KEYS).withColumn("status", F.lit(SUCCESS))
    done = ready.join(changes.select(*KEYS), KEYS, "left_semi")
    updated = update_revisions(done, changes, ["status", "data_files_csv", "n_csv_files"])
    stuck = given_up(ready.join(changes.select(*KEYS), KEYS, "left_anti"), feed.max_attempts)
    append_state(updated.unionByName(stuck), feed.state_log, batch, STEP_UPDATE)

    outbox = stored(outbound_messages(written, feed.mode, feed.limit_bytes), feed.folder("outbox", batch))
    sent, oversize = split_oversize(outbox, feed.limit_bytes)
    write_messages(sent, feed.folder("messages", batch))
    oversize.select(*KEYS, "pos", "name").write.mode("overwrite").parquet(feed.folder("oversize", batch))
    if batch % feed.snapshot_every == feed.snapshot_every - 1:
        write_snapshot(spark, feed.state_log, feed.snapshots, batch)
    return counts


def run_batch(
    feed: Feed, raw: DataFrame, listing: Listing, batch: int, clock: datetime, repair: Repair | None = None
) -> dict:
    """Intake and export of one batch; safe to repeat with the same arguments."""
    intake(feed, raw, listing, batch, clock, repair)
    return export(feed, raw.sparkSession, batch, clock)


def feed_state(feed: Feed, spark: SparkSession, status: str | None = None) -> DataFrame:
    """State of every revision now, or of those with one status."""
    return state_as_of(spark, feed.state_log, feed.snapshots, status=status)


def feed_files(feed: Feed, spark: SparkSession) -> DataFrame:
    """Every file of every exported revision, however many it has: key and CSV key, one row each."""
    done = feed_state(feed, spark, SUCCESS).select(*KEYS, "batch")
    kind = f"{', '.join(f'{c} STRING' for c in KEYS)}, pos BIGINT, name STRING, key STRING, csv_key STRING, batch BIGINT"
    files = spark.read.schema(kind).parquet(f"{feed.work}/csv_assets")
    return files.join(done, [*KEYS, "batch"], "left_semi").drop("batch")


def feed_outputs(feed: Feed, spark: SparkSession) -> DataFrame:
    """The parts that each named output holds now, from the manifest (not for ``named=True``)."""
    return live_parts(spark, feed.manifest, CSV_BY)

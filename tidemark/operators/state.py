"""State of each (data set, revision): an append-only log and its latest view."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import time_text
from tidemark.operators.latest import latest_by
from tidemark.operators.sizing import tasks_for
from tidemark.schemas import ASSET_LOG, KEYS, READY, REJECTED, STATE_LOG

#: Order of two versions of a key written by the same batch.
STEP_PUT = 0
STEP_UPDATE = 1


def ready_rows(revisions: DataFrame, at: Column) -> DataFrame:
    """Revision rows as new state rows: status READY and the export stamp as text."""
    return revisions.withColumns(
        {"status": F.lit(READY), "export_time_stamp": time_text(at)}
    )


def given_up(ready: DataFrame, most: int) -> DataFrame:
    """Ready rows asked for ``most`` times already, as REJECTED rows: a new event puts them again."""
    return ready.where(F.coalesce("attempts", F.lit(1)) >= most).withColumn("status", F.lit(REJECTED))


def put_revisions(
    state: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] | None = None
) -> DataFrame:
    """Replace whole rows by key: new rows, plus old rows no new row replaces.

    With ``order`` the last of several new rows of a key counts; without it ``new``
    must hold one row per key at most.
    """
    if order is not None:
        new = latest_by(new, list(keys), list(order)).drop(*[c for c in order if c not in state.columns])
    kept = state.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def update_revisions(
    state: DataFrame, changes: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Set ``columns`` where a change row exists, keep everything else.

    ``changes`` must hold at most one row per key (see ``latest_by``). A change to
    NULL counts as a change, so the match is decided by a marker, not by the value.
    """
    marked = changes.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = state.join(marked, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in state.columns
        ]
    )


def _conform(df: DataFrame, schema: T.StructType, fixed: Mapping[str, int]) -> DataFrame:
    """Columns of ``schema`` in order; absent ones are NULL."""
    return df.select(
        *[
            (
                F.lit(fixed[f.name])
                if f.name in fixed
                else F.col(f.name) if f.name in df.columns else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append_state(rows: DataFrame, log: str, batch: int, step: int) -> None:
    """Write one step of one batch; writing it again replaces it, so a replay is safe."""
    body = _conform(rows, STATE_LOG, {"batch": batch, "step": step}).drop("batch", "step")
    body.write.mode("overwrite").parquet(f"{log}/batch={batch}/step={step}")


def append_assets(listing: DataFrame, log: str, batch: int) -> None:
    """Write the listed files of one batch's revisions, one row per file."""
    _conform(listing, ASSET_LOG, {"batch": batch}).drop("batch").write.mode("overwrite").parquet(
        f"{log}/batch={batch}"
    )


def read_state_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(STATE_LOG).option("basePath", log).parquet(log)


def read_asset_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(ASSET_LOG).option("basePath", log).parquet(log)


def current_state(log: DataFrame, as_of: tuple[int, int] | None = None) -> DataFrame:
    """Latest version per key, optionally as it stood after (batch, step).

    ``as_of`` filters the log's partition columns, so later folders are not read.
    """
    if as_of is not None:
        batch, step = as_of
        log = log.where((F.col("batch") < batch) | ((F.col("batch") == batch) & (F.col("step") <= step)))
    return latest_by(log, KEYS, ["batch", "step"])


def assets_of(asset_log: DataFrame, revisions: DataFrame) -> DataFrame:
    """Listed files of the given state rows, as the batch that put them saw them."""
    return asset_log.join(revisions.select(*KEYS, "batch"), [*KEYS, "batch"], "left_semi")


def ready_revisions(state: DataFrame, dataset_ids: Sequence[str] | None = None, status: str = READY) -> DataFrame:
    """State rows of the given data sets that wait for export.

    Over a log view the data-set filter passes below the aggregate to the scan; the
    status filter must not, since an older version may have held that status.
    """
    chosen = state if dataset_ids is None else state.where(F.col("dataset_id").isin(*dataset_ids))
    return chosen.where(F.col("status") == status)


def write_by_status(state: DataFrame, path: str, status: str = "status") -> None:
    """Snapshot partitioned by status. A task sorts its rows by status to write them, so they are
    counted and dealt out by key in bounded numbers, whatever their status."""
    n_tasks = tasks_for(state.count(), 0)
    state.repartition(n_tasks, *KEYS).write.mode("overwrite").partitionBy(status).parquet(path)


def revisions_by_status(snapshot: DataFrame, status: str, column: str = "status") -> DataFrame:
    """Rows of one status; on a status-partitioned snapshot only its folder is read."""
    return snapshot.where(F.col(column) == status)


def drop_expired(state: DataFrame, now: Column, column: str = "time_to_exist") -> DataFrame:
    """Rows without an expiry, or whose expiry (epoch seconds) is still ahead."""
    return state.where(F.col(column).isNull() | (F.col(column) > F.unix_timestamp(now.cast("timestamp"))))

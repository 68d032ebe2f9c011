"""The state log in compacted form: a snapshot, and the batches after it.

A snapshot holds the latest version of every key as of the end of one batch, partitioned by
status, so it is the index by status too. It is never rewritten: a state is the newest
snapshot, less the keys that later batches touched, plus the latest versions of those. Later
batches are few, so their keys are broadcast when small enough and the snapshot's rows don't
move. Rows that do move are dealt out by key to a number of tasks that grows with them (see
``tasks_for``) before anything sorts them: a batch writes a key once a step, so a key has few
rows. Of a status that is asked for only its folder is read. A snapshot counts once Spark
has committed it (``_SUCCESS``); one that was being written when a run died is ignored and
overwritten by the replay.
"""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_by
from tidemark.operators.sizing import broadcast_if_small, tasks_for
from tidemark.operators.state import STEP_UPDATE, drop_expired
from tidemark.schemas import KEYS, STATE_LOG

#: In a snapshot the status is a folder, so it is read last.
SNAPSHOT = T.StructType([*[f for f in STATE_LOG.fields if f.name != "status"], STATE_LOG["status"]])


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbered_folders(spark: SparkSession, path: str, column: str, committed: bool = False) -> list[int]:
    """Numbers of the folders ``column=N`` right below ``path``, in order; one listing."""
    place, fs = _file_system(spark, path)
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
    numbers = sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"{column}=(\d+)", n)))
    if not committed:
        return numbers
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [n for n in numbers if fs.exists(marker(f"{path}/{column}={n}/_SUCCESS"))]


def drop_snapshots(spark: SparkSession, snapshots: str, batch: int) -> None:
    """Delete the snapshots that hold ``batch``: it is about to be written again."""
    for n in numbered_folders(spark, snapshots, "as_of"):
        if n >= batch:
            place, fs = _file_system(spark, f"{snapshots}/as_of={n}")
            fs.delete(place, True)


def _tasks(spark: SparkSession, rows: DataFrame, folders: Sequence[str]) -> int:
    """Tasks for ``rows`` of ``folders``: rows and bytes come from footers and listings."""
    sizes = []
    for folder in folders:
        place, fs = _file_system(spark, folder)
        sizes.append(fs.getContentSummary(place).getLength())
    return tasks_for(rows.count(), sum(sizes))


def _tail(
    spark: SparkSession, log: str, after: int, as_of: tuple[int, int] | None
) -> tuple[DataFrame, list[str]]:
    """Versions written after batch ``after``, from the folders of those batches alone, and the folders."""
    batches = [
        n for n in numbered_folders(spark, log, "batch") if n > after and (as_of is None or n <= as_of[0])
    ]
    if not batches:
        return spark.createDataFrame([], STATE_LOG), []
    folders = [f"{log}/batch={n}" for n in batches]
    rows = spark.read.schema(STATE_LOG).option("basePath", log).parquet(*folders)
    if as_of is not None:
        rows = rows.where((F.col("batch") < as_of[0]) | (F.col("step") <= as_of[1]))
    return rows, folders


def state_as_of(
    spark: SparkSession,
    log: str,
    snapshots: str,
    as_of: tuple[int, int] | None = None,
    status: str | None = None,
    dataset_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Latest version of every key after (batch, step), or of all there is.

    With ``status`` only keys that hold it: of the snapshot one folder is read.
    """
    known = numbered_folders(spark, snapshots, "as_of", committed=True)
    if as_of is not None:
        # a snapshot is taken after its batch's last step
        last = as_of[0] if as_of[1] >= STEP_UPDATE else as_of[0] - 1
        known = [n for n in known if n <= last]
    newest = known[-1] if known else -1
    tail, folders = _tail(spark, log, newest, as_of)
    n_tasks = _tasks(spark, tail, folders)
    if dataset_ids is not None:
        tail = tail.where(F.col("dataset_id").isin(*dataset_ids))
    tail = tail.repartition(n_tasks, *KEYS)
    latest = latest_by(tail, KEYS, ["batch", "step"])
    if not known:
        return latest if status is None else latest.where(F.col("status") == status)
    base = spark.read.schema(SNAPSHOT).parquet(f"{snapshots}/as_of={newest}").select(*STATE_LOG.names)
    if dataset_ids is not None:
        base = base.where(F.col("dataset_id").isin(*dataset_ids))
    if status is not None:
        base, latest = (df.where(F.col("status") == status) for df in (base, latest))
    touched = tail.select(*KEYS).distinct()
    later = broadcast_if_small(touched)
    if later is touched:
        n_tasks = max(n_tasks, _tasks(spark, base, [f"{snapshots}/as_of={newest}"]))
        base, later = base.repartition(n_tasks, *KEYS), touched.repartition(n_tasks, *KEYS)
    kept = base.join(later, KEYS, "left_anti")
    return kept.select(*STATE_LOG.names).unionByName(latest)


def write_snapshot(
    spark: SparkSession, log: str, snapshots: str, batch: int, now: Column | None = None
) -> None:
    """Compact the log as of the end of ``batch``; rows expired at ``now`` are left out.

    A task sorts its rows by status to write them, so it gets a bounded number of them, whatever
    their status: a few files for each status, and none too large.
    """
    state = state_as_of(spark, log, snapshots, (batch, STEP_UPDATE))
    known = [n for n in numbered_folders(spark, snapshots, "as_of", committed=True) if n <= batch]
    tail, folders = _tail(spark, log, known[-1] if known else -1, (batch, STEP_UPDATE))
    if known:
        folders.append(f"{snapshots}/as_of={known[-1]}")
        tail = tail.select(*KEYS).unionAll(spark.read.schema(SNAPSHOT).parquet(folders[-1]).select(*KEYS))
    if now is not None:
        state = drop_expired(state, now)
    n_tasks = _tasks(spark, tail, folders)
    state.repartition(n_tasks, *KEYS).write.mode("overwrite").partitionBy("status").parquet(
        f"{snapshots}/as_of={batch}"
    )

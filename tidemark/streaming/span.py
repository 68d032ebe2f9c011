"""Keyed state with timers: exact-span de-duplication and job tracking as streams."""

import json
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.status import COMPLETED, ERROR
from tidemark.functions.text import content_hash

TIMED_OUT = "TIMED_OUT"


def dedup_within_span_stream(
    events: DataFrame, group: Sequence[str], body: str, ts: str, span_micros: int
) -> DataFrame:
    """Streaming form of ``dedup_within_span``: the state of a body is its last accepted time.

    ``events`` must have a watermark on ``ts``. The state goes once the watermark is a span
    past it. Rows that come within one micro-batch are taken in time order; one that arrives
    in a later micro-batch than a newer copy counts as a copy of that.
    """
    keyed = events.withColumn("_hash", content_hash(F.col(body).cast("string")))
    schema = events.schema
    names = schema.names

    def accept(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values([ts, *names], kind="stable")
        last = state.get[0] if state.exists else None
        kept = []
        for place, at in enumerate(rows[ts].astype("datetime64[us]").astype("int64").tolist()):
            if last is None or at >= last + span_micros:
                kept.append(place)
                last = at
        state.update((last,))
        # not before the watermark, which Spark refuses
        state.setTimeoutTimestamp(max((last + span_micros) // 1000, state.getCurrentWatermarkMs()) + 1)
        if kept:
            yield rows.iloc[kept][names]

    return keyed.groupBy(*group, "_hash").applyInPandasWithState(
        accept, schema, "last BIGINT", "append", GroupStateTimeout.EventTimeTimeout
    )


def _packed(jobs: set) -> bytes:
    """Names of jobs in a few bytes each: names of one key have much in common."""
    return zlib.compress(json.dumps(sorted(jobs, key=lambda j: (j is not None, j or ""))).encode(), 1)


def _unpacked(jobs: bytes) -> set:
    return set(json.loads(zlib.decompress(jobs))) if jobs else set()


def track_jobs(events: DataFrame, keys: Sequence[str], ts: str, wait_millis: int) -> DataFrame:
    """One row per key when its jobs are settled: COMPLETED, ERROR, or TIMED_OUT.

    ``events`` has the keys, job_id, state, n_jobs (how many jobs the key has) and a watermark
    on ``ts``. A key is COMPLETED once all its jobs are, ERROR with the first failed one, and
    TIMED_OUT when the watermark passes ``wait_millis`` after its first event. Held per key:
    the jobs done so far, compressed, and after settling only that it is settled, for the same
    wait. The rows of a key are put in order only if their order decides.
    """
    outcome = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema.fields if f.name in keys)
    held = "first BIGINT, done BINARY, n_done BIGINT, settled BOOLEAN"

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def told(status: str, n_done: int) -> pd.DataFrame:
            return pd.DataFrame({**{k: [v] for k, v in zip(keys, key, strict=True)}, "status": [status], "n_done": [n_done]})

        if state.hasTimedOut:
            _, _, n_done, settled = state.get
            state.remove()
            if not settled:
                yield told(TIMED_OUT, n_done)
            return
        parts = list(frames)
        first, packed, n_done, settled = state.get if state.exists else (None, b"", 0, False)
        at = min(int(part[ts].to_numpy().astype("datetime64[ms]").astype("int64").min()) for part in parts if len(part))
        first = at if first is None else min(first, at)
        done, outcomes = set(), []
        if not settled:
            done = _unpacked(packed)
            states = [s for part in parts for s in part["state"].tolist()]
            wanted = {n for part in parts for n in part["n_jobs"].unique().tolist()}
            n_jobs = wanted.pop()
            if not wanted and n_jobs > len(done) and ERROR not in states:
                # whatever their order, the key is complete with the job that makes up the number
                jobs = (job for part in parts for job in part["job_id"].tolist())
                done.update(job for job, now in zip(jobs, states, strict=True) if now == COMPLETED)
                outcomes = [(COMPLETED, n_jobs)] if len(done) >= n_jobs else []
            else:
                rows = pd.concat(parts, ignore_index=True).sort_values([ts, "job_id"], kind="stable")
                outcomes = _settling(rows, done)
        for status, n in outcomes:
            settled = True
            yield told(status, int(n))
        state.update((first, b"" if settled else _packed(done), len(done), settled))
        state.setTimeoutTimestamp(max(first + wait_millis, state.getCurrentWatermarkMs()) + 1)

    return events.groupBy(*keys).applyInPandasWithState(
        follow, f"{outcome}, status STRING, n_done BIGINT", held, "append", GroupStateTimeout.EventTimeTimeout
    )


def _settling(rows: pd.DataFrame, done: set) -> list[tuple[str, int]]:
    """What settles the key among its ordered ``rows``, if anything; adds to ``done`` what comes before."""
    for job, now, n_jobs in zip(rows["job_id"], rows["state"], rows["n_jobs"], strict=True):
        if now == ERROR:
            return [(ERROR, len(done))]
        if now == COMPLETED:
            done.add(job)
            if len(done) >= n_jobs:
                return [(COMPLETED, len(done))]
    return []

"""What several operators share: reading tables, words, written intermediates."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Words are runs of anything but space and the ASCII controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

#: Lower-cases A-Z only, as the word rules ask.
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Rows in one Arrow batch. Texts may be long: a batch, not a partition, must fit.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds; a setting of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def lower_ascii(text: str) -> str:
    return text.translate(ASCII_LOWER)


def word_list(text: str | None) -> list[str]:
    """Lower-cased words of a text."""
    return WORD_RE.findall(text.translate(ASCII_LOWER)) if text else []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame) -> DataFrame:
    """``docs`` with every column but ``text`` under a name of its place.

    Whatever other columns are called, they can't clash with what an operator computes.
    """
    return docs.toDF(*["text" if c == "text" else f"carried_{i}" for i, c in enumerate(docs.columns)])


def restored(df: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of its ``carried`` rows, some of them changed."""
    columns = []
    for i, c in enumerate(docs.columns):
        held = F.col("text" if c == "text" else f"carried_{i}")
        columns.append((changed[c].cast(docs.schema[i].dataType) if c in changed else held).alias(c))
    return df.select(*columns)


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``fn`` over every Arrow batch, with bounded batches."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def id_lists(texts: list[bytes]) -> pa.ListArray:
    """Arrow lists of int32 from the bytes of each list."""
    offsets = np.zeros(len(texts) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in texts], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(texts))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def spread(df: DataFrame, row_bytes: int, rows: int, *keys: str) -> DataFrame:
    """Deal rows out by key, so that a partition holds about 8 MB however many rows there are."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows * row_bytes / (8 << 20)))
    return df.repartition(parts, *keys)


def sorted_groups(batches: Iterator[pa.RecordBatch], ids: list[str]) -> Iterator[pa.Table]:
    """Tables of equal ``ids`` from sorted batches; a group may reach over several batches."""
    held: list[pa.Table] = []
    held_id = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        names = list(zip(*(part.column(c).to_pylist() for c in ids), strict=True))
        starts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
        for start, end in zip(starts, [*starts[1:], len(names)], strict=True):
            if held and held_id != names[start]:
                yield pa.concat_tables(held)
                held = []
            held_id = names[start]
            held.append(part.slice(start, end - start))
    if held:
        yield pa.concat_tables(held)

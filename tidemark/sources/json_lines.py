"""JSON-lines scans, batch and incremental."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CORRUPT, HEARTBEAT


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_json_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = HEARTBEAT,
    keep_corrupt: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """One record per line, explicit schema.

    A broken line, or a value that does not fit its declared type, keeps its text
    in ``_corrupt_record``. ``keep_corrupt=False`` lets column pruning drop the raw
    text when nobody counts the rejects.
    """
    return (
        spark.read.schema(_with_corrupt(schema) if keep_corrupt else schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", "false")
        .option("recursiveFileLookup", str(recursive).lower())
        .json(paths if isinstance(paths, str) else list(paths))
    )


def read_variant_lines(spark: SparkSession, paths: str | Sequence[str], column: str = "v") -> DataFrame:
    """Every line as one Variant, for files that disagree on types."""
    return spark.read.option("singleVariantColumn", column).json(
        paths if isinstance(paths, str) else list(paths)
    )


def stream_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = HEARTBEAT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental scan: a file committed in the checkpoint is never read again."""
    reader = (
        spark.readStream.schema(_with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", "false")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def corrupt_summary(lines: DataFrame) -> DataFrame:
    """One row: how many lines were read and how many did not parse.

    All fields are referenced, so that a value of the wrong type in any of them
    counts: a field that is pruned is not checked.
    """
    fields = F.struct(*[c for c in lines.columns if c != CORRUPT])
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(F.col(CORRUPT).isNotNull(), F.to_json(fields))).alias("n_corrupt"),
    )

"""Explicit schemas of every record the feed reads or writes.

Schemas are always given to the readers: inference costs an extra pass over the
input and would widen a column when one file disagrees.
"""

from pyspark.sql import types as T

# Names and constants other systems see.
READY = "READY"
SUCCESS = "SUCCESS"
DATASET_NAME = "heartbeat"
MANIFEST_PREFIX = "manifest"
MAPPED_FIELD = "timestampssincelastrevision"
MESSAGE_LIMIT_BYTES = 2048
GATE_MINUTES = 10

#: Asked for so often without an export that it is not looked for again.
REJECTED = "REJECTED"

KEYS = ["dataset_id", "revision_id"]

CORRUPT = "_corrupt_record"

HEARTBEAT = T.StructType([T.StructField(MAPPED_FIELD, T.ArrayType(T.StringType()))])

#: One event as it travels in a queue record's ``body`` text.
EVENT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("detail-type", T.StringType()),
        T.StructField("resources", T.ArrayType(T.StringType())),
        T.StructField(
            "detail",
            T.StructType([T.StructField("RevisionIds", T.ArrayType(T.StringType()))]),
        ),
    ]
)

#: A queue batch, or a manual start; exactly one of the two fields is set.
ENVELOPE = T.StructType(
    [
        T.StructField(
            "InitialInit",
            T.StructType(
                [
                    T.StructField("data_set_id", T.StringType()),
                    T.StructField("RevisionIds", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "Records",
            T.ArrayType(T.StructType([T.StructField("body", T.StringType())])),
        ),
    ]
)

ASSET = T.StructType(
    [
        T.StructField("bucket", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)

DATA_FILES = T.MapType(T.StringType(), T.ArrayType(ASSET))

LISTING = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("revision_id", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)

#: One version of one state row. ``batch``/``step`` order the versions of a key.
STATE_LOG = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("revision_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("export_time_stamp", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("n_data_files", T.LongType()),
        T.StructField("data_files", DATA_FILES),
        T.StructField("data_files_csv", T.ArrayType(ASSET)),
        T.StructField("time_to_exist", T.LongType()),
        T.StructField("n_csv_files", T.LongType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("batch", T.LongType()),
        T.StructField("step", T.IntegerType()),
    ]
)

#: One listed file of one revision, as found by the batch that put the revision.
ASSET_LOG = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("revision_id", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)

EXPORT_JOBS = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("errors", T.StringType()),
    ]
)

JOB_RUNS = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("state", T.StringType()),
    ]
)

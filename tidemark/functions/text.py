"""JSON text, paths, names and time stamps as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(value: Column) -> Column:
    """JSON text that keeps null fields (Spark's default drops them)."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def array_text(value: Column, style: str = "json") -> Column:
    """A nested value as text: ``json`` parses back, ``cast`` is display form."""
    if style == "json":
        return json_text(value)
    if style == "cast":
        return value.cast("string")
    raise ValueError(f"unknown style: {style}")


def first_or_null(values: Column) -> Column:
    """First element, NULL when the array is empty (``[0]`` would raise)."""
    return F.get(values, F.lit(0))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """Everything before the last slash."""
    return F.regexp_replace(path, "/[^/]*$", "")


def stem(name: Column) -> Column:
    """Name up to its first dot."""
    return F.substring_index(name, ".", 1)


def file_stem(name: Column) -> Column:
    """Name without its last extension, so ``a.v1.json`` and ``a.v2.json`` differ."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def hour_prefix(prefix: str, at: Column) -> Column:
    """``prefix/Y/M/D/H/`` with unpadded numbers."""
    return F.concat_ws("/", F.lit(prefix), F.year(at), F.month(at), F.day(at), F.hour(at), F.lit(""))


def revision_prefix(prefix: str, at: Column, dataset_id: Column, revision_id: Column) -> Column:
    """``prefix/Y/M/D/H/dataset/revision/``."""
    return F.concat(hour_prefix(prefix, at), dataset_id, F.lit("/"), revision_id, F.lit("/"))


def time_text(at: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff``, always with six fraction digits."""
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def epoch_millis(at: Column) -> Column:
    """Whole milliseconds since the epoch, truncated."""
    return F.unix_millis(at.cast("timestamp"))


def content_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def decoded_path(path: Column) -> Column:
    """``_metadata.file_path`` is URI-encoded, a ``binaryFile`` path is not; this
    brings the first into the form of the second."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def path_only(path: Column) -> Column:
    """Path without scheme and authority, so that ``file:/a`` equals ``file:///a``."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")

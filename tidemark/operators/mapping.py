"""Declarative column mapping: select, rename, cast."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import array_text
from tidemark.schemas import MAPPED_FIELD

#: (source, source type, target, target type)
Mapping = tuple[str, str, str, str]

# Fixed value: the one mapping the feed applies.
HEARTBEAT_MAPPING: list[Mapping] = [(MAPPED_FIELD, "array", MAPPED_FIELD, "string")]

NESTED = (T.ArrayType, T.MapType, T.StructType)


def _is_of(held: T.DataType, declared: str) -> bool:
    """A nested type is declared by its kind, any other by its full name."""
    return declared in (held.simpleString(), held.typeName())


def failure_counts(schema: T.StructType, mappings: Sequence[Mapping], prefix: str = "") -> list[Column]:
    """Aggregates, one for each target: how many values can't be cast and so become NULL."""
    counts = []
    for (source, _, target, _), mapped in zip(mappings, mapped_columns(schema, mappings), strict=True):
        counts.append(F.count_if(F.col(f"`{source}`").isNotNull() & mapped.isNull()).alias(f"{prefix}{target}"))
    return counts


def failed_values(df: DataFrame, mappings: Sequence[Mapping]) -> DataFrame:
    """One row: how many values of each target can't be cast and so become NULL."""
    return df.agg(*failure_counts(df.schema, mappings))


def bad_values(df: DataFrame, mappings: Sequence[Mapping], keep: Sequence[str] = ()) -> DataFrame:
    """The values that can't be cast: ``keep``, target and the value as text, one row each."""
    told = [
        F.when(
            F.col(f"`{source}`").isNotNull() & mapped.isNull(),
            F.struct(F.lit(target).alias("target"), F.col(f"`{source}`").cast("string").alias("held")),
        )
        for (source, _, target, _), mapped in zip(mappings, mapped_columns(df.schema, mappings), strict=True)
    ]
    return df.select(*keep, F.explode(F.array_compact(F.array(*told))).alias("_bad")).select(*keep, "_bad.*")


def mapped_columns(schema: T.StructType, mappings: Sequence[Mapping], style: str = "json") -> list[Column]:
    """The select list of a mapping over ``schema``."""
    columns = []
    for source, source_type, target, target_type in mappings:
        held = schema[source].dataType
        if not _is_of(held, source_type):
            raise ValueError(f"{source} is {held.simpleString()}, the mapping says {source_type}")
        column = F.col(f"`{source}`")
        to_text = isinstance(held, NESTED) and target_type == "string"
        columns.append((array_text(column, style) if to_text else column.try_cast(target_type)).alias(target))
    return columns


def apply_mapping(
    df: DataFrame,
    mappings: Sequence[Mapping] = HEARTBEAT_MAPPING,
    style: str = "json",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project ``df`` through ``mappings``; columns not listed are dropped.

    A value that can't be cast becomes NULL (``failed_values`` counts them).

    ``keep`` carries identity columns (data set, revision, asset) past the mapping.
    """
    return df.select(*keep, *mapped_columns(df.schema, mappings, style))


#: What ``schema_of_variant`` says of a value, by the type a mapping declares.
VARIANT_KINDS = {
    "bigint": ("BIGINT",),
    "double": ("DOUBLE", "FLOAT", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "string": ("STRING",),
    "array": ("ARRAY",),
    "struct": ("OBJECT",),
}


def _variant_mapped(held: Column, kind: Column, source_type: str, target_type: str) -> tuple[Column, Column]:
    """(is the value of the declared type, the value mapped)."""
    fits = F.coalesce(F.array_contains(F.lit(list(VARIANT_KINDS[source_type])), F.regexp_extract(kind, "^[A-Z]+", 0)), F.lit(False))
    if source_type in ("array", "struct"):
        if target_type != "string":
            raise ValueError(f"a nested value can only become text, not {target_type}")
        return fits, F.to_json(held)
    return fits, F.try_variant_get(held, "$", source_type).try_cast(target_type)


def apply_variant_mapping(
    df: DataFrame, mappings: Sequence[Mapping], column: str = "v", keep: Sequence[str] = ()
) -> DataFrame:
    """A mapping over records that disagree on types, held as Variant in ``column``.

    A target may be listed once for each type its source field may have; each record takes
    the entry of the type it holds. ``bad`` lists the targets whose value had no such entry
    or didn't cast, with the value's JSON text; a missing or null field is no failure.
    """
    targets: dict[str, list[Mapping]] = {}
    for mapping in mappings:
        targets.setdefault(mapping[2], []).append(mapping)
    columns, bad = [], []
    for target, entries in targets.items():
        value = F.lit(None)
        sources = {entry[0] for entry in entries}
        if len(sources) > 1 or len({entry[3] for entry in entries}) > 1:
            raise ValueError(f"{target} is mapped from several fields or to several types")
        held = F.try_variant_get(column, f"$.{entries[0][0]}", "variant")
        kind = F.schema_of_variant(held)
        for _, source_type, _, target_type in entries:
            fits, mapped = _variant_mapped(held, kind, source_type, target_type)
            value = F.when(fits, mapped).otherwise(value)
        columns.append(value.cast(entries[0][3]).alias(target))
        failed = held.isNotNull() & ~F.is_variant_null(held) & F.col(target).isNull()
        told = F.struct(F.lit(target).alias("target"), F.to_json(held).alias("held"))
        bad.append(F.when(failed, told))
    mapped = df.select("*", *columns)
    return mapped.select(*keep, *targets, F.array_compact(F.array(*bad)).alias("bad"))

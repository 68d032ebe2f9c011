"""Ordered message output."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def ordered_by_group(messages: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows in order within each group.

    Range partitioning splits a hot group at its order values instead of giving it
    to one task; the order then runs on through the numbered partitions.
    """
    return messages.repartitionByRange(group, *order).sortWithinPartitions(group, *order)


def write_messages(
    messages: DataFrame,
    path: str,
    group: str = "dataset_id",
    order: Sequence[str] = ("revision_id", "pos", "name"),
    mode: str = "overwrite",
) -> None:
    """JSON lines, ordered within ``group`` (by file number, then line)."""
    ordered_by_group(messages, group, order).write.mode(mode).option("ignoreNullFields", "false").json(path)

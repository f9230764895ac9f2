"""Dense surrogate keys without a single-task window over the data."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.context import materialize

_SLOT_BITS = 33


def next_start(table: DataFrame, key: str) -> int:
    """The highest key given out so far, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]


def assign_keys(new: DataFrame, order: list[str], key: str, start: int = 0) -> DataFrame:
    """Number rows start+1, start+2, ... in the given order (nulls first)."""
    keyed = assign_keys_by(new.withColumn("_all", F.lit(0)), "_all", order, key, {0: start})
    return keyed.select(key, *new.columns)


def assign_keys_by(
    new: DataFrame, group: str, order: list[str], key: str, starts: dict[object, int]
) -> DataFrame:
    """Number the rows of each group from its start, all groups by one sort.

    The groups are few and named in `starts`. A range sort spreads the rows over tasks; each row keeps
    its task and position. The position plus the number of the group's rows in the tasks before is
    the key. Ranges are sampled, so the numbered rows are materialized once before the counts are taken.
    """
    slots = new.orderBy(group, *[F.col(c).asc_nulls_first() for c in order]).withColumn(
        "_slot", F.monotonically_increasing_id()
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    slots = materialize(slots).select(
        "*", F.shiftright("_slot", _SLOT_BITS).cast("int").alias("_task"), position.alias("_position")
    )
    # One row per group and task: the list is as long as the sort had output partitions.
    runs = slots.groupBy(group, "_task").agg(F.min("_position"), F.count(F.lit(1))).collect()
    offset = F.lit(None).cast("bigint")
    for name, start in starts.items():
        sizes = {task: (first, n) for found, task, first, n in runs if found == name}
        if not sizes:
            continue
        low, high = min(sizes), max(sizes)
        parts = [sizes.get(task, (0, 0)) for task in range(low, high + 1)]
        before = accumulate((n for _, n in parts[:-1]), initial=start)
        # As one literal, so that using the keys costs neither a join nor a job.
        values = ",".join(str(b - first) for b, (first, _) in zip(before, parts, strict=True))
        of_task = F.element_at(F.split(F.lit(values), ",").cast("array<bigint>"), F.col("_task") - low + 1)
        offset = F.when(F.col(group) == F.lit(name), of_task).otherwise(offset)
    return slots.select((offset + F.col("_position") + 1).cast("bigint").alias(key), *new.columns)


def assign_keys_apart(rows: DataFrame, row: str, order: list[str], key: str, start: int = 0) -> DataFrame:
    """`assign_keys` for wide rows: only `order` and the row's number `row` are sorted and stored.

    The rows meet their key by a join on `row`, which must be unique and the same whenever the rows
    are read, as in a materialized table. It also settles ties and is dropped.
    """
    numbered = assign_keys(rows.select(row, *order), [*order, row], key, start).select(row, key)
    return rows.join(numbered, row).select(key, *[c for c in rows.columns if c != row])

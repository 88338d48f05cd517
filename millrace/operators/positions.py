"""Dense positions in a total order, without pulling a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import sized_join
from millrace.staging import stage

# Up to this rank Spark prunes a ranking window before its shuffle.
PRUNED_RANK = 1000
# A ranking is cut in so many parts of each group first.
PARTS = 64
_ROW_MASK = (1 << 33) - 1


def with_positions(
    df: DataFrame, group: Sequence[str], order: Sequence[str], *, name: str = "position"
) -> DataFrame:
    """Add the 0-based position of a row in its group, and ``group_size``.

    The rows are range partitioned by group and order and written with their place in
    the partition. The counts per (partition, group) give the offsets: at most
    partitions plus groups of them. A group holding a third of all rows is spread over
    a third of the partitions.
    """
    keys = [*group, *order]
    ranged = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))),
        "ranged",
    )
    scope = list(group) or [F.lit(0)]
    whole = Window.partitionBy(*scope)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part", *group)
        .agg(F.min("_row").alias("_start"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            *group,
            "_start",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("group_size"),
        )
    )
    return sized_join(ranged, offsets, ["_part", *group], null_safe=True).select(
        *df.columns,
        (F.col("_before") + F.col("_row") - F.col("_start")).alias(name),
        "group_size",
    )


def with_totals_before(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, *, name: str = "before"
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group, ranged like positions."""
    keys = [*group, *order]
    ranged = stage(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    whole = Window.partitionBy(*group).orderBy("_part")
    offsets = ranged.groupBy("_part", *group).agg(F.sum(value).alias("_sum")).select(
        "_part", *group,
        F.coalesce(
            F.sum("_sum").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    within = Window.partitionBy("_part", *group).orderBy(*order)
    earlier = F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, -1))
    summed = ranged.withColumn("_within", F.coalesce(earlier, F.lit(0)))
    return sized_join(summed, offsets, ["_part", *group], null_safe=True).select(
        *df.columns, (F.col("_offset") + F.col("_within")).alias(name)
    )


def first_n(
    df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, *, cap: Column | None = None
) -> DataFrame:
    """First ``n`` rows of each group; ``cap`` is a bound per row's group, of at most ``n``.

    A small ``n`` uses two ranking windows, which Spark prunes to ``n`` rows per task before each
    shuffle: one over parts of a group, then one over what they leave, so that no task gets
    more than ``PARTS * n`` rows of a hot group. A larger one uses positions. Null groups are
    groups.
    """
    if n <= 0:
        return df.limit(0)
    bound = F.lit(n) if cap is None else F.coalesce(cap, F.lit(n))
    if n <= PRUNED_RANK:
        part = F.pmod(F.xxhash64(*order), F.lit(PARTS))
        for keys in ([*group, "_part"], [*group]):
            rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            df = df.withColumn("_part", part).withColumn("_rank", rank)
            df = df.filter((F.col("_rank") <= n) & (F.col("_rank") <= bound)).drop("_part", "_rank")
        return df
    placed = with_positions(df, group, order)
    return placed.filter(F.col("position") < bound).select(*df.columns)

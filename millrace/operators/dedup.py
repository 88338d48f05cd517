"""Exact deduplication in which the first row of a total order survives.

Only narrow rows (key and order columns) are aggregated, with a partial aggregate
before the shuffle, so that a key owning a third of all rows reaches its reducer
as one row per map task. The wide rows are then filtered, never grouped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.joins import fits_broadcast, null_safe_join
from millrace.staging import stage


def first_order(order: Sequence[str]) -> Column:
    """Smallest order key of a group; a single column avoids the sort of a struct."""
    return F.min(order[0] if len(order) == 1 else F.struct(*order))


@dataclass(frozen=True)
class Repeats:
    """Keys that occur more than once, each with the order key of its first row."""

    table: DataFrame
    none: bool
    fit_broadcast: bool


def find_repeats(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], limit: int | None = None
) -> Repeats:
    """Aggregate, write and measure the repeated keys: one row per key however often it
    occurs."""
    table = stage(
        rows.groupBy(*key)
        .agg(first_order(order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") > 1)
        .drop("_copies"),
        "repeated-keys",
    )
    return Repeats(table, table.isEmpty(), fits_broadcast(table, limit))


def keep_first(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    *,
    rows: DataFrame | None = None,
    repeats: Repeats | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Keep the first row of each ``key`` in the total order ``order``.

    ``order`` identifies a row. When ``df`` has several rows per order key, such as the
    chunks of a file, ``rows`` gives one row for each of them. The repeated keys decide:

    * none: every row survives;
    * within the broadcast bound: each row looks up the first row of its key, and
      the wide side is not shuffled;
    * beyond it: semi join with the survivors on key and order. Copies do not share the
      order, so no partition is hot. The survivors are written once for all readers.

    Nulls follow one rule on all ways: a null key is a key like any other, and so is a null in
    the order (a single order column takes it after all values, several take it before).
    """
    narrow = df if rows is None else rows
    repeats = repeats or find_repeats(narrow, key, order, limit)
    if repeats.none:
        return df
    if repeats.fit_broadcast:
        own = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        return (
            null_safe_join(
                df, repeats.table.withColumn("_repeated", F.lit(True)), key, "left", broadcast=True
            )
            .filter(F.col("_repeated").isNull() | F.col("_first").eqNullSafe(own))
            .select(*df.columns)
        )
    first = stage(distinct_first(narrow, key, order), "survivors")
    return semi_join_survivors(df, first, [*key, *order])


def semi_join_survivors(df: DataFrame, first: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that are among the survivors. Spark sorts both sides, which can spill, unless it
    measures at run time that the narrow one is small."""
    return null_safe_join(df, first.select(*on), on, "left_semi")


def distinct_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """:func:`keep_first` for rows made of key and order columns only: one aggregate."""
    firsts = df.groupBy(*key).agg(first_order(order).alias("_first"))
    if len(order) == 1:
        return firsts.withColumnRenamed("_first", order[0])
    return firsts.select(*key, *[F.col(f"_first.{name}").alias(name) for name in order])
